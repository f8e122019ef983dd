"""Queries of this package: name -> callable(spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import (alignment, byte_bpe, html_text, language_id, mixing, permutation_index, quality_rules,
                        secrets, simhash, spelling, token_files, toxicity, winnowing)
from quarry.llm.common import table


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mixing_plan(docs, mixing.domain_labels(docs, table(spark, sf_dir, "labels")))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.neighbours(table(spark, sf_dir, "embeddings"))


def op10_simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_dups(table(spark, sf_dir, "documents"))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secret_scans, op2_language_id, op3_quality_rules, op4_byte_bpe, op5_token_files,
        op6_html_text, op7_toxicity, op8_mixing, op9_nearest_neighbours, op10_simhash_near_dups, op11_winnowing,
        op12_token_alignment, op13_spelling_variants, pipeline)}
SQL: dict[str, str] = {}
