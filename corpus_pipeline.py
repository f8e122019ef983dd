"""Training-data pipeline over ``documents``.

Stages, in order: quality rules (rejected documents go), SimHash near-dedup (one
document of each group stays), secret scans (reported spans are replaced by
their kind), mixing to target weights (every document is repeated by its whole
number of copies; no language has to shrink), byte-level BPE (token counts and
digests of the encoded and decoded text). All stages but the last return the
columns of ``documents``.

``ORACLE_SQL`` is None: learned rules, fingerprints and BPE have no SQL form;
``tests/llm`` holds the stages against brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import byte_bpe, mixing, quality_rules, secrets, simhash
from quarry.llm.common import staged, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, mixing.domain_labels(docs, table(spark, sf_dir, "labels")))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good_documents),
    ("simhash_near_dedup", distinct_documents),
    ("secret_scans", without_secrets),
    ("mixing", mixed),
    ("byte_bpe", tokenised),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written and read again before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
