"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

#: A word: a run of characters other than space, tab, LF, VT, FF, CR.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: later jobs reread the files, also after an executor is
    lost. Reading with the written schema makes empty tables work.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(col), F.lit(""))


def framed(docs: DataFrame, *more: Column) -> DataFrame:
    """The rows as one struct ``_doc`` beside ``more`` columns: their names can't clash with working columns."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *more)


def unframed(names: list[str]) -> list[Column]:
    """The columns of ``_doc``."""
    return [F.col("_doc").getField(c).alias(c) for c in names]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_BREAK, -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def id_bucket(n: int, col: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (the split of the labels)."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n))


def literals(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
