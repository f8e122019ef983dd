"""COUNT(DISTINCT key) that adds up: bitmaps of surrogate keys.

Distinct counts of parts don't add up, bitmaps of the keys do: the bitmaps of the
months of a year, or-ed, count the year's distinct keys exactly. Keys are whole
numbers from 1, dense or nearly so (surrogate keys); each 32,768 of them share one
bitmap of 4 KB. Stored bitmaps are read for any period in place of the fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_bitmaps(df: DataFrame, by: list[str | Column], key: str) -> DataFrame:
    """by columns, ``bucket``, ``keys`` (bitmap) and ``rows``: one row for each group and bucket with keys.

    Null keys are left out, as COUNT(DISTINCT) does. Bitmaps are merged in the tasks
    before the shuffle, so a group of any size is a few rows a task.
    """
    return (df.where(F.col(key).isNotNull())
            .groupBy(*by, F.bitmap_bucket_number(key).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("keys"), F.count(F.lit(1)).alias("rows")))


def distinct_counts(bitmaps: DataFrame, by: list[str], out: str, rows_out: str | None = None) -> DataFrame:
    """Exact distinct keys (and rows) of each coarser group ``by``."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("keys").alias("keys"), F.sum("rows").alias("rows"))
    aggs = [F.sum(F.bitmap_count("keys")).alias(out)]
    if rows_out:
        aggs.append(F.sum("rows").alias(rows_out))
    return merged.groupBy(*by).agg(*aggs)
