"""The star as tables of the session's catalog, with statistics and buckets.

The fact and the customers are bucketed by the customer key into the same number of
buckets: aggregations, windows and joins by customer need no exchange of the fact.
Collected statistics (rows, sizes, column ranges) go to the optimiser, which then
chooses join sides and orders from them.

A bucket is read by one task. Where one customer holds much of the fact, its bucket
would be that task; the buckets are counted first, and a fact whose largest bucket
has more than ``MOST_SHARE`` times the mean is saved without buckets, so that
Spark's skew handling deals with the key as in any other shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.tpch_star import Star

ROWS_A_BUCKET = 2_000_000
LEAST_BUCKETS = 8
MOST_SHARE = 4.0
KEY = "customer_key"
TABLES = ("dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales")


def bucket_count(fact: DataFrame, least: int = LEAST_BUCKETS, rows_a_bucket: int = ROWS_A_BUCKET) -> tuple[int, float]:
    """(number of buckets for the fact, rows of the largest one over the mean)."""
    n = least
    rows = fact.count()
    while n * rows_a_bucket < rows:
        n *= 2
    # Spark's bucket of a key is the same hash
    sizes = fact.groupBy(F.pmod(F.hash(KEY), F.lit(n)).alias("b")).agg(F.count(F.lit(1)).alias("c"))
    largest = sizes.agg(F.max("c")).first()[0] or 0
    return n, largest * n / rows if rows else 1.0


def save_star(spark: SparkSession, star: Star, database: str, location: str,
              rows_a_bucket: int = ROWS_A_BUCKET) -> bool:
    """Save the star as tables of ``database`` below ``location``; whether the fact is bucketed."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    buckets, share = bucket_count(star.fact_sales, rows_a_bucket=rows_a_bucket)
    bucketed = share <= MOST_SHARE
    for name in TABLES:
        df = getattr(star, name)
        if bucketed and KEY in df.columns:
            # one file a bucket, and more where Spark splits a large one
            dealt = df.withColumn("_q_bucket", F.pmod(F.hash(KEY), F.lit(buckets))).hint("rebalance", F.col("_q_bucket"))
            writer = dealt.drop("_q_bucket").write.bucketBy(buckets, KEY).sortBy(KEY)
        else:
            writer = df.write
        writer.mode("overwrite").option("path", f"{location}/{name}").saveAsTable(f"{database}.{name}")
        spark.sql(f"ANALYZE TABLE {database}.{name} COMPUTE STATISTICS FOR ALL COLUMNS")
    return bucketed


def open_star(spark: SparkSession, database: str) -> Star:
    """The star that :func:`save_star` has saved."""
    return Star(*[spark.table(f"{database}.{name}") for name in TABLES])
