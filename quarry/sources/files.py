"""Scans and sinks: CSV with explicit schemas, Parquet, quarantine, full refresh.

Schemas are always given (no inference pass). Sinks write whole directories in
one job; a path that is being read is never overwritten in the same job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RAW_SCHEMAS = {
    "customers": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("signup_date", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
    ]),
    "products": T.StructType([
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
    ]),
    "stores": T.StructType([
        T.StructField("store_id", T.LongType()),
        T.StructField("store_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
    ]),
    # quantity is a nullable 64-bit integer; the date stays text until cleaned
    "orders": T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("store_id", T.LongType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("channel", T.StringType()),
    ]),
}


CORRUPT_RECORD = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Headered CSV with a declared schema; an empty field reads as null.

    A line with a value that doesn't fit its type keeps its text in
    ``_corrupt_record`` (null for good lines), so a malformed value is never
    taken for a missing one.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT_RECORD, T.StringType())])
    return (spark.read.schema(wide).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_RECORD).option("encoding", "UTF-8").csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite ``path`` with ``df`` (parent folders are created by the writer)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def stored(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` and read it back with its schema, which also works without rows."""
    write_parquet(df, path, partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def full_refresh_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str],
                      batch_size: int = 5000) -> None:
    """Replace the rows of a relational table: TRUNCATE (keeps the DDL) and
    batched INSERTs from every partition in parallel."""
    (df.write.mode("overwrite").option("truncate", True).option("batchsize", batch_size)
       .jdbc(url, table, properties=properties))
