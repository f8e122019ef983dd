"""Parquet table access for a data directory (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


class TableSet:
    """Named lazy scans over one directory."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.data_dir, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

