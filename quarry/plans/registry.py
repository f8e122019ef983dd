"""Name -> callable(spark, data_dir) for every registered query."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.plans.etl_queries import ETL_QUERIES
from quarry.plans.load import star_for
from quarry.plans.reports import REPORTS
from quarry.session import scratch_path
from quarry.sources.catalog import open_star, save_star

#: Reports that are registered once more over catalog tables.
CATALOG_REPORTS = ("best_order_per_customer", "unique_customers_by_category")


def _report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = REPORTS[name]

    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        return fn(star_for(spark, data_dir))

    run.__name__ = name
    run.__doc__ = fn.__doc__
    return run


_CATALOGS: dict[str, str] = {}  # location of a star -> database


def _catalog_report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = REPORTS[name]

    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        star = star_for(spark, data_dir)
        database = _CATALOGS.get(star.location)
        if database is None or not spark.catalog.databaseExists(database):
            database = f"star_{uuid.uuid4().hex[:12]}"
            save_star(spark, star, database, scratch_path(spark, "catalog"))
            _CATALOGS[star.location] = database
        return fn(open_star(spark, database))

    run.__name__ = f"catalog_{name}"
    run.__doc__ = f"S5: {name} over bucketed, analysed catalog tables."
    return run


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name in REPORTS:
        out[name] = _report(name)
    for name in CATALOG_REPORTS:
        out[f"catalog_{name}"] = _catalog_report(name)
    out.update(ETL_QUERIES)
    return out
