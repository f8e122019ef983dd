"""Catalog tables with buckets, and distinct counts from bitmaps."""

import uuid

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from quarry.operators.distinct_bitmaps import distinct_counts, key_bitmaps
from quarry.plans.load import star_for
from quarry.plans.reports import (
    best_order_per_customer, customer_bitmaps, unique_customers_between, unique_customers_by_category,
)
from quarry.session import scratch_path
from quarry.sources.catalog import bucket_count, open_star, save_star


@pytest.fixture(scope="module")
def saved(spark):
    name = f"star_test_{uuid.uuid4().hex[:8]}"
    assert save_star(spark, star_for(spark, SMALL), name, scratch_path(spark, "catalog-test"))
    return name


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_reports_by_customer_do_not_exchange_the_fact(spark, saved):
    star = open_star(spark, saved)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(best_order_per_customer(star))
        # the bucketed customers join in place as well
        assert "hashpartitioning(customer_key" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 << 20))
    plan = plan_of(unique_customers_by_category(star))
    assert "customer_key" not in "".join(x for x in plan.split("\n") if "Exchange hashpartitioning" in x)


def test_same_rows_and_statistics(spark, saved):
    star, tables = star_for(spark, SMALL), open_star(spark, saved)
    for report in (best_order_per_customer, unique_customers_by_category):
        assert [tuple(r) for r in report(tables).collect()] == [tuple(r) for r in report(star).collect()]
    found = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {saved}.fact_sales").collect()}
    assert f"{star.fact_sales.count()} rows" in found["Statistics"] and found["Num Buckets"] == "8"
    column = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {saved}.fact_sales customer_key").collect()}
    assert int(column["distinct_count"]) > 0 and column["num_nulls"] == "0"
    got = spark.sql(f"SELECT f.channel, count(*) AS n FROM {saved}.fact_sales f JOIN {saved}.dim_store s "
                    "ON f.store_key = s.store_key GROUP BY f.channel").collect()
    assert sum(r.n for r in got) == star.fact_sales.count()


def test_hot_customer_is_saved_without_buckets(spark):
    star = star_for(spark, SMALL)
    hot = star.fact_sales.withColumn("customer_key", F.when(F.col("order_id") % 5 > 0, F.lit(7).cast("long")).otherwise(F.col("customer_key")))
    assert bucket_count(hot)[1] > 4
    name = f"star_test_{uuid.uuid4().hex[:8]}"
    from dataclasses import replace
    assert not save_star(spark, replace(star, fact_sales=hot), name, scratch_path(spark, "catalog-test"))
    assert open_star(spark, name).fact_sales.count() == hot.count()


def test_bitmaps_count_exactly_over_any_period(spark):
    star = star_for(spark, SMALL)
    bitmaps = customer_bitmaps(star)
    lines = star.fact_sales.join(star.dim_product.select("product_key", "category"), "product_key")
    for lo, hi in ((199501, 200112), (199803, 199807), (200012, 200012), (203001, 203012)):
        want = (lines.where(F.col("date_key").between(lo * 100, hi * 100 + 99)).groupBy("category")
                .agg(F.countDistinct("customer_key"), F.count("*")))
        assert sorted(map(tuple, unique_customers_between(bitmaps, lo, hi).collect())) == sorted(map(tuple, want.collect()))
    assert "order_id" not in plan_of(unique_customers_between(bitmaps, 199803, 199807))


def test_bitmaps_of_wide_and_null_keys(spark):
    df = spark.createDataFrame([("a", k) for k in (1, 2, 2, 32768, 32769, 100_000, 1 << 40, None)] + [("b", None)], "g string, k long")
    got = distinct_counts(key_bitmaps(df, ["g"], "k"), ["g"], "n", "rows").collect()
    assert [(r.g, r.n, r.rows) for r in got] == [("a", 6, 7)]
