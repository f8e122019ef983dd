"""Every registered query against its DuckDB oracle on sf0.001, plus plan checks."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from quarry.oracle import oracle_queries
from quarry.plans.registry import registry
from conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem".split()
QUERIES = registry()
ORACLE = oracle_queries()
FRAMES = {}


def frame(spark, name):
    """The query's result, built once for the tests that look at it (several queries run jobs to build it)."""
    if name not in FRAMES:
        FRAMES[name] = QUERIES[name](spark, SMALL)
    return FRAMES[name]


def _canon(v):
    if isinstance(v, decimal.Decimal):
        return f"D{v}"
    if isinstance(v, float):
        return f"F{v!r}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = frame(spark, name)
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, df.collect()) == _rows(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0


def test_window_form_of_first_last_equals_group_form(spark):
    from quarry.plans.reports import first_last_order, first_last_order_window
    from quarry.plans.load import star_for
    star = star_for(spark, SMALL)
    a = sorted(map(tuple, first_last_order(star).collect()))
    b = sorted(map(tuple, first_last_order_window(star).collect()))
    assert a == b


def test_store_pairs_equal_brute_force(spark):
    from pyspark.sql import functions as F
    from quarry.plans.reports import store_pairs_same_country
    from quarry.plans.load import star_for
    star = star_for(spark, SMALL)
    s = star.dim_store
    brute = (s.alias("a").join(s.alias("b"), (F.col("a.country") == F.col("b.country"))
                               & (F.col("a.store_key") < F.col("b.store_key")))
             .orderBy("a.country", "a.store_key", "b.store_key").limit(15)
             .select(F.col("a.store_name").alias("store_a"), F.col("b.store_name").alias("store_b"),
                     F.col("a.country").alias("country")))
    assert [tuple(r) for r in store_pairs_same_country(star).collect()] == [tuple(r) for r in brute.collect()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cartesian_or_python_udf(spark, name):
    plan = frame(spark, name)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_sql_over_registered_views(spark):
    from quarry.plans.reports import revenue_by_channel
    from quarry.plans.load import star_for
    from quarry.sources.tpch_star import register_star_views
    star = star_for(spark, SMALL)
    register_star_views(star)
    got = spark.sql("""
        SELECT channel, count(*) AS num_orders, CAST(SUM(revenue) AS DECIMAL(38,2)) AS total_revenue
        FROM fact_sales GROUP BY channel""").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, revenue_by_channel(star).collect()))
