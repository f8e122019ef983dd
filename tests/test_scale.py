"""Steps whose tasks and exchanges must not grow faster than the tables: rows of their own."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.modeling import keyed_lines, looked_up_lines, priced_lines
from quarry.plans.ingest import run_ingest
from quarry.plans.load import load_star
from quarry.plans.reports import all_moving_averages, all_previous_lines
from quarry.sources import tpch_star
from quarry.sources.tables import TableSet
from quarry.sources.tpch_star import order_headers, order_items, order_lines, raw_tables


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """TPC-H-like tables with orphans, repeated and null keys and a price too large for a revenue."""
    rng, folder = random.Random(5), str(tmp_path_factory.mktemp("tables"))
    day = lambda: dt.datetime(1996, 1, 1) + dt.timedelta(days=rng.randrange(700))
    rows = {
        "region": ("r_regionkey int, r_name string", [(0, "R")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(i, f"NATION_{i}", 0) for i in range(3)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
                     [(i, f"Customer#{i:09d}", i % 3, "SEG") for i in range(1, 40)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(i, f"Supplier#{i}", i % 3) for i in range(1, 9)]),
        "part": ("p_partkey long, p_name string, p_type string, p_retailprice double",
                 [(i, f"part {i}", "ECONOMY", 99999999.0 if i == 7 else 10.5 * i) for i in range(1, 30)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string",
                   [(None if i % 50 == 0 else i - i % 60 // 59, None if i % 23 == 0 else rng.randint(1, 42), day(), "1-URGENT")
                    for i in range(1, 300)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_quantity double",
                     [(rng.choice([None, *range(1, 300)]), rng.choice([None, *range(1, 32)]), rng.choice([None, *range(1, 10)]),
                       float(rng.choice([1, 2, 50, 5000]))) for _ in range(2000)]),
    }
    for name, (schema, found) in rows.items():
        spark.createDataFrame(found, schema).write.parquet(f"{folder}/{name}.parquet")
    return TableSet(spark, folder)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_tasks_of_the_order_join_grow_with_the_lines(tables, monkeypatch):
    plain = rows_of(order_lines(tables))
    monkeypatch.setattr(tpch_star, "BYTES_A_TASK", 500)
    tasks = tpch_star.join_tasks(tables)
    assert tasks > 12 and order_lines(tables).rdd.getNumPartitions() == tasks
    assert plain and rows_of(order_lines(tables)) == plain
    assert tpch_star.join_tasks(TableSet(tables.spark, tables.data_dir + "/none")) is None


def test_ingest_of_dealt_lines_is_the_same(spark, tables, tmp_path, monkeypatch):
    found = []
    for size in (8 << 20, 500):
        monkeypatch.setattr(tpch_star, "BYTES_A_TASK", size)
        silver = run_ingest(spark, raw_tables(spark, tables.data_dir), str(tmp_path / str(size)))
        found.append((rows_of(silver.orders), rows_of(silver.quarantine), silver.rows_in, silver.rows_clean))
    assert found[0] == found[1] and found[0][0] and found[0][1]


def test_lookups_by_order_equal_lookups_by_line(spark, tables):
    key = lambda df, old, new: df.select(F.col(old).alias(new)).withColumn(new.replace("_id", "_key"), F.col(new) + 100)
    c, s = key(tables.customer, "c_custkey", "customer_id"), key(tables.supplier, "s_suppkey", "store_id")
    p = key(tables.part.withColumnRenamed("p_retailprice", "unit_price"), "p_partkey", "product_id").join(
        tables.part.select(F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("unit_price")), "product_id")
    want = rows_of(looked_up_lines(order_lines(tables), c, p, s))
    for tasks in (None, 11):
        assert rows_of(priced_lines(keyed_lines(order_items(tables), c, p, s, order_headers(tables), tasks))) == want
    assert len(want) > 1500


def test_natural_keys_are_stored_for_skipped_lines_only(spark, tables):
    star = load_star(spark, tables.data_dir)
    ids = ["customer_id", "product_id", "store_id"]
    lines = spark.read.parquet(f"{star.location}/fact_lines")
    assert lines.where("not skipped").agg(*[F.count(c) for c in ids]).first() == (0, 0, 0)
    raw = order_lines(tables)
    assert lines.count() == raw.count() and star.skipped_rows == star.skipped.count() > 100
    known = (raw.join(tables.customer, F.col("customer_id") == F.col("c_custkey"), "left")
             .join(tables.part, F.col("product_id") == F.col("p_partkey"), "left")
             .join(tables.supplier, F.col("store_id") == F.col("s_suppkey"), "left"))
    large = F.coalesce(F.col("quantity") * F.col("p_retailprice") >= 1e10, F.lit(False))
    lost = known.where("c_custkey is null or p_partkey is null or s_suppkey is null" ).select("order_id", *ids)
    lost = lost.unionByName(known.where("c_custkey + p_partkey + s_suppkey is not null").where(large).select("order_id", *ids))
    assert rows_of(star.skipped.select("order_id", *ids)) == rows_of(lost)


def test_lines_with_a_number_are_not_written_for_tie_breakers(spark, tables, monkeypatch):
    import quarry.operators.ordering as ordering
    star, plain, written = load_star(spark, tables.data_dir), ordering.scratch_path, []
    monkeypatch.setattr(ordering, "scratch_path", lambda s, name: written.append(name) or plain(s, name))
    w = Window.partitionBy("customer_key").orderBy(
        *[F.col(c).asc_nulls_last() for c in ("date_key", "order_id", "product_key", "store_key", "quantity", "revenue")])
    got = all_previous_lines(star).select("customer_key", "order_id", "revenue", "previous_revenue", "previous_date_key")
    want = star.fact_sales.select("customer_key", "order_id", "revenue", F.lag("revenue").over(w).alias("previous_revenue"),
                                  F.lag("date_key").over(w).alias("previous_date_key"))
    assert rows_of(got) == rows_of(want)
    mean = F.avg("revenue").over(w.rowsBetween(-2, 0))
    near = all_moving_averages(star).select("order_id", F.round(F.col("moving_avg").cast("double"), 1).alias("m"))
    assert near.count() == star.fact_sales.count() and near.agg(F.sum("m")).first()[0] == pytest.approx(
        star.fact_sales.select(mean.cast("double").alias("m")).agg(F.sum("m")).first()[0], rel=1e-4)
    assert not written
