"""Surrogate keys, distributed orderings, SCD1, insert-only merge, calendar."""

import datetime as dt
from dataclasses import replace

import pytest
from conftest import SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.modeling import (
    assign_surrogate_keys, dim_date_between, insert_only_merge, scd1_merge,
)
from quarry.operators.ordering import (
    exact_percentile_cont, global_lead, global_ranks, global_row_number, ntile_of,
)
from quarry.operators.quality import ConstraintViolation
from quarry.session import scratch_path


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 1000).alias("v"), "id")
    ours = global_row_number(df, [F.col("v").desc(), F.col("id")], out="rn")
    plain = df.select("v", "id", F.row_number().over(Window.orderBy(F.col("v").desc(), "id")).alias("rn"))
    assert sorted(map(tuple, ours.select("v", "id", "rn").collect())) == sorted(map(tuple, plain.collect()))


def test_ntile_matches_builtin(spark):
    for n in (1, 3, 4, 5, 17, 50):
        df = spark.range(n)
        plain = df.select("id", F.ntile(4).over(Window.orderBy("id")).alias("t"))
        ours = df.select("id", ntile_of(F.col("id") + 1, F.lit(n), 4).alias("t"))
        assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect())), n


def test_exact_percentile(spark):
    df = spark.range(0, 1001, numPartitions=5).select(((F.col("id") * 37) % 1001 / 3).alias("x"))
    ours = exact_percentile_cont(df, "x", 0.95, out="p").first().p
    ref = df.agg(F.percentile("x", 0.95).alias("p")).first().p
    assert abs(ours - ref) < 1e-9


def test_surrogate_keys_dense_and_ordered(spark):
    df = spark.createDataFrame([(30,), (10,), (20,)], "nid long")
    rows = assign_surrogate_keys(df, "nid", "k", start_after=5).orderBy("k").collect()
    assert [(r.k, r.nid) for r in rows] == [(6, 10), (7, 20), (8, 30)]


def test_scd1_merge(spark):
    ts = dt.datetime(2020, 1, 1)
    existing = spark.createDataFrame([(1, 10, "a", "x", ts), (2, 20, "b", "y", ts)],
                                     "k long, nid long, name string, city string, loaded_at timestamp")
    incoming = spark.createDataFrame([(20, "B", None), (30, "c", "z")], "nid long, name string, city string")
    merged = scd1_merge(existing, incoming, "nid", "k", ["name", "city"])
    got = {r.nid: (r.k, r.name, r.city, r.loaded_at == ts) for r in merged.collect()}
    assert got == {10: (1, "a", "x", True), 20: (2, "B", None, True), 30: (3, "c", "z", False)}
    again = scd1_merge(merged, incoming, "nid", "k", ["name", "city"])
    assert sorted((r.k, r.nid, r.name, r.city) for r in again.collect()) == \
        sorted((r.k, r.nid, r.name, r.city) for r in merged.collect())


def test_insert_only_merge_keeps_existing(spark):
    existing = spark.createDataFrame([(1, "old")], "id long, v string")
    incoming = spark.createDataFrame([(1, "new"), (2, "two")], "id long, v string")
    got = sorted(map(tuple, insert_only_merge(existing, incoming, "id").collect()))
    assert got == [(1, "old"), (2, "two")]


def test_dim_date_has_every_day(spark):
    d = dim_date_between(spark, "2023-01-01", "2025-12-31")
    assert d.count() == 1096
    assert d.select("date_key").distinct().count() == 1096


def test_ranks_and_lead_match_windows(spark):
    df = spark.range(0, 3000, numPartitions=5).select(
        (F.col("id") * 31 % 40).alias("v"), (F.col("id") % 3).alias("g"), "id")
    plain = df.select("v", "g", "id", F.rank().over(Window.orderBy(F.col("v").desc())).alias("r"),
                      F.dense_rank().over(Window.orderBy(F.col("v").desc())).alias("d"))
    ours = global_ranks(df, "v", rank="r", dense_rank="d")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))
    plain = df.select("v", "g", "id", F.lead("v").over(Window.partitionBy("g").orderBy("v", "id")).alias("n"))
    ours = global_lead(df, "g", ["v", "id"], "v", "n")
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, ours.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)


def test_equal_rows_spread_over_the_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(200_000).select(F.lit(7).alias("v"))
        numbered = global_row_number(df, [F.col("v")], out="rn")
        sizes = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 6 and max(sizes) < 60_000
    assert numbered.agg(F.min("rn"), F.max("rn"), F.countDistinct("rn")).first()[:] == (1, 200_000, 200_000)


def test_merge_refuses_repeated_and_null_ids(spark):
    schema = "k long, nid long, name string, loaded_at timestamp"
    existing = spark.createDataFrame([(1, 10, "a", dt.datetime(2020, 1, 1))], schema)
    for rows in ([(20, "x"), (20, "y")], [(None, "x")]):
        with pytest.raises(ConstraintViolation):
            scd1_merge(existing, spark.createDataFrame(rows, "nid long, name string"), "nid", "k", ["name"])


def _source(spark, **changes):
    from quarry.plans.load import Source
    from quarry.sources.tables import TableSet
    from quarry.sources.tpch_star import customer_source, order_lines, product_source, store_source
    t = TableSet(spark, SMALL)
    src = Source(customer_source(t), product_source(t), store_source(t), order_lines(t))
    return replace(src, **{k: f(getattr(src, k)) for k, f in changes.items()})


def test_repeated_product_stops_the_load(spark):
    from quarry.plans.load import run_load
    twice = lambda df: df.union(df.limit(1))
    with pytest.raises(ConstraintViolation, match="dim_product.unique:product_id: 2"):
        run_load(spark, _source(spark, products=twice), scratch_path(spark, "wh-test"))


def test_order_outside_the_calendar_stops_the_load(spark):
    from quarry.plans.load import run_load
    with pytest.raises(ConstraintViolation, match="fact_sales.foreign_key:date_key"):
        run_load(spark, _source(spark), scratch_path(spark, "wh-test"), calendar=("1995-01-01", "1995-12-31"))
    far = lambda df: df.withColumn("order_date", F.when(F.col("order_id") == 1, F.lit("9999-12-31").cast("date"))
                                   .otherwise(F.col("order_date")))
    with pytest.raises(ConstraintViolation, match="state the calendar range"):
        run_load(spark, _source(spark, orders=far), scratch_path(spark, "wh-test"))


def test_versions_change_only_when_a_load_passes(spark):
    from quarry.plans.load import current, published, refresh
    wh = scratch_path(spark, "wh-test")
    assert current(spark, wh) is None
    first = refresh(spark, wh, _source(spark, products=lambda df: df.where("product_id % 2 = 0")))
    assert current(spark, wh).location == first.location and first.skipped_rows > 0
    with pytest.raises(ConstraintViolation):
        refresh(spark, wh, _source(spark, products=lambda df: df.union(df)))
    assert current(spark, wh).location == first.location
    again = refresh(spark, wh, _source(spark))
    now = current(spark, wh)
    assert now.location == again.location and now.skipped_rows == 0 and published(spark, wh).count() == 2
    old = {r.product_id: r.product_key for r in first.dim_product.collect()}
    new = {r.product_id: r.product_key for r in now.dim_product.collect()}
    assert old.items() <= new.items() and len(set(new.values())) == len(new)


def test_empty_batch(spark):
    from quarry.plans.ingest import run_ingest
    from quarry.plans.load import run_load
    from quarry.sources.tpch_star import raw_tables
    raw = raw_tables(spark, SMALL)
    raw.orders = raw.orders.limit(0)
    silver = run_ingest(spark, raw, scratch_path(spark, "silver-test"))
    assert silver.orders.count() == silver.quarantine.count() == 0
    star = run_load(spark, silver, scratch_path(spark, "wh-test"), calendar=("2000-01-01", "2000-12-31"))
    assert star.fact_sales.count() == star.skipped_rows == 0 and star.dim_date.count() == 366


def test_orphan_lines_leave_the_listing_whole(spark):
    from quarry.plans.load import run_load
    from quarry.plans.reports import customers_without_orders, order_details, products_never_sold, recent_orders
    star = run_load(spark, _source(spark), scratch_path(spark, "wh-test"))
    assert customers_without_orders(star).count() == products_never_sold(star).first()[0] == 0
    lost = star.fact_sales.orderBy("order_id").limit(10)
    hit = [r.customer_key for r in lost.select("customer_key").distinct().collect()]
    star.dim_customer = star.dim_customer.where(~F.col("customer_key").isin(hit))
    assert order_details(star).count() == recent_orders(star).count() == 10
    busy = star.fact_sales.where(F.col("customer_key") > 5)
    star.fact_sales = busy
    assert customers_without_orders(star, n=100).count() == star.dim_customer.where("customer_key <= 5").count()


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    from quarry import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, path):
            self.path = path

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: Session.named)

    Session.named = None
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session)
    Session.named = "hdfs://shared/ckpt"
    assert session.ensure_checkpoint_dir(Session) == "hdfs://shared/ckpt"
    Session.named, Context.master = None, "local[4]"
    assert "quarry-ckpt-" in session.ensure_checkpoint_dir(Session)


def test_load_job_first_load_and_reload(spark):
    from conftest import SMALL
    from quarry.plans.ingest import silver_for
    from quarry.plans.load import run_load
    from quarry.session import scratch_path
    silver = silver_for(spark, SMALL)
    first = run_load(spark, silver, scratch_path(spark, "wh-test"))
    again = run_load(spark, silver, scratch_path(spark, "wh-test"), previous=first)
    assert first.fact_sales.count() == silver.orders.count() == again.fact_sales.count()
    keys = lambda s: sorted(map(tuple, s.dim_customer.select("customer_key", "customer_id").collect()))
    assert keys(first) == keys(again)
    assert first.fact_sales.select("sale_id").distinct().count() == first.fact_sales.count()
