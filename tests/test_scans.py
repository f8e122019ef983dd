"""Recursion, prefix scans, halos and order statistics: against plain Spark and plain Python."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.recursion import RecursionLimit, chains, month_series, recursive_union
from quarry.operators.scans import lags, moving_sums, running_sums
from quarry.operators.selection import order_statistics, percentile_cont, tile_bounds, tile_summary

rng = random.Random(3)
KEY = lambda r: tuple((x is None, x) for x in r)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=KEY)


# --- recursion -------------------------------------------------------------------------------------


def test_cyclic_hierarchy_ends(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 4), (5, 6), (None, 1)], "a long, b long")
    walk = edges.withColumnRenamed("a", "mid").withColumnRenamed("b", "end")
    step = lambda last: last.join(walk, F.col("b") == F.col("mid")).select("a", F.col("end").alias("b"))
    found = recursive_union(edges, step)
    want, graph = set(), {}
    for a, b in rows_of(edges):
        graph.setdefault(a, set()).add(b)
    for a in graph:
        todo = set(graph[a])
        while todo:
            want.add((a, b := todo.pop()))
            todo |= {c for c in graph.get(b, ()) if (a, c) not in want}
    assert rows_of(found) == sorted(want, key=KEY)
    with pytest.raises(RecursionLimit, match="after 20 rounds"):
        recursive_union(edges, step, all_rows=True, most_rounds=20)


def test_recursion_sees_only_the_last_round(spark):
    rounds = []

    def step(last):
        rounds.append(last.count())
        return last.where("n < 6").select((F.col("n") + 1).alias("n"), F.lit("x").alias("t"))

    anchor = spark.createDataFrame([(1, None), (1, None), (4, "x")], "n int, t string")
    assert rows_of(recursive_union(anchor, step)) == sorted([(1, None), *((n, "x") for n in (2, 3, 4, 5, 6))], key=KEY)
    assert rounds == [2, 2, 2, 1, 1][:len(rounds)]
    assert recursive_union(anchor, lambda df: df.where("false"), all_rows=True).count() == 3
    assert recursive_union(anchor.limit(0), step).count() == 0


def test_month_series(spark):
    months = [str(r.month_start) for r in month_series(spark, "1999-11-01", "2008-02-01").collect()]
    assert len(months) == 100 and months[:3] == ["1999-11-01", "1999-12-01", "2000-01-01"] and months[-1] == "2008-02-01"
    assert month_series(spark, "1999-11-01", "1999-11-01").count() == 1


def test_chains(spark):
    links = [(1, None), (2, 1), (3, 2), (9, None), (7, 9), (20, 21), (21, 20)]
    got = chains(spark.createDataFrame(links, "id long, prev long"), "id", "prev")
    assert rows_of(got) == [(1, 1, 1), (2, 1, 2), (3, 1, 3), (7, 9, 2), (9, 9, 1)]


# --- scans -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lines(spark):
    # one group holds most rows, others lie inside a range; ties, nulls in every column
    rows = [(None if i % 97 == 0 else "hot" if rng.random() < 0.6 else f"g{rng.randint(0, 40)}",
             None if i % 41 == 0 else rng.randint(0, 60), i, None if i % 13 == 0 else Decimal(rng.randint(-500, 900)) / 100)
            for i in range(4000)]
    return spark.createDataFrame(rows, "g string, t int, id long, v decimal(12,2)").repartition(5)


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("by", [["g"], []])
def test_running_sums_match_the_window(lines, many_ranges, by):
    window = Window.partitionBy(*by).orderBy(F.col("t").asc_nulls_last())
    plain = lines.select("*", F.sum("v").over(window).cast("decimal(38,2)").alias("s"))
    ours = running_sums(lines, by, ["t"], "v", "s").withColumn("s", F.col("s").cast("decimal(38,2)"))
    assert rows_of(ours) == rows_of(plain)


@pytest.mark.parametrize("by,k", [(["g"], 2), ([], 3), (["g"], 700)])
def test_moving_sums_match_the_window(lines, many_ranges, by, k):
    order = [F.col("t").asc_nulls_last(), F.col("id").asc_nulls_last()]
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(-k, 0)
    plain = lines.select("*", F.sum("v").over(window).alias("s"), F.count("v").over(window).alias("n"))
    assert rows_of(moving_sums(lines, by, ["t", "id"], "v", k, "s", "n")) == rows_of(plain)


@pytest.mark.parametrize("offset", [1, 5])
def test_lags_match_the_window(lines, many_ranges, offset):
    window = Window.partitionBy("g").orderBy(F.col("t").asc_nulls_last(), "id")
    plain = lines.select("*", F.lag("v", offset).over(window).alias("a"), F.lag("id", offset).over(window).alias("b"))
    assert rows_of(lags(lines, ["g"], ["t", "id"], {"v": "a", "id": "b"}, offset)) == rows_of(plain)


def test_scans_of_an_empty_table(lines):
    none = lines.limit(0)
    assert running_sums(none, ["g"], ["t"], "v", "s").count() == 0
    assert moving_sums(none, ["g"], ["t"], "v", 2, "s", "n").count() == 0


def test_no_window_over_all_rows(spark, lines):
    plan = lags(lines, [], ["t", "id"], {"v": "a"})._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "_q_pid" in plan.split("Window", 1)[1].split("\n")[0]


# --- order statistics ------------------------------------------------------------------------------


@pytest.mark.parametrize("values", [
    [7], [3, 3, 3, 3], list(range(-50, 51)), [rng.randint(-10**6, 10**6) for _ in range(3000)],
    [-(1 << 63), (1 << 63) - 1, 0, -1, 1], [5, None, 2, None, 9]])
def test_order_statistics_of_longs(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    held = sorted(v for v in values if v is not None)
    ranks = sorted({0, len(held) // 3, len(held) // 2, len(held) - 1})
    assert order_statistics(df, "v", ranks) == {r: held[r] for r in ranks}
    with pytest.raises(IndexError):
        order_statistics(df, "v", [len(held)])


def test_percentile_of_decimals(spark):
    values = [Decimal(rng.randint(0, 10**9)) / 100 for _ in range(2001)]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(38,2)")
    for p in (0.0, 0.3, 0.95, 1.0):
        assert percentile_cont(df, "v", p) == pytest.approx(df.agg(F.percentile(F.col("v").cast("double"), p)).first()[0], abs=1e-6)
    assert percentile_cont(df.limit(0), "v", 0.5) is None
    with pytest.raises(TypeError):
        order_statistics(df.select(F.col("v").cast("double")), "v", [0])


@pytest.mark.parametrize("n,tiles", [(0, 4), (1, 4), (3, 4), (10, 4), (1003, 4), (500, 7)])
def test_tile_summary_matches_ntile(spark, n, tiles):
    df = spark.createDataFrame([(i, Decimal(rng.randint(0, 60)) / 4) for i in range(n)], "id long, v decimal(38,2)")
    t = df.select("v", F.ntile(tiles).over(Window.orderBy(F.col("v").desc(), "id")).alias("t"))
    want = t.groupBy("t").agg(F.count("*"), F.min("v"), F.max("v"), F.sum("v"))
    got = [(x["tile"], x["count"], x["min"], x["max"], x["sum"]) for x in tile_summary(df, "v", tiles)]
    assert sorted(got) == rows_of(want)
    assert sum(e - a + 1 for a, e in tile_bounds(n, tiles)) == n
