"""Recursive queries as rounds of ordinary Spark jobs.

``WITH RECURSIVE t AS (anchor UNION [ALL] step(t))`` evaluates semi-naively: a
round gives ``step`` only the rows that the round before added, and the first
round without new rows is the last. Every round is a written table, so a lost
executor repeats one round's tasks and no plan grows with the number of rounds.

* :func:`recursive_union` -- any anchor and step. With UNION, rows that are
  already there are no news, so a recursion over a cycle ends; with UNION ALL, or
  a step that makes ever new values, ``most_rounds`` stops it with an error.
* :func:`recursive_sql` -- the same query as one SQL statement, run by Spark's own
  recursive CTE under a stated limit; for series whose rounds are a few rows, where
  a job a round would cost more than the work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

MOST_ROUNDS = 1000


class RecursionLimit(Exception):
    """A recursion still made rows after its last allowed round."""


def recursive_union(anchor: DataFrame, step: Callable[[DataFrame], DataFrame], all_rows: bool = False,
                    most_rounds: int = MOST_ROUNDS, name: str = "recursion") -> DataFrame:
    """The fixpoint of ``anchor`` and ``step``, stored.

    ``step`` takes the rows of the last round and returns rows with the anchor's
    column names; they are cast to its types, as SQL does. ``all_rows``: UNION ALL,
    else UNION (nulls are equal to each other). An empty anchor gives no rows.
    """
    spark, schema = anchor.sparkSession, anchor.schema
    base = scratch_path(spark, name)
    paths: list[str] = []

    def put(df: DataFrame) -> DataFrame:
        path = f"{base}/round={len(paths)}"
        df.write.parquet(path)
        paths.append(path)
        return spark.read.schema(schema).parquet(path)

    new = put(anchor if all_rows else anchor.distinct())
    while not new.isEmpty():
        if len(paths) > most_rounds:
            raise RecursionLimit(f"{name}: rows after {most_rounds} rounds")
        found = step(new)
        found = found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        # EXCEPT DISTINCT: an anti-join on null-safe equality with all rows so far
        new = put(found if all_rows else found.subtract(spark.read.schema(schema).parquet(*paths)))
    return spark.read.schema(schema).parquet(*paths)


def recursive_sql(spark: SparkSession, name: str, columns: str, anchor: str, step: str, most_rounds: int) -> DataFrame:
    """``WITH RECURSIVE name(columns) AS (anchor UNION ALL step) SELECT * FROM name``.

    Spark raises when a round after the ``most_rounds``-th is needed.
    """
    return spark.sql(f"WITH RECURSIVE {name}({columns}) MAX RECURSION LEVEL {int(most_rounds)} AS "
                     f"({anchor} UNION ALL {step}) SELECT * FROM {name}")


def month_series(spark: SparkSession, start: str, end: str) -> DataFrame:
    """``month_start``: ``start``, a month later, ... up to ``end``; at least ``start`` itself.

    The recursive member adds one month to the last round's row.
    """
    months = (int(end[:4]) - int(start[:4])) * 12 + int(end[5:7]) - int(start[5:7])
    return recursive_sql(
        spark, "months", "month_start", f"SELECT DATE'{start}'",
        f"SELECT CAST(month_start + INTERVAL 1 MONTH AS DATE) FROM months WHERE month_start < DATE'{end}'",
        max(months, 0) + 2)


def chains(links: DataFrame, node: str, before: str, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(node, first, position): each node's place in the chain it stands in.

    ``links``: one row per node with the node before it, null for the first of a
    chain. A round places the next node of every chain that still has one, so
    rounds are the longest chain; nodes on a cycle have no first and are left out.
    """
    kind = links.schema[node].dataType
    first = links.where(F.col(before).isNull()).select(
        F.col(node).alias("node"), F.col(node).alias("first"), F.lit(1).cast("long").alias("position"))
    following = links.where(F.col(before).isNotNull()).select(F.col(node).alias("next"), F.col(before).cast(kind).alias("node"))

    def step(last: DataFrame) -> DataFrame:
        return last.join(following, "node").select(F.col("next").alias("node"), "first", (F.col("position") + 1).alias("position"))

    # a node has one predecessor, so no round can meet an earlier row again
    return recursive_union(first, step, all_rows=True, most_rounds=most_rounds, name="chains")
