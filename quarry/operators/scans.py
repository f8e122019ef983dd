"""Running sums, moving frames and LAG over whole tables.

A window function orders a whole group in one task, and a window without
``PARTITION BY`` orders all rows in one. These forms work on the ranges of a
stored total order (:func:`~quarry.operators.ordering.numbered_ranges`), whose
size doesn't depend on how rows fall into groups:

* a running sum is a segmented prefix scan: sums inside a range, plus what the
  same group has in the ranges before (one row a range);
* a frame of the k rows before is worked out inside a range that also gets the k
  rows before it (its halo: at most k copied rows a range).

Orders are ascending, nulls last; null group keys form one group.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quarry.operators.ordering import numbered_ranges

_PID, _RN = "_q_pid", "_q_rn"


def _sort(by: list[str], order_cols: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in [*by, *order_cols]]


def running_sums(df: DataFrame, by: list[str], order_cols: list[str], value: str, out: str) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY by ORDER BY order_cols)`` for every row of ``df``.

    The default frame: rows that tie on the order columns share the sum up to the
    last of them. Ties are summed first, so a key that many rows share is one row
    in the scan; nulls count as in SUM (null while no value was met).
    """
    keys = [*by, *order_cols]
    peers = df.groupBy(*keys).agg(F.sum(value).alias("_q_v"))
    rows, ranges = numbered_ranges(peers, _sort(by, order_cols), out=_RN, unique=True)
    inside = F.sum("_q_v").over(Window.partitionBy(_PID, *by).orderBy(_RN).rowsBetween(Window.unboundedPreceding, 0))
    # a group goes on in the next range only if it reaches the end of its own
    parts = rows.groupBy(_PID, *by).agg(F.sum("_q_v").alias("_q_t"), F.min(_RN).alias("_q_lo"), F.max(_RN).alias("_q_hi"))
    edges = parts.join(F.broadcast(ranges), _PID).select(
        _PID, *by, "_q_lo", "_q_hi", "_q_off", F.when(F.col("_q_hi") == F.col("_q_off") + F.col("_q_n"), F.col("_q_t")).alias("_q_t"))
    edges = edges.where((F.col("_q_lo") == F.col("_q_off") + 1) | F.col("_q_t").isNotNull())
    # at most two rows a range
    before = Window.partitionBy(*by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    heads = (edges.withColumn("_q_carry", F.sum("_q_t").over(before)).where(F.col("_q_lo") == F.col("_q_off") + 1)
             .select(_PID, F.col("_q_hi").alias("_q_head"), "_q_carry"))
    carry = F.when(F.col(_RN) <= F.col("_q_head"), F.col("_q_carry"))
    own = F.col("_q_in")
    total = F.when(carry.isNull(), own).when(own.isNull(), carry).otherwise(own + carry)
    summed = (rows.withColumn("_q_in", inside).join(F.broadcast(heads), _PID)
              .select(*[F.col(k).alias(f"_q_k{i}") for i, k in enumerate(keys)], total.alias(out)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_q_k{i}")) for i, k in enumerate(keys)])
    return df.join(summed, same).select(*df.columns, out)


def over_rows_before(df: DataFrame, by: list[str], order_cols: list[str], k: int,
                     outs: Callable[[WindowSpec], dict[str, Column]], tie: str | None = None) -> DataFrame:
    """Adds columns that look at a row and at most the ``k`` rows before it in its group.

    ``outs`` gets the window (partitioned and ordered, no frame) and names the new
    columns. Rows that tie on all order columns stand in the order of the stored number
    ``tie``, which no two rows share; without one, in an arbitrary but stored order
    (which takes a write of all rows).
    """
    rows, ranges = numbered_ranges(df, _sort(by, [*order_cols, *([tie] if tie else [])]), out=_RN, unique=tie is not None)
    first = ranges.select(F.col(_PID).alias("_q_to"), (F.col("_q_off") + 1).alias("_q_first"))
    last = ranges.select(_PID, (F.col("_q_off") + F.col("_q_n")).alias("_q_end"))
    # the last k rows of a range belong to the halo of every range that begins within k rows after them
    halo = (rows.join(F.broadcast(last), _PID).where(F.col("_q_end") - F.col(_RN) < k).drop(_PID, "_q_end")
            .withColumn("_q_first", F.explode(F.sequence(F.col(_RN) + 1, F.col(_RN) + k)))
            .join(F.broadcast(first), "_q_first").withColumnRenamed("_q_to", _PID))
    columns = [*df.columns, _PID, _RN]
    both = (rows.select(*columns, F.lit(False).alias("_q_halo"))
            .unionByName(halo.select(*columns, F.lit(True).alias("_q_halo"))))
    window = Window.partitionBy(_PID, *by).orderBy(_RN)
    return (both.select("*", *[c.alias(name) for name, c in outs(window).items()])
            .where(~F.col("_q_halo")).drop(_PID, _RN, "_q_halo"))


def moving_sums(df: DataFrame, by: list[str], order_cols: list[str], value: str, preceding: int,
                sum_out: str, count_out: str, tie: str | None = None) -> DataFrame:
    """SUM and COUNT of ``value`` over ROWS BETWEEN ``preceding`` PRECEDING AND CURRENT ROW."""
    return over_rows_before(df, by, order_cols, preceding, lambda w: {
        sum_out: F.sum(value).over(w.rowsBetween(-preceding, 0)),
        count_out: F.count(value).over(w.rowsBetween(-preceding, 0))}, tie)


def lags(df: DataFrame, by: list[str], order_cols: list[str], values: dict[str, str], offset: int = 1,
         tie: str | None = None) -> DataFrame:
    """``LAG(value, offset)`` for every row; ``values``: column -> name of its lag."""
    return over_rows_before(df, by, order_cols, offset, lambda w: {
        out: F.lag(c, offset).over(w) for c, out in values.items()}, tie)
