"""Global orderings that stay distributed.

A window with ``ORDER BY`` and no ``PARTITION BY`` moves every row into one
task. Reports that number, rank or tile all rows of a large input use these
helpers instead:

* :func:`global_row_number` -- give rows a stored unique tie breaker, sort once
  (range exchange, split points sampled on the full key, so equal rows are split
  as well), checkpoint the sorted partitions to the shared checkpoint folder so a
  re-run cannot draw other split points, count rows per partition (one row per
  partition, broadcast), and add the running offset to the position inside the
  partition.
* :func:`global_ranks` -- RANK and DENSE_RANK without a window over all rows: the
  distinct values are numbered, each with the rows before it, and joined back.
* :func:`global_lead` -- LEAD as a join of row numbers n and n + 1.
* :func:`ntile_of` -- NTILE(n) from a global row number and the row count,
  the first ``count % n`` tiles taking one extra row.
* :func:`percentile_of_numbered` -- PERCENTILE_CONT(p) from the two order
  statistics around ``p * (count - 1)``, found by position, never by gathering
  the values of a group into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir, scratch_path

_PID = "_q_pid"
_IDX = "_q_idx"
_OFF = "_q_off"
_TIE = "_q_tie"


def sorted_checkpoint(df: DataFrame, order_cols: list[Column | str], unique: bool = False) -> DataFrame:
    """Range-sort ``df`` and checkpoint the sorted partitions (reliable storage).

    Rows that may tie on every order column get a tie breaker that is written
    before the sort: a value that many rows share then spreads over many ranges,
    and a task that runs again meets the same tie breakers.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if unique:
        return df.orderBy(*order_cols).checkpoint(eager=True)
    tied = df.withColumn(_TIE, F.monotonically_increasing_id())
    path = scratch_path(spark, "order_ties")
    tied.write.parquet(path)
    return spark.read.schema(tied.schema).parquet(path).orderBy(*order_cols, _TIE).checkpoint(eager=True)


def numbered_ranges(df: DataFrame, order_cols: list[Column | str], out: str = "row_num",
                    unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, ranges) of the stored total order.

    ``rows`` has ``out``, the 1-based position, and ``_q_pid``, the range a row lies
    in. ``ranges`` has one row for each range with rows: ``_q_pid``, ``_q_off`` (rows
    before it) and ``_q_n`` (its rows). Both read the checkpoint, not the input. Without
    order columns rows are numbered as they are stored, and nothing is exchanged.
    """
    if order_cols:
        ordered = sorted_checkpoint(df, order_cols, unique)
    else:
        ensure_checkpoint_dir(df.sparkSession)
        ordered = df.checkpoint(eager=True)
    pid = F.spark_partition_id()
    # monotonically_increasing_id = partition index << 33 | position in partition
    pos = ordered.select(
        "*", pid.alias(_PID),
        (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias(_IDX),
    )
    counts = pos.groupBy(_PID).agg(F.count(F.lit(1)).alias("_q_n"))
    # one row per partition: a window over it is bounded by the partition count
    ranges = counts.select(
        _PID, "_q_n",
        F.coalesce(
            F.sum("_q_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias(_OFF),
    )
    rows = (pos.join(F.broadcast(ranges.select(_PID, _OFF)), _PID)
            .withColumn(out, (F.col(_OFF) + F.col(_IDX) + 1).cast("long"))
            .drop(_IDX, _OFF, _TIE))
    return rows, ranges


def global_row_number(df: DataFrame, order_cols: list[Column | str], out: str = "row_num",
                      unique: bool = False) -> DataFrame:
    """Add ``out`` = 1-based position of each row in the total order.

    ``unique``: the order columns tell all rows apart, no tie breaker is needed.
    Rows that tie on all of them are numbered in an arbitrary but stored order.
    Counting the result reads the checkpoint, not the input.
    """
    return numbered_ranges(df, order_cols, out, unique)[0].drop(_PID)


def global_ranks(df: DataFrame, value: str, descending: bool = True, rank: str = "rnk",
                 dense_rank: str = "dense_rnk") -> DataFrame:
    """RANK() and DENSE_RANK() OVER (ORDER BY value) for every row; nulls first if
    descending, else last.

    Distinct values are few enough to aggregate but not to gather: they are
    numbered (that is DENSE_RANK), and RANK adds up the rows of the values before,
    inside sorted ranges and over one total per range.
    """
    sizes = df.groupBy(F.col(value).alias("_q_val")).agg(F.count(F.lit(1)).alias("_q_rows"))
    order = F.col("_q_val").desc_nulls_first() if descending else F.col("_q_val").asc_nulls_last()
    numbered = global_row_number(sizes, [order], out=dense_rank, unique=True)
    # ranges of 4096 values: running sums inside a range, then one total for each range
    numbered = numbered.withColumn("_q_range", F.floor((F.col(dense_rank) - 1) / 4096))
    before = Window.partitionBy("_q_range").orderBy(dense_rank).rowsBetween(Window.unboundedPreceding, -1)
    inside = numbered.withColumn("_q_in", F.coalesce(F.sum("_q_rows").over(before), F.lit(0)))
    totals = numbered.groupBy("_q_range").agg(F.sum("_q_rows").alias("_q_total"))
    running = Window.orderBy("_q_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_q_range", F.coalesce(F.sum("_q_total").over(running), F.lit(0)).alias("_q_start"))
    ranks = (inside.join(starts, "_q_range")
             .select("_q_val", dense_rank, (F.col("_q_start") + F.col("_q_in") + 1).cast("long").alias(rank)))
    return (df.join(ranks, F.col(value).eqNullSafe(F.col("_q_val")))
            .select(*df.columns, rank, dense_rank))


def global_lead(df: DataFrame, by: str, order_cols: list[str], value: str, out: str) -> DataFrame:
    """LEAD(value) OVER (PARTITION BY by ORDER BY order_cols) for every row.

    One group may hold most rows, so no task gets a whole group: rows are numbered
    over all groups and joined with the next number.
    """
    numbered = global_row_number(df, [F.col(by).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in order_cols]],
                                 out="_q_at")
    following = numbered.select((F.col("_q_at") - 1).alias("_q_at"), F.col(by).alias("_q_by"),
                                F.col(value).alias("_q_next"))
    return (numbered.join(following, "_q_at", "left")
            .select(*df.columns, F.when(F.col(by).eqNullSafe(F.col("_q_by")), F.col("_q_next")).alias(out)))


def ntile_of(row_num: Column, total: Column, n: int) -> Column:
    """NTILE(n) for 1-based ``row_num`` out of ``total`` rows.

    Tiles have ``total // n`` rows and the first ``total % n`` tiles one more.
    """
    q = F.floor(total / F.lit(n)).cast("long")
    r = (total - q * F.lit(n)).cast("long")
    big = r * (q + 1)  # rows held by the larger tiles
    return (F.when(row_num <= big, F.floor((row_num - 1) / (q + 1)) + 1)
            .otherwise(r + F.floor((row_num - big - 1) / F.greatest(q, F.lit(1))) + 1)
            ).cast("long")


def percentile_of_numbered(numbered: DataFrame, value: str, row_num: str, p: float, out: str = "pct") -> DataFrame:
    """One row: PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY value) of rows numbered by value.

    Linear interpolation between the order statistics at 0-based positions
    floor(p*(n-1)) and ceil(p*(n-1)) as doubles; null for an empty input. The
    values must not be null. Both passes read the stored numbering.
    """
    n = numbered.agg(F.count(F.lit(1))).scalar()
    pos = F.lit(p) * (n - 1)
    placed = numbered.select(F.col(row_num).alias("_at"), F.col(value).cast("double").alias("_v"),
                             (F.floor(pos) + 1).alias("_lo"), (F.ceil(pos) + 1).alias("_hi"),
                             (pos - F.floor(pos)).alias("_part"))
    at, v = F.col("_at"), F.col("_v")
    picked = placed.where((at == F.col("_lo")) | (at == F.col("_hi"))).agg(
        F.max(F.when(at == F.col("_lo"), v)).alias("lo"), F.max(F.when(at == F.col("_hi"), v)).alias("hi"),
        F.max("_part").alias("part"))
    return picked.select((F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias(out))


def exact_percentile_cont(df: DataFrame, value: str, p: float, out: str = "pct") -> DataFrame:
    """One row: PERCENTILE_CONT(p) of a column; nulls are left out."""
    vals = df.select(F.col(value).cast("double").alias("_q_v")).where(F.col("_q_v").isNotNull())
    return percentile_of_numbered(global_row_number(vals, [F.col("_q_v")], out="_q_rn"), "_q_v", "_q_rn", p, out)
