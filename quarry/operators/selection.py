"""Exact order statistics by refining histograms.

The value at a rank is found without sorting: one aggregation counts the rows by
the leading bits of the value, the bin that holds the rank is kept, and the next
aggregation counts inside it, until a bin is a single value. ``BINS`` bins for
each rank and round reach the driver, whatever the number of rows; 64-bit values
take at most six rounds.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

BITS = 12
BINS = 1 << BITS


def units(df: DataFrame, value: str) -> tuple[Column, Decimal]:
    """The value as a whole number of 64 bits, and what one unit is worth."""
    kind = df.schema[value].dataType
    scale = kind.scale if isinstance(kind, DecimalType) else 0
    if not isinstance(kind, DecimalType) and kind.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{value}: order statistics need whole numbers or decimals, not {kind.simpleString()}")
    return (F.col(value) * F.lit(10**scale)).cast("long"), Decimal(1).scaleb(-scale)


def order_statistics(df: DataFrame, value: str, ranks: list[int]) -> dict[int, Decimal]:
    """The values at 0-based ascending ``ranks``; nulls are left out.

    ``df`` is read once for its bounds and once a round, so it should be stored.
    """
    number, unit = units(df, value)
    rows = df.select(number.alias("v")).where(F.col("v").isNotNull())
    bounds = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    if any(not 0 <= r < bounds["n"] for r in ranks):
        raise IndexError(f"ranks {ranks} of {bounds['n']} values")
    if not ranks:
        return {}
    lo, hi = bounds["lo"], bounds["hi"]
    shift = 0
    while (hi >> shift) - (lo >> shift) >= BINS:
        shift += 1
    # rank -> (prefix of its values above the current shift, rank among them)
    at: dict[int, tuple[int | None, int]] = {r: (None, r) for r in set(ranks)}
    above = 64
    while True:
        prefixes = sorted({p for p, _ in at.values() if p is not None})
        inside = F.shiftright("v", above).isin(prefixes) if prefixes else F.lit(True)
        counts = rows.where(inside).groupBy(F.shiftright("v", shift).alias("b")).agg(F.count(F.lit(1)).alias("c")).collect()
        by_prefix: dict[int | None, list[tuple[int, int]]] = {}
        for r in counts:
            by_prefix.setdefault(r["b"] >> (above - shift) if prefixes else None, []).append((r["b"], r["c"]))
        for rank, (prefix, left) in at.items():
            for b, c in sorted(by_prefix[prefix]):
                if left < c:
                    at[rank] = (b, left)
                    break
                left -= c
        if shift == 0:
            return {rank: b * unit for rank, (b, _) in at.items()}
        above, shift = shift, max(0, shift - BITS)


def percentile_cont(df: DataFrame, value: str, p: float) -> float | None:
    """PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY value) as a double; None without values."""
    n = df.agg(F.count(value)).first()[0]
    if not n:
        return None
    pos = p * (n - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    found = order_statistics(df, value, [lo, hi])
    low, high = float(found[lo]), float(found[hi])
    return low + (high - low) * (pos - lo)


def tile_bounds(n: int, tiles: int) -> list[tuple[int, int]]:
    """First and last 0-based position of each tile with rows; the first n % tiles tiles hold one row more."""
    out, at = [], 0
    for t in range(tiles):
        size = n // tiles + (t < n % tiles)
        if size:
            out.append((at, at + size - 1))
        at += size
    return out


def tile_summary(df: DataFrame, value: str, tiles: int) -> list[dict]:
    """Of each NTILE(tiles) OVER (ORDER BY value DESC): tile, count, min, max, sum.

    Equal values on a border are dealt by their number, which is all that count,
    minimum, maximum and sum depend on. Nulls are left out.
    """
    n = df.agg(F.count(value)).first()[0]
    bounds = tile_bounds(n, tiles)
    last = n - 1  # descending position i is ascending rank last - i
    at = order_statistics(df, value, sorted({last - i for pair in bounds for i in pair}))
    edges = [(at[last - a], at[last - e]) for a, e in bounds]  # (max, min) of each tile
    kind = df.schema[value].dataType
    v = F.col(value)
    borders = sorted({x for pair in edges for x in pair})
    aggs = [F.coalesce(F.sum(F.when((v < F.lit(hi).cast(kind)) & (v > F.lit(lo).cast(kind)), v)), F.lit(0)).alias(f"s{i}")
            for i, (hi, lo) in enumerate(edges)]
    aggs += [f for i, x in enumerate(borders) for f in (F.count_if(v > F.lit(x).cast(kind)).alias(f"g{i}"),
                                                        F.count_if(v == F.lit(x).cast(kind)).alias(f"e{i}"))]
    row = df.agg(*aggs).first() if bounds else None
    out = []
    for i, ((a, e), (hi, lo)) in enumerate(zip(bounds, edges, strict=True)):
        total = Decimal(row[f"s{i}"])
        for x in {hi, lo}:
            start = row[f"g{borders.index(x)}"]
            total += x * max(0, min(e, start + row[f"e{borders.index(x)}"] - 1) - max(a, start) + 1)
        out.append({"tile": i + 1, "count": e - a + 1, "min": lo, "max": hi, "sum": total})
    return out
