"""Exact money arithmetic.

Money is ``decimal(p,2)``. Ratios that a report rounds to two places (averages,
percentages) are computed on whole cents with integer division and rounded half
away from zero, so no intermediate scale limit or binary float can move a value
that sits on a rounding boundary.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"
PRICE = "decimal(10,2)"
REVENUE = "decimal(12,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def revenue(quantity: Column | str, unit_price: Column | str) -> Column:
    """quantity * unit_price, exact, stored as decimal(12,2); null if it doesn't fit."""
    return (_col(quantity).cast("decimal(20,0)") * _col(unit_price).cast(PRICE)).try_cast(REVENUE)


def money(c: Column | str) -> Column:
    """Widen a money value (for sums) to the common decimal(38,2)."""
    return _col(c).cast(MONEY)


def _cents(c: Column) -> Column:
    return (c.cast(MONEY) * F.lit(100)).cast("decimal(38,0)")


def _half_up_div(num: Column, den: Column) -> Column:
    """Integer quotient of num/den rounded half away from zero (den > 0)."""
    twice = F.abs(num) * F.lit(2) + den
    d2 = den * F.lit(2)
    # subtract the remainder first so the division below is exact
    q = ((twice - F.pmod(twice, d2)) / d2).cast("decimal(38,0)")
    return F.when(num < 0, -q).otherwise(q)


def _cents_to_money(q: Column) -> Column:
    return (q * F.lit(Decimal("0.01"))).cast(MONEY)


def avg_money(total: Column | str, count: Column | str) -> Column:
    """ROUND(total / count, 2) for a money total and a positive row count."""
    return _cents_to_money(_half_up_div(_cents(_col(total)), _col(count).cast("decimal(38,0)")))


def pct_money(part: Column | str, whole: Column | str) -> Column:
    """ROUND(100 * part / whole, 2) for two money values (whole != 0).

    Evaluated as 10000 * part_cents / whole_cents in integers, then rounded.
    """
    num = _cents(_col(part)) * F.lit(10000)
    den = _cents(_col(whole))
    sign_fix = F.when(den < 0, -num).otherwise(num)
    return _cents_to_money(_half_up_div(sign_fix, F.abs(den)))


def pct_of_counts(part: Column | str, whole: Column | str) -> Column:
    """ROUND(100 * part / whole, 2) for row counts (whole > 0)."""
    num = _col(part).cast("decimal(38,0)") * F.lit(10000)
    return _cents_to_money(_half_up_div(num, _col(whole).cast("decimal(38,0)")))
