"""Date parsing and calendar expressions.

Everything here is a built-in Column expression: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The raw date layouts accepted, tried in this order
# (ISO, US month-first, day-abbreviated-month-year, year-first with slashes).
# Month-first is never read as day-first. Each layout is guarded by a shape
# check so that only 1-2 digit day/month fields and 4-digit years parse.
DATE_LAYOUTS = [
    (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "yyyy-M-d"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    (r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}$", "d-MMM-yyyy"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_iso_date(c: Column | str) -> Column:
    """ISO ``yyyy-MM-dd`` text to date, null when it does not parse."""
    s = _col(c)
    shape, layout = DATE_LAYOUTS[0]
    return F.when(s.rlike(shape), F.try_to_date(s, layout))


def parse_messy_date(c: Column | str) -> Column:
    """First layout that parses wins; null for junk, empty text and null."""
    s = _col(c)
    candidates = [F.when(s.rlike(shape), F.try_to_date(s, layout))
                  for shape, layout in DATE_LAYOUTS]
    return F.coalesce(*candidates)


def date_key(d: Column | str) -> Column:
    """Calendar date to its ``YYYYMMDD`` integer key."""
    x = _col(d)
    return (F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)).cast("int")


def calendar_columns(d: Column | str) -> list[Column]:
    """The ten calendar-dimension columns for a date column.

    ``day_of_week`` counts from 0 = Monday and the weekend is days 5 and 6.
    Month and day names are the English names produced by the datetime
    formatter (``MMMM`` / ``EEEE``).
    """
    x = _col(d)
    wd = F.weekday(x)
    return [
        date_key(x).alias("date_key"),
        x.alias("full_date"),
        F.dayofmonth(x).cast("smallint").alias("day"),
        F.month(x).cast("smallint").alias("month"),
        F.date_format(x, "MMMM").alias("month_name"),
        F.quarter(x).cast("smallint").alias("quarter"),
        F.year(x).cast("smallint").alias("year"),
        wd.cast("smallint").alias("day_of_week"),
        F.date_format(x, "EEEE").alias("day_name"),
        (wd >= 5).alias("is_weekend"),
    ]
