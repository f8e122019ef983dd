"""Column expressions: date parsing, trimming, calendar, exact rounding."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarry.functions.dates import calendar_columns, parse_messy_date
from quarry.functions.numeric import avg_money, pct_money
from quarry.functions.text import normalise_email, strip_chars

D = dt.date(2024, 3, 5)


@pytest.mark.parametrize("text,expected", [
    ("2024-03-05", D), ("03/05/2024", D), ("05-Mar-2024", D), ("2024/03/05", D),
    ("not-a-date", None), (None, None), ("", None),
    ("05-MAR-2024", D), ("3/5/2024", D), ("2024-02-30", None), ("13/05/2024", None),
    ("003/5/2024", None), ("2024-003-05", None), (" 2024-03-05", None), ("2024-03-05x", None),
])
def test_parse_messy_date(spark, text, expected):
    df = spark.createDataFrame([(text,)], "value string")
    assert df.select(parse_messy_date("value").alias("d")).first().d == expected


def test_strip_unicode_whitespace(spark):
    df = spark.createDataFrame([(" \t Ann \n",), (None,), ("  ",)], "s string")
    got = [r.s for r in df.select(strip_chars("s").alias("s")).collect()]
    assert got == ["Ann", None, ""]
    e = spark.createDataFrame([("\t JOE@X.COM  ",)], "e string").select(normalise_email("e").alias("e"))
    assert e.first().e == "joe@x.com"


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),), (dt.date(2024, 12, 31),)],
                               "d date")
    rows = df.select(*calendar_columns(F.col("d"))).orderBy("full_date").collect()
    assert rows[0].day_name == "Monday" and rows[0].day_of_week == 0 and not rows[0].is_weekend
    assert rows[1].day_name == "Sunday" and rows[1].day_of_week == 6 and rows[1].is_weekend
    assert rows[0].month_name == "January" and rows[2].month_name == "December"
    assert rows[2].date_key == 20241231 and rows[2].quarter == 4


def test_quarter_of_months(spark):
    df = spark.createDataFrame([(dt.date(2024, m, 1),) for m in (1, 4, 9, 12)], "d date")
    got = [r.quarter for r in df.select(*calendar_columns(F.col("d"))).orderBy("full_date").collect()]
    assert got == [1, 2, 3, 4]


def test_half_up_rounding(spark):
    df = spark.createDataFrame([(Decimal("0.05"), 2, Decimal("-1.00"), Decimal("8.00")),
                                (Decimal("10.00"), 3, Decimal("1.00"), Decimal("-8.00"))],
                               "t decimal(12,2), n long, a decimal(12,2), b decimal(12,2)")
    rows = df.select(avg_money("t", "n").alias("avg"), pct_money("a", "b").alias("pct")).collect()
    assert rows[0].avg == Decimal("0.03") and rows[0].pct == Decimal("-12.50")
    assert rows[1].avg == Decimal("3.33") and rows[1].pct == Decimal("-12.50")


def test_money_above_double_precision(spark):
    from decimal import Decimal

    from quarry.functions.numeric import avg_money, pct_of_counts, revenue
    big = Decimal("123456789012345678.91")
    df = spark.createDataFrame([(big, 1)], "t decimal(38,2), n long")
    assert df.select(avg_money("t", "n")).first()[0] == big
    assert df.select(pct_of_counts("n", "n")).first()[0] == Decimal("100.00")
    df = spark.createDataFrame([(2_000_000, Decimal("99999.99")), (3, Decimal("2.50"))], "q long, p decimal(10,2)")
    assert [r[0] for r in df.select(revenue("q", "p")).collect()] == [None, Decimal("7.50")]
