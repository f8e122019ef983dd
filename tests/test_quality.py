"""Quarantine rules, referential integrity, metrics and constraint checks."""

import pytest
from pyspark.sql import functions as F

from quarry.operators.cleaning import (
    check_referential_integrity, quality_reason, tag_order_quality, tag_orders,
)
from quarry.operators.quality import (
    ConstraintViolation, TableRules, customer_quality, enforce, require_key, validate,
)
from quarry.sources.tpch_star import raw_tables

from conftest import SMALL


def _dims(spark):
    return (spark.createDataFrame([(1,), (2,), (3,)], "customer_id long"),
            spark.createDataFrame([(10,), (20,)], "product_id long"),
            spark.createDataFrame([(100,)], "store_id long"))


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id long, customer_id long, product_id long, store_id long")


# (case, customer, product, store, is an orphan)
KEY_CASES = [("every key known", 2, 20, 100, False), ("customer unknown", 999, 20, 100, True),
             ("product unknown", 1, 999, 100, True), ("store unknown", 1, 10, 5, True),
             ("customer missing", None, 10, 100, True), ("store missing", 3, 10, None, True)]


def test_orphans_by_case(spark):
    rows = [(i, *case[1:4]) for i, case in enumerate(KEY_CASES)]
    valid, orphans = check_referential_integrity(_orders(spark, rows), *_dims(spark))
    assert {r.order_id for r in valid.collect()} == {i for i, c in enumerate(KEY_CASES) if not c[4]}
    assert {(r.order_id, r.rejection_reason) for r in orphans.collect()} == {
        (i, "orphan_foreign_key") for i, c in enumerate(KEY_CASES) if c[4]}


# (quantity, date, reason)
QUALITY_CASES = [(1, "2024-03-05", None), (100, "2024-03-05", None), (None, "2024-03-05", "null_quantity"),
                 (-3, "2024-03-05", "non_positive_quantity"), (0, "2024-03-05", "non_positive_quantity"),
                 (5, None, "unparseable_date"), (None, None, "unparseable_date")]


def test_quality_reasons_by_case(spark):
    df = spark.createDataFrame([(i, q, d) for i, (q, d, _) in enumerate(QUALITY_CASES)],
                               "i int, quantity long, order_date string")
    got = df.select("i", quality_reason(F.to_date("order_date"), F.col("quantity")).alias("r")).collect()
    assert {r.i: r.r for r in got} == {i: c[2] for i, c in enumerate(QUALITY_CASES)}


def test_reason_precedence(spark):
    df = spark.createDataFrame([(1, 1, 10, 100, "junk", None, "web")],
                               "order_id long, customer_id long, product_id long, store_id long, "
                               "order_date string, quantity long, channel string")
    assert tag_order_quality(df).first().rejection_reason == "unparseable_date"


def test_clean_plus_quarantine_equals_input(spark):
    raw = raw_tables(spark, SMALL)
    tagged = tag_orders(raw.orders, raw.customers, raw.products, raw.stores)
    counts = {r.rejection_reason: r["count"] for r in tagged.groupBy("rejection_reason").count().collect()}
    assert sum(counts.values()) == raw.orders.count()
    assert set(counts) <= {None, "unparseable_date", "null_quantity", "non_positive_quantity",
                           "orphan_foreign_key", "missing_order_id"}
    # each injected defect shows up
    assert counts.get("unparseable_date", 0) > 0 and counts.get("orphan_foreign_key", 0) > 0


def test_duplicate_emails_count_null_once(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, None, "y"), (4, None, "z")],
                               "customer_id long, email string, city string")
    r = customer_quality(df).first()
    assert (r.rows, r.null_cities, r.duplicate_emails) == (4, 1, 2)


def test_validate_rules(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1, 1, "ab"), (1, 5, None), (2, None, "abcdef")],
                                  "id long, pid long, name string")
    rules = [TableRules("child", child, not_null=["name"], unique=[["id"]],
                        checks={"pid>0": F.col("pid") > 0}, max_length={"name": 3},
                        foreign_keys=[("pid", parent, "id")])]
    got = {r.constraint_name: r.violations for r in validate(rules).collect()}
    assert got == {"not_null:name": 1, "check:pid>0": 0, "length:name<=3": 1, "unique:id": 2,
                   "foreign_key:pid": 1}


def test_no_rules_give_an_empty_report(spark):
    assert validate([]).collect() == []
    enforce([])


def test_enforce_names_the_broken_rule(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "id long")
    with pytest.raises(ConstraintViolation, match=r"t\.not_null:id: 1.*t\.unique:id: 2|t\.unique:id: 2.*t\.not_null:id: 1"):
        require_key(df, "id", "t")
    require_key(df.where("id is not null").distinct(), "id", "t")


def test_malformed_lines_are_no_missing_values(spark, tmp_path):
    from quarry.sources.files import RAW_SCHEMAS, read_csv
    path = tmp_path / "orders.csv"
    path.write_text("order_id,customer_id,product_id,store_id,order_date,quantity,channel\n"
                    "1,1,1,1,2024-01-02,3,web\nabc,1,1,1,2024-01-02,3,web\n3,1,1,1,2024-01-02,two,web\n"
                    "4,1,1,1,2024-01-02,2.0,web\n5,1,1,1,2024-01-02,,web\n,1,1,1,2024-01-02,3,web\n")
    tagged = tag_order_quality(read_csv(spark, str(path), RAW_SCHEMAS["orders"]))
    assert sorted((r.rejection_reason or "") for r in tagged.collect()) == sorted(
        ["", "malformed_record", "malformed_record", "malformed_record", "null_quantity", "missing_order_id"])
