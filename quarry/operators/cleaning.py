"""Raw -> clean ("silver") transformations with a quarantine instead of drops.

Each cleaning step is one projection of built-in expressions. Orders get a
nullable ``rejection_reason`` in a single pass; valid rows are the ones where it
is null, so one tagged DataFrame yields both the clean table and the quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.dates import lenient_iso_date, parse_messy_date
from quarry.functions.text import normalise_email, strip_chars
from quarry.sources.files import CORRUPT_RECORD

# Rejection reasons, in precedence order.
MALFORMED_RECORD = "malformed_record"
MISSING_ORDER_ID = "missing_order_id"
UNPARSEABLE_DATE = "unparseable_date"
NULL_QUANTITY = "null_quantity"
NON_POSITIVE_QUANTITY = "non_positive_quantity"
UNKNOWN = "unknown"
ORPHAN_FOREIGN_KEY = "orphan_foreign_key"

ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "store_id", "order_date", "quantity", "channel"]


def clean_customers(raw: DataFrame) -> DataFrame:
    """Trim names, city, country; trim and lower-case e-mail; lenient ISO signup date.

    Duplicate e-mails are kept: customer_id is the identity (see
    :func:`quarry.operators.quality.customer_quality`).
    """
    return raw.select(
        "customer_id",
        strip_chars("first_name").alias("first_name"),
        strip_chars("last_name").alias("last_name"),
        normalise_email("email").alias("email"),
        lenient_iso_date(F.col("signup_date").cast("string")).alias("signup_date"),
        strip_chars("city").alias("city"),
        strip_chars("country").alias("country"),
    )


def clean_products(raw: DataFrame) -> DataFrame:
    return raw.select("product_id", strip_chars("product_name").alias("product_name"),
                      strip_chars("category").alias("category"), "unit_price")


def clean_stores(raw: DataFrame) -> DataFrame:
    return raw.select("store_id", strip_chars("store_name").alias("store_name"),
                      strip_chars("city").alias("city"), strip_chars("country").alias("country"))


def is_valid_order(date: Column, quantity: Column) -> Column:
    """quantity present and positive and the date parsed (never null)."""
    return quantity.isNotNull() & date.isNotNull() & F.coalesce(quantity > 0, F.lit(False))


def quality_reason(date: Column, quantity: Column) -> Column:
    """Null for a valid row, else the first failing rule in precedence order."""
    return (F.when(is_valid_order(date, quantity), F.lit(None).cast("string"))
            .when(date.isNull(), F.lit(UNPARSEABLE_DATE))
            .when(quantity.isNull(), F.lit(NULL_QUANTITY))
            .when(quantity <= 0, F.lit(NON_POSITIVE_QUANTITY))
            .otherwise(F.lit(UNKNOWN)))


def tag_order_quality(raw_orders: DataFrame) -> DataFrame:
    """Parse the order date and add ``rejection_reason`` (null when valid).

    A record the reader could not parse (``_corrupt_record``, see
    :func:`quarry.sources.files.read_csv`) and an order without id are rejected
    before the other rules look at their nulls.
    """
    bad = (F.col(CORRUPT_RECORD).isNotNull() if CORRUPT_RECORD in raw_orders.columns else F.lit(False))
    parsed = raw_orders.withColumn("order_date", parse_messy_date(F.col("order_date").cast("string")))
    reason = (F.when(bad, F.lit(MALFORMED_RECORD))
              .when(F.col("order_id").isNull(), F.lit(MISSING_ORDER_ID))
              .otherwise(quality_reason(F.col("order_date"), F.col("quantity"))))
    return parsed.withColumn("rejection_reason", reason).drop(CORRUPT_RECORD)


def clean_orders(raw_orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected) split of raw orders by the quality rules."""
    tagged = tag_order_quality(raw_orders)
    clean = tagged.where(F.col("rejection_reason").isNull()).drop("rejection_reason")
    rejected = tagged.where(F.col("rejection_reason").isNotNull())
    return clean, rejected


def _key_flag(keys: DataFrame, key: str, flag: str) -> DataFrame:
    # distinct before the join: partial aggregation shrinks the key side first
    return keys.select(key).where(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))


def tag_orphans(orders: DataFrame, customers: DataFrame, products: DataFrame,
                stores: DataFrame) -> DataFrame:
    """Add boolean ``fk_ok``: every foreign key present in its dimension.

    Three left joins against the distinct key sets (the planner broadcasts a
    key set only when its measured size allows). A null foreign key is an
    orphan.
    """
    return (orders
            .join(_key_flag(customers, "customer_id", "_q_c"), "customer_id", "left")
            .join(_key_flag(products, "product_id", "_q_p"), "product_id", "left")
            .join(_key_flag(stores, "store_id", "_q_s"), "store_id", "left")
            .withColumn("fk_ok", F.col("_q_c").isNotNull() & F.col("_q_p").isNotNull()
                        & F.col("_q_s").isNotNull())
            .drop("_q_c", "_q_p", "_q_s"))


def check_referential_integrity(orders: DataFrame, customers: DataFrame, products: DataFrame,
                                stores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, orphans); orphans carry ``rejection_reason = 'orphan_foreign_key'``."""
    cols = orders.columns
    tagged = tag_orphans(orders, customers, products, stores)
    valid = tagged.where(F.col("fk_ok")).select(*cols)
    orphans = (tagged.where(~F.col("fk_ok")).select(*cols)
               .withColumn("rejection_reason", F.lit(ORPHAN_FOREIGN_KEY)))
    return valid, orphans


def tag_orders(raw_orders: DataFrame, customers: DataFrame, products: DataFrame,
               stores: DataFrame) -> DataFrame:
    """Quality rules, then foreign keys on the rows that passed them.

    One pass over the raw orders: the key flags are joined to every row and
    only consulted where the quality rules passed, so each rejected row gets
    exactly one reason (quality first) and a null reason marks a clean row.
    """
    q = tag_order_quality(raw_orders)
    fk = tag_orphans(q, customers, products, stores)
    reason = F.coalesce(F.col("rejection_reason"),
                        F.when(~F.col("fk_ok"), F.lit(ORPHAN_FOREIGN_KEY)))
    return fk.select(*ORDER_COLUMNS, reason.alias("rejection_reason"))


def merge_rejects(*frames: DataFrame) -> DataFrame:
    """Diagonal concatenation: union by name, missing columns as null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
