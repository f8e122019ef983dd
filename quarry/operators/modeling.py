"""Warehouse modelling: surrogate keys, SCD type 1, calendar, fact assembly.

Every operator takes and returns DataFrames; nothing is gathered on the driver
except single scalars (a maximum key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.dates import calendar_columns, date_key
from quarry.functions.numeric import PRICE, revenue
from quarry.operators.ordering import global_row_number
from quarry.operators.quality import require_key


# --------------------------------------------------------------------------- K1
def assign_surrogate_keys(df: DataFrame, natural_key: str, key_col: str,
                          start_after: int = 0, in_order: bool = True) -> DataFrame:
    """Dense surrogate keys ``start_after + 1 ...`` in natural-key order.

    Without ``in_order`` every stored partition gets a range of keys as long as its
    rows: still dense, but in the order the rows lie in, and without a sort. That is
    enough for increments, whose keys only have to be new and to stay.

    The natural key must be unique and not null (:func:`quarry.operators.quality.require_key`
    checks it; the load does so before numbering). The numbering is distributed (:func:`global_row_number`), so no task sees
    more than one sorted range of keys.
    """
    numbered = global_row_number(df, [F.col(natural_key)] if in_order else [], out="_q_rn", unique=True)
    return (numbered.withColumn(key_col, (F.col("_q_rn") + F.lit(start_after)).cast("long"))
            .drop("_q_rn")
            .select(key_col, *[c for c in df.columns]))


# --------------------------------------------------------------------------- K2-K4
def scd1_merge(existing: DataFrame, incoming: DataFrame, natural_key: str, key_col: str,
               attrs: list[str], loaded_at: str = "loaded_at",
               now: Column | None = None) -> DataFrame:
    """Slowly changing dimension, type 1.

    * natural key in both: surrogate key and ``loaded_at`` kept, every attribute
      taken from ``incoming`` (an incoming null overwrites, no coalesce);
    * only in ``existing``: row kept unchanged;
    * only in ``incoming``: new key after the current maximum, ``loaded_at = now``.

    Both natural keys must be unique and not null; a repeated or null incoming key
    stops the merge before anything is numbered. Kept rows come from one left join,
    new ones from one anti-join (either side may be skewed or split), and the
    largest key from the existing dimension alone.
    """
    now = now if now is not None else F.current_timestamp()
    require_key(existing, natural_key, "existing")
    require_key(incoming, natural_key, "incoming")
    i = incoming.select(F.col(natural_key).alias("_q_id"), *[F.col(a).alias(f"_q_i_{a}") for a in attrs],
                        F.lit(True).alias("_q_i"))
    kept = (existing.join(i, F.col(natural_key) == F.col("_q_id"), "left")
            .select(key_col, natural_key,
                    *[F.when(F.col("_q_i"), F.col(f"_q_i_{a}")).otherwise(F.col(a)).alias(a) for a in attrs],
                    loaded_at))
    fresh = (incoming.select(natural_key, *attrs)
             .join(existing.select(natural_key), natural_key, "left_anti"))
    max_key = existing.agg(F.max(key_col)).first()[0] or 0
    fresh_keyed = (assign_surrogate_keys(fresh, natural_key, key_col, start_after=int(max_key))
                   .withColumn(loaded_at, now)
                   .select(key_col, natural_key, *attrs, loaded_at))
    return kept.unionByName(fresh_keyed)


# --------------------------------------------------------------------------- K5
def year_bounds(df: DataFrame, date_col: str) -> DataFrame:
    """One row (start, end): 1 January of the first year to 31 December of the last."""
    d = F.to_date(F.col(date_col))
    return df.agg(F.min(d).alias("_lo"), F.max(d).alias("_hi")).select(
        F.trunc("_lo", "year").alias("start"),
        F.date_sub(F.add_months(F.trunc("_hi", "year"), 12), 1).alias("end"),
    )


def dim_date_from_range(bounds: DataFrame) -> DataFrame:
    """Calendar dimension: one row per day of the inclusive range, no gaps.

    ``bounds`` is a one-row DataFrame with ``start`` and ``end`` dates; its size
    is fixed and the output is bounded by the number of days in the range.
    """
    days = bounds.select(F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def dim_date_between(spark, start: str, end: str) -> DataFrame:
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("start"),
                                   F.to_date(F.lit(end)).alias("end"))
    return dim_date_from_range(bounds)


# --------------------------------------------------------------------------- K6
def insert_only_merge(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """``INSERT ... ON CONFLICT (key) DO NOTHING``: add only unseen keys."""
    return existing.unionByName(incoming.join(existing.select(key), key, "left_anti"))


# --------------------------------------------------------------------------- K7
def fact_revenue(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Orders priced from the product table; revenue = quantity * unit_price.

    Inner join: an order whose product is unknown has no price (the quality
    step quarantines such orphans before this point).
    """
    p = products.select("product_id", F.col("unit_price").cast(PRICE).alias("unit_price"))
    return (orders.join(p, "product_id")
            .select("order_id", "customer_id", "product_id", "store_id", "order_date",
                    "channel", "quantity", "unit_price",
                    revenue("quantity", "unit_price").alias("revenue")))


# --------------------------------------------------------------------------- K8/K9
FACT_COLUMNS = ["order_id", "customer_key", "product_key", "store_key", "date_key", "channel",
                "quantity", "unit_price", "revenue"]
SKIP_COLUMNS = ["order_id", "customer_id", "product_id", "store_id", "missing_customer",
                "missing_product", "missing_store", "revenue_too_large"]


def joined_by(left: DataFrame, right: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Inner join; ``tasks``: partitions that both sides are dealt to, instead of the session's."""
    if tasks:
        left, right = left.repartition(tasks, key), right.repartition(tasks, key)
    return left.join(right, key)


def keyed_lines(lines: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_store: DataFrame,
                headers: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Order lines with surrogate keys, price and date key: all that :func:`priced_lines` derives from.

    ``headers`` (order_id, customer_id, order_date, channel): what lines of an order
    share, if ``lines`` lack it. Customers are then looked up once an order and products
    before the lines meet their orders, so that no exchange moves whole lines for a
    lookup; ``tasks`` deals that join (:func:`joined_by`).
    """
    c = dim_customer.select("customer_id", "customer_key")
    p = dim_product.select("product_id", "product_key",
                           F.col("unit_price").cast(PRICE).alias("unit_price"))
    s = dim_store.select("store_id", "store_key")
    looked = lines.join(p, "product_id", "left")
    if headers is None:
        looked = looked.join(c, "customer_id", "left")
    else:
        looked = joined_by(looked, headers.join(c, "customer_id", "left"), "order_id", tasks)
    return looked.join(s, "store_id", "left").select(
        "order_id", "customer_id", "product_id", "store_id", "customer_key", "product_key", "store_key",
        date_key("order_date").alias("date_key"), "channel", "quantity", "unit_price")


def _too_large() -> Column:
    """Of a keyed line: it has a revenue, but one that doesn't fit."""
    return revenue("quantity", "unit_price").isNull() & F.col("quantity").isNotNull() & F.col("unit_price").isNotNull()


def is_skipped() -> Column:
    """Of a keyed line: a key is missing or the revenue doesn't fit."""
    return (F.col("customer_key").isNull() | F.col("product_key").isNull() | F.col("store_key").isNull()
            | _too_large())


def priced_lines(keyed: DataFrame, *more: str) -> DataFrame:
    """:func:`keyed_lines` with revenue and flags, and the columns named ``more``."""
    return keyed.select(
        "order_id", "customer_id", "product_id", "store_id", "customer_key", "product_key", "store_key",
        "date_key", "channel",
        F.when(F.abs("quantity") < 2**31, F.col("quantity")).cast("int").alias("quantity"),
        "unit_price", revenue("quantity", "unit_price").alias("revenue"),
        F.col("customer_key").isNull().alias("missing_customer"),
        F.col("product_key").isNull().alias("missing_product"),
        F.col("store_key").isNull().alias("missing_store"),
        _too_large().alias("revenue_too_large"), is_skipped().alias("skipped"), *more)


def looked_up_lines(lines: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                    dim_store: DataFrame) -> DataFrame:
    """Order lines with surrogate keys, price, revenue and a ``skipped`` flag, in one pass.

    ``lines``: order_id, customer_id, product_id, store_id, order_date, channel,
    quantity. Natural keys of the dimensions must be unique. Three left joins; the
    product join also brings the price. A line is skipped if a key is missing or
    its revenue doesn't fit decimal(12,2); the flags say why. The planner broadcasts
    a dimension only when its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold``; larger ones are sort-merge joined.
    """
    return priced_lines(keyed_lines(lines, dim_customer, dim_product, dim_store))
