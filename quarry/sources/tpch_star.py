"""Binding of the retail star schema and its raw landing tables to the TPC-H-like
test tables (``region nation customer supplier part orders lineitem``).

Star (what the reports query):

* dim_customer  <- customer (+ nation name); key = rank of c_custkey
* dim_product   <- part; category = p_type, price = p_retailprice as decimal(10,2)
* dim_store     <- supplier (+ nation name)
* dim_date      <- every day from 1 January of the first order year to
                   31 December of the last
* fact_sales    <- lineitem x orders, one row per line; channel = o_orderpriority

Raw (what the cleaning operators read): the same entities as text-typed landing
rows with defects injected by key, so an independent SQL engine can compute the
same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.numeric import PRICE
from quarry.operators.modeling import joined_by
from quarry.session import input_signature
from quarry.sources.tables import BASE_TABLES, TableSet

# Fixed values of the test binding.
EMAIL_DOMAIN = "@example.com"
SIGNUP_EPOCH = "1994-01-01"
CUSTOMER_ZERO_EMAIL = "customer.000000000@example.com"


@dataclass
class Star:
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_store: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame
    skipped: DataFrame | None = None
    location: str | None = None
    skipped_rows: int | None = None
    dimensions: dict | None = None  # name -> StoredDimension


def _nation(t: TableSet) -> DataFrame:
    # left to the planner, which broadcasts it by its measured size
    return t.nation.select("n_nationkey", "n_name")


def customer_source(t: TableSet) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    return c.join(_nation(t), c.c_nationkey == F.col("n_nationkey"), "left").select(
        k.alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit(EMAIL_DOMAIN)).alias("email"),
        F.date_add(F.to_date(F.lit(SIGNUP_EPOCH)), (k % 365).cast("int")).alias("signup_date"),
        F.when(k % 20 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("city"),
        F.col("n_name").alias("country"),
    )


def product_source(t: TableSet) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(PRICE).alias("unit_price"),
    )


def store_source(t: TableSet) -> DataFrame:
    s = t.supplier
    return s.join(_nation(t), s.s_nationkey == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("country"),
    )


#: Bytes of the line table that one task of its join with the orders gets.
BYTES_A_TASK = 8 << 20
#: Tasks a join must need before its rows are dealt by size; the planner deals smaller ones.
LEAST_TASKS = 9


def join_tasks(t: TableSet) -> int | None:
    """Tasks for the join of lines and orders: as many as the stored lines need, so that a task's
    rows don't grow with the table; None if the session's partitions (or a broadcast) will do."""
    tasks = -(-input_signature(t.spark, [f"{t.data_dir}/lineitem.parquet"])[0][1] // BYTES_A_TASK)
    return tasks if tasks >= LEAST_TASKS else None


def order_headers(t: TableSet) -> DataFrame:
    """What an order's lines share."""
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"), F.col("o_orderpriority").alias("channel"))


def order_items(t: TableSet) -> DataFrame:
    """The lines without what their order says."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"), F.col("l_quantity").cast("long").alias("quantity"))


def order_lines(t: TableSet) -> DataFrame:
    """lineitem x orders projected to the order-line shape of the source system.

    The one big-to-big join of the binding: both sides are hash-partitioned on
    the order key (sort-merge join), only the six needed columns are read.
    """
    return joined_by(order_items(t), order_headers(t), "order_id", join_tasks(t)).select(
        "order_id", "customer_id", "product_id", "store_id", "order_date", "channel", "quantity")


def source_signature(spark: SparkSession, data_dir: str) -> tuple:
    """State of the base tables: caches of derived tables are keyed by it."""
    return input_signature(spark, [f"{data_dir.rstrip('/')}/{t}.parquet" for t in BASE_TABLES])


# --------------------------------------------------------------------------- raw
@dataclass
class Raw:
    customers: DataFrame
    products: DataFrame
    stores: DataFrame
    orders: DataFrame


def _messy_date_text(d: Column, k: Column) -> Column:
    return (F.when(k % 211 == 0, F.lit("not-a-date"))
            .when(k % 10 == 0, F.date_format(d, "MM/dd/yyyy"))
            .when(k % 10 == 1, F.date_format(d, "dd-MMM-yyyy"))
            .when(k % 10 == 2, F.date_format(d, "yyyy/MM/dd"))
            .otherwise(F.date_format(d, "yyyy-MM-dd")))


def raw_tables(spark: SparkSession, data_dir: str) -> Raw:
    """Landing-zone rows with the defect mix of the source system.

    Orders (one per line item, k = order key): k%10 in {0,1,2} gives
    MM/dd/yyyy, dd-MMM-yyyy, yyyy/MM/dd dates, others ISO; k%211 = 0 an
    unparseable date; k%97 = 0 a null quantity; k%193 = 0 a negated
    quantity; k%307 = 0 an unknown product id (-1); k%311 = 0 an unknown and
    k%313 = 0 a null customer id; k%317 = 0 an unknown and k%331 = 0 a null
    store id; k%337 = 0 a null order id.
    Customers: k%33 = 0 repeats customer 0's e-mail upper-cased with outer
    white space; k%20 = 0 has no city; k%7 = 0 has white space around the first
    name, city and country; k%13 = 0 a signup date that isn't ISO.
    Products (k%5 = 0) and stores (k%3 = 0): white space around name and category
    or city.
    """
    t = TableSet(spark, data_dir)
    cust = customer_source(t)
    k = F.col("customer_id")

    def padded(col: str, when: Column) -> Column:
        return F.when(when, F.concat(F.lit(" \t"), F.col(col), F.lit("\n "))).otherwise(F.col(col)).alias(col)

    customers = cust.select(
        "customer_id", padded("first_name", k % 7 == 0), "last_name",
        F.when(k % 33 == 0, F.concat(F.lit("\t "), F.upper(F.lit(CUSTOMER_ZERO_EMAIL)), F.lit("  ")))
         .otherwise(F.col("email")).alias("email"),
        F.when(k % 13 == 0, F.date_format("signup_date", "MM/dd/yyyy"))
         .otherwise(F.date_format("signup_date", "yyyy-MM-dd")).alias("signup_date"),
        padded("city", k % 7 == 0), padded("country", k % 7 == 0),
    )
    pk, sk = F.col("product_id") % 5 == 0, F.col("store_id") % 3 == 0
    products = product_source(t).select("product_id", padded("product_name", pk), padded("category", pk), "unit_price")
    stores = store_source(t).select("store_id", padded("store_name", sk), padded("city", sk), "country")
    lines = order_lines(t)
    ok = F.col("order_id")
    q = F.col("quantity")
    none = F.lit(None).cast("long")
    orders = lines.select(
        F.when(ok % 337 == 0, none).otherwise(ok).alias("order_id"),
        F.when(ok % 311 == 0, F.lit(-1).cast("long")).when(ok % 313 == 0, none)
         .otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(ok % 307 == 0, F.lit(-1).cast("long")).otherwise(F.col("product_id")).alias("product_id"),
        F.when(ok % 317 == 0, F.lit(-1).cast("long")).when(ok % 331 == 0, none)
         .otherwise(F.col("store_id")).alias("store_id"),
        _messy_date_text(F.col("order_date"), ok).alias("order_date"),
        F.when(ok % 97 == 0, none).when(ok % 193 == 0, -q).otherwise(q)
         .alias("quantity"),
        "channel",
    )
    return Raw(customers, products, stores, orders)


def register_star_views(star: Star, prefix: str = "") -> list[str]:
    """Expose the star tables as temporary views for ``spark.sql`` queries."""
    names = []
    for name in ("dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales"):
        getattr(star, name).createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
