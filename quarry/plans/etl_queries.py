"""Registered queries for the cleaning, quality and modelling operators.

Each takes (spark, data_dir) and returns a DataFrame over the whole raw view
of the test tables (or the silver/star tables Spark derives from it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.dates import lenient_iso_date, parse_messy_date
from quarry.operators.cleaning import (
    ORDER_COLUMNS, ORPHAN_FOREIGN_KEY, clean_customers as _clean_customers,
    clean_products as _clean_products, clean_stores as _clean_stores, merge_rejects,
    tag_order_quality, tag_orders,
)
from quarry.operators import dimension_store
from quarry.operators.modeling import (
    FACT_COLUMNS, SKIP_COLUMNS, dim_date_from_range, fact_revenue as _fact_revenue,
    insert_only_merge, year_bounds,
)
from quarry.operators.quality import (
    TableRules, customer_quality, quality_rates, reject_reason_counts, validate,
)
from quarry.plans.ingest import silver_for
from quarry.plans.load import (
    DIMENSIONS, Source, current, date_rules, dimension_rules, fact_rules, refresh, run_load, star_for,
)
from quarry.session import scratch_path, together
from quarry.sources.files import RAW_SCHEMAS, read_csv, stored, write_csv
from quarry.sources.tables import TableSet
from quarry.sources.tpch_star import raw_tables, source_signature

# Split points of the two-batch dimension loads (first batch = rows before them).
FIRST_BATCH_SIGNUP_BEFORE = "1994-07-01"
FIRST_BATCH_PRICE_BELOW = 1500
FIRST_BATCH_CALENDAR_END = "1998-12-31"


def parse_dates(spark: SparkSession, d: str) -> DataFrame:
    """raw order-date text and the date it parses to (null when none fits)."""
    o = raw_tables(spark, d).orders
    return o.select("order_id", F.col("order_date").alias("order_date_text"),
                    parse_messy_date("order_date").alias("order_date"))


def clean_customers(spark: SparkSession, d: str) -> DataFrame:
    return _clean_customers(raw_tables(spark, d).customers)


def clean_products(spark: SparkSession, d: str) -> DataFrame:
    return _clean_products(raw_tables(spark, d).products)


def clean_stores(spark: SparkSession, d: str) -> DataFrame:
    return _clean_stores(raw_tables(spark, d).stores)


def clean_orders(spark: SparkSession, d: str) -> DataFrame:
    """D4 + D7: orders passing quality rules and foreign keys (the silver table)."""
    return silver_for(spark, d).orders


def quarantine_orders(spark: SparkSession, d: str) -> DataFrame:
    """D6 + D8 + S7: every rejected order with exactly one reason."""
    return silver_for(spark, d).quarantine


def reject_reasons(spark: SparkSession, d: str) -> DataFrame:
    return reject_reason_counts(silver_for(spark, d).tagged)


def _tagged(spark: SparkSession, d: str) -> DataFrame:
    """All raw orders with the reason that rejects them, in one pass."""
    raw = raw_tables(spark, d)
    return tag_orders(raw.orders, _clean_customers(raw.customers), _clean_products(raw.products), _clean_stores(raw.stores))


def fk_valid(spark: SparkSession, d: str) -> DataFrame:
    """Quality-passed orders whose customer, product and store are known."""
    return _tagged(spark, d).where("rejection_reason is null").select(*ORDER_COLUMNS)


def fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Quality-passed orders whose customer, product or store is unknown or null."""
    return _tagged(spark, d).where(F.col("rejection_reason") == ORPHAN_FOREIGN_KEY)


def quality_rejects(spark: SparkSession, d: str) -> DataFrame:
    """D4/D6/D8 without the stored silver: quality rejects and FK orphans merged."""
    tagged = _tagged(spark, d)
    orphan = F.col("rejection_reason") == ORPHAN_FOREIGN_KEY
    return merge_rejects(tagged.where(~orphan), tagged.where(orphan))


def malformed_records(spark: SparkSession, d: str) -> DataFrame:
    """S2 + D4: raw orders landed as text with words for numbers (k%401 = 0: quantity,
    k%409 = 0: order id); lines by reason, clean ones under ``clean``."""
    path, k = scratch_path(spark, "raw_orders_text"), F.col("order_id")
    text = raw_tables(spark, d).orders.select(
        F.when(k % 409 == 0, F.lit("abc")).otherwise(k.cast("string")).alias("order_id"),
        "customer_id", "product_id", "store_id", "order_date",
        F.when(k % 401 == 0, F.lit("two")).otherwise(F.col("quantity").cast("string")).alias("quantity"), "channel")
    write_csv(text, path)
    tagged = tag_order_quality(read_csv(spark, path, RAW_SCHEMAS["orders"]))
    return (tagged.groupBy(F.coalesce("rejection_reason", F.lit("clean")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("rows")))


def dq_customers(spark: SparkSession, d: str) -> DataFrame:
    return customer_quality(_clean_customers(raw_tables(spark, d).customers))


def dq_orders(spark: SparkSession, d: str) -> DataFrame:
    """What the ingest counted while it wrote the orders."""
    silver = silver_for(spark, d)
    counted = spark.createDataFrame([(silver.rows_in, silver.rows_clean)], "rows_in long, rows_clean long")
    return quality_rates(counted)


def scan_csv(spark: SparkSession, d: str) -> DataFrame:
    """Raw orders written as headered CSV and read back with the schema."""
    path = scratch_path(spark, "raw_orders_csv")
    write_csv(raw_tables(spark, d).orders, path)
    return read_csv(spark, path, RAW_SCHEMAS["orders"]).select(*RAW_SCHEMAS["orders"].names)


def sink_parquet(spark: SparkSession, d: str) -> DataFrame:
    """The silver customers table as written."""
    return silver_for(spark, d).customers


def fact_revenue(spark: SparkSession, d: str) -> DataFrame:
    """K7: clean orders priced by product."""
    silver = silver_for(spark, d)
    return _fact_revenue(silver.orders, silver.products)


def scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    """S3: SQL straight over the silver Parquet folders: units and lines by product."""
    s = silver_for(spark, d)
    return spark.sql(f"""
        SELECT o.product_id, p.product_name, SUM(o.quantity) AS units, COUNT(*) AS lines
        FROM parquet.`{s.location}/orders_tagged` o
        JOIN parquet.`{s.location}/products` p ON o.product_id = p.product_id
        WHERE o.rejection_reason IS NULL
        GROUP BY o.product_id, p.product_name""")


def fact_sales(spark: SparkSession, d: str) -> DataFrame:
    """K8: the stored fact table (sale_id and load time left out)."""
    return star_for(spark, d).fact_sales.select(*FACT_COLUMNS)


def _passed_source(spark: SparkSession, d: str) -> Source:
    """Silver dimensions and the orders that passed the quality rules, orphans among them."""
    s = silver_for(spark, d)
    reason = F.col("rejection_reason")
    passed = s.tagged.where(reason.isNull() | (reason == ORPHAN_FOREIGN_KEY)).select(*ORDER_COLUMNS)
    return Source(s.customers, s.products, s.stores, passed)


_LOADS: dict = {}


def fact_skipped(spark: SparkSession, d: str) -> DataFrame:
    """K9: quality-passed orders that find no dimension key, as the load wrote them."""
    key = (spark.sparkContext.applicationId, source_signature(spark, d))
    if key not in _LOADS:
        _LOADS[key] = run_load(spark, _passed_source(spark, d), scratch_path(spark, "raw_star"))
    return _LOADS[key].skipped.select(*SKIP_COLUMNS)


def fact_full_refresh(spark: SparkSession, d: str) -> DataFrame:
    """Raw -> silver -> star twice: a first version without the later customers and
    with other product names, then the whole batch; facts of the current version."""
    warehouse = scratch_path(spark, "warehouse")
    full = _passed_source(spark, d)
    first = Source(full.customers.where(F.col("signup_date") < FIRST_BATCH_SIGNUP_BEFORE),
                   full.products.withColumn("product_name", F.concat("product_name", F.lit(" (old)"))),
                   full.stores, full.orders)
    refresh(spark, warehouse, first)
    refresh(spark, warehouse, full)
    star = current(spark, warehouse)
    return (star.fact_sales.join(star.dim_customer.select("customer_key", "customer_id"), "customer_key")
            .join(star.dim_product.select("product_key", "product_name"), "product_key")
            .join(star.dim_store.select("store_key", "store_id"), "store_key")
            .select("order_id", "customer_id", "product_name", "store_id", "date_key", "quantity", "revenue"))


def surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    """K1: customer surrogate keys, dense in customer-id order."""
    return star_for(spark, d).dim_customer.select("customer_key", "customer_id")


def dim_date(spark: SparkSession, d: str) -> DataFrame:
    """K5 + K10: the calendar dimension spanning the order years."""
    return star_for(spark, d).dim_date


def insert_only_merge_dates(spark: SparkSession, d: str) -> DataFrame:
    """K6: a first calendar (to 1998, day names in capitals) and the full one, insert-only:
    days met before keep what they have."""
    orders = TableSet(spark, d).orders
    b = year_bounds(orders, "o_orderdate")
    first = dim_date_from_range(b.select("start", F.to_date(F.lit(FIRST_BATCH_CALENDAR_END)).alias("end")))
    full = dim_date_from_range(b)
    return insert_only_merge(first.withColumn("day_name", F.upper("day_name")), full, "date_key")


def _scd1(spark: SparkSession, d: str, name: str, first_batch: Column) -> DataFrame:
    """A stored dimension of the first batch as landed (white space and all; ids divisible
    by 11 among them), and the cleaned rows of all other ids merged into it: ids that only
    the first batch holds stay as they were."""
    raw = raw_tables(spark, d)
    table, nat, key, attrs = DIMENSIONS[name]
    raw_df = getattr(raw, table)
    cleaner = {"customers": _clean_customers, "products": _clean_products, "stores": _clean_stores}[table]
    only_first = F.col(nat) % 11 == 0
    first = raw_df.where(first_batch | only_first)
    if "signup_date" in attrs:  # the first load types the date but keeps text as landed
        first = first.withColumn("signup_date", lenient_iso_date("signup_date"))
    second = cleaner(raw_df).where(~only_first)
    first, second = together(lambda: stored(first.select(nat, *attrs), scratch_path(spark, f"{name}_first")),
                             lambda: stored(second.select(nat, *attrs), scratch_path(spark, f"{name}_second")))
    before = dimension_store.create(first, nat, key, attrs, scratch_path(spark, name))
    after, _ = dimension_store.merge(before, second, scratch_path(spark, name))
    return after.read(spark).select(key, nat, *attrs)


def scd1_customer(spark: SparkSession, d: str) -> DataFrame:
    """K2: raw customers with ids under 900 or divisible by 4 or 11 loaded first, then the
    cleaned ones merged (attributes overwritten, keys kept, new keys appended)."""
    return _scd1(spark, d, "dim_customer", (F.col("customer_id") < 900) | (F.col("customer_id") % 4 == 0))


def scd1_product(spark: SparkSession, d: str) -> DataFrame:
    """K3: products under 1500 (and ids divisible by 11) loaded first, then the catalogue merged."""
    return _scd1(spark, d, "dim_product", F.col("unit_price") < FIRST_BATCH_PRICE_BELOW)


def scd1_store(spark: SparkSession, d: str) -> DataFrame:
    """K4: stores of nations named up to NATION_5 (and ids divisible by 11) first, then the others merged."""
    return _scd1(spark, d, "dim_store", F.col("country") <= "NATION_5")


def constraint_violations(spark: SparkSession, d: str) -> DataFrame:
    """The declared rules on candidate tables with breaches of every kind: repeated
    ids, nulls, texts too long, prices and quantities out of range, unknown parents,
    dates outside the calendar."""
    raw, star = raw_tables(spark, d), star_for(spark, d)

    def candidate(df: DataFrame, name: str) -> DataFrame:
        """Stored: a table is read for its own rules, its keys and as a parent."""
        return stored(df, scratch_path(spark, f"candidate_{name}"))

    def blank(col: str, when) -> Column:
        return F.when(~when, F.col(col)).alias(col)

    c, p, s, o = F.col("customer_id"), F.col("product_id"), F.col("store_id"), F.col("order_id")
    cust = _clean_customers(raw.customers)
    cust = cust.unionByName(cust.where(c % 50 == 0)).withColumns({
        "email": blank("email", c % 41 == 0),
        "last_name": F.when(c % 43 == 0, F.repeat("last_name", F.lit(20))).otherwise(F.col("last_name"))})
    prod = _clean_products(raw.products)
    prod = prod.unionByName(prod.where(p % 50 == 0)).withColumns({
        "unit_price": F.when(p % 17 == 0, -F.col("unit_price")).otherwise(F.col("unit_price")),
        "category": blank("category", p % 47 == 0)})
    store = _clean_stores(raw.stores)
    store = store.unionByName(store.where(s % 3 == 0)).withColumn(
        "store_name", F.when(s % 4 == 0, F.repeat("store_name", F.lit(30))).otherwise(F.col("store_name")))
    cust, prod, store = together(lambda: candidate(cust, "customers"), lambda: candidate(prod, "products"),
                                 lambda: candidate(store, "stores"))
    orders = raw.orders.withColumn("order_date", parse_messy_date("order_date")).withColumn(
        "channel", F.when(o % 401 == 0, F.repeat("channel", F.lit(10))).otherwise(F.col("channel")))
    days = star.dim_date
    days = days.unionByName(days.where((F.col("month") == 1) & (F.col("day") == 1))).withColumn(
        "quarter", F.when(F.col("day") == 31, F.lit(5)).otherwise(F.col("quarter")))
    fact = star.fact_sales.select(*FACT_COLUMNS).withColumns({
        "customer_key": F.when(o % 101 == 0, F.lit(-1)).otherwise(F.col("customer_key")),
        "date_key": F.when(o % 103 == 0, F.lit(19000101)).otherwise(F.col("date_key")),
        "quantity": F.when(o % 107 == 0, F.lit(0)).otherwise(F.col("quantity")),
        "revenue": blank("revenue", o % 109 == 0)})
    rules = [
        *dimension_rules(cust, prod, store),
        date_rules(days),
        TableRules("orders", orders, not_null=["order_id", "order_date", "quantity", "channel"],
                   checks={"quantity>0": F.col("quantity") > 0},
                   max_length={"channel": 50},
                   foreign_keys=[("customer_id", cust, "customer_id"),
                                 ("product_id", prod, "product_id"),
                                 ("store_id", store, "store_id")]),
        fact_rules(fact, star.dim_customer, star.dim_product, star.dim_store, star.dim_date),
    ]
    return validate(rules)


ETL_QUERIES = {
    "parse_dates": parse_dates,
    "clean_customers": clean_customers,
    "clean_products": clean_products,
    "clean_stores": clean_stores,
    "clean_orders": clean_orders,
    "quarantine_orders": quarantine_orders,
    "quality_rejects": quality_rejects,
    "reject_reasons": reject_reasons,
    "fk_valid": fk_valid,
    "fk_orphans": fk_orphans,
    "malformed_records": malformed_records,
    "dq_customers": dq_customers,
    "dq_orders": dq_orders,
    "scan_csv": scan_csv,
    "sink_parquet": sink_parquet,
    "fact_revenue": fact_revenue,
    "scan_parquet": scan_parquet,
    "fact_sales": fact_sales,
    "fact_skipped": fact_skipped,
    "fact_full_refresh": fact_full_refresh,
    "surrogate_keys": surrogate_keys,
    "dim_date": dim_date,
    "insert_only_merge": insert_only_merge_dates,
    "scd1_customer": scd1_customer,
    "scd1_product": scd1_product,
    "scd1_store": scd1_store,
    "constraint_violations": constraint_violations,
}


def stream_ingest_orders(spark: SparkSession, d: str) -> DataFrame:
    """Structured Streaming run of the order ingest over the raw orders landed as
    CSV files, in two micro-batches; returns every tagged row."""
    from quarry.streaming.order_ingest import read_ingested, start_order_ingest
    raw = raw_tables(spark, d)
    landing = scratch_path(spark, "landing_orders")
    write_csv(raw.orders, landing)
    files = len(spark.read.schema(RAW_SCHEMAS["orders"]).csv(landing).inputFiles())
    out = scratch_path(spark, "stream_orders")
    q = start_order_ingest(spark, landing, out, scratch_path(spark, "stream_ckpt"),
                           _clean_customers(raw.customers), _clean_products(raw.products),
                           _clean_stores(raw.stores), files_per_batch=max(1, (files + 1) // 2))
    q.awaitTermination()
    return read_ingested(spark, out).select(*ORDER_COLUMNS, "rejection_reason")


ETL_QUERIES["stream_ingest_orders"] = stream_ingest_orders
