"""Silver -> star job (dimensions first, then the fact).

A first load numbers each dimension in natural-key order; a later load merges
into the previous version: the three entity dimensions by rewriting the buckets
in which rows changed (SCD type 1), the calendar insert-only. The fact is a full
refresh. The declared constraints are enforced on the landed dimensions before
anything is numbered, and on the fact while it's written. A broken rule raises,
the load's folder goes, and the current version stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.operators import dimension_store
from quarry.operators.dimension_store import StoredDimension
from quarry.operators.modeling import (
    FACT_COLUMNS, SKIP_COLUMNS, dim_date_between, insert_only_merge, is_skipped, keyed_lines,
    priced_lines,
)
from quarry.operators.quality import ConstraintViolation, TableRules, enforce, rule_counts
from quarry.plans import versions
from quarry.plans.versions import ConcurrentCommit, Version, latest, published  # noqa: F401
from quarry.session import scratch_path, together
from quarry.sources.files import stored
from quarry.sources.tables import TableSet
from quarry.sources.tpch_star import (
    Star, customer_source, join_tasks, order_headers, order_items, product_source, source_signature, store_source,
)

DIMENSIONS = {
    # name: (silver table, natural key, surrogate key, attributes)
    "dim_customer": ("customers", "customer_id", "customer_key",
                     ["first_name", "last_name", "email", "signup_date", "city", "country"]),
    "dim_product": ("products", "product_id", "product_key", ["product_name", "category", "unit_price"]),
    "dim_store": ("stores", "store_id", "store_key", ["store_name", "city", "country"]),
}
#: Longest calendar a load accepts when the range comes from the data.
MAX_CALENDAR_YEARS = 100


@dataclass
class Source:
    """What a load reads: clean dimensions and order lines (a ``Silver`` has the same fields).

    If ``headers`` holds what lines of an order share, ``orders`` has the other columns;
    ``tasks``: see :func:`~quarry.operators.modeling.keyed_lines`.
    """
    customers: DataFrame
    products: DataFrame
    stores: DataFrame
    orders: DataFrame
    headers: DataFrame | None = None
    tasks: int | None = None


def dimension_rules(customers: DataFrame, products: DataFrame, stores: DataFrame) -> list[TableRules]:
    """The declared constraints of the three entity dimensions."""
    return [
        TableRules("dim_customer", customers, not_null=["customer_id", "first_name", "last_name", "email", "country"],
                   unique=[["customer_id"]],
                   max_length={"first_name": 100, "last_name": 100, "email": 255, "city": 150, "country": 150}),
        TableRules("dim_product", products, not_null=["product_id", "product_name", "category", "unit_price"],
                   unique=[["product_id"]], checks={"unit_price>=0": F.col("unit_price") >= 0},
                   max_length={"product_name": 255, "category": 100}),
        TableRules("dim_store", stores, not_null=["store_id", "store_name", "city", "country"],
                   unique=[["store_id"]], max_length={"store_name": 255, "city": 150, "country": 150}),
    ]


def date_rules(dim_date: DataFrame) -> TableRules:
    return TableRules("dim_date", dim_date, not_null=["date_key", "full_date", "day", "month", "quarter", "year"],
                      unique=[["date_key"], ["full_date"]],
                      checks={"month 1-12": F.col("month").between(1, 12),
                              "quarter 1-4": F.col("quarter").between(1, 4),
                              "day_of_week 0-6": F.col("day_of_week").between(0, 6)})


def fact_rules(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_store: DataFrame,
               dim_date: DataFrame) -> TableRules:
    return TableRules("fact_sales", fact,
                      not_null=["order_id", "customer_key", "product_key", "store_key", "date_key", "channel",
                                "quantity", "unit_price", "revenue"],
                      checks={"quantity>0": F.col("quantity") > 0, "unit_price>=0": F.col("unit_price") >= 0,
                              "revenue>=0": F.col("revenue") >= 0},
                      max_length={"channel": 50},
                      foreign_keys=[("customer_key", dim_customer, "customer_key"),
                                    ("product_key", dim_product, "product_key"),
                                    ("store_key", dim_store, "store_key"), ("date_key", dim_date, "date_key")])


def _whole_years(first: int, last: int) -> tuple[str, str]:
    """The calendar from the first to the last date key: whole years, bounded, else an error."""
    lo, hi = first // 10000, last // 10000
    if hi - lo + 1 > MAX_CALENDAR_YEARS:
        raise ConstraintViolation(f"dim_date: order dates span {hi - lo + 1} years; state the calendar range")
    return f"{lo:04d}-01-01", f"{hi:04d}-12-31"


def run_load(spark: SparkSession, source, location: str, previous: Star | None = None,
             calendar: tuple[str, str] | None = None) -> Star:
    """Build and check one version below ``location``; nothing is published.

    The looked-up lines are written once, by ``skipped`` and ``sale_year`` and sorted
    by date inside a file, so row groups prune by ``date_key``; facts and skipped
    lines are two folders of that one table and add up to the input. Without a stated
    ``calendar`` it spans the years of the lines, whose dates the same write observes.
    """
    landed = dict(zip(DIMENSIONS, together(*[
        lambda t=table, c=(nat, *attrs): stored(getattr(source, t).select(*c), scratch_path(spark, f"landed_{t}"))
        for table, nat, _, attrs in DIMENSIONS.values()]), strict=True))
    enforce(dimension_rules(*landed.values()))

    def dimension(name: str) -> StoredDimension:
        _, nat, key, attrs = DIMENSIONS[name]
        if previous is None:
            return dimension_store.create(landed[name], nat, key, attrs, f"{location}/{name}", checked=True)
        return dimension_store.merge(previous.dimensions[name], landed[name], f"{location}/{name}", checked=True)[0]

    def days(span: tuple[str, str] | None) -> DataFrame:
        dates = dim_date_between(spark, *(span or ("1970-01-01", "1970-01-01"))).where(F.lit(span is not None))
        if previous is not None:
            dates = insert_only_merge(previous.dim_date, dates, "date_key")
        dates = stored(dates, f"{location}/dim_date")
        enforce([date_rules(dates)])
        return dates

    *made, dates = together(*[lambda n=name: dimension(n) for name in DIMENSIONS],
                            lambda: days(calendar) if calendar else None)
    dims = dict(zip(DIMENSIONS, made, strict=True))
    out = {name: dim.read(spark) for name, dim in dims.items()}
    keyed = keyed_lines(source.orders, out["dim_customer"], out["dim_product"], out["dim_store"],
                        getattr(source, "headers", None), getattr(source, "tasks", None))
    written, seen = _write_lines(keyed, out, dates, f"{location}/fact_lines")
    counts = {rule: n for rule, n in seen.items() if rule not in ("first", "last")}
    if broken := {rule: n for rule, n in counts.items() if n and rule != "skipped"}:
        raise ConstraintViolation("; ".join(f"fact_sales.{rule}: {n}" for rule, n in broken.items()))
    if dates is None:
        dates = days(None if seen["first"] is None else _whole_years(seen["first"], seen["last"]))
    fact = written.where(~F.col("skipped")).select("sale_id", *FACT_COLUMNS, "loaded_at", "sale_year")
    skipped = written.where("skipped").select(*SKIP_COLUMNS)
    return Star(out["dim_customer"], out["dim_product"], out["dim_store"], dates, fact, skipped, location,
                skipped_rows=counts["skipped"], dimensions=dims)


def _write_lines(lines: DataFrame, dims: dict[str, DataFrame], dates: DataFrame | None,
                 path: str) -> tuple[DataFrame, dict]:
    """The looked-up lines as written, and what the write observed: skipped lines, breaches of each
    rule, first and last day.

    The customer, product and store keys come out of the dimensions, so only the date's
    needs a check of its own, and only if the calendar is stated (``dates``). Months lie
    together; Spark splits busy ones by their size (rebalance), and what can be derived from
    a line's other columns is derived after that exchange; the natural keys go through it for
    skipped lines only, as the facts have surrogate keys instead. What is observed stands
    after the last exchange, in the tasks that write, so a stage that runs again isn't
    counted twice; ``sale_id`` is given there as well: task and position, whatever
    order a task that runs again meets its rows in.
    """
    extra = []
    if dates is not None:
        lines = lines.join(dates.select(F.col("date_key").alias("_q_date")), F.col("date_key") == F.col("_q_date"), "left")
        extra = [(F.col("date_key").isNotNull() & F.col("_q_date").isNull()).alias("_q_unknown")]
    dealt = (lines.withColumns({c: F.when(is_skipped(), F.col(c)) for c in ("customer_id", "product_id", "store_id")})
             .select("*", *extra, (F.col("date_key") / 100).cast("int").alias("_q_month"))
             .hint("rebalance", F.col("_q_month")))
    unknown = F.col("_q_unknown") if extra else F.lit(False)
    lines = priced_lines(dealt, *["_q_unknown" for _ in extra]).withColumn(
        "sale_year", (F.col("date_key") / 10000).cast("smallint"))
    columns = [c for c in lines.columns if c not in ("_q_unknown", "sale_year")]
    rules = fact_rules(lines, dims["dim_customer"], dims["dim_product"], dims["dim_store"], dates)
    kept = ~F.col("skipped")
    watched = {rule: F.count_if(kept & broken) for rule, broken in rule_counts(rules)}
    watched |= {"foreign_key:date_key": F.count_if(kept & unknown), "skipped": F.count_if("skipped"),
                "first": F.min("date_key"), "last": F.max("date_key")}
    seen = Observation()
    dealt = (lines.sortWithinPartitions("skipped", "sale_year", "date_key")
             .observe(seen, *[c.alias(f"c{i}") for i, c in enumerate(watched.values())])
             .select((F.monotonically_increasing_id() + 1).alias("sale_id"), *columns,
                     F.current_timestamp().alias("loaded_at"), "sale_year"))
    written = stored(dealt, path, ["skipped", "sale_year"])
    found = seen.get
    return written, {rule: found.get(f"c{i}") or (None if rule in ("first", "last") else 0) for i, rule in enumerate(watched)}


# ------------------------------------------------------------------ versions
_FACT_LINES = (
    "sale_id long, order_id long, customer_id long, product_id long, store_id long, customer_key long, "
    "product_key long, store_key long, date_key int, channel string, quantity int, unit_price decimal(10,2), "
    "revenue decimal(12,2), missing_customer boolean, missing_product boolean, missing_store boolean, "
    "revenue_too_large boolean, loaded_at timestamp, skipped boolean, sale_year smallint")


def open_version(spark: SparkSession, version: Version) -> Star:
    location = version.location
    stores = {name: dimension_store.from_manifest(m) for name, m in version.dimensions.items()}
    dims = {name: dim.read(spark) for name, dim in stores.items()}
    lines = spark.read.schema(_FACT_LINES).parquet(f"{location}/fact_lines")
    return Star(dims["dim_customer"], dims["dim_product"], dims["dim_store"], spark.read.parquet(f"{location}/dim_date"),
                lines.where(~F.col("skipped")).select("sale_id", *FACT_COLUMNS, "loaded_at", "sale_year"),
                lines.where("skipped").select(*SKIP_COLUMNS), location, skipped_rows=version.skipped_rows,
                dimensions=stores)


def current(spark: SparkSession, warehouse: str) -> Star | None:
    """The version published last, or None."""
    version = latest(spark, warehouse)
    return open_version(spark, version) if version else None


def refresh(spark: SparkSession, warehouse: str, source, calendar: tuple[str, str] | None = None,
            most_tries: int = 5) -> Star:
    """Load a new version on top of the current one, check it, publish it.

    If another load has published meanwhile, this one starts again on top of that
    version, so no version is lost; what a load that fails or loses has written goes.
    """
    for _ in range(most_tries):
        base = latest(spark, warehouse)
        number = (base.version if base else 0) + 1
        location = versions.new_location(warehouse, number)
        try:
            star = run_load(spark, source, location, open_version(spark, base) if base else None, calendar)
            manifests = {name: dim.manifest() for name, dim in star.dimensions.items()}
            won = versions.commit(spark, warehouse, number, location, star.skipped_rows, manifests)
        except BaseException:
            versions.drop(spark, location)
            raise
        if won:
            return star
        versions.drop(spark, location)
    raise ConcurrentCommit(f"{warehouse}: other loads were faster {most_tries} times")


# ------------------------------------------------------------------ test binding
_STAR_CACHE: dict[tuple, Star] = {}


def load_star(spark: SparkSession, data_dir: str) -> Star:
    """The star of the test tables, loaded by the same job as any other source."""
    t = TableSet(spark, data_dir)
    source = Source(customer_source(t), product_source(t), store_source(t), order_items(t), order_headers(t), join_tasks(t))
    return run_load(spark, source, scratch_path(spark, "star"))


def star_for(spark: SparkSession, data_dir: str) -> Star:
    """The stored star for ``data_dir`` in this application (built once for each state of the input)."""
    key = (spark.sparkContext.applicationId, source_signature(spark, data_dir))
    if key not in _STAR_CACHE:
        _STAR_CACHE[key] = load_star(spark, data_dir)
    return _STAR_CACHE[key]
