"""The analytical report suite over the star schema, as DataFrame functions.

Each report takes a :class:`~quarry.sources.tpch_star.Star` (any object with the
five star DataFrames) and its literals as keyword parameters, and returns a lazy
DataFrame. Plans follow three rules:

* aggregate the fact on its own keys before joining a dimension, so a join sees
  at most one row per key (partial aggregation happens before every shuffle);
* dimension joins are left to the planner, which broadcasts only sides measured
  below ``spark.sql.autoBroadcastJoinThreshold``, the calendar among them;
* a cut to the first n lines comes after (or as a semi-join before) every join
  that can drop lines;
* a global ordering over many rows never goes through a window without
  ``PARTITION BY``: top-k reports cut first and number afterwards, full-table
  numberings use :mod:`quarry.operators.ordering`.

Sorting follows PostgreSQL (nulls last ascending, first descending) and adds
the remaining output columns as tie breakers wherever the original order is not
total, so the result of a LIMIT is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.numeric import avg_money, money, pct_money
from quarry.functions.text import full_name
from quarry.operators.distinct_bitmaps import distinct_counts, key_bitmaps
from quarry.operators.ordering import global_lead, global_ranks, ntile_of
from quarry.operators.recursion import chains, month_series
from quarry.operators.scans import lags, moving_sums, running_sums
from quarry.operators.selection import percentile_cont, tile_summary
from quarry.session import scratch_path
from quarry.sources.files import stored

# Default literals for the test binding (years with complete data, categories
# and channels that exist in it). The reference used other values for its own
# synthetic data; every report takes them as parameters.
DEFAULTS = dict(
    category="ECONOMY",
    category_a="ECONOMY",
    category_b="PROMO",
    channel="1-URGENT",
    having_threshold=240_000_000,
    tiers=(5_000, 20_000, 40_000),
    this_year=2000,
    last_year=1999,
    report_year=2000,
    spine_start="1995-01-01",
    spine_end="2001-12-01",
)


def _asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def _desc(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def _desc_last(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def _calendar(star) -> DataFrame:
    return star.dim_date


def _date_key_range(lo_year: int, hi_year: int, fact: DataFrame) -> Column:
    """Predicate on the fact for whole years: prunes row groups by date_key and,
    on the stored star, whole ``sale_year`` directories."""
    pred = F.col("date_key").between(lo_year * 10000 + 101, hi_year * 10000 + 1231)
    if "sale_year" in fact.columns:
        pred = pred & F.col("sale_year").between(lo_year, hi_year)
    return pred


def _fact_between_dates(fact: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """The fact, or its lines from ``start`` and to ``end`` where given."""
    for bound, low in ((start, True), (end, False)):
        if bound is not None:
            key = int(bound.replace("-", ""))
            for col, value in (("date_key", key), ("sale_year", key // 10000)):
                if col in fact.columns:
                    fact = fact.where(F.col(col) >= value if low else F.col(col) <= value)
    return fact


def _known(fact: DataFrame, *parents: tuple[DataFrame, str]) -> DataFrame:
    """Lines whose keys all have a parent: what inner joins with the parents keep."""
    for parent, key in parents:
        fact = fact.join(parent.select(key), key, "left_semi")
    return fact


def _revenue_by(fact: DataFrame, *keys: str, count: bool = True) -> DataFrame:
    aggs = [F.sum("revenue").alias("_rev")]
    if count:
        aggs.append(F.count(F.lit(1)).alias("_n"))
    return fact.groupBy(*keys).agg(*aggs)


def _customer_spend(star) -> DataFrame:
    """customer_id, first_name, last_name, total_spend (aggregated per key first)."""
    per_key = star.fact_sales.groupBy("customer_key").agg(money(F.sum("revenue")).alias("total_spend"))
    return per_key.join(star.dim_customer.select("customer_key", "customer_id", "first_name", "last_name"),
                        "customer_key").select("customer_id", "first_name", "last_name", "total_spend")


def _stored_spend(star) -> DataFrame:
    """Customers' spend, written once: the fact is aggregated a single time."""
    spend = _customer_spend(star)
    return stored(spend, scratch_path(spend.sparkSession, "customer_spend"))


def _threshold_top_k(df: DataFrame, col: str, k: int, descending: bool) -> Column:
    """Scalar: the k-th value of ``col`` in the given order (top-k of one column).

    Filtering ``df`` to values at or before it keeps every row that can reach
    a top-k by ``col`` (ties included), so joins after it see at most k rows
    plus ties instead of the whole table.
    """
    order = F.col(col).desc() if descending else F.col(col).asc()
    top = df.select(col).where(F.col(col).isNotNull()).orderBy(order).limit(k)
    return (top.agg(F.min(col)) if descending else top.agg(F.max(col))).scalar()


# ============================================================ basic
def top_products_in_category(star, category: str = DEFAULTS["category"], n: int = 10) -> DataFrame:
    """The n dearest products of one category."""
    return (star.dim_product.where(F.col("category") == category)
            .select("product_name", "category", "unit_price")
            .orderBy(_desc("unit_price"), _asc("product_name")).limit(n))


def distinct_categories(star) -> DataFrame:
    """The categories sold."""
    return star.dim_product.select("category").distinct().orderBy(_asc("category"))


def sales_summary(star) -> DataFrame:
    """Line count, total, rounded average, smallest and largest line revenue."""
    f = star.fact_sales
    agg = f.agg(F.count(F.lit(1)).alias("total_line_items"),
                F.sum("revenue").alias("_sum"),
                F.min("revenue").alias("min_line_item_revenue"),
                F.max("revenue").alias("max_line_item_revenue"))
    return agg.select(
        "total_line_items",
        money("_sum").alias("total_revenue"),
        avg_money("_sum", "total_line_items").alias("avg_line_item_revenue"),
        "min_line_item_revenue", "max_line_item_revenue",
    )


def revenue_by_channel(star) -> DataFrame:
    """Lines and revenue per sales channel."""
    return (star.fact_sales.groupBy("channel")
            .agg(F.count(F.lit(1)).alias("num_orders"), money(F.sum("revenue")).alias("total_revenue"))
            .orderBy(_desc("total_revenue"), _asc("channel")))


def category_revenue_having(star, threshold: float = DEFAULTS["having_threshold"]) -> DataFrame:
    """Categories whose revenue exceeds a threshold (GROUP BY + HAVING)."""
    per_product = _revenue_by(star.fact_sales, "product_key", count=False)
    return (per_product.join(star.dim_product.select("product_key", "category"), "product_key")
            .groupBy("category").agg(money(F.sum("_rev")).alias("total_revenue"))
            .where(F.col("total_revenue") > F.lit(threshold))
            .orderBy(_desc("total_revenue"), _asc("category")))


def recent_orders(star, n: int = 10) -> DataFrame:
    """The n latest lines with customer and product names."""
    f = _known(star.fact_sales, (star.dim_customer, "customer_key"), (star.dim_product, "product_key"),
               (star.dim_date, "date_key"))
    latest = f.where(F.col("date_key") >= _threshold_top_k(f, "date_key", n, descending=True))
    joined = (latest.join(star.dim_customer.select("customer_key", "first_name", "last_name"), "customer_key")
              .join(star.dim_product.select("product_key", "product_name"), "product_key")
              .join(_calendar(star).select("date_key", "full_date"), "date_key"))
    return (joined.select("order_id", full_name("first_name", "last_name").alias("customer_name"),
                          "product_name", "quantity", "revenue", "full_date")
            .orderBy(_desc("full_date"), _asc("order_id"), _asc("customer_name"), _asc("product_name"),
                     _asc("quantity"), _asc("revenue"))
            .limit(n))


def revenue_by_store(star, n: int = 10) -> DataFrame:
    """Top stores by revenue, grouped by (store_name, city) as in the original."""
    per_store = _revenue_by(star.fact_sales, "store_key")
    return (per_store.join(star.dim_store.select("store_key", "store_name", "city"), "store_key")
            .groupBy("store_name", "city")
            .agg(F.sum("_n").alias("num_orders"), money(F.sum("_rev")).alias("total_revenue"))
            .orderBy(_desc("total_revenue"), _asc("store_name"), _asc("city"))
            .limit(n))


def weekend_orders(star, n: int = 10) -> DataFrame:
    """First n lines placed on a Saturday or Sunday."""
    weekend = _calendar(star).where(F.col("is_weekend")).select("date_key", "full_date", "day_name")
    return (star.fact_sales.select("order_id", "date_key", "revenue").join(weekend, "date_key")
            .select("order_id", "full_date", "day_name", "revenue")
            .orderBy(_asc("full_date"), _asc("order_id"), _asc("revenue"))
            .limit(n))


# ===================================================== intermediate
def order_details(star, n: int = 10) -> DataFrame:
    """Five-table listing of the first n lines by order id."""
    f = _known(star.fact_sales, (star.dim_customer, "customer_key"), (star.dim_product, "product_key"),
               (star.dim_store, "store_key"), (star.dim_date, "date_key"))
    first = f.where(F.col("order_id") <= _threshold_top_k(f, "order_id", n, descending=False))
    joined = (first.join(star.dim_customer.select("customer_key", "first_name", "last_name"), "customer_key")
              .join(star.dim_product.select("product_key", "product_name", "category"), "product_key")
              .join(star.dim_store.select("store_key", "store_name"), "store_key")
              .join(_calendar(star).select("date_key", "full_date", "month_name"), "date_key"))
    cols = ["order_id", "customer", "product_name", "category", "store_name", "full_date",
            "month_name", "channel", "quantity", "revenue"]
    return (joined.select("order_id", full_name("first_name", "last_name").alias("customer"),
                          *cols[2:])
            .orderBy(*[_asc(c) for c in cols]).limit(n))


def monthly_revenue(star) -> DataFrame:
    """Revenue and lines per calendar month."""
    per_day = _revenue_by(star.fact_sales, "date_key")
    return (per_day.join(_calendar(star).select("date_key", "year", "month", "month_name"), "date_key")
            .groupBy("year", "month", "month_name")
            .agg(money(F.sum("_rev")).alias("monthly_revenue"), F.sum("_n").alias("num_orders"))
            .orderBy(_asc("year"), _asc("month")))


def _tier(rev: Column, tiers, labels) -> Column:
    t1, t2, t3 = tiers
    return (F.when(rev < t1, F.lit(labels[0])).when(rev < t2, F.lit(labels[1]))
            .when(rev < t3, F.lit(labels[2])).otherwise(F.lit(labels[3])))


def tier_labels(tiers, numbered: bool) -> list[str]:
    t1, t2, t3 = tiers
    if not numbered:
        return ["Small", "Medium", "Large", "Very Large"]
    return [f"1. Small (<${t1})", f"2. Medium (${t1}-{t2})", f"3. Large (${t2}-{t3})",
            f"4. Very Large (>${t3})"]


def revenue_tier_rows(star, tiers=DEFAULTS["tiers"], n: int = 10) -> DataFrame:
    """CASE bucketing of single lines, the n largest."""
    return (star.fact_sales.select("order_id", "revenue",
                                   _tier(F.col("revenue"), tiers, tier_labels(tiers, False)).alias("revenue_tier"))
            .orderBy(_desc("revenue"), _asc("order_id")).limit(n))


def revenue_tier_share(star, tiers=DEFAULTS["tiers"]) -> DataFrame:
    """Lines and revenue per tier with the share of all revenue."""
    per_tier = (star.fact_sales
                .groupBy(_tier(F.col("revenue"), tiers, tier_labels(tiers, True)).alias("revenue_tier"))
                .agg(F.count(F.lit(1)).alias("num_orders"), money(F.sum("revenue")).alias("tier_revenue")))
    # four rows: the empty OVER () window is bounded by the number of tiers
    total = F.sum("tier_revenue").over(Window.partitionBy())
    return (per_tier.select("revenue_tier", "num_orders", "tier_revenue",
                            pct_money(F.col("tier_revenue"), total).alias("pct_of_total_revenue"))
            .orderBy(_asc("revenue_tier")))


def above_average_lines(star, n: int = 10) -> DataFrame:
    """Lines above the overall average (scalar subquery), the n largest.

    ``revenue > sum / count`` is evaluated as ``revenue * count > sum`` in
    exact decimals.
    """
    f = star.fact_sales
    stats = f.agg(F.sum("revenue").alias("s"), F.count(F.lit(1)).alias("c"))
    s = stats.select("s").scalar()
    c = stats.select("c").scalar()
    return (f.where(F.col("revenue") * c.cast("decimal(20,0)") > s)
            .select("order_id", "revenue")
            .orderBy(_desc("revenue"), _asc("order_id")).limit(n))


def channel_customers(star, channel: str = DEFAULTS["channel"], n: int = 10) -> DataFrame:
    """Customers with at least one line in a channel (IN subquery = semi-join)."""
    buyers = (star.fact_sales.where(F.col("channel") == channel)
              .select("customer_key").distinct())
    return (star.dim_customer.join(buyers, "customer_key", "left_semi")
            .select("customer_id", "first_name", "last_name", "country")
            .orderBy(_asc("customer_id")).limit(n))


def best_order_per_customer(star, n: int = 10) -> DataFrame:
    """Each customer's highest-revenue lines (ties kept), the n largest.

    The correlated MAX subquery becomes ``rank() <= 1`` per customer: each task
    keeps only its best lines of a customer before the shuffle (window group
    limit), so the fact is read once and never shuffled whole.
    """
    best = Window.partitionBy("customer_key").orderBy(_desc_last("revenue"))
    top = (star.fact_sales.where(F.col("revenue").isNotNull()).select("customer_key", "order_id", "revenue")
           .withColumn("_r", F.rank().over(best)).where(F.col("_r") <= 1))
    return (top.join(star.dim_customer.select("customer_key", "customer_id", "first_name", "last_name"),
                     "customer_key")
            .select("customer_id", "first_name", "last_name", "order_id", "revenue")
            .orderBy(_desc("revenue"), _asc("customer_id"), _asc("order_id")).limit(n))


def unique_customers_by_category(star) -> DataFrame:
    """Distinct customers and lines per category.

    COUNT(DISTINCT) in two aggregation steps: (category, customer) pairs first
    -- few categories, so partial aggregation collapses each task's lines to its
    distinct pairs before the shuffle -- then per category.
    """
    per_pair = (star.fact_sales.select("product_key", "customer_key")
                .join(star.dim_product.select("product_key", "category"), "product_key")
                .groupBy("category", "customer_key").agg(F.count(F.lit(1)).alias("_n")))
    return (per_pair.groupBy("category")
            .agg(F.count(F.lit(1)).alias("unique_customers"), F.sum("_n").alias("total_line_items"))
            .orderBy(_desc("unique_customers"), _asc("category")))


def customer_bitmaps(star) -> DataFrame:
    """Stored bitmaps of the customers of each month and category: what distinct counts of
    any months read instead of the fact."""
    lines = (star.fact_sales.select("product_key", "customer_key", "date_key")
             .join(star.dim_product.select("product_key", "category"), "product_key")
             .withColumn("month_key", (F.col("date_key") / 100).cast("int")))
    found = key_bitmaps(lines, ["category", "month_key"], "customer_key")
    return stored(found, scratch_path(found.sparkSession, "customer_bitmaps"))


def unique_customers_between(bitmaps: DataFrame, first_month: int, last_month: int) -> DataFrame:
    """Distinct customers and lines per category in the months (yyyymm) of a period, from
    stored bitmaps."""
    some = bitmaps.where(F.col("month_key").between(first_month, last_month))
    return distinct_counts(some, ["category"], "unique_customers", "total_line_items")


def unique_customers_by_year(star) -> DataFrame:
    """Distinct customers and lines per category of every year, or-ed from monthly bitmaps."""
    yearly = customer_bitmaps(star).withColumn("year", (F.col("month_key") / 100).cast("long"))
    return distinct_counts(yearly, ["category", "year"], "unique_customers", "total_line_items")


def customers_without_orders(star, start: str | None = None, end: str | None = None,
                             n: int = 10) -> DataFrame:
    """Customers with no line at all, or none in a given period (anti-join)."""
    active = _fact_between_dates(star.fact_sales, start, end).select("customer_key").distinct()
    return (star.dim_customer.join(active, "customer_key", "left_anti")
            .select("customer_id", "first_name", "last_name", "email")
            .orderBy(_asc("customer_id")).limit(n))


def products_never_sold(star, start: str | None = None, end: str | None = None) -> DataFrame:
    """Number of products with no line at all, or none in a given period."""
    sold = _fact_between_dates(star.fact_sales, start, end).select("product_key").distinct()
    return (star.dim_product.join(sold, "product_key", "left_anti")
            .agg(F.count(F.lit(1)).alias("products_never_sold")))


# ========================================================= advanced
def top_spenders_p95(star, p: float = 0.95, n: int = 15) -> DataFrame:
    """Customers whose spend reaches the 95th percentile (exact, interpolated).

    The percentile comes from refining histograms over the stored spend: no customer
    is sorted but the n of the result.
    """
    spend = _stored_spend(star)
    p95 = percentile_cont(spend, "total_spend", p)
    return (spend.where(F.col("total_spend").cast("double") >= F.lit(p95).cast("double"))
            .orderBy(_desc("total_spend"), _asc("customer_id")).limit(n))


def category_yoy(star, this_year: int = DEFAULTS["this_year"],
                 last_year: int = DEFAULTS["last_year"]) -> DataFrame:
    """Category revenue of two years side by side and the change in percent.

    The two yearly slices of one aggregate are read in a single pass with
    conditional sums; a category must have lines in both years (inner join).
    """
    f = star.fact_sales
    lo, hi = min(this_year, last_year), max(this_year, last_year)
    per = (f.where(_date_key_range(lo, hi, f))
           .join(_calendar(star).select("date_key", "year"), "date_key")
           .where(F.col("year").isin(this_year, last_year))
           .groupBy("product_key", "year").agg(F.sum("revenue").alias("_rev"))
           .join(star.dim_product.select("product_key", "category"), "product_key"))
    ly = f"revenue_{last_year}"
    ty = f"revenue_{this_year}"
    both = (per.groupBy("category")
            .agg(money(F.sum(F.when(F.col("year") == last_year, F.col("_rev")))).alias(ly),
                 money(F.sum(F.when(F.col("year") == this_year, F.col("_rev")))).alias(ty))
            .where(F.col(ly).isNotNull() & F.col(ty).isNotNull()))
    return (both.select("category", ly, ty,
                        pct_money(F.col(ty) - F.col(ly), F.col(ly)).alias("pct_change"))
            .orderBy(_desc("pct_change"), _asc("category")))


def month_spine_revenue(star, start: str = DEFAULTS["spine_start"],
                        end: str = DEFAULTS["spine_end"]) -> DataFrame:
    """Revenue of every month in [start, end], zero for months without lines.

    The month series is a recursive query; the fact is aggregated per day before the
    two left joins.
    """
    months = month_series(star.fact_sales.sparkSession, start, end)
    per_day = _revenue_by(star.fact_sales, "date_key", count=False)
    cal = _calendar(star).select("date_key", "year", "month")
    spine = months.join(cal, (F.year("month_start") == F.col("year"))
                        & (F.month("month_start") == F.col("month")), "left")
    return (spine.join(per_day, "date_key", "left")
            .groupBy("month_start")
            .agg(money(F.coalesce(F.sum("_rev"), F.lit(0))).alias("revenue"))
            .orderBy(_asc("month_start")))


def quarter_pivot(star, year: int = DEFAULTS["report_year"]) -> DataFrame:
    """One row per category, one revenue column per quarter (null when empty)."""
    f = star.fact_sales
    per = (f.where(_date_key_range(year, year, f))
           .join(_calendar(star).where(F.col("year") == year).select("date_key", "quarter"), "date_key")
           .groupBy("product_key", "quarter").agg(F.sum("revenue").alias("_rev"))
           .join(star.dim_product.select("product_key", "category"), "product_key"))
    qs = [money(F.sum(F.when(F.col("quarter") == q, F.col("_rev")))).alias(f"q{q}_revenue")
          for q in (1, 2, 3, 4)]
    return (per.groupBy("category").agg(*qs, money(F.sum("_rev")).alias("total_revenue"))
            .orderBy(_desc("total_revenue"), _asc("category")))


def channel_entities_union(star, channel: str = DEFAULTS["channel"], n: int = 20) -> DataFrame:
    """Customers and stores seen in a channel, tagged, as one distinct list.

    One pass: each line gives two tagged keys, which are made distinct; tags keep
    the two lists apart, so the union needs no second distinct.
    """
    keys = (star.fact_sales.where(F.col("channel") == channel)
            .select(F.explode(F.array(
                F.struct(F.lit("customer").alias("entity_type"), F.col("customer_key").alias("_k")),
                F.struct(F.lit("store").alias("entity_type"), F.col("store_key").alias("_k")))).alias("e"))
            .select("e.entity_type", "e._k").distinct())
    cust = star.dim_customer.select(F.lit("customer").alias("entity_type"), F.col("customer_key").alias("_k"),
                                    F.col("customer_id").alias("entity_id"))
    stores = star.dim_store.select(F.lit("store").alias("entity_type"), F.col("store_key").alias("_k"),
                                   F.col("store_id").alias("entity_id"))
    return (keys.join(cust.union(stores), ["entity_type", "_k"]).select("entity_type", "entity_id")
            .orderBy(_asc("entity_type"), _asc("entity_id")).limit(n))


def bought_both_categories(star, category_a: str = DEFAULTS["category_a"],
                           category_b: str = DEFAULTS["category_b"], n: int = 15) -> DataFrame:
    """Customers with lines in both categories (INTERSECT), as two flags in one pass."""
    prod = (star.dim_product.where(F.col("category").isin(category_a, category_b))
            .select("product_key", "category"))
    both = (star.fact_sales.select("customer_key", "product_key").join(prod, "product_key")
            .groupBy("customer_key")
            .agg(F.max(F.col("category") == category_a).alias("_a"), F.max(F.col("category") == category_b).alias("_b"))
            .where(F.col("_a") & F.col("_b")))
    return (both.join(star.dim_customer.select("customer_key", "customer_id", "first_name", "last_name"),
                      "customer_key")
            .select("customer_id", "first_name", "last_name").distinct()
            .orderBy(_asc("customer_id"), _asc("first_name"), _asc("last_name")).limit(n))


def store_pairs_same_country(star, n: int = 15) -> DataFrame:
    """Pairs of stores in one country (self-join on country, a.key < b.key).

    Only the first n pairs in (country, key a, key b) order are reported, so
    all pairs are never formed: a store opens a pair only if its country holds a
    larger key; the first n such stores are the only possible left sides, and
    each is joined with its own country's larger keys (at most n * stores rows).
    """
    s = star.dim_store.select("store_key", "store_name", "country")
    top_key = s.groupBy("country").agg(F.max("store_key").alias("_max_key"))
    openers = (s.join(top_key, "country").where(F.col("store_key") < F.col("_max_key"))
               .orderBy(_asc("country"), _asc("store_key")).limit(n)
               .select(F.col("country"), F.col("store_key").alias("_ka"), F.col("store_name").alias("store_a")))
    # openers has at most n rows: broadcasting it is size-bounded
    pairs = F.broadcast(openers).join(
        s.select("country", F.col("store_key").alias("_kb"), F.col("store_name").alias("store_b")),
        "country").where(F.col("_ka") < F.col("_kb"))
    return (pairs.orderBy(_asc("country"), _asc("_ka"), _asc("_kb")).limit(n)
            .select("store_a", "store_b", "country"))


def category_rank_by_quarter(star, year: int = DEFAULTS["report_year"], n: int = 20) -> DataFrame:
    """RANK of category revenue inside each quarter of one year."""
    f = star.fact_sales
    per = (f.where(_date_key_range(year, year, f))
           .join(_calendar(star).where(F.col("year") == year).select("date_key", "quarter"), "date_key")
           .groupBy("product_key", "quarter").agg(F.sum("revenue").alias("_rev"))
           .join(star.dim_product.select("product_key", "category"), "product_key")
           .groupBy("quarter", "category").agg(money(F.sum("_rev")).alias("revenue")))
    w = Window.partitionBy("quarter").orderBy(_desc("revenue"))
    return (per.select("quarter", "category", "revenue", F.rank().over(w).cast("long").alias("revenue_rank"))
            .orderBy(_asc("quarter"), _asc("revenue_rank"), _asc("category")).limit(n))


# ================================================== window functions
def _product_revenue(star, *by: str) -> DataFrame:
    per_product = _revenue_by(star.fact_sales, "product_key", count=False)
    return (per_product.join(star.dim_product.select("product_key", *by), "product_key")
            .groupBy(*by).agg(money(F.sum("_rev")).alias("revenue")))


def product_three_ranks(star, n: int = 15) -> DataFrame:
    """ROW_NUMBER, RANK and DENSE_RANK of product revenue, the n largest.

    Every row ranked above a top-n row is itself in the top n, so all three
    numbers are computed exactly on the n rows kept (ties broken by name).
    """
    top = (_product_revenue(star, "product_name", "category")
           .orderBy(_desc("revenue"), _asc("product_name"), _asc("category")).limit(n))
    # at most n rows: a window without PARTITION BY is bounded here
    w = Window.orderBy(_desc("revenue"), _asc("product_name"), _asc("category"))
    wr = Window.orderBy(_desc("revenue"))
    return (top.select("product_name", "category", "revenue",
                       F.row_number().over(w).cast("long").alias("row_num"),
                       F.rank().over(wr).cast("long").alias("rnk"),
                       F.dense_rank().over(wr).cast("long").alias("dense_rnk"))
            .orderBy(_desc("revenue"), _asc("product_name"), _asc("category")))


def top3_products_per_category(star, k: int = 3) -> DataFrame:
    """The k best-selling product names within each category.

    ``row_number() <= k`` over a category partition lets Spark keep only k rows
    per category in each task before the shuffle (window group limit).
    """
    rev = _product_revenue(star, "category", "product_name")
    w = Window.partitionBy("category").orderBy(_desc("revenue"), _asc("product_name"))
    return (rev.select("category", "product_name", "revenue",
                       F.row_number().over(w).cast("long").alias("rank_in_category"))
            .where(F.col("rank_in_category") <= k)
            .orderBy(_asc("category"), _asc("rank_in_category")))


def _monthly(star, year: int | None = None) -> DataFrame:
    f = star.fact_sales
    cal = _calendar(star)
    if year is not None:
        f = f.where(_date_key_range(year, year, f))
        cal = cal.where(F.col("year") == year)
    per_day = _revenue_by(f, "date_key", count=False)
    return (per_day.join(cal.select("date_key", "year", "month", "month_name"), "date_key")
            .groupBy("year", "month", "month_name").agg(money(F.sum("_rev")).alias("revenue")))


def running_total(star, year: int = DEFAULTS["report_year"]) -> DataFrame:
    """Cumulative monthly revenue of one year (twelve rows, one window)."""
    m = _monthly(star, year)
    w = Window.orderBy("month")  # default frame: RANGE UNBOUNDED PRECEDING .. CURRENT ROW
    return (m.select("month", "month_name", "revenue", money(F.sum("revenue").over(w)).alias("running_total"))
            .orderBy(_asc("month")))


def moving_average(star) -> DataFrame:
    """Trailing three-month average of monthly revenue (ROWS 2 PRECEDING)."""
    m = _monthly(star)
    w = Window.orderBy("year", "month").rowsBetween(-2, 0)
    return (m.select("year", "month", "revenue",
                     avg_money(F.sum("revenue").over(w), F.count(F.lit(1)).over(w)).alias("moving_avg_3mo"))
            .orderBy(_asc("year"), _asc("month")))


def month_over_month(star) -> DataFrame:
    """Previous month's revenue (LAG) and the change in percent."""
    m = _monthly(star)
    w = Window.orderBy("year", "month")
    prev = F.lag("revenue", 1).over(w)
    return (m.select("year", "month", "revenue", prev.alias("prev_month_revenue"))
            .select("year", "month", "revenue", "prev_month_revenue",
                    pct_money(F.col("revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue"))
                    .alias("pct_change_mom"))
            .orderBy(_asc("year"), _asc("month")))


def days_to_next_order(star, n: int = 20) -> DataFrame:
    """Next order date (LEAD) per customer and the gap in days, first n lines.

    In (customer, date, order) order the row after a line is either its LEAD
    (same customer) or belongs to the next customer (no LEAD). So the first
    n + 1 lines in that order -- a top-k, no per-customer sort -- decide every
    reported value exactly, however many lines one customer has.
    """
    lines = (star.fact_sales.select("customer_key", "order_id", "date_key")
             .join(_calendar(star).select("date_key", F.col("full_date").alias("order_date")), "date_key"))
    head = lines.orderBy(_asc("customer_key"), _asc("order_date"), _asc("order_id")).limit(n + 1)
    # n + 1 rows: the window below is bounded
    w = Window.partitionBy("customer_key").orderBy(_asc("order_date"), _asc("order_id"))
    nxt = F.lead("order_date", 1).over(w)
    return (head.select("customer_key", "order_id", "order_date", nxt.alias("next_order_date"))
            .select("customer_key", "order_id", "order_date", "next_order_date",
                    F.datediff("next_order_date", "order_date").cast("long").alias("days_until_next_order"))
            .orderBy(_asc("customer_key"), _asc("order_date"), _asc("order_id"), _asc("next_order_date"))
            .limit(n))


def spend_quartiles(star, n: int = 20, tiles: int = 4) -> DataFrame:
    """NTILE(4) of customers by spend, the n biggest spenders.

    NTILE needs a row's position and the number of customers. The first n positions
    are those of a top-k; the window over them has n rows.
    """
    spend = _stored_spend(star)
    total = spend.agg(F.count(F.lit(1))).scalar()
    order = [_desc("total_spend"), _asc("customer_id")]
    top = spend.orderBy(*order).limit(n).withColumn("_pos", F.row_number().over(Window.orderBy(*order)))
    return (top.select("customer_id", "first_name", "last_name", "total_spend",
                       ntile_of(F.col("_pos"), total, tiles).alias("spend_quartile"))
            .orderBy(*order))


def quartile_summary(star, tiles: int = 4) -> DataFrame:
    """Customers, smallest, largest and mean spend per spend quartile.

    The borders of the quartiles are order statistics (refining histograms); counts and
    sums between them are one aggregation. One row a tile reaches the driver.
    """
    spend = _stored_spend(star)
    kind = spend.schema["total_spend"].dataType.simpleString()
    rows = [(t["tile"], t["count"], t["min"], t["max"], t["sum"]) for t in tile_summary(spend, "total_spend", tiles)]
    found = spend.sparkSession.createDataFrame(
        rows, f"spend_quartile long, num_customers long, min_spend {kind}, max_spend {kind}, _sum {kind}")
    return (found.select("spend_quartile", "num_customers", "min_spend", "max_spend",
                         avg_money("_sum", "num_customers").alias("avg_spend"))
            .orderBy(_asc("spend_quartile")))


def first_last_order(star, n: int = 15) -> DataFrame:
    """First and most recent order date per customer, first n customers.

    FIRST_VALUE / LAST_VALUE over a whole-partition frame ordered by date,
    followed by DISTINCT, equal MIN / MAX per customer: a partial-aggregating
    GROUP BY instead of a per-customer sort.
    """
    f = _known(star.fact_sales.select("customer_key", "date_key"), (star.dim_date, "date_key"))
    per = f.groupBy("customer_key").agg(F.min("date_key").alias("_lo"), F.max("date_key").alias("_hi"))
    top = per.orderBy(_asc("customer_key")).limit(n)
    cal = _calendar(star).select("date_key", "full_date")
    return (top.join(cal.withColumnRenamed("date_key", "_lo").withColumnRenamed("full_date", "first_order_date"), "_lo")
            .join(cal.withColumnRenamed("date_key", "_hi").withColumnRenamed("full_date", "most_recent_order_date"), "_hi")
            .select("customer_key", "first_order_date", "most_recent_order_date")
            .orderBy(_asc("customer_key")))


def first_last_order_window(star, n: int | None = 15) -> DataFrame:
    """R35 written with a named window, FIRST_VALUE and LAST_VALUE (full frame).

    A customer's lines are reduced to distinct days first, so a window partition
    is bounded by the calendar, however many lines one customer has.
    """
    lines = (star.fact_sales.select("customer_key", "date_key").distinct()
             .join(_calendar(star).select("date_key", F.col("full_date").alias("order_date")), "date_key"))
    w = (Window.partitionBy("customer_key").orderBy("order_date")
         .rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = lines.select("customer_key", F.first_value("order_date").over(w).alias("first_order_date"),
                       F.last_value("order_date").over(w).alias("most_recent_order_date")).distinct()
    return out if n is None else out.orderBy(_asc("customer_key")).limit(n)


# ================================================ the same operators over whole tables
def all_first_last_orders(star) -> DataFrame:
    """FIRST_VALUE and LAST_VALUE over a named window for every customer."""
    return first_last_order_window(star, n=None)


def all_line_ranks(star) -> DataFrame:
    """RANK and DENSE_RANK of every line by revenue, without a window over all lines."""
    return global_ranks(star.fact_sales.select("order_id", "product_key", "revenue"), "revenue")


def all_next_orders(star) -> DataFrame:
    """LEAD of the order date for every line of every customer."""
    lines = (star.fact_sales.select("customer_key", "order_id", "date_key")
             .join(_calendar(star).select("date_key", F.col("full_date").alias("order_date")), "date_key")
             .select("customer_key", "order_id", "order_date"))
    return global_lead(lines, "customer_key", ["order_date", "order_id"], "order_date", "next_order_date")


def pivot_quarter(star) -> DataFrame:
    """G6 as a declared pivot: revenue of every product category by quarter, all years."""
    per = (star.fact_sales.select("product_key", "date_key", "revenue")
           .join(_calendar(star).select("date_key", "quarter"), "date_key")
           .groupBy("product_key", "quarter").agg(F.sum("revenue").alias("_rev"))
           .join(star.dim_product.select("product_key", "category"), "product_key"))
    wide = per.groupBy("category").pivot("quarter", [1, 2, 3, 4]).agg(money(F.sum("_rev")))
    return wide.select("category", *[F.col(str(q)).alias(f"q{q}") for q in (1, 2, 3, 4)])


def recursive_months(star) -> DataFrame:
    """Every month from the first sale to the last, with its lines (0 if none).

    The months are the rows of a recursive query between two scalars of the fact.
    """
    f = star.fact_sales.select("date_key").join(_calendar(star).select("date_key", "full_date"), "date_key")
    lines = f.groupBy(F.trunc("full_date", "month").alias("month_start")).agg(F.count(F.lit(1)).alias("lines"))
    ends = lines.agg(F.min("month_start").alias("lo"), F.max("month_start").alias("hi")).first()
    if ends["lo"] is None:
        return lines
    months = month_series(lines.sparkSession, ends["lo"].isoformat(), ends["hi"].isoformat())
    return months.join(lines, "month_start", "left").select("month_start", F.coalesce("lines", F.lit(0)).alias("lines"))


def order_chains(star, gap_days: int = 45) -> DataFrame:
    """An order that follows the customer's order before within ``gap_days`` continues
    its chain; each order with the first order of its chain and its place in it.

    The order before is a distributed LAG, the chains a recursion over links.
    """
    orders = (star.fact_sales.select("customer_key", "order_id", "date_key").distinct()
              .join(_calendar(star).select("date_key", F.col("full_date").alias("order_date")), "date_key")
              .select("customer_key", "order_id", "order_date"))
    links = lags(orders, ["customer_key"], ["order_date", "order_id"], {"order_id": "before_id", "order_date": "before_date"})
    near = F.datediff("order_date", "before_date") <= gap_days
    links = links.select("order_id", F.when(near, F.col("before_id")).alias("before_id"))
    links = stored(links, scratch_path(links.sparkSession, "order_links"))
    return chains(links, "order_id", "before_id").select(
        F.col("node").alias("order_id"), F.col("first").alias("first_order_id"), "position")


# ---------------------------------------------- windows over all lines, without a task a group
_LINE_ORDER = ["date_key", "order_id", "product_key", "store_key", "quantity", "revenue"]


def _line_number(star) -> str | None:
    """The stored number of a line, unique in a load, if the fact has it."""
    return "sale_id" if "sale_id" in star.fact_sales.columns else None


def all_running_totals(star) -> DataFrame:
    """Running revenue of each customer by day, for every line (lines of a day share it)."""
    lines = star.fact_sales.select("customer_key", "order_id", "date_key", "revenue")
    return running_sums(lines, ["customer_key"], ["date_key"], "revenue", "_sum").select(
        *lines.columns, money(F.col("_sum")).alias("running_total"))


def all_moving_averages(star, preceding: int = 2) -> DataFrame:
    """Mean revenue of a line and the two lines of the customer before it."""
    tie = _line_number(star)
    lines = star.fact_sales.select("customer_key", *_LINE_ORDER, *([tie] if tie else []))
    return moving_sums(lines, ["customer_key"], _LINE_ORDER, "revenue", preceding, "_sum", "_n", tie).select(
        "customer_key", "date_key", "order_id", "revenue", avg_money("_sum", "_n").alias("moving_avg"))


def all_previous_lines(star) -> DataFrame:
    """Revenue and day of the customer's line before, and the change in revenue, for every line."""
    tie = _line_number(star)
    lines = star.fact_sales.select("customer_key", *_LINE_ORDER, *([tie] if tie else []))
    out = lags(lines, ["customer_key"], _LINE_ORDER, {"revenue": "previous_revenue", "date_key": "previous_date_key"}, tie=tie)
    return out.select("customer_key", "date_key", "order_id", "revenue", "previous_revenue", "previous_date_key",
                      (F.col("revenue") - F.col("previous_revenue")).cast("decimal(38,2)").alias("change"))


REPORTS = {
    "top_products_in_category": top_products_in_category,
    "distinct_categories": distinct_categories,
    "sales_summary": sales_summary,
    "revenue_by_channel": revenue_by_channel,
    "category_revenue_having": category_revenue_having,
    "recent_orders": recent_orders,
    "revenue_by_store": revenue_by_store,
    "weekend_orders": weekend_orders,
    "order_details": order_details,
    "monthly_revenue": monthly_revenue,
    "revenue_tier_rows": revenue_tier_rows,
    "revenue_tier_share": revenue_tier_share,
    "above_average_lines": above_average_lines,
    "channel_customers": channel_customers,
    "best_order_per_customer": best_order_per_customer,
    "unique_customers_by_category": unique_customers_by_category,
    "customers_without_orders": customers_without_orders,
    "products_never_sold": products_never_sold,
    "top_spenders_p95": top_spenders_p95,
    "category_yoy": category_yoy,
    "month_spine_revenue": month_spine_revenue,
    "quarter_pivot": quarter_pivot,
    "channel_entities_union": channel_entities_union,
    "bought_both_categories": bought_both_categories,
    "store_pairs_same_country": store_pairs_same_country,
    "category_rank_by_quarter": category_rank_by_quarter,
    "product_three_ranks": product_three_ranks,
    "top3_products_per_category": top3_products_per_category,
    "running_total": running_total,
    "moving_average": moving_average,
    "month_over_month": month_over_month,
    "days_to_next_order": days_to_next_order,
    "spend_quartiles": spend_quartiles,
    "quartile_summary": quartile_summary,
    "first_last_order": first_last_order,
    "all_first_last_orders": all_first_last_orders,
    "all_line_ranks": all_line_ranks,
    "all_next_orders": all_next_orders,
    "pivot_quarter": pivot_quarter,
    "recursive_months": recursive_months,
    "order_chains": order_chains,
    "unique_customers_by_year": unique_customers_by_year,
    "all_running_totals": all_running_totals,
    "all_moving_averages": all_moving_averages,
    "all_previous_lines": all_previous_lines,
}
