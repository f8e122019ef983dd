"""Independent SQL (DuckDB dialect) for every registered query.

The star and raw tables are defined here a second time, in SQL, straight from
the test tables, and every literal is stated again, so a mistake in the Spark
binding cannot hide in both engines. Statements answer the question of a query
in their own way (positions instead of NTILE, self-joins instead of LAG, counts
instead of RANK). Rounded ratios use whole-cent integers (half away from zero).
"""

from __future__ import annotations

# The literals of the reports.
CATEGORY, OTHER_CATEGORY, CHANNEL = "ECONOMY", "PROMO", "1-URGENT"
CATEGORY_FLOOR = 240_000_000
TIER_LIMITS = (5_000, 20_000, 40_000)
TIER_NAMES = ("Small", "Medium", "Large", "Very Large")
TIER_RANGES = ("1. Small (<$5000)", "2. Medium ($5000-20000)", "3. Large ($20000-40000)", "4. Very Large (>$40000)")
YEAR, YEAR_BEFORE = 2000, 1999
FIRST_MONTH, LAST_MONTH = "1995-01-01", "2001-12-01"


# ------------------------------------------------------------------ helpers
def cents(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,2)) * 100 AS HUGEINT)"


def half_up_div(num: str, den: str) -> str:
    return f"((CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def to_money(q: str) -> str:
    return f"CAST(CAST({q} AS DECIMAL(36,0)) * CAST(0.01 AS DECIMAL(2,2)) AS DECIMAL(38,2))"


def avg_money(total: str, count: str) -> str:
    return to_money(half_up_div(cents(total), f"CAST({count} AS HUGEINT)"))


def pct_money(part: str, whole: str) -> str:
    num = f"({cents(part)} * 10000)"
    den = cents(whole)
    signed = f"(CASE WHEN {den} < 0 THEN -{num} ELSE {num} END)"
    return to_money(half_up_div(signed, f"abs({den})"))


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(38,2))"


# ------------------------------------------------------------------ star
STAR_CTES = """
dim_customer AS (
    SELECT CAST(row_number() OVER (ORDER BY c.c_custkey) AS BIGINT) AS customer_key,
           c.c_custkey AS customer_id,
           split_part(c.c_name, '#', 1) AS first_name,
           split_part(c.c_name, '#', 2) AS last_name,
           lower(replace(c.c_name, '#', '.')) || '@example.com' AS email,
           CAST(DATE '1994-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS DATE) AS signup_date,
           CASE WHEN c.c_custkey % 20 = 0 THEN NULL ELSE c.c_mktsegment END AS city,
           n.n_name AS country
    FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
dim_product AS (
    SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS product_key,
           p_partkey AS product_id, p_name AS product_name, p_type AS category,
           CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
    FROM part
),
dim_store AS (
    SELECT CAST(row_number() OVER (ORDER BY s.s_suppkey) AS BIGINT) AS store_key,
           s.s_suppkey AS store_id, s.s_name AS store_name, n.n_name AS city, n.n_name AS country
    FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
),
calendar_days AS (
    SELECT CAST(unnest(generate_series(
        (SELECT CAST(date_trunc('year', min(o_orderdate)) AS DATE) FROM orders),
        (SELECT CAST(date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) FROM orders),
        INTERVAL 1 DAY)) AS DATE) AS d
),
dim_date AS (
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
           CAST(day(d) AS SMALLINT) AS day, CAST(month(d) AS SMALLINT) AS month,
           monthname(d) AS month_name, CAST(quarter(d) AS SMALLINT) AS quarter,
           CAST(year(d) AS SMALLINT) AS year, CAST(isodow(d) - 1 AS SMALLINT) AS day_of_week,
           dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend
    FROM calendar_days
),
order_lines AS (
    SELECT l.l_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS product_id,
           l.l_suppkey AS store_id, CAST(o.o_orderdate AS DATE) AS order_date,
           o.o_orderpriority AS channel, CAST(l.l_quantity AS BIGINT) AS quantity
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
fact_sales AS (
    SELECT ol.order_id, c.customer_key, p.product_key, s.store_key,
           CAST(strftime(ol.order_date, '%Y%m%d') AS INTEGER) AS date_key,
           ol.channel, CAST(ol.quantity AS INTEGER) AS quantity, p.unit_price,
           CAST(ol.quantity * p.unit_price AS DECIMAL(12,2)) AS revenue
    FROM order_lines ol
    JOIN dim_customer c ON ol.customer_id = c.customer_id
    JOIN dim_product p ON ol.product_id = p.product_id
    JOIN dim_store s ON ol.store_id = s.store_id
)"""


def with_star(extra_ctes: str, select: str) -> str:
    ctes = STAR_CTES + (",\n" + extra_ctes if extra_ctes.strip() else "")
    return f"WITH RECURSIVE {ctes}\n{select}"


# A line with everything the dimensions say about it.
SALE = """sale AS (
    SELECT f.*, c.customer_id, c.first_name || ' ' || c.last_name AS buyer, p.product_name, p.category,
           st.store_id, st.store_name, d.full_date, d.year, d.month, d.month_name, d.quarter
    FROM fact_sales f, dim_customer c, dim_product p, dim_store st, dim_date d
    WHERE f.customer_key = c.customer_key AND f.product_key = p.product_key
      AND f.store_key = st.store_key AND f.date_key = d.date_key
)"""

# Customers by falling spend, numbered, with their count.
SPENDER = """per_key AS (SELECT customer_key, CAST(sum(revenue) AS DECIMAL(38,2)) AS total_spend
            FROM fact_sales GROUP BY customer_key),
spender AS (
    SELECT customer_id, first_name, last_name, total_spend,
           row_number() OVER (ORDER BY total_spend DESC, customer_id) - 1 AS place,
           (SELECT count(*) FROM per_key) AS n
    FROM per_key JOIN dim_customer USING (customer_key)
)"""

# Tile of a 0-based place among n rows: the first n % 4 tiles hold one row more.
QUARTILE = """CAST(CASE WHEN place < (n % 4) * (n // 4 + 1) THEN place // (n // 4 + 1)
             ELSE n % 4 + (place - (n % 4) * (n // 4 + 1)) // greatest(n // 4, 1) END + 1 AS BIGINT)"""

# Months with sales, numbered in order.
MONTH = """month_total AS (
    SELECT CAST(date_key // 10000 AS SMALLINT) AS year, CAST(date_key // 100 % 100 AS SMALLINT) AS month,
           CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue, row_number() OVER (ORDER BY date_key // 100) AS i
    FROM fact_sales GROUP BY date_key // 100, 1, 2
)"""


def _tier(names: tuple[str, ...]) -> str:
    passed = " + ".join(f"CAST(revenue >= {t} AS INTEGER)" for t in TIER_LIMITS)
    return f"[{', '.join(repr(n) for n in names)}][1 + {passed}]"


def _first(n: int, order: str) -> str:
    return f"QUALIFY row_number() OVER (ORDER BY {order}) <= {n}"


def report_sql() -> dict[str, str]:
    q = {}
    q["top_products_in_category"] = with_star("", f"""
SELECT product_name, category, unit_price FROM dim_product WHERE category = '{CATEGORY}'
{_first(10, "unit_price DESC NULLS FIRST, product_name")}""")
    q["distinct_categories"] = with_star("", "SELECT category FROM dim_product GROUP BY ALL")
    q["sales_summary"] = with_star("", f"""
SELECT n AS total_line_items, {money('s')} AS total_revenue, {avg_money('s', 'n')} AS avg_line_item_revenue,
       lo AS min_line_item_revenue, hi AS max_line_item_revenue
FROM (SELECT count(*) AS n, sum(revenue) AS s, min(revenue) AS lo, max(revenue) AS hi FROM fact_sales)""")
    q["revenue_by_channel"] = with_star("", f"""
SELECT channel, sum(n)::BIGINT AS num_orders, {money('sum(r)')} AS total_revenue
FROM (SELECT channel, date_key, count(*) AS n, sum(revenue) AS r FROM fact_sales GROUP BY ALL) GROUP BY channel""")
    q["category_revenue_having"] = with_star(SALE, f"""
SELECT * FROM (SELECT category, {money('sum(revenue)')} AS total_revenue FROM sale GROUP BY category)
WHERE total_revenue > {CATEGORY_FLOOR}""")
    q["recent_orders"] = with_star(SALE, f"""
SELECT order_id, buyer AS customer_name, product_name, quantity, revenue, full_date FROM sale
{_first(10, "full_date DESC, order_id, buyer, product_name, quantity, revenue")}""")
    q["revenue_by_store"] = with_star("""store_total AS (
    SELECT store_key, count(*) AS n, sum(revenue) AS r FROM fact_sales GROUP BY store_key)""", f"""
SELECT store_name, city, sum(n)::BIGINT AS num_orders, {money('sum(r)')} AS total_revenue
FROM dim_store JOIN store_total USING (store_key) GROUP BY store_name, city
{_first(10, "sum(r) DESC, store_name, city")}""")
    q["weekend_orders"] = with_star("", f"""
SELECT order_id, day AS full_date, dayname(day) AS day_name, revenue
FROM (SELECT order_id, revenue, CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS day FROM fact_sales)
WHERE isodow(day) IN (6, 7)
{_first(10, "day, order_id, revenue")}""")
    q["order_details"] = with_star(SALE, f"""
SELECT order_id, buyer AS customer, product_name, category, store_name, full_date, month_name, channel,
       quantity, revenue
FROM sale
{_first(10, "order_id, buyer, product_name, category, store_name, full_date, month_name, channel, quantity, revenue")}""")
    q["monthly_revenue"] = with_star("", f"""
SELECT CAST(ym // 100 AS SMALLINT) AS year, CAST(ym % 100 AS SMALLINT) AS month,
       monthname(make_date(ym // 100, ym % 100, 1)) AS month_name, {money('r')} AS monthly_revenue, n AS num_orders
FROM (SELECT date_key // 100 AS ym, sum(revenue) AS r, count(*) AS n FROM fact_sales GROUP BY 1)""")
    q["revenue_tier_rows"] = with_star("", f"""
SELECT order_id, revenue, {_tier(TIER_NAMES)} AS revenue_tier FROM fact_sales
{_first(10, "revenue DESC, order_id")}""")
    q["revenue_tier_share"] = with_star("everything AS (SELECT sum(revenue) AS whole FROM fact_sales)", f"""
SELECT {_tier(TIER_RANGES)} AS revenue_tier, count(*) AS num_orders, {money('sum(revenue)')} AS tier_revenue,
       {pct_money('sum(revenue)', 'any_value(whole)')} AS pct_of_total_revenue
FROM fact_sales, everything GROUP BY 1""")
    q["above_average_lines"] = with_star("size AS (SELECT count(*) AS n, sum(revenue) AS s FROM fact_sales)", f"""
SELECT order_id, revenue FROM fact_sales, size WHERE revenue * n - s > 0
{_first(10, "revenue DESC, order_id")}""")
    q["channel_customers"] = with_star("", f"""
SELECT customer_id, first_name, last_name, country FROM dim_customer c
WHERE EXISTS (FROM fact_sales f WHERE f.channel = '{CHANNEL}' AND f.customer_key = c.customer_key)
{_first(10, "customer_id")}""")
    q["best_order_per_customer"] = with_star("""line AS (
    SELECT *, max(revenue) OVER (PARTITION BY customer_key) - revenue AS below_best FROM fact_sales)""", f"""
SELECT customer_id, first_name, last_name, order_id, revenue FROM line JOIN dim_customer USING (customer_key)
WHERE below_best = 0
{_first(10, "revenue DESC, customer_id, order_id")}""")
    q["unique_customers_by_category"] = with_star("""buyer_lines AS (
    SELECT category, customer_key, count(*) AS n FROM fact_sales JOIN dim_product USING (product_key) GROUP BY ALL)""", """
SELECT category, count(*) AS unique_customers, sum(n)::BIGINT AS total_line_items FROM buyer_lines GROUP BY category""")
    q["customers_without_orders"] = with_star("", f"""
SELECT customer_id, first_name, last_name, email FROM dim_customer c
WHERE NOT EXISTS (FROM fact_sales f WHERE f.customer_key = c.customer_key)
{_first(10, "customer_id")}""")
    q["products_never_sold"] = with_star("", """
SELECT count(*) - count(lines) AS products_never_sold
FROM dim_product LEFT JOIN (SELECT product_key, count(*) AS lines FROM fact_sales GROUP BY 1) USING (product_key)""")
    q["top_spenders_p95"] = with_star(SPENDER + """,
sorted AS (SELECT list_sort(list(CAST(total_spend AS DOUBLE))) AS v, 0.95::DOUBLE * (count(*) - 1) AS spot FROM spender),
ends AS (SELECT v[CAST(floor(spot) AS BIGINT) + 1] AS lo, v[CAST(ceil(spot) AS BIGINT) + 1] AS hi,
                spot - floor(spot) AS part FROM sorted)""", f"""
SELECT customer_id, first_name, last_name, total_spend FROM spender, ends
WHERE CAST(total_spend AS DOUBLE) >= lo + (hi - lo) * part
{_first(15, "place")}""")
    q["category_yoy"] = with_star(SALE, f"""
SELECT category, {money('a')} AS revenue_{YEAR_BEFORE}, {money('b')} AS revenue_{YEAR}, {pct_money('b - a', 'a')} AS pct_change
FROM (SELECT category, sum(CASE year WHEN {YEAR_BEFORE} THEN revenue END) AS a,
             sum(CASE year WHEN {YEAR} THEN revenue END) AS b FROM sale GROUP BY category)
WHERE a IS NOT NULL AND b IS NOT NULL""")
    q["month_spine_revenue"] = with_star(MONTH, f"""
SELECT CAST(m AS DATE) AS month_start, {money('coalesce(revenue, 0)')} AS revenue
FROM generate_series(DATE '{FIRST_MONTH}', DATE '{LAST_MONTH}', INTERVAL 1 MONTH) AS spine(m)
LEFT JOIN month_total ON month_total.year = year(m) AND month_total.month = month(m)""")
    q["quarter_pivot"] = with_star(SALE + f""",
cell AS (SELECT category, quarter, sum(revenue) AS r FROM sale WHERE year = {YEAR} GROUP BY ALL)""", f"""
SELECT category, {", ".join(f"{money(f'max(CASE quarter WHEN {k} THEN r END)')} AS q{k}_revenue" for k in (1, 2, 3, 4))},
       {money('sum(r)')} AS total_revenue
FROM cell GROUP BY category""")
    q["channel_entities_union"] = with_star(SALE, f"""
SELECT e.entity_type, e.entity_id FROM (
    SELECT DISTINCT unnest([{{'entity_type': 'customer', 'entity_id': customer_id}},
                            {{'entity_type': 'store', 'entity_id': store_id}}]) AS e
    FROM sale WHERE channel = '{CHANNEL}')
{_first(20, "e.entity_type, e.entity_id")}""")
    q["bought_both_categories"] = with_star("""basket AS (
    SELECT customer_key, list(DISTINCT category) AS bought FROM fact_sales JOIN dim_product USING (product_key)
    GROUP BY customer_key)""", f"""
SELECT customer_id, first_name, last_name FROM basket JOIN dim_customer USING (customer_key)
WHERE list_has_all(bought, ['{CATEGORY}', '{OTHER_CATEGORY}'])
{_first(15, "customer_id")}""")
    q["store_pairs_same_country"] = with_star("""shelf AS (
    SELECT country, list(store_name ORDER BY store_key) AS names FROM dim_store GROUP BY country),
pair AS (
    SELECT country, i, j, names[i] AS store_a, names[j] AS store_b
    FROM shelf, range(1, len(names) + 1) AS a(i), range(1, len(names) + 1) AS b(j) WHERE i < j)""", f"""
SELECT store_a, store_b, country FROM pair
{_first(15, "country, i, j")}""")
    q["category_rank_by_quarter"] = with_star(SALE + f""",
cell AS (SELECT quarter, category, {money('sum(revenue)')} AS revenue FROM sale WHERE year = {YEAR} GROUP BY ALL),
ranked AS (SELECT c.*, (SELECT count(*) + 1 FROM cell o WHERE o.quarter = c.quarter AND o.revenue > c.revenue) AS revenue_rank
           FROM cell c)""", f"""
SELECT quarter, category, revenue, CAST(revenue_rank AS BIGINT) AS revenue_rank FROM ranked
{_first(20, "quarter, revenue_rank, category")}""")
    q["product_three_ranks"] = with_star(SALE + f""",
total AS (SELECT product_name, category, {money('sum(revenue)')} AS revenue FROM sale GROUP BY ALL),
best AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, product_name, category) AS row_num FROM total QUALIFY row_num <= 15)""", """
SELECT product_name, category, revenue, row_num,
       (SELECT count(*) + 1 FROM total t WHERE t.revenue > best.revenue) AS rnk,
       (SELECT count(DISTINCT t.revenue) + 1 FROM total t WHERE t.revenue > best.revenue) AS dense_rnk
FROM best""")
    q["top3_products_per_category"] = with_star(SALE + f""",
total AS (SELECT category, product_name, {money('sum(revenue)')} AS revenue FROM sale GROUP BY ALL),
shelf AS (SELECT category, list({{'n': product_name, 'r': revenue}} ORDER BY revenue DESC, product_name)[1:3] AS best
          FROM total GROUP BY category)""", """
SELECT category, best[k].n AS product_name, best[k].r AS revenue, k AS rank_in_category
FROM shelf, range(1, 4) AS t(k) WHERE k <= len(best)""")
    q["running_total"] = with_star(MONTH, f"""
SELECT m.month, monthname(make_date(m.year, m.month, 1)) AS month_name, any_value(m.revenue) AS revenue,
       {money('sum(e.revenue)')} AS running_total
FROM month_total m JOIN month_total e ON e.year = m.year AND e.month <= m.month
WHERE m.year = {YEAR} GROUP BY m.year, m.month""")
    q["moving_average"] = with_star(MONTH, f"""
SELECT m.year, m.month, any_value(m.revenue) AS revenue, {avg_money('sum(e.revenue)', 'count(*)')} AS moving_avg_3mo
FROM month_total m JOIN month_total e ON m.i - e.i BETWEEN 0 AND 2 GROUP BY m.year, m.month""")
    q["month_over_month"] = with_star(MONTH, f"""
SELECT m.year, m.month, m.revenue, e.revenue AS prev_month_revenue,
       {pct_money('m.revenue - e.revenue', 'e.revenue')} AS pct_change_mom
FROM month_total m LEFT JOIN month_total e ON e.i = m.i - 1""")
    q["days_to_next_order"] = with_star("""visit AS (
    SELECT customer_key, order_id, CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS day,
           row_number() OVER (PARTITION BY customer_key ORDER BY date_key, order_id) AS i
    FROM fact_sales)""", f"""
SELECT a.customer_key, a.order_id, a.day AS order_date, b.day AS next_order_date,
       CAST(b.day - a.day AS BIGINT) AS days_until_next_order
FROM visit a LEFT JOIN visit b ON b.customer_key = a.customer_key AND b.i = a.i + 1
{_first(20, "a.customer_key, a.day, a.order_id, b.day NULLS LAST")}""")
    q["spend_quartiles"] = with_star(SPENDER, f"""
SELECT customer_id, first_name, last_name, total_spend, {QUARTILE} AS spend_quartile FROM spender WHERE place < 20""")
    q["quartile_summary"] = with_star(SPENDER, f"""
SELECT {QUARTILE} AS spend_quartile, count(*) AS num_customers, min(total_spend) AS min_spend,
       max(total_spend) AS max_spend, {avg_money('sum(total_spend)', 'count(*)')} AS avg_spend
FROM spender GROUP BY 1""")
    span = """
SELECT customer_key, CAST(strptime(CAST(min(date_key) AS VARCHAR), '%Y%m%d') AS DATE) AS first_order_date,
       CAST(strptime(CAST(max(date_key) AS VARCHAR), '%Y%m%d') AS DATE) AS most_recent_order_date
FROM fact_sales GROUP BY customer_key"""
    q["first_last_order"] = with_star("", f"{span} {_first(15, 'customer_key')}")
    q["all_first_last_orders"] = with_star("", span)
    q["all_line_ranks"] = with_star("""place AS (
    SELECT revenue, sum(n) OVER w - n + 1 AS rnk, row_number() OVER w AS dense_rnk
    FROM (SELECT revenue, count(*) AS n FROM fact_sales GROUP BY revenue) WINDOW w AS (ORDER BY revenue DESC))""", """
SELECT order_id, product_key, revenue, CAST(rnk AS BIGINT) AS rnk, dense_rnk FROM fact_sales JOIN place USING (revenue)""")
    q["all_next_orders"] = with_star("""visit AS (
    SELECT customer_key, order_id, CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS order_date FROM fact_sales)""", """
SELECT customer_key, order_id, order_date,
       lead(order_date) OVER (PARTITION BY customer_key ORDER BY order_date, order_id) AS next_order_date
FROM visit""")
    q["pivot_quarter"] = with_star(SALE, f"""
SELECT category, {", ".join(f"{money(f'sum(CASE quarter WHEN {k} THEN revenue END)')} AS q{k}" for k in (1, 2, 3, 4))}
FROM sale GROUP BY category""")
    q["unique_customers_by_year"] = with_star(SALE, """
SELECT category, CAST(year AS BIGINT) AS year, count(DISTINCT customer_key) AS unique_customers, count(*) AS total_line_items
FROM sale GROUP BY ALL""")
    q["order_chains"] = with_star("""visit AS (
    SELECT DISTINCT customer_key, order_id, full_date FROM fact_sales JOIN dim_date USING (date_key)
),
numbered AS (SELECT *, row_number() OVER (PARTITION BY customer_key ORDER BY full_date, order_id) AS place FROM visit),
linked AS (
    SELECT a.order_id, CASE WHEN a.full_date - b.full_date <= 45 THEN b.order_id END AS before_id
    FROM numbered a LEFT JOIN numbered b ON a.customer_key = b.customer_key AND a.place = b.place + 1
),
walk AS (
    SELECT order_id, order_id AS first_order_id, CAST(1 AS BIGINT) AS position FROM linked WHERE before_id IS NULL
    UNION ALL
    SELECT l.order_id, w.first_order_id, w.position + 1 FROM walk w JOIN linked l ON l.before_id = w.order_id
)""", "SELECT * FROM walk")
    line_order = "date_key, order_id, product_key, store_key, quantity, revenue"
    q["all_running_totals"] = with_star("", f"""
SELECT customer_key, order_id, date_key, revenue,
       {money('sum(revenue) OVER (PARTITION BY customer_key ORDER BY date_key)')} AS running_total
FROM fact_sales""")
    q["all_moving_averages"] = with_star("", f"""
SELECT customer_key, date_key, order_id, revenue, {avg_money('total', 'n')} AS moving_avg
FROM (SELECT *, sum(revenue) OVER w AS total, count(*) OVER w AS n FROM fact_sales
      WINDOW w AS (PARTITION BY customer_key ORDER BY {line_order} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))""")
    q["all_previous_lines"] = with_star("", f"""
SELECT customer_key, date_key, order_id, revenue, lag(revenue) OVER w AS previous_revenue,
       lag(date_key) OVER w AS previous_date_key, {money('revenue - lag(revenue) OVER w')} AS change
FROM fact_sales WINDOW w AS (PARTITION BY customer_key ORDER BY {line_order})""")
    q["recursive_months"] = with_star("""sold AS (SELECT date_key // 100 AS ym, count(*) AS n FROM fact_sales GROUP BY 1),
step AS (
    SELECT min(ym) AS ym FROM sold
    UNION ALL
    SELECT CASE WHEN ym % 100 = 12 THEN ym + 89 ELSE ym + 1 END FROM step WHERE ym < (SELECT max(ym) FROM sold))""", """
SELECT make_date(ym // 100, ym % 100, 1) AS month_start, coalesce(n, 0)::BIGINT AS lines FROM step LEFT JOIN sold USING (ym)""")
    return q


# ------------------------------------------------------------------ raw / silver
def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


PARSE_FORMATS = "['%Y-%m-%d', '%m/%d/%Y', '%d-%b-%Y', '%Y/%m/%d']"

def pad(x: str, when: str) -> str:
    return f"CASE WHEN {when} THEN ' ' || chr(9) || {x} || chr(10) || ' ' ELSE {x} END AS {x}"


RAW_CTES = f"""
raw_customers AS (
    SELECT customer_id, {pad('first_name', 'customer_id % 7 = 0')}, last_name,
           CASE WHEN customer_id % 33 = 0
                THEN chr(9) || ' ' || upper('customer.000000000@example.com') || '  '
                ELSE email END AS email,
           CASE WHEN customer_id % 13 = 0 THEN strftime(signup_date, '%m/%d/%Y')
                ELSE strftime(signup_date, '%Y-%m-%d') END AS signup_date,
           {pad('city', 'customer_id % 7 = 0')}, {pad('country', 'customer_id % 7 = 0')}
    FROM dim_customer
),
raw_products AS (
    SELECT product_id, {pad('product_name', 'product_id % 5 = 0')}, {pad('category', 'product_id % 5 = 0')}, unit_price
    FROM dim_product
),
raw_stores AS (
    SELECT store_id, {pad('store_name', 'store_id % 3 = 0')}, {pad('city', 'store_id % 3 = 0')}, country FROM dim_store
),
raw_orders AS (
    SELECT CASE WHEN order_id % 337 = 0 THEN NULL ELSE order_id END AS order_id,
           CASE WHEN order_id % 311 = 0 THEN -1 WHEN order_id % 313 = 0 THEN NULL ELSE customer_id END AS customer_id,
           CASE WHEN order_id % 307 = 0 THEN -1 ELSE product_id END AS product_id,
           CASE WHEN order_id % 317 = 0 THEN -1 WHEN order_id % 331 = 0 THEN NULL ELSE store_id END AS store_id,
           CASE WHEN order_id % 211 = 0 THEN 'not-a-date'
                WHEN order_id % 10 = 0 THEN strftime(order_date, '%m/%d/%Y')
                WHEN order_id % 10 = 1 THEN strftime(order_date, '%d-%b-%Y')
                WHEN order_id % 10 = 2 THEN strftime(order_date, '%Y/%m/%d')
                ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
           CASE WHEN order_id % 97 = 0 THEN NULL WHEN order_id % 193 = 0 THEN -quantity
                ELSE quantity END AS quantity,
           channel
    FROM order_lines
),
clean_customers AS (
    SELECT customer_id, {strip('first_name')} AS first_name, {strip('last_name')} AS last_name,
           lower({strip('email')}) AS email,
           CAST(try_strptime(signup_date, '%Y-%m-%d') AS DATE) AS signup_date,
           {strip('city')} AS city, {strip('country')} AS country
    FROM raw_customers
),
clean_products AS (
    SELECT product_id, {strip('product_name')} AS product_name, {strip('category')} AS category, unit_price
    FROM raw_products
),
clean_stores AS (
    SELECT store_id, {strip('store_name')} AS store_name, {strip('city')} AS city, {strip('country')} AS country
    FROM raw_stores
),
parsed_orders AS (
    SELECT order_id, customer_id, product_id, store_id,
           CAST(try_strptime(order_date, {PARSE_FORMATS}) AS DATE) AS order_date, quantity, channel
    FROM raw_orders
),
quality AS (
    SELECT *, CASE WHEN order_id IS NULL THEN 'missing_order_id'
                   WHEN order_date IS NULL THEN 'unparseable_date'
                   WHEN quantity IS NULL THEN 'null_quantity'
                   WHEN quantity <= 0 THEN 'non_positive_quantity' END AS q_reason
    FROM parsed_orders
),
tagged AS (
    SELECT order_id, customer_id, product_id, store_id, order_date, quantity, channel,
           COALESCE(q_reason,
                    CASE WHEN customer_id IN (SELECT customer_id FROM clean_customers)
                          AND product_id IN (SELECT product_id FROM clean_products)
                          AND store_id IN (SELECT store_id FROM clean_stores)
                         THEN NULL ELSE 'orphan_foreign_key' END) AS rejection_reason
    FROM quality
),
clean_orders AS (
    SELECT order_id, customer_id, product_id, store_id, order_date, quantity, channel
    FROM tagged WHERE rejection_reason IS NULL
)"""


def with_raw(extra: str, select: str) -> str:
    return with_star(RAW_CTES + (",\n" + extra if extra.strip() else ""), select)


ORDER_COLS = "order_id, customer_id, product_id, store_id, order_date, quantity, channel"


def _scd1_sql(table: str, nat: str, key: str, attrs: list[str], first_where: str) -> str:
    a = ", ".join(attrs)
    typed = ", ".join("CAST(try_strptime(signup_date, '%Y-%m-%d') AS DATE) AS signup_date"
                      if x == "signup_date" else x for x in attrs)
    merged = ", ".join(f"CASE WHEN i.{nat} IS NOT NULL THEN i.{x} ELSE e.{x} END AS {x}" for x in attrs)
    return with_raw(f"""existing AS (
    SELECT CAST(row_number() OVER (ORDER BY {nat}) AS BIGINT) AS {key}, {nat}, {typed}
    FROM raw_{table} WHERE {first_where} OR {nat} % 11 = 0
),
incoming AS (SELECT {nat}, {a} FROM clean_{table} WHERE {nat} % 11 <> 0)""", f"""
SELECT e.{key}, e.{nat}, {merged}
FROM existing e LEFT JOIN incoming i ON e.{nat} = i.{nat}
UNION ALL
SELECT CAST((SELECT COALESCE(max({key}), 0) FROM existing) + row_number() OVER (ORDER BY i.{nat}) AS BIGINT)
           AS {key}, i.{nat}, {", ".join("i." + x for x in attrs)}
FROM incoming i WHERE i.{nat} NOT IN (SELECT {nat} FROM existing)""")


def _count_rule(table_sql: str, table: str, name: str, predicate_violates: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{name}' AS constraint_name, "
            f"CAST(count(*) FILTER (WHERE {predicate_violates}) AS BIGINT) AS violations FROM {table_sql}")


def _unique_rule(table_sql: str, table: str, key: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'unique:{key}' AS constraint_name, "
            f"CAST(COALESCE(sum(n), 0) AS BIGINT) AS violations FROM "
            f"(SELECT {key}, count(*) AS n FROM {table_sql} GROUP BY {key} HAVING count(*) > 1)")


def _fk_rule(table_sql: str, table: str, col: str, parent_sql: str, pcol: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'foreign_key:{col}' AS constraint_name, "
            f"CAST(count(*) AS BIGINT) AS violations FROM {table_sql} "
            f"WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {pcol} FROM {parent_sql} WHERE {pcol} IS NOT NULL)")


CANDIDATES = """
bad_customer AS (
    SELECT customer_id, first_name, repeat(last_name, CASE WHEN customer_id % 43 = 0 THEN 20 ELSE 1 END) AS last_name,
           CASE WHEN customer_id % 41 <> 0 THEN email END AS email, city, country
    FROM (FROM clean_customers UNION ALL FROM clean_customers WHERE customer_id % 50 = 0)),
bad_product AS (
    SELECT product_id, product_name, CASE WHEN product_id % 47 <> 0 THEN category END AS category,
           CASE WHEN product_id % 17 = 0 THEN -unit_price ELSE unit_price END AS unit_price
    FROM (FROM clean_products UNION ALL FROM clean_products WHERE product_id % 50 = 0)),
bad_store AS (
    SELECT store_id, repeat(store_name, CASE WHEN store_id % 4 = 0 THEN 30 ELSE 1 END) AS store_name, city, country
    FROM (FROM clean_stores UNION ALL FROM clean_stores WHERE store_id % 3 = 0)),
bad_order AS (
    SELECT * REPLACE (CASE WHEN order_id % 401 = 0 THEN repeat(channel, 10) ELSE channel END AS channel) FROM parsed_orders),
bad_date AS (
    SELECT * REPLACE (CASE WHEN day = 31 THEN 5 ELSE quarter END AS quarter)
    FROM (FROM dim_date UNION ALL FROM dim_date WHERE month = 1 AND day = 1)),
bad_fact AS (
    SELECT * REPLACE (CASE WHEN order_id % 101 = 0 THEN -1 ELSE customer_key END AS customer_key,
                      CASE WHEN order_id % 103 = 0 THEN 19000101 ELSE date_key END AS date_key,
                      CASE WHEN order_id % 107 = 0 THEN 0 ELSE quantity END AS quantity,
                      CASE WHEN order_id % 109 <> 0 THEN revenue END AS revenue)
    FROM fact_sales)"""


def _constraints_sql() -> str:
    parts = []
    spec = [
        ("dim_customer", "bad_customer", ["customer_id", "first_name", "last_name", "email", "country"],
         ["customer_id"], {}, {"first_name": 100, "last_name": 100, "email": 255, "city": 150, "country": 150}, []),
        ("dim_product", "bad_product", ["product_id", "product_name", "category", "unit_price"],
         ["product_id"], {"unit_price>=0": "unit_price < 0"}, {"product_name": 255, "category": 100}, []),
        ("dim_store", "bad_store", ["store_id", "store_name", "city", "country"],
         ["store_id"], {}, {"store_name": 255, "city": 150, "country": 150}, []),
        ("dim_date", "bad_date", ["date_key", "full_date", "day", "month", "quarter", "year"],
         ["date_key", "full_date"],
         {"month 1-12": "month < 1 OR month > 12", "quarter 1-4": "quarter < 1 OR quarter > 4",
          "day_of_week 0-6": "day_of_week < 0 OR day_of_week > 6"}, {}, []),
        ("orders", "bad_order", ["order_id", "order_date", "quantity", "channel"],
         [], {"quantity>0": "quantity <= 0"}, {"channel": 50},
         [("customer_id", "bad_customer"), ("product_id", "bad_product"), ("store_id", "bad_store")]),
        ("fact_sales", "bad_fact", ["order_id", "customer_key", "product_key", "store_key", "date_key", "channel",
                                    "quantity", "unit_price", "revenue"],
         [], {"quantity>0": "quantity <= 0", "unit_price>=0": "unit_price < 0", "revenue>=0": "revenue < 0"},
         {"channel": 50}, [("customer_key", "dim_customer"), ("product_key", "dim_product"),
                           ("store_key", "dim_store"), ("date_key", "dim_date")]),
    ]
    for table, src, nn, uq, checks, lengths, fks in spec:
        for c in nn:
            parts.append(_count_rule(src, table, f"not_null:{c}", f"{c} IS NULL"))
        for nm, viol in checks.items():
            parts.append(_count_rule(src, table, f"check:{nm}", viol))
        for c, n in lengths.items():
            parts.append(_count_rule(src, table, f"length:{c}<={n}", f"length({c}) > {n}"))
        for c in uq:
            parts.append(_unique_rule(src, table, c))
        for col, parent in fks:
            parts.append(_fk_rule(src, table, col, parent, col))
    return with_raw(CANDIDATES, "\nUNION ALL\n".join(parts))


def etl_sql() -> dict[str, str]:
    q = {}
    q["parse_dates"] = with_raw("", f"""
SELECT order_id, order_date AS order_date_text,
       CAST(try_strptime(order_date, {PARSE_FORMATS}) AS DATE) AS order_date FROM raw_orders""")
    q["clean_customers"] = with_raw("", "SELECT * FROM clean_customers")
    q["clean_products"] = with_raw("", "SELECT * FROM clean_products")
    q["clean_stores"] = with_raw("", "SELECT * FROM clean_stores")
    q["clean_orders"] = with_raw("", "SELECT * FROM clean_orders")
    q["quarantine_orders"] = with_raw("", f"SELECT {ORDER_COLS}, rejection_reason FROM tagged "
                                          "WHERE rejection_reason IS NOT NULL")
    q["quality_rejects"] = q["quarantine_orders"]
    q["reject_reasons"] = with_raw("", "SELECT rejection_reason, count(*) AS rows FROM tagged "
                                       "WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason")
    q["fk_orphans"] = with_raw("", f"SELECT {ORDER_COLS}, rejection_reason FROM tagged "
                                   "WHERE rejection_reason = 'orphan_foreign_key'")
    q["fk_valid"] = q["clean_orders"]
    q["malformed_records"] = with_raw("", """
SELECT CASE WHEN order_id % 409 = 0 OR order_id % 401 = 0 THEN 'malformed_record' ELSE coalesce(q_reason, 'clean') END AS reason,
       count(*) AS rows
FROM quality GROUP BY 1""")
    q["dq_customers"] = with_raw("", """
SELECT count(*) AS rows, count(*) FILTER (WHERE city IS NULL) AS null_cities,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT email FROM clean_customers)) AS duplicate_emails
FROM clean_customers""")
    rej = "count(*) FILTER (WHERE rejection_reason IS NOT NULL)"
    q["dq_orders"] = with_raw("", f"""
SELECT count(*) AS rows_in, count(*) FILTER (WHERE rejection_reason IS NULL) AS rows_clean,
       {rej} AS rows_rejected,
       {to_money(half_up_div(f'CAST({rej} AS HUGEINT) * 10000', 'CAST(count(*) AS HUGEINT)'))} AS reject_rate_pct
FROM tagged""")
    q["scan_csv"] = with_raw("", "SELECT * FROM raw_orders")
    q["sink_parquet"] = q["clean_customers"]
    q["fact_revenue"] = with_raw("", """
SELECT o.order_id, o.customer_id, o.product_id, o.store_id, o.order_date, o.channel, o.quantity,
       p.unit_price, CAST(o.quantity * p.unit_price AS DECIMAL(12,2)) AS revenue
FROM clean_orders o JOIN clean_products p ON o.product_id = p.product_id""")
    q["scan_parquet"] = with_raw("", """
SELECT product_id, product_name, CAST(sum(quantity) AS BIGINT) AS units, count(*) AS lines
FROM clean_orders JOIN clean_products USING (product_id) GROUP BY ALL""")
    q["fact_full_refresh"] = with_raw("", """
SELECT order_id, customer_id, product_name, store_id, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(quantity AS INTEGER) AS quantity, CAST(quantity * unit_price AS DECIMAL(12,2)) AS revenue
FROM clean_orders JOIN clean_products USING (product_id)""")
    q["fact_sales"] = with_star("", "SELECT order_id, customer_key, product_key, store_key, date_key, channel, "
                                    "quantity, unit_price, revenue FROM fact_sales")
    q["fact_skipped"] = with_raw("", """
SELECT q.order_id, q.customer_id, q.product_id, q.store_id,
       c.customer_key IS NULL AS missing_customer, p.product_key IS NULL AS missing_product,
       s.store_key IS NULL AS missing_store, coalesce(q.quantity * p.unit_price >= 10000000000, FALSE) AS revenue_too_large
FROM (SELECT * FROM quality WHERE q_reason IS NULL) q
LEFT JOIN dim_customer c ON q.customer_id = c.customer_id
LEFT JOIN dim_product p ON q.product_id = p.product_id
LEFT JOIN dim_store s ON q.store_id = s.store_id
WHERE c.customer_key IS NULL OR p.product_key IS NULL OR s.store_key IS NULL""")
    q["surrogate_keys"] = with_star("", "SELECT customer_key, customer_id FROM dim_customer")
    q["dim_date"] = with_star("", "SELECT * FROM dim_date")
    q["insert_only_merge"] = with_star("", """
SELECT * REPLACE (CASE WHEN full_date <= DATE '1998-12-31' THEN upper(day_name) ELSE day_name END AS day_name)
FROM dim_date""")
    q["scd1_customer"] = _scd1_sql("customers", "customer_id", "customer_key",
                                   ["first_name", "last_name", "email", "signup_date", "city", "country"],
                                   "customer_id < 900 OR customer_id % 4 = 0")
    q["scd1_product"] = _scd1_sql("products", "product_id", "product_key",
                                  ["product_name", "category", "unit_price"], "unit_price < 1500")
    q["scd1_store"] = _scd1_sql("stores", "store_id", "store_key", ["store_name", "city", "country"],
                                "country <= 'NATION_5'")
    q["constraint_violations"] = _constraints_sql()
    q["stream_ingest_orders"] = with_raw("", f"SELECT {ORDER_COLS}, rejection_reason FROM tagged")
    return q


def oracle_queries() -> dict[str, str]:
    out = {}
    out.update(report_sql())
    out.update({f"catalog_{name}": out[name] for name in ("best_order_per_customer", "unique_customers_by_category")})
    out.update(etl_sql())
    return out
