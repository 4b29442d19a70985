"""Oracles of the star schema, aggregates, views, reports, segments and checks."""

from __future__ import annotations

from oracles.prelude import half_up, over_star, percent, ratio, text
from oracles.raw import nulls, union
from oracles.values import EXACT_SEGMENTS, RANGE_SEGMENTS, REQUIRED_COLUMNS, SEGMENT_ADVICE

ORACLES: dict[str, str] = {}


def put(name: str, select: str) -> None:
    ORACLES[name] = over_star(select)


def dbl(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name or expr}"


def big(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS BIGINT) AS {name or expr}"


def day(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS VARCHAR) AS {name or expr}"


def stamp(expr: str, name: str | None = None) -> str:
    return f"{text(expr)} AS {name or expr}"


LATE = "COUNT(*) FILTER (WHERE is_delayed = 1)"
MEAN = ratio("SUM(total_value)", "COUNT(total_value)")
YEAR, MONTH = "CAST(substr(ym, 1, 4) AS BIGINT)", "CAST(substr(ym, 6, 2) AS BIGINT)"

# --- fact and dimensions ---------------------------------------------------

FACT = ", ".join([
    "order_id", big("order_item_id"), "product_id", "seller_id", stamp("shipping_limit_date"),
    dbl("price"), dbl("freight_value"), big("has_shipping_limit"),
    big("shipping_limit_date_is_missing"), "customer_id", "order_status",
    *[stamp(c) for c in (
        "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date")],
    big("is_approved"), big("is_shipped"), big("is_delivered"), dbl("total_value"),
    day("order_purchase_date"), "order_purchase_ym", stamp("order_delivered_timestamp"),
    "delivery_time_days", "estimated_delivery_days", big("has_delivery_date"),
    big("is_delayed"), stamp("etl_loaded_at"), "data_source",
])
put("fact_order_items", f"SELECT {FACT} FROM fact_unfiltered")
put("referential_filter", f"""SELECT order_id, {big('order_item_id')}, product_id, seller_id,
  customer_id FROM fact""")
put("orphan_report", union([
    f"SELECT '{k}' AS key_column, COUNT(DISTINCT {k}) AS orphan_keys, COUNT(*) AS orphan_rows "
    f"FROM fact_unfiltered f WHERE NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{k} = f.{k})"
    for k, d in (("customer_id", "dim_customers"), ("product_id", "dim_products"),
                 ("seller_id", "dim_sellers"))
]))
put("dim_customers", f"SELECT * EXCLUDE (etl_loaded_at), {stamp('etl_loaded_at')} FROM dim_customers")
put("dim_sellers", f"SELECT * EXCLUDE (etl_loaded_at), {stamp('etl_loaded_at')} FROM dim_sellers")
put("dim_products", "SELECT product_id, product_category_name, " + ", ".join(
    [big(c) for c in ("product_name_lenght", "product_description_lenght", "product_photos_qty",
                      "has_product_info")]
    + [f"product_{c}" for c in ("weight_g", "length_cm", "height_cm", "width_cm")]
    + [big(f"product_{c}_is_missing") for c in (
        "category_name", "name_lenght", "description_lenght", "photos_qty", "weight_g",
        "length_cm", "height_cm", "width_cm")]
) + f", category_english, {stamp('etl_loaded_at')}, data_source FROM dim_products")
put("dim_time", f"""SELECT {day('date_id')}, {big('year')}, {big('month')}, {big('day')},
  {big('day_of_week')}, day_name, month_name, {big('quarter')}, {big('week_of_year')},
  {big('is_weekend')}, {big('date_key')} FROM dim_time""")

# --- aggregates ------------------------------------------------------------

LOADED = "'2024-01-01 00:00:00' AS etl_loaded_at"
DELIVERY = f"""{ratio('SUM(delivery_time_days)', 'COUNT(delivery_time_days)', 2)}
    AS avg_delivery_days, {ratio('SUM(is_delayed)', 'COUNT(*)', 2)} AS delayed_rate"""
CUSTOMER_METRICS = f"""SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders,
  {dbl('SUM(total_value)', 'total_revenue')},
  {ratio('SUM(total_value)', 'COUNT(*)', 2)} AS avg_order_value,
  {ratio('SUM(total_value)', 'COUNT(DISTINCT order_id)', 2)} AS aov,
  {dbl('MIN(total_value)', 'min_order_value')}, {dbl('MAX(total_value)', 'max_order_value')},
  {DELIVERY},
  {stamp('MIN(order_purchase_timestamp)', 'first_order_date')},
  {stamp('MAX(order_purchase_timestamp)', 'last_order_date')},
  CAST(floor(date_diff('second', MIN(order_purchase_timestamp), MAX(order_purchase_timestamp))
    / 86400.0) AS BIGINT) AS days_as_customer, {LOADED}
FROM arrived GROUP BY customer_id"""
put("agg_customer_metrics", CUSTOMER_METRICS)
put("incremental_refresh", CUSTOMER_METRICS)
PRODUCT_METRICS = f"""SELECT product_id, COUNT(DISTINCT order_id) AS orders_count,
  COUNT(*) AS units_sold, {big('SUM(order_item_id)', 'order_item_id_sum')},
  {dbl('SUM(total_value)', 'total_revenue')},
  {ratio('SUM(total_value)', 'COUNT(*)', 2)} AS avg_price, {DELIVERY},
  {stamp('MIN(order_purchase_timestamp)', 'first_sale_date')},
  {stamp('MAX(order_purchase_timestamp)', 'last_sale_date')}, {LOADED}
FROM arrived GROUP BY product_id"""
put("agg_product_metrics", PRODUCT_METRICS)
put("incremental_stream", PRODUCT_METRICS)
MONTHLY = f"""SELECT order_purchase_ym AS year_month, {dbl('SUM(total_value)', 'total_revenue')},
  COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT customer_id) AS unique_customers,
  COUNT(*) AS item_count, {big('SUM(order_item_id)', 'order_item_id_sum')},
  {ratio('SUM(total_value)', 'COUNT(DISTINCT order_id)', 2)} AS avg_order_value,
  CAST(substr(order_purchase_ym, 1, 4) AS BIGINT) AS year,
  CAST(substr(order_purchase_ym, 6, 2) AS BIGINT) AS month, {LOADED}
FROM arrived GROUP BY order_purchase_ym"""
for key in ("agg_monthly_revenue", "etl_flagship", "etl_by_keys", "load_existing"):
    put(key, MONTHLY)

# --- views -----------------------------------------------------------------

put("v_order_metrics", f"""SELECT order_id, customer_id, {day('order_purchase_date')},
  COUNT(*) AS item_count, {dbl('SUM(total_value)', 'order_total')},
  {big('MAX(is_delayed)', 'order_delayed')}, MIN(order_status) AS order_status,
  {stamp('MIN(etl_loaded_at)', 'etl_loaded_at')}
FROM fact GROUP BY order_id, customer_id, order_purchase_date""")
put("v_customer_history", f"""SELECT c.customer_id, customer_city, customer_state,
  COUNT(DISTINCT order_id) AS total_purchases, {dbl('SUM(total_value)', 'lifetime_value')},
  {day('MIN(order_purchase_date)', 'first_purchase')},
  {day('MAX(order_purchase_date)', 'last_purchase')},
  {big("date_diff('day', MAX(order_purchase_date), (SELECT d FROM today))",
       'days_since_last_purchase')},
  {half_up(MEAN, 2)} AS avg_order_value
FROM arrived f JOIN dim_customers c ON f.customer_id = c.customer_id
GROUP BY c.customer_id, customer_city, customer_state""")
put("v_product_performance", f"""SELECT p.product_id, product_category_name,
  COUNT(DISTINCT order_id) AS orders_sold, {big('SUM(is_delivered)', 'delivered_count')},
  {dbl('SUM(total_value)', 'total_revenue')}, {half_up(MEAN, 2)} AS avg_price,
  {ratio('SUM(delivery_time_days)', 'COUNT(delivery_time_days)', 1)} AS avg_delivery_days,
  {ratio('SUM(is_delayed)', 'COUNT(*)', 3)} AS delayed_rate
FROM fact f JOIN dim_products p ON f.product_id = p.product_id
GROUP BY p.product_id, product_category_name""")
put("v_monthly_trend", f"""SELECT {big('year')}, {big('month')}, month_name,
  COUNT(DISTINCT order_id) AS orders, {dbl('SUM(total_value)', 'revenue')},
  COUNT(DISTINCT customer_id) AS unique_customers,
  {ratio('SUM(total_value)', 'COUNT(DISTINCT order_id)', 2)} AS avg_order_value
FROM arrived JOIN dim_time ON order_purchase_date = date_id
GROUP BY year, month, month_name""")

# --- reports ---------------------------------------------------------------

TOP = f"""SELECT c.customer_id, customer_city, customer_state,
  COUNT(DISTINCT order_id) AS total_orders, COUNT(*) AS total_items,
  {dbl('SUM(total_value)', 'total_revenue')}, {MEAN} AS avg_item_value,
  {day('MIN(order_purchase_date)', 'first_order_date')},
  {day('MAX(order_purchase_date)', 'last_order_date')},
  {big("date_diff('day', MIN(order_purchase_date), MAX(order_purchase_date))",
       'customer_lifetime_days')}
FROM delivered f JOIN dim_customers c ON f.customer_id = c.customer_id
GROUP BY c.customer_id, customer_city, customer_state
ORDER BY SUM(total_value) DESC, c.customer_id LIMIT """
put("top_customers", TOP + "10")
put("api_top_customers", f"""best AS ({TOP}25)
SELECT customer_id, customer_city AS city, customer_state AS state, total_orders, total_items,
  total_revenue, avg_item_value FROM best""")
MONTHS = f"""months AS (
  SELECT order_purchase_ym AS ym, SUM(total_value) AS revenue,
    COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT customer_id) AS unique_customers,
    COUNT(*) AS item_count, {MEAN} AS avg_item_value
  FROM delivered GROUP BY order_purchase_ym)"""


def growth(before: str) -> str:
    return half_up(f"(CAST(revenue - {before} AS DOUBLE) / "
                   f"NULLIF(CAST({before} AS DOUBLE), 0) * 100)", 2)


put("monthly_revenue_trend", f"""{MONTHS},
dated AS (SELECT *, {YEAR} AS year, {MONTH} AS month FROM months),
lagged AS (SELECT *, LAG(revenue) OVER (ORDER BY year, month) AS before,
  LAG(revenue) OVER (PARTITION BY month ORDER BY year) AS year_before,
  SUM(revenue) OVER (ORDER BY year, month) AS running FROM dated)
SELECT ym AS year_month, year, month, {dbl('revenue')}, order_count, unique_customers, item_count,
  avg_item_value, {dbl('before', 'prev_month_revenue')},
  {growth('before')} AS mom_growth_pct, {dbl('year_before', 'prev_year_same_month')},
  {growth('year_before')} AS yoy_growth_pct, {dbl('running', 'cumulative_revenue')}
FROM lagged""")
put("api_monthly_revenue", f"""{MONTHS}
SELECT {YEAR} AS year, {MONTH} AS month, ym AS year_month, {dbl('revenue')},
  order_count AS orders, unique_customers AS customers FROM months""")
put("aov_analysis", f"""order_totals AS (
  SELECT order_id, customer_id, order_purchase_ym AS ym, SUM(total_value) AS v
  FROM delivered GROUP BY order_id, customer_id, order_purchase_ym),
months AS (
  SELECT ym, COUNT(*) AS total_orders, COUNT(DISTINCT customer_id) AS unique_customers,
    {ratio('SUM(v)', 'COUNT(*)')} AS mean_value, stddev_samp(CAST(v AS DOUBLE)) AS spread,
    MIN(v) AS low, MAX(v) AS high, median(CAST(v AS DOUBLE)) AS middle
  FROM order_totals GROUP BY ym)
SELECT {YEAR} AS year, {MONTH} AS month, total_orders, unique_customers,
  {half_up('mean_value', 2)} AS aov, {half_up('spread', 2)} AS aov_stddev,
  {dbl('low', 'min_order')}, {dbl('high', 'max_order')}, {half_up('middle', 2)} AS median_aov,
  RANK() OVER (ORDER BY mean_value DESC) AS aov_rank,
  {half_up('(mean_value - AVG(mean_value) OVER ())', 2)} AS aov_vs_average
FROM months""")
put("repeat_purchase_rate", f"""buyers AS (
  SELECT customer_id, COUNT(DISTINCT order_id) AS n, SUM(total_value) AS v,
    date_diff('day', MIN(order_purchase_date), MAX(order_purchase_date)) AS days
  FROM delivered GROUP BY customer_id)
SELECT COUNT(*) AS total_customers, COUNT(*) FILTER (WHERE n = 1) AS one_time_buyers,
  COUNT(*) FILTER (WHERE n > 1) AS repeat_customers,
  {percent('COUNT(*) FILTER (WHERE n > 1)', 'COUNT(*)')} AS repeat_purchase_rate_pct,
  {ratio('SUM(n)', 'COUNT(*)', 2)} AS avg_purchases_per_customer,
  {ratio('SUM(v)', 'COUNT(*)', 2)} AS avg_customer_lifetime_value,
  {dbl('COALESCE(SUM(v) FILTER (WHERE n > 5), 0)', 'revenue_from_high_frequency_customers')},
  MAX(n) AS max_purchases_by_single_customer,
  {ratio('SUM(days)', 'COUNT(*)', 2)} AS avg_customer_lifetime_days
FROM buyers""")
put("cohort_retention", f"""firsts AS (
  SELECT customer_id, date_trunc('month', MIN(order_purchase_date)) AS cohort
  FROM delivered GROUP BY customer_id),
active AS (
  SELECT cohort, date_diff('month', cohort, date_trunc('month', order_purchase_date)) AS k,
    COUNT(DISTINCT d.customer_id) AS n
  FROM delivered d JOIN firsts f ON d.customer_id = f.customer_id GROUP BY 1, 2),
sizes AS (SELECT cohort, COUNT(*) AS size FROM firsts GROUP BY cohort)
SELECT strftime(a.cohort, '%Y-%m') AS cohort_month, {big('k', 'months_since_first_purchase')},
  n AS customers_in_cohort, {percent('n', 'size')} AS cohort_retention_pct
FROM active a JOIN sizes s ON a.cohort = s.cohort""")
put("retention_60d", f"""seq AS (
  SELECT customer_id, order_id, MIN(order_purchase_date) AS d FROM delivered GROUP BY 1, 2),
steps AS (
  SELECT *, LEAD(d) OVER (PARTITION BY customer_id ORDER BY d, order_id) AS again,
    row_number() OVER (PARTITION BY customer_id ORDER BY d, order_id) AS place FROM seq),
firsts AS (SELECT *, again IS NOT NULL AND date_diff('day', d, again) <= 60 AS back
  FROM steps WHERE place = 1)
SELECT strftime(d, '%Y-%m') AS cohort_month, COUNT(*) AS new_customers,
  COUNT(*) FILTER (WHERE back) AS returned_customers,
  {percent('COUNT(*) FILTER (WHERE back)', 'COUNT(*)')} AS retention_pct
FROM firsts GROUP BY 1""")


def _top_products(whole: str) -> str:
    return f"""totals AS (
  SELECT p.product_id, product_category_name, COUNT(DISTINCT order_id) AS order_count,
    COUNT(*) AS units_sold, SUM(price) AS prices, SUM(freight_value) AS freights,
    SUM(total_value) AS v, COUNT(DISTINCT customer_id) AS unique_customers,
    {ratio('SUM(price)', 'COUNT(*)', 2)} AS avg_price, {half_up(MEAN, 2)} AS avg_item_value,
    {ratio('SUM(is_delayed)', 'COUNT(*)', 4)} AS delayed_rate,
    MIN(order_purchase_date) AS first_day, MAX(order_purchase_date) AS last_day
  FROM delivered f JOIN dim_products p ON f.product_id = p.product_id
  GROUP BY p.product_id, product_category_name),
best AS (SELECT * FROM totals ORDER BY v DESC, product_id LIMIT 20)
SELECT product_id, product_category_name, order_count, units_sold,
  {dbl('prices', 'total_price_revenue')}, {dbl('freights', 'total_freight')},
  {dbl('v', 'total_revenue')}, avg_price, avg_item_value, unique_customers, delayed_rate,
  {day('first_day', 'first_sale_date')}, {day('last_day', 'last_sale_date')},
  RANK() OVER (ORDER BY v DESC) AS revenue_rank,
  RANK() OVER (ORDER BY units_sold DESC) AS volume_rank,
  {percent('v', whole)} AS pct_of_total_revenue,
  {percent('SUM(v) OVER (ORDER BY v DESC, product_id ROWS UNBOUNDED PRECEDING)', whole)}
    AS cumulative_pct_of_revenue
FROM best"""


put("top_products", _top_products("SUM(v) OVER ()"))
put("top_products_share_of_all", _top_products("(SELECT SUM(v) FROM totals)"))
put("api_top_products", f"""SELECT p.product_id, product_category_name AS category, COUNT(*) AS items_sold,
  {dbl('SUM(total_value)', 'total_revenue')}, {ratio('SUM(price)', 'COUNT(price)')} AS avg_price
FROM delivered f JOIN dim_products p ON f.product_id = p.product_id
GROUP BY p.product_id, product_category_name
ORDER BY SUM(total_value) DESC, p.product_id LIMIT 25""")
put("category_performance", f"""totals AS (
  SELECT product_category_name, COUNT(DISTINCT order_id) AS order_count, COUNT(*) AS units_sold,
    COUNT(DISTINCT customer_id) AS unique_customers, SUM(total_value) AS v,
    {half_up(MEAN, 2)} AS avg_item_value, {ratio('SUM(is_delayed)', 'COUNT(*)', 4)} AS delayed_rate,
    {percent('SUM(is_delivered)', 'COUNT(*)')} AS delivery_rate_pct
  FROM fact f JOIN dim_products p ON f.product_id = p.product_id
  WHERE order_status IN ('delivered', 'shipped') GROUP BY product_category_name)
SELECT * EXCLUDE (v), {dbl('v', 'total_revenue')}, RANK() OVER (ORDER BY v DESC) AS revenue_rank,
  {percent('v', 'SUM(v) OVER ()')} AS revenue_contribution_pct, order_count AS current_orders
FROM totals""")


def _sellers(done: str, late: str) -> str:
    return f"""totals AS (
  SELECT s.seller_id, seller_city, seller_state, COUNT(DISTINCT order_id) AS total_orders,
    COUNT(*) AS total_items, SUM(total_value) AS v, {done} AS delivered_orders,
    {late} AS delayed_orders,
    {ratio('SUM(delivery_time_days)', 'COUNT(delivery_time_days)', 1)} AS avg_delivery_time_days,
    {ratio('SUM(is_delayed)', 'COUNT(*)', 4)} AS delayed_rate
  FROM fact f JOIN dim_sellers s ON f.seller_id = s.seller_id
  GROUP BY s.seller_id, seller_city, seller_state HAVING COUNT(DISTINCT order_id) >= 10)
SELECT * EXCLUDE (v), {dbl('v', 'total_revenue')}, RANK() OVER (ORDER BY v DESC) AS revenue_rank,
  RANK() OVER (ORDER BY delayed_rate) AS performance_rank,
  CASE WHEN delayed_rate <= 0.05 THEN 'Excellent' WHEN delayed_rate <= 0.10 THEN 'Good'
    WHEN delayed_rate <= 0.20 THEN 'Fair' ELSE 'Poor' END AS performance_tier
FROM totals"""


put("seller_performance", _sellers("COUNT(*) FILTER (WHERE order_status = 'delivered')", LATE))
put("seller_performance_by_order", _sellers(
    "COUNT(DISTINCT order_id) FILTER (WHERE order_status = 'delivered')",
    "COUNT(DISTINCT order_id) FILTER (WHERE is_delayed = 1)"))


def _delayed(late: str) -> str:
    return f"""months AS (
  SELECT order_purchase_ym AS order_month, COUNT(DISTINCT order_id) AS total_orders,
    {late} AS delayed_orders, {percent(late, 'COUNT(DISTINCT order_id)')} AS delayed_rate_pct,
    {ratio('SUM(delivery_time_days)', 'COUNT(delivery_time_days)', 1)} AS avg_delivery_time_days,
    {ratio('SUM(estimated_delivery_days)', 'COUNT(estimated_delivery_days)', 1)}
      AS avg_estimated_delivery_days,
    {dbl('COALESCE(SUM(total_value) FILTER (WHERE is_delayed = 1), 0)',
         'revenue_from_delayed_orders')}
  FROM delivered GROUP BY order_purchase_ym)
SELECT *, LAG(delayed_orders) OVER (ORDER BY order_month) AS prev_month_delayed_orders
FROM months"""


put("delayed_orders", _delayed(LATE))
put("delayed_orders_by_order", _delayed("COUNT(DISTINCT order_id) FILTER (WHERE is_delayed = 1)"))


def _payments(source: str) -> str:
    return f"""paid AS ({source}),
totals AS (
  SELECT payment_type, COUNT(DISTINCT order_id) AS order_count, SUM(payment_value) AS v,
    {ratio('SUM(payment_value)', 'COUNT(payment_value)', 2)} AS avg_payment_value,
    COUNT(DISTINCT customer_id) AS unique_customers, COUNT(*) AS total_payment_records,
    {ratio('SUM(payment_installments)', 'COUNT(payment_installments)', 1)} AS avg_installments
  FROM paid GROUP BY payment_type)
SELECT * EXCLUDE (v), {dbl('v', 'total_payment_value')},
  {percent('v', 'SUM(v) OVER ()')} AS revenue_contribution_pct,
  RANK() OVER (ORDER BY v DESC) AS payment_method_rank
FROM totals"""


put("payment_method", _payments("""SELECT p.*, o.customer_id FROM raw_payments p
  JOIN (SELECT DISTINCT order_id, customer_id FROM delivered) o ON p.order_id = o.order_id"""))
put("payment_method_fanout", _payments("""SELECT p.*, f.customer_id
  FROM delivered f JOIN raw_payments p ON f.order_id = p.order_id"""))

# --- segments --------------------------------------------------------------

EXACT = " ".join(f"WHEN r_score = {r} AND f_score = {f} AND m_score = {m} THEN '{n}'"
                 for (r, f, m), n in EXACT_SEGMENTS.items())
put("rfm_sql", f"""base AS (
  SELECT c.customer_id, customer_city, customer_state,
    date_diff('day', MAX(order_purchase_date), (SELECT d FROM today)) AS recency_days,
    COUNT(DISTINCT order_id) AS frequency, SUM(total_value) AS monetary
  FROM delivered f JOIN dim_customers c ON f.customer_id = c.customer_id
  GROUP BY c.customer_id, customer_city, customer_state),
scores AS (
  SELECT *, NTILE(4) OVER (ORDER BY recency_days DESC, customer_id) AS r_score,
    NTILE(4) OVER (ORDER BY frequency, customer_id) AS f_score,
    NTILE(4) OVER (ORDER BY monetary, customer_id) AS m_score FROM base)
SELECT customer_id, customer_city, customer_state, {big('recency_days')}, frequency,
  {dbl('monetary')}, r_score, f_score, m_score, CASE {EXACT} ELSE 'Other' END AS rfm_segment
FROM scores""")

BASE = """base AS (
  SELECT f.customer_id, customer_city, customer_state,
    CAST(floor(date_diff('second', MAX(order_purchase_timestamp),
      (SELECT MAX(order_purchase_timestamp) FROM fact) + INTERVAL 1 DAY) / 86400.0) AS BIGINT)
      AS recency_days,
    COUNT(DISTINCT order_id) AS frequency, SUM(total_value) AS monetary
  FROM delivered f LEFT JOIN dim_customers c ON f.customer_id = c.customer_id
  GROUP BY f.customer_id, customer_city, customer_state)"""


def _cut(column: str, share: float) -> str:
    return f"(SELECT quantile_cont(CAST({column} AS DOUBLE), {share}) FROM base)"


def _bin(column: str) -> str:
    over = " + ".join(f"CAST(CAST({column} AS DOUBLE) > {_cut(column, q)} AS BIGINT)"
                      for q in (0.25, 0.5, 0.75))
    return f"1 + {over}"


SCORES = f"""{BASE},
ranked AS (SELECT *, row_number() OVER (ORDER BY frequency, customer_id) AS place,
  COUNT(*) OVER () AS n FROM base),
scored AS (
  SELECT *, 5 - ({_bin('recency_days')}) AS r_score, {_bin('monetary')} AS m_score,
    1 + {' + '.join(f'CAST(place > 1 + (n - 1) * {q} AS BIGINT)' for q in (0.25, 0.5, 0.75))}
      AS f_score
  FROM ranked),
scores AS (SELECT *, {half_up('((r_score + f_score + m_score) / 3.0)', 2)} AS rfm_score
  FROM scored)"""


def _range(low, high) -> str:
    return " AND ".join(f"{m} BETWEEN {lo} AND {hi}" for m, lo, hi in
                        zip(("r_score", "f_score", "m_score"), low, high))


RULES = " ".join(f"WHEN {_range(lo, hi)} THEN '{n}'" for n, lo, hi in RANGE_SEGMENTS)
SEGMENTS = f"""{SCORES},
segments AS (SELECT *, CASE {RULES} ELSE 'Other' END AS segment FROM scores)"""
RFM = f"customer_id, recency_days, frequency, {dbl('monetary')}"
put("rfm_base", f"{BASE} SELECT {RFM}, customer_city, customer_state FROM base")
put("rfm_distribution", BASE + "\n" + union([
    f"SELECT '{m}' AS metric, {ratio(f'SUM({m})', 'COUNT(*)', 2)} AS mean, "
    f"{half_up(f'median(CAST({m} AS DOUBLE))', 2)} AS median, "
    f"{half_up(f'MIN({m})', 2)} AS min, {half_up(f'MAX({m})', 2)} AS max, "
    f"{half_up(f'stddev_samp(CAST({m} AS DOUBLE))', 2)} AS std FROM base"
    for m in ("recency_days", "frequency", "monetary")
]))
put("rfm_top", f"{BASE} SELECT {RFM} FROM base ORDER BY base.monetary DESC, customer_id LIMIT 10")
put("rfm_scores", f"""{SCORES}
SELECT {RFM}, customer_city, customer_state, r_score, f_score, m_score, rfm_score FROM scores""")
put("rfm_score_counts", SCORES + "\n" + union([
    f"SELECT '{m}' AS metric, {m} AS score, COUNT(*) AS customers FROM scores GROUP BY {m}"
    for m in ("r_score", "f_score", "m_score")
]))
put("rfm_segments", f"""{SEGMENTS}
SELECT customer_id, r_score, f_score, m_score, rfm_score, segment FROM segments""")
put("export_rfm", f"""{SEGMENTS}
SELECT {RFM}, r_score, f_score, m_score, rfm_score, segment, customer_city, customer_state
FROM segments""")
put("customers_by_segment", f"""{SEGMENTS}
SELECT {RFM}, segment, rfm_score FROM segments WHERE segment = 'Champions'""")
put("rfm_quantile_rules", f"""{BASE},
cuts AS (SELECT *, {', '.join(
    f"{_cut(m, q)} AS {m}_{int(q * 100)}" for m in ('recency_days', 'frequency', 'monetary')
    for q in (0.25, 0.5, 0.75))} FROM base)
SELECT customer_id, CASE
  WHEN recency_days <= recency_days_25 AND frequency >= frequency_75
    AND CAST(monetary AS DOUBLE) >= monetary_75 THEN 'champions'
  WHEN recency_days <= recency_days_50 AND frequency >= frequency_50
    AND CAST(monetary AS DOUBLE) >= monetary_50 THEN 'loyal'
  WHEN recency_days <= recency_days_75 AND frequency >= frequency_50
    AND CAST(monetary AS DOUBLE) >= monetary_50 THEN 'at_risk'
  WHEN recency_days <= recency_days_75 AND frequency >= frequency_25
    AND CAST(monetary AS DOUBLE) >= monetary_50 THEN 'need_attention'
  ELSE 'lost' END AS segment
FROM cuts""")
ADVICE = " ".join(f"WHEN '{s}' THEN '{a}'" for s, a in SEGMENT_ADVICE.items())
put("segment_summary", f"""{SEGMENTS},
totals AS (
  SELECT segment, COUNT(*) AS customer_count,
    {ratio('SUM(recency_days)', 'COUNT(*)', 2)} AS avg_recency_days,
    {ratio('SUM(frequency)', 'COUNT(*)', 2)} AS avg_frequency,
    {ratio('SUM(monetary)', 'COUNT(*)', 2)} AS avg_monetary, SUM(monetary) AS v,
    {ratio('SUM(CAST(rfm_score AS DECIMAL(4,2)))', 'COUNT(*)', 2)} AS avg_rfm_score
  FROM segments GROUP BY segment)
SELECT * EXCLUDE (v), {dbl('v', 'total_monetary')},
  {percent('customer_count', 'SUM(customer_count) OVER ()', 1)} AS pct_customers,
  {percent('v', 'SUM(v) OVER ()', 1)} AS pct_revenue, CASE segment {ADVICE} END AS strategy
FROM totals""")


def _insight(name: str, value: str) -> str:
    return f"SELECT '{name}' AS metric, {value} AS value FROM segments"


AT_RISK, NEW = "FILTER (WHERE segment = 'At Risk')", "FILTER (WHERE segment = 'New Customers')"
BEST = "(SELECT segment FROM segments GROUP BY segment ORDER BY SUM(monetary) DESC LIMIT 1)"
REPEAT = "COUNT(*) FILTER (WHERE frequency > 1)"
put("segment_insights", SEGMENTS + "\n" + union([
    _insight("top_segment_customer_pct",
             percent(f"COUNT(*) FILTER (WHERE segment = {BEST})", "COUNT(*)", 1)),
    _insight("top_segment_revenue_pct",
             percent(f"SUM(monetary) FILTER (WHERE segment = {BEST})", "SUM(monetary)", 1)),
    _insight("at_risk_customers", f"CAST(COUNT(*) {AT_RISK} AS DOUBLE)"),
    _insight("at_risk_customer_pct", percent(f"COUNT(*) {AT_RISK}", "COUNT(*)", 1)),
    _insight("at_risk_revenue", f"CAST(COALESCE(SUM(monetary) {AT_RISK}, 0) AS DOUBLE)"),
    _insight("new_customers", f"CAST(COUNT(*) {NEW} AS DOUBLE)"),
    _insight("new_customer_pct", percent(f"COUNT(*) {NEW}", "COUNT(*)", 1)),
    _insight("new_customer_avg_value",
             ratio(f"SUM(monetary) {NEW}", f"COUNT(*) {NEW}", 2)),
    _insight("repeat_purchase_pct", percent(REPEAT, "COUNT(*)", 1)),
    _insight("avg_customer_value", ratio("SUM(monetary)", "COUNT(*)", 2)),
    _insight("repeat_target_met", f"CAST(100.0 * {REPEAT} / COUNT(*) > 30 AS DOUBLE)"),
]))
put("global_rank", """buyers AS (
  SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders FROM delivered GROUP BY customer_id)
SELECT customer_id, total_orders, RANK() OVER (ORDER BY total_orders DESC) AS rank,
  NTILE(4) OVER (ORDER BY total_orders, customer_id) AS quarter FROM buyers""")

# --- metrics ---------------------------------------------------------------

JOINED = """joined AS (
  SELECT o.order_id, o.customer_id, o.order_status, i.price + i.freight_value AS v
  FROM raw_orders o LEFT JOIN clean_items i ON o.order_id = i.order_id)"""
put("total_revenue", f"{JOINED} SELECT {dbl('COALESCE(SUM(v), 0)', 'total_revenue')} FROM joined")
put("aov", f"""{JOINED} SELECT {dbl('COALESCE(SUM(v), 0)', 'total_revenue')},
  COUNT(DISTINCT order_id) AS orders,
  {ratio('SUM(v)', 'COUNT(DISTINCT order_id)', 2)} AS aov FROM joined""")
put("repeat_rate", f"""buyers AS (
  SELECT customer_id, COUNT(DISTINCT order_id) AS n FROM raw_orders GROUP BY customer_id)
SELECT COUNT(*) AS customers, COUNT(*) FILTER (WHERE n > 1) AS repeat_customers,
  {percent('COUNT(*) FILTER (WHERE n > 1)', 'COUNT(*)')} AS repeat_rate_pct FROM buyers""")
put("clv_distribution", f"""{JOINED},
clv AS (SELECT customer_id, COALESCE(SUM(v), 0) AS v FROM joined GROUP BY customer_id)
SELECT {ratio('SUM(v)', 'COUNT(*)', 2)} AS mean_clv,
  {half_up('median(CAST(v AS DOUBLE))', 2)} AS median_clv, {dbl('MIN(v)', 'min_clv')},
  {dbl('MAX(v)', 'max_clv')} FROM clv""")
put("order_counts", f"""SELECT COUNT(DISTINCT order_id) AS total_orders,
  COUNT(DISTINCT customer_id) AS unique_customers,
  {ratio('COUNT(DISTINCT order_id)', 'COUNT(DISTINCT customer_id)', 2)} AS orders_per_customer
FROM raw_orders""")
put("revenue_by_status", f"""{JOINED},
totals AS (SELECT order_status, COALESCE(SUM(v), 0) AS v FROM joined GROUP BY order_status)
SELECT order_status, {dbl('v', 'revenue')}, {percent('v', 'SUM(v) OVER ()', 1)} AS revenue_pct
FROM totals""")
ON_TIME = ("COUNT(*) FILTER (WHERE order_delivered_customer_date "
           "<= order_estimated_delivery_date)")
put("on_time_rate", f"""SELECT COUNT(*) AS orders, {ON_TIME} AS on_time_orders,
  {percent(ON_TIME, 'COUNT(*)')} AS on_time_rate_pct FROM clean_orders""")
SPLIT = "COUNT(*) FILTER (WHERE payment_installments > 1)"
put("installment_usage", f"""SELECT COUNT(*) AS payments, {SPLIT} AS installment_payments,
  {percent(SPLIT, 'COUNT(*)')} AS installment_pct,
  {ratio('SUM(payment_installments)', 'COUNT(payment_installments)', 2)} AS avg_installments
FROM raw_payments""")
put("revenue_concentration", f"""buyers AS (
  SELECT customer_id, SUM(total_value) AS v FROM delivered GROUP BY customer_id),
best AS (SELECT v, row_number() OVER (ORDER BY v DESC, customer_id) AS place,
  COUNT(*) OVER () AS n FROM buyers),
goods AS (SELECT v, row_number() OVER (ORDER BY v DESC, product_id) AS place FROM (
  SELECT product_id, SUM(total_value) AS v FROM delivered GROUP BY product_id))
SELECT 'top_20pct_customers' AS part, COUNT(*) AS members,
  {percent('SUM(v)', '(SELECT SUM(v) FROM buyers)')} AS revenue_pct
FROM best WHERE place <= greatest(CAST(floor(n * 0.2) AS BIGINT), 1)
""" + "".join(f"""UNION ALL SELECT 'top_{k}_products', COUNT(*),
  {percent('SUM(v)', '(SELECT SUM(v) FROM buyers)')} FROM goods WHERE place <= {k}
""" for k in (10, 50)))
put("revenue_by_region", f"""totals AS (
  SELECT customer_state, SUM(total_value) AS v, COUNT(DISTINCT f.customer_id) AS customers
  FROM delivered f JOIN dim_customers c ON f.customer_id = c.customer_id GROUP BY customer_state)
SELECT customer_state, {dbl('v', 'revenue')}, customers,
  {percent('v', 'SUM(v) OVER ()')} AS revenue_pct FROM totals""")
put("seasonality", f"""months AS (
  SELECT order_purchase_ym AS ym, SUM(total_value) AS v FROM arrived GROUP BY order_purchase_ym),
ends AS (SELECT MAX(v) AS high, MIN(v) AS low, stddev_samp(CAST(v AS DOUBLE)) AS spread FROM months)
SELECT (SELECT ym FROM months ORDER BY v DESC, ym DESC LIMIT 1) AS peak_month,
  {dbl('high', 'peak_revenue')},
  (SELECT ym FROM months ORDER BY v, ym LIMIT 1) AS trough_month, {dbl('low', 'trough_revenue')},
  {percent('high - low', 'low')} AS peak_to_trough_pct, {half_up('spread', 2)} AS revenue_stddev
FROM ends""")
put("purchase_frequency_split", f"""buyers AS (
  SELECT customer_id, COUNT(DISTINCT order_id) AS n FROM delivered GROUP BY customer_id)
SELECT COUNT(*) AS customers,
  {percent('COUNT(*) FILTER (WHERE n = 1)', 'COUNT(*)')} AS one_time_pct,
  {percent('COUNT(*) FILTER (WHERE n >= 2)', 'COUNT(*)')} AS repeat_pct,
  {percent('COUNT(*) FILTER (WHERE n >= 5)', 'COUNT(*)')} AS loyal_pct FROM buyers""")

# --- checks ----------------------------------------------------------------

ORPHAN = """(NOT EXISTS (SELECT 1 FROM dim_customers x WHERE x.customer_id = f.customer_id)
  OR NOT EXISTS (SELECT 1 FROM dim_products x WHERE x.product_id = f.product_id)
  OR NOT EXISTS (SELECT 1 FROM dim_sellers x WHERE x.seller_id = f.seller_id))"""
NEGATIVE = "(price < 0 OR freight_value < 0 OR total_value < 0)"
put("fk_integrity", f"""SELECT 'FK_INTEGRITY' AS check_type, COUNT(*) AS orphaned_records
FROM fact_unfiltered f WHERE {ORPHAN}""")
put("null_checks", "SELECT 'NULL_CHECKS' AS check_type, " + ", ".join(
    f"{nulls(c)} AS null_{c}" for c in ("order_id", "customer_id", "product_id", "price")
) + " FROM fact_unfiltered")
put("value_validation", f"""SELECT 'VALUE_VALIDATION' AS check_type, COUNT(*) AS negative_price
FROM fact WHERE {NEGATIVE}""")
put("data_freshness", f"""SELECT 'DATA_FRESHNESS' AS check_type,
  {stamp('MAX(etl_loaded_at)', 'last_load')},
  {half_up("(date_diff('second', MAX(etl_loaded_at), TIMESTAMP '2024-01-02 06:00:00') / 3600.0)", 4)}
    AS hours_since_load FROM fact""")
COLUMNS = [
    "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
    "freight_value", "has_shipping_limit", "shipping_limit_date_is_missing", "customer_id",
    "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "is_approved", "is_shipped", "is_delivered", "total_value",
    "order_purchase_date", "order_purchase_ym", "order_delivered_timestamp",
    "delivery_time_days", "estimated_delivery_days", "has_delivery_date", "is_delayed",
    "etl_loaded_at", "data_source",
]
STATUSES = "('delivered', 'shipped', 'canceled', 'processing', 'invoiced', 'approved')"
UNKNOWN = f"(order_status IS NULL OR order_status NOT IN {STATUSES})"
put("fact_metrics", union([
    f"SELECT '{n}' AS metric, {v} AS value FROM fact" for n, v in {
        "fact_table_rows": "CAST(COUNT(*) AS DOUBLE)",
        "fact_table_null_percentage":
            percent(" + ".join(nulls(c) for c in COLUMNS), f"COUNT(*) * {len(COLUMNS)}", 4),
        "total_revenue": "CAST(COALESCE(SUM(total_value), 0) AS DOUBLE)",
        "avg_order_value": ratio("SUM(total_value)", "COUNT(total_value)", 4),
        "negative_prices_count": "CAST(COUNT(*) FILTER (WHERE price < 0) AS DOUBLE)",
        "invalid_order_statuses": f"CAST(COUNT(*) FILTER (WHERE {UNKNOWN}) AS DOUBLE)",
        **{f"null_pct_{c}": percent(nulls(c), "COUNT(*)", 4) for c in COLUMNS},
    }.items()
]))
FACT_NULL = "(order_id IS NULL OR customer_id IS NULL OR product_id IS NULL OR price IS NULL)"
put("quality_log", "counts AS (" + union([
    f"SELECT '{n}' AS check_name, COUNT(*) AS records_checked, "
    f"COUNT(*) FILTER (WHERE {bad}) AS records_failed FROM fact_unfiltered f"
    for n, bad in (("NULL_CHECKS", FACT_NULL), ("VALUE_VALIDATION", NEGATIVE),
                   ("STATUS_VALIDATION", UNKNOWN))
] + [f"""SELECT 'FK_INTEGRITY', (SELECT COUNT(*) FROM fact_unfiltered),
  (SELECT COUNT(*) FROM fact_unfiltered f WHERE {ORPHAN})"""]) + """)
SELECT check_name, 'fact_order_items' AS table_name, records_checked, records_failed,
  CASE WHEN records_failed > 0.01 * records_checked THEN 'FAIL'
    WHEN records_failed > 0 THEN 'WARNING' ELSE 'PASS' END AS check_result,
  '2024-01-01 00:00:00' AS check_timestamp,
  records_failed || ' of ' || records_checked || ' rows' AS details
FROM counts""")
MONTH_ROWS = "(SELECT DISTINCT order_purchase_ym FROM arrived)"
KEYED = {
    "dim_customers": ("dim_customers", "customer_id"), "dim_products": ("dim_products", "product_id"),
    "dim_sellers": ("dim_sellers", "seller_id"), "dim_time": ("dim_time", "date_key"),
    "fact_order_items": ("fact", "order_id, order_item_id"),
    "agg_customer_metrics": ("(SELECT DISTINCT customer_id FROM arrived)", "customer_id"),
    "agg_product_metrics": ("(SELECT DISTINCT product_id FROM arrived)", "product_id"),
    "agg_monthly_revenue": (MONTH_ROWS, "order_purchase_ym"),
}
put("pk_uniqueness", union([
    f"SELECT '{t}' AS table_name, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS row_count, "
    f"COUNT(*) FILTER (WHERE n > 1) AS repeated_keys, "
    f"CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS repeated_rows "
    f"FROM (SELECT COUNT(*) AS n FROM {s} GROUP BY {k})" for t, (s, k) in KEYED.items()
]))
put("not_null", union([
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {nulls(c)} AS null_count FROM {s}"
    for t, s in (("dim_time", "dim_time"), ("fact_order_items", "fact_unfiltered"))
    for c in REQUIRED_COLUMNS[t]
]))
CHECKS = [
    ("dim_customers", "dim_customers", "state_has_two_letters", "length(customer_state) <> 2"),
    ("dim_products", "dim_products", "weight_not_negative", "product_weight_g < 0"),
    ("dim_products", "dim_products", "photos_not_negative", "product_photos_qty < 0"),
    ("dim_sellers", "dim_sellers", "state_has_two_letters", "length(seller_state) <> 2"),
    ("dim_time", "dim_time", "month_valid", "month NOT BETWEEN 1 AND 12"),
    ("dim_time", "dim_time", "quarter_valid", "quarter NOT BETWEEN 1 AND 4"),
    ("fact_order_items", "fact", "price_not_negative", "price < 0"),
    ("fact_order_items", "fact", "freight_not_negative", "freight_value < 0"),
    ("fact_order_items", "fact", "delayed_is_flag", "is_delayed NOT IN (0, 1)"),
    ("fact_order_items", "fact", "delivery_date_is_flag", "has_delivery_date NOT IN (0, 1)"),
    ("agg_monthly_revenue", MONTH_ROWS, "month_valid",
     "CAST(substr(order_purchase_ym, 6, 2) AS INTEGER) NOT BETWEEN 1 AND 12"),
]
put("check_constraint", union([
    f"SELECT '{t}' AS table_name, '{n}' AS constraint_name, COUNT(*) AS row_count, "
    f"COUNT(*) FILTER (WHERE {bad}) AS failed_rows, "
    f"CAST(COUNT(*) FILTER (WHERE {bad}) = 0 AS BIGINT) AS success FROM {s}"
    for t, s, n, bad in CHECKS
]))


def _gate(table: str, check: str, source: str, checked: str, failed: str,
          warn: float, fail: float) -> str:
    share = f"COALESCE({ratio(failed, checked)}, 0)"
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, "
            f"CAST({checked} AS BIGINT) AS checked, CAST({failed} AS BIGINT) AS failed, "
            f"{half_up(f'({share} * 100)', 4)} AS failed_pct, "
            f"CASE WHEN {share} > {fail} THEN 'FAIL' WHEN {share} > {warn} THEN 'WARNING' "
            f"ELSE 'PASS' END AS result FROM {source}")


GATES = {
    "fact_order_items": ("fact_unfiltered", COLUMNS, "order_id, order_item_id", 0.05,
                         ("order_id", "product_id", "customer_id", "price")),
    "dim_customers": ("dim_customers", [
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city",
        "customer_state", "etl_loaded_at", "data_source"], "customer_id", 0.10,
        ("customer_id", "customer_city", "customer_state")),
    "dim_products": ("dim_products", [
        "product_id", "product_category_name", "product_name_lenght",
        "product_description_lenght", "product_photos_qty", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm", "has_product_info",
        *[f"product_{c}_is_missing" for c in (
            "category_name", "name_lenght", "description_lenght", "photos_qty", "weight_g",
            "length_cm", "height_cm", "width_cm")],
        "category_english", "etl_loaded_at", "data_source"], "product_id", 0.20, ("product_id",)),
    "dim_sellers": ("dim_sellers", [
        "seller_id", "seller_zip_code_prefix", "seller_city", "seller_state", "etl_loaded_at",
        "data_source"], "seller_id", 0.10, ("seller_id",)),
}
_gates = []
for _table, (_source, _columns, _key, _limit, _critical) in GATES.items():
    for _c in _columns:
        _warn, _fail = (0.0, _limit) if _c in _critical else (0.15, 1.0)
        _gates.append(_gate(_table, f"null:{_c}", _source, "COUNT(*)", nulls(_c), _warn, _fail))
    _gates.append(_gate(
        _table, "duplicates", f"(SELECT COUNT(*) AS n FROM {_source} GROUP BY {_key})",
        "SUM(n)", "SUM(n - 1)", 0.0, 0.01))
_gates.append(_gate("fact_order_items", "negative amounts", "fact_unfiltered", "COUNT(*)",
                    f"COUNT(*) FILTER (WHERE {NEGATIVE})", 0.0, 0.01))
for _k, _d in (("customer_id", "dim_customers"), ("product_id", "dim_products"),
               ("seller_id", "dim_sellers")):
    _gates.append(_gate(
        "fact_order_items", f"reference:{_k}",
        f"(SELECT f.order_id, x.{_k} AS found FROM fact_unfiltered f "
        f"LEFT JOIN {_d} x ON f.{_k} = x.{_k})",
        "COUNT(*)", "COUNT(*) FILTER (WHERE found IS NULL)", 0.0, 0.02))
put("threshold_gate", union(_gates))

# The stored order grain gives the same reports.
for _name in ("v_order_metrics", "top_customers", "payment_method"):
    ORACLES[f"{_name}_stored"] = ORACLES[_name]
