"""The raw tables, the cleaning and the star schema, stated as SQL.

Common table expressions over the driver's tables; each oracle starts with them
and ends in its own SELECT. Unused expressions cost nothing.
"""

from __future__ import annotations

STAMP = "%Y-%m-%d %H:%M:%S"


def half_up(expr: str, digits: int) -> str:
    """Round a double with ties away from zero, through ten decimals."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def ratio(part: str, whole: str, digits: int | None = None) -> str:
    value = f"(CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0))"
    return value if digits is None else half_up(value, digits)


def percent(part: str, whole: str, digits: int = 2) -> str:
    return half_up(f"(100.0 * CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0))", digits)


def text(expr: str) -> str:
    return f"strftime({expr}, '{STAMP}')"


RAW = f"""
bought AS (
  SELECT *, o_orderdate + to_seconds(o_orderkey * 61 % 86400) AS ts FROM orders),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
      ELSE 'processing' END AS order_status,
    {text('ts')} AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 'unknown'
      ELSE {text('ts + to_hours(o_orderkey % 48)')} END AS order_approved_at,
    CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderkey % 89 = 0 THEN '0000-00-00 00:00:00'
      ELSE {text('ts + to_hours(24 * (1 + o_orderkey % 5))')} END AS order_delivered_carrier_date,
    CASE WHEN (o_orderstatus = 'F' AND o_orderkey % 20 <> 0)
           OR (o_orderstatus = 'O' AND o_orderkey % 33 = 0)
      THEN {text('ts + to_hours(24 * (3 + o_orderkey * 7 % 38) + o_orderkey % 24)')}
      END AS order_delivered_customer_date,
    {text('o_orderdate + to_hours(24 * (14 + o_orderkey * 11 % 23))')}
      AS order_estimated_delivery_date
  FROM bought),
raw_order_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
    CASE WHEN l_orderkey % 200 = 0 AND l_linenumber = 2 THEN NULL ELSE l_partkey END AS product_id,
    CASE WHEN l_orderkey % 64 = 0 AND l_linenumber = 1 THEN -1 - l_suppkey
      ELSE l_suppkey END AS seller_id,
    CASE WHEN l_orderkey % 3 = 0 AND l_linenumber = 7 THEN NULL
      ELSE {text('l_shipdate')} END AS shipping_limit_date,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
    CAST(CAST(l_quantity AS INTEGER) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(10,2))
      AS freight_value
  FROM lineitem),
raw_customers AS (
  SELECT c_custkey AS customer_id, c_custkey - c_custkey % 2 AS customer_unique_id,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
    CASE WHEN c_custkey % 40 = 0 THEN NULL ELSE n_name END AS customer_city,
    substr(r_name, 1, 2) AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey),
raw_products AS (
  SELECT p_partkey AS product_id,
    CASE WHEN p_partkey % 50 <> 7 THEN lower(p_type) END AS product_category_name,
    CASE WHEN p_partkey % 50 <> 7 THEN length(p_name) END AS product_name_lenght,
    CASE WHEN p_partkey % 50 <> 7 THEN p_size * 10 END AS product_description_lenght,
    CASE WHEN p_partkey % 50 <> 7 THEN p_partkey % 6 + 1 END AS product_photos_qty,
    CASE WHEN p_partkey % 61 <> 0 THEN CAST(floor(p_retailprice) AS INTEGER) END
      AS product_weight_g,
    CASE WHEN p_partkey % 61 <> 0 THEN p_size + 10 END AS product_length_cm,
    CASE WHEN p_partkey % 61 <> 0 THEN p_size + 2 END AS product_height_cm,
    CASE WHEN p_partkey % 61 <> 0 THEN p_size + 11 END AS product_width_cm
  FROM part),
raw_sellers AS (
  SELECT s_suppkey AS seller_id,
    lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
    n_name AS seller_city, substr(r_name, 1, 2) AS seller_state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey),
raw_payments AS (
  SELECT o_orderkey AS order_id, 1 AS payment_sequential,
    lower(substr(o_orderpriority, 3, 20)) AS payment_type,
    CAST(o_orderkey % 12 + 1 AS INTEGER) AS payment_installments,
    CAST(o_totalprice AS DECIMAL(10,2)) AS payment_value
  FROM orders
  UNION ALL
  SELECT o_orderkey, 2, 'voucher', 1, CAST(10 AS DECIMAL(10,2)) FROM orders
  WHERE o_orderkey % 10 = 0),
raw_reviews AS (
  SELECT d.doc_id AS review_id, d.doc_id AS order_id,
    1 + 3 * quality + (1 - toxic) AS review_score,
    CASE WHEN d.doc_id % 9 = 0 THEN source END AS review_comment_title,
    CASE WHEN d.doc_id % 5 <> 0 THEN d.text END AS review_comment_message,
    {text("TIMESTAMP '2024-01-01 00:00:00' + to_hours(d.doc_id)")} AS review_creation_date,
    {text("TIMESTAMP '2024-01-01 00:00:00' + to_hours(d.doc_id + n_chars % 240)")}
      AS review_answer_timestamp
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
raw_geolocation AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
    n_nationkey * 2.0 - 23.5 AS geolocation_lat, n_nationkey * -1.5 - 46.5 AS geolocation_lng,
    n_name AS geolocation_city, substr(r_name, 1, 2) AS geolocation_state
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
raw_category_translation AS (
  SELECT DISTINCT lower(p_type) AS product_category_name,
    upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS product_category_name_english
  FROM part)"""

CLEAN = """
clean_orders AS (
  SELECT order_id, customer_id, order_status,
    TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp,
    COALESCE(TRY_CAST(order_approved_at AS TIMESTAMP),
      TRY_CAST(order_purchase_timestamp AS TIMESTAMP)) AS order_approved_at,
    TRY_CAST(order_delivered_carrier_date AS TIMESTAMP) AS order_delivered_carrier_date,
    TRY_CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_date,
    TRY_CAST(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_date,
    CASE WHEN TRY_CAST(order_approved_at AS TIMESTAMP) IS NULL THEN 0 ELSE 1 END AS is_approved,
    CASE WHEN TRY_CAST(order_delivered_carrier_date AS TIMESTAMP) IS NULL THEN 0 ELSE 1 END
      AS is_shipped,
    CASE WHEN TRY_CAST(order_delivered_customer_date AS TIMESTAMP) IS NULL THEN 0 ELSE 1 END
      AS is_delivered
  FROM raw_orders),
deduped_items AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id
      ORDER BY product_id NULLS FIRST, seller_id NULLS FIRST, shipping_limit_date NULLS FIRST,
        price NULLS FIRST, freight_value NULLS FIRST) AS place
    FROM raw_order_items) WHERE place = 1),
clean_items AS (
  SELECT order_id, order_item_id, product_id, seller_id,
    TRY_CAST(shipping_limit_date AS TIMESTAMP) AS shipping_limit_date, price, freight_value,
    CASE WHEN shipping_limit_date IS NULL THEN 0 ELSE 1 END AS has_shipping_limit,
    CASE WHEN shipping_limit_date IS NULL THEN 1 ELSE 0 END AS shipping_limit_date_is_missing
  FROM deduped_items),
clean_products AS (
  SELECT product_id, COALESCE(product_category_name, 'unknown') AS product_category_name,
    COALESCE(product_name_lenght, 0) AS product_name_lenght,
    COALESCE(product_description_lenght, 0) AS product_description_lenght,
    COALESCE(product_photos_qty, 0) AS product_photos_qty,
    COALESCE(CAST(product_weight_g AS DOUBLE), (SELECT median(product_weight_g) FROM raw_products))
      AS product_weight_g,
    COALESCE(CAST(product_length_cm AS DOUBLE), (SELECT median(product_length_cm) FROM raw_products))
      AS product_length_cm,
    COALESCE(CAST(product_height_cm AS DOUBLE), (SELECT median(product_height_cm) FROM raw_products))
      AS product_height_cm,
    COALESCE(CAST(product_width_cm AS DOUBLE), (SELECT median(product_width_cm) FROM raw_products))
      AS product_width_cm,
    CASE WHEN product_category_name IS NULL THEN 0 ELSE 1 END AS has_product_info,
    CASE WHEN product_category_name IS NULL THEN 1 ELSE 0 END AS product_category_name_is_missing,
    CASE WHEN product_name_lenght IS NULL THEN 1 ELSE 0 END AS product_name_lenght_is_missing,
    CASE WHEN product_description_lenght IS NULL THEN 1 ELSE 0 END
      AS product_description_lenght_is_missing,
    CASE WHEN product_photos_qty IS NULL THEN 1 ELSE 0 END AS product_photos_qty_is_missing,
    CASE WHEN product_weight_g IS NULL THEN 1 ELSE 0 END AS product_weight_g_is_missing,
    CASE WHEN product_length_cm IS NULL THEN 1 ELSE 0 END AS product_length_cm_is_missing,
    CASE WHEN product_height_cm IS NULL THEN 1 ELSE 0 END AS product_height_cm_is_missing,
    CASE WHEN product_width_cm IS NULL THEN 1 ELSE 0 END AS product_width_cm_is_missing
  FROM raw_products)"""

STAR = """
fact_all AS (
  SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date, i.price,
    i.freight_value, i.has_shipping_limit, i.shipping_limit_date_is_missing,
    o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
    o.order_delivered_carrier_date, o.order_delivered_customer_date,
    o.order_estimated_delivery_date, o.is_approved, o.is_shipped, o.is_delivered,
    i.price + i.freight_value AS total_value,
    CAST(o.order_purchase_timestamp AS DATE) AS order_purchase_date,
    strftime(o.order_purchase_timestamp, '%Y-%m') AS order_purchase_ym,
    o.order_delivered_customer_date AS order_delivered_timestamp,
    CAST(floor(date_diff('second', o.order_purchase_timestamp, o.order_delivered_customer_date)
      / 86400.0) AS BIGINT) AS delivery_time_days,
    CAST(floor(date_diff('second', o.order_purchase_timestamp, o.order_estimated_delivery_date)
      / 86400.0) AS BIGINT) AS estimated_delivery_days,
    CASE WHEN o.order_delivered_customer_date IS NULL THEN 0 ELSE 1 END AS has_delivery_date
  FROM clean_items i LEFT JOIN clean_orders o ON i.order_id = o.order_id),
fact_unfiltered AS (
  SELECT *, CASE WHEN is_delivered = 1 AND delivery_time_days > estimated_delivery_days
    THEN 1 ELSE 0 END AS is_delayed,
    TIMESTAMP '2024-01-01 00:00:00' AS etl_loaded_at, 'commerce_csv' AS data_source
  FROM fact_all),
dim_customers AS (
  SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS etl_loaded_at, 'commerce_csv' AS data_source
  FROM raw_customers),
dim_sellers AS (
  SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS etl_loaded_at, 'commerce_csv' AS data_source
  FROM raw_sellers),
dim_products AS (
  SELECT p.*, t.product_category_name_english AS category_english,
    TIMESTAMP '2024-01-01 00:00:00' AS etl_loaded_at, 'commerce_csv' AS data_source
  FROM clean_products p LEFT JOIN raw_category_translation t
    ON p.product_category_name = t.product_category_name),
day_series AS (
  SELECT unnest(generate_series(
    (SELECT CAST(min(order_purchase_timestamp) AS DATE) FROM clean_orders),
    (SELECT CAST(max(order_purchase_timestamp) AS DATE) FROM clean_orders),
    INTERVAL 1 DAY)) AS d),
dim_time AS (
  SELECT CAST(d AS DATE) AS date_id, year(d) AS year, month(d) AS month, day(d) AS day,
    isodow(d) - 1 AS day_of_week, strftime(d, '%A') AS day_name, strftime(d, '%B') AS month_name,
    quarter(d) AS quarter, week(d) AS week_of_year,
    CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    year(d) * 10000 + month(d) * 100 + day(d) AS date_key
  FROM day_series),
fact AS (
  SELECT * FROM fact_unfiltered
  WHERE customer_id IN (SELECT customer_id FROM dim_customers)
    AND product_id IN (SELECT product_id FROM dim_products)
    AND seller_id IN (SELECT seller_id FROM dim_sellers)),
arrived AS (SELECT * FROM fact WHERE is_delivered = 1),
delivered AS (SELECT * FROM fact WHERE order_status = 'delivered'),
today AS (SELECT max(order_purchase_date) + 1 AS d FROM fact)"""


def over_raw(select: str) -> str:
    """A SELECT that may be preceded by further expressions, over the raw tables."""
    return f"WITH {RAW.strip()}{_tail(select)}"


def over_star(select: str) -> str:
    return f"WITH {RAW.strip()},{CLEAN},{STAR}{_tail(select)}"


def _tail(select: str) -> str:
    """Further expressions start with AND-less names: "name AS (...), ... SELECT"."""
    body = select.strip()
    return ("\n" if body.upper().startswith("SELECT") else ",\n") + body


TABLE_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
               "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id",
                    "shipping_limit_date", "price", "freight_value"],
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                  "customer_city", "customer_state"],
    "products": ["product_id", "product_category_name", "product_name_lenght",
                 "product_description_lenght", "product_photos_qty", "product_weight_g",
                 "product_length_cm", "product_height_cm", "product_width_cm"],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments",
                 "payment_value"],
    "reviews": ["review_id", "order_id", "review_score", "review_comment_title",
                "review_comment_message", "review_creation_date", "review_answer_timestamp"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                    "geolocation_city", "geolocation_state"],
    "category_translation": ["product_category_name", "product_category_name_english"],
}
