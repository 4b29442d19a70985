"""Oracles of the operators on raw tables: sources, cleaning, profiles, text."""

from __future__ import annotations

from itertools import combinations

from oracles.prelude import (
    CLEAN, RAW, TABLE_COLUMNS, half_up, over_raw, over_star, percent, ratio, text,
)
from oracles.values import (
    CRITICAL, EMOJI_CLASS, KEYS, OPINION_WORDS, ORDER_TIMES, PROFILED_FIELDS, RANGES, REVIEW_TEXTS,
    STOP_WORDS, WORD_BREAK,
)

ORACLES: dict[str, str] = {}


def union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def nulls(column: str) -> str:
    return f"COUNT(*) FILTER (WHERE {column} IS NULL)"


# --- sources ---------------------------------------------------------------

# Columns that are read as numbers; all others are text.
NUMBERS = {
    "order_item_id", "price", "freight_value", "product_name_lenght",
    "product_description_lenght", "product_photos_qty", "product_weight_g", "product_length_cm",
    "product_height_cm", "product_width_cm", "payment_sequential", "payment_installments",
    "payment_value", "review_score", "geolocation_lat", "geolocation_lng",
}


def _content(table: str, column: str) -> str:
    characters, total = "NULL", "NULL"
    if column in NUMBERS:
        total = half_up(f"SUM(CAST({column} AS DOUBLE))", 2)
    else:
        characters = f"SUM(length(CAST({column} AS VARCHAR)))"
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, COUNT(*) AS n_rows, "
            f"COUNT({column}) AS n_present, CAST({characters} AS BIGINT) AS n_characters, "
            f"CAST({total} AS DOUBLE) AS total FROM raw_{table}")


ORACLES["read_tables"] = over_raw(union(
    [_content(t, c) for t, columns in TABLE_COLUMNS.items() for c in columns]))

LAYERS = {
    "raw_orders": ("clean_orders", 14), "raw_order_items": ("clean_items", 9),
    "raw_customers": ("raw_customers", 5), "raw_products": ("clean_products", 18),
    "raw_payments": ("raw_payments", 5), "dim_customers": ("dim_customers", 7),
    "dim_products": ("dim_products", 21), "dim_sellers": ("dim_sellers", 6),
    "dim_time": ("dim_time", 11), "fact_order_items": ("fact", 29),
    "agg_customer_metrics": ("(SELECT DISTINCT customer_id FROM arrived)", 13),
    "agg_product_metrics": ("(SELECT DISTINCT product_id FROM arrived)", 11),
    "agg_monthly_revenue": ("(SELECT DISTINCT order_purchase_ym FROM arrived)", 10),
}
ORACLES["write_layers"] = over_star(union([
    f"SELECT '{n}' AS table_name, COUNT(*) AS n_rows, CAST({c} AS BIGINT) AS n_columns FROM {t}"
    for n, (t, c) in LAYERS.items()
]))

UPDATES = """dim AS (SELECT customer_id, customer_city, customer_state FROM raw_customers),
updates AS (
  SELECT customer_id, 'unknown' AS customer_city, customer_state FROM dim
  WHERE customer_city IS NULL
  UNION ALL SELECT -1 - seller_id, seller_city, seller_state FROM raw_sellers)
"""
ORACLES["upsert_table"] = over_raw(UPDATES + """SELECT * FROM updates
UNION ALL SELECT * FROM dim WHERE customer_id NOT IN (SELECT customer_id FROM updates)""")
ORACLES["replace_table"] = over_raw(UPDATES + "SELECT * FROM updates")
ORACLES["append_table"] = over_raw(UPDATES + """SELECT * FROM dim
UNION ALL SELECT * FROM updates WHERE customer_id NOT IN (SELECT customer_id FROM dim)""")
ORACLES["sample_rows"] = over_star("""SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id,
  product_id, customer_id, CAST(total_value AS DOUBLE) AS total_value
FROM fact ORDER BY order_id, order_item_id LIMIT 1000""")
ORACLES["dataset_info"] = over_raw(union([
    f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, CAST({len(c)} AS BIGINT) AS n_columns, "
    f"{percent(' + '.join(nulls(x) for x in c), f'COUNT(*) * {len(c)}', 4)} AS null_percentage "
    f"FROM raw_{t}" for t, c in TABLE_COLUMNS.items()
]))

# --- cleaning --------------------------------------------------------------

ORACLES["validate_critical"] = over_raw(union([
    f"SELECT '{t}' AS table_name, '{c}' AS field, COUNT(*) AS rows, {nulls(c)} AS null_count, "
    f"{half_up(f'(100.0 * {nulls(c)} / COUNT(*))', 4)} AS null_pct, "
    f"CAST({nulls(c)} <= 0.05 * COUNT(*) AS BIGINT) AS passed FROM raw_{t}"
    for t, fields in CRITICAL.items() for c in fields
]))
ORACLES["missing_flags"] = f"""WITH {RAW.strip()},{CLEAN}
SELECT order_id, CAST(is_approved AS BIGINT) AS is_approved,
  CAST(is_shipped AS BIGINT) AS is_shipped, CAST(is_delivered AS BIGINT) AS is_delivered
FROM clean_orders"""
ORACLES["dedupe_first"] = f"""WITH {RAW.strip()},{CLEAN}
SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, product_id, seller_id,
  shipping_limit_date, CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE)
    AS freight_value
FROM deduped_items"""
ORACLES["coerce_timestamps"] = over_raw("SELECT order_id, " + ", ".join(
    f"{text(f'TRY_CAST({c} AS TIMESTAMP)')} AS {c}" for c in ORDER_TIMES
) + " FROM raw_orders")
ORACLES["fill_approved_at"] = over_raw(f"""SELECT order_id,
  {text('''COALESCE(TRY_CAST(order_approved_at AS TIMESTAMP),
  TRY_CAST(order_purchase_timestamp AS TIMESTAMP))''')} AS order_approved_at FROM raw_orders""")
ORACLES["impute_drop"] = over_raw("""SELECT product_id, product_category_name FROM raw_products
WHERE product_category_name IS NOT NULL""")
ORACLES["impute_zero"] = over_raw("""SELECT product_id,
  CAST(COALESCE(product_photos_qty, 0) AS BIGINT) AS product_photos_qty FROM raw_products""")
ORACLES["impute_mean"] = over_raw("""SELECT product_id, ROUND(COALESCE(
  CAST(product_weight_g AS DOUBLE),
  (SELECT SUM(product_weight_g) / CAST(COUNT(product_weight_g) AS DOUBLE) FROM raw_products)), 6)
  AS product_weight_g FROM raw_products""")
ORACLES["impute_median"] = over_raw("""SELECT product_id, COALESCE(
  CAST(product_weight_g AS DOUBLE), (SELECT median(product_weight_g) FROM raw_products))
  AS product_weight_g FROM raw_products""")
ORACLES["impute_unknown"] = over_raw("""SELECT product_id,
  COALESCE(product_category_name, 'unknown') AS product_category_name FROM raw_products""")
ORACLES["impute_keep"] = over_raw("SELECT review_id, review_comment_title FROM raw_reviews")
ORACLES["impute_flag"] = over_raw("SELECT product_id, " + ", ".join(
    f"CAST({c} IS NULL AS BIGINT) AS {c}_is_missing"
    for c in ("product_category_name", "product_weight_g")
) + " FROM raw_products")
ORACLES["impute_in_order"] = over_raw("""kept AS (
  SELECT * FROM raw_products WHERE product_category_name IS NOT NULL)
SELECT product_id,
  COALESCE(CAST(product_weight_g AS DOUBLE), (SELECT median(product_weight_g) FROM kept))
    AS product_weight_g,
  CAST(product_weight_g IS NULL AS BIGINT) AS product_weight_g_is_missing,
  CAST(COALESCE(product_photos_qty, 0) AS BIGINT) AS product_photos_qty FROM kept""")
ORACLES["validate_ranges"] = over_raw(union([
    f"SELECT '{t}' AS table_name, '{c}' AS field, CAST({lo} AS DOUBLE) AS min_value, "
    f"CAST({hi} AS DOUBLE) AS max_value, "
    f"COUNT(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS violations FROM raw_{t}"
    for t, ranges in RANGES.items() for c, (lo, hi) in ranges.items()
]))


def _words(c: str) -> str:
    trimmed = f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"
    return (f"CASE WHEN length({trimmed}) > 0 "
            f"THEN len(string_split_regex({trimmed}, '\\s+')) ELSE 0 END")


ORACLES["text_features"] = over_raw("SELECT review_id, " + ", ".join(
    f"COALESCE(length({c}), 0) AS {c}_length, CAST({_words(c)} AS BIGINT) AS {c}_word_count"
    for c in REVIEW_TEXTS
) + " FROM raw_reviews")

CLEANED = {
    "orders": ("clean_orders", TABLE_COLUMNS["orders"] + [
        "is_approved", "is_shipped", "is_delivered", "order_approved_at_is_missing",
        "order_delivered_carrier_date_is_missing", "order_delivered_customer_date_is_missing"]),
    "order_items": ("clean_items", TABLE_COLUMNS["order_items"] + [
        "has_shipping_limit", "shipping_limit_date_is_missing"]),
    "products": ("clean_products", TABLE_COLUMNS["products"] + ["has_product_info"] + [
        f"{c}_is_missing" for c in TABLE_COLUMNS["products"][1:]]),
    "reviews": ("raw_reviews", TABLE_COLUMNS["reviews"] + [
        "has_review_title", "has_review_message", "review_comment_title_is_missing",
        "review_comment_message_is_missing", "review_comment_title_length",
        "review_comment_title_word_count", "review_comment_message_length",
        "review_comment_message_word_count"]),
}
ORACLES["clean_all"] = f"WITH {RAW.strip()},{CLEAN}\n" + union([
    "SELECT '{0}' AS table_name, COUNT(*) AS n_rows, CAST({2} AS BIGINT) AS n_columns FROM {1}"
    .format(t, *((lambda x: (x[0], len(x[1])))(CLEANED[t]) if t in CLEANED else (f"raw_{t}", len(c))))
    for t, c in TABLE_COLUMNS.items()
])


def _audit_rows() -> list[str]:
    rows = []
    for t, columns in TABLE_COLUMNS.items():
        source, names = CLEANED.get(t, (f"raw_{t}", columns))
        for c in names:
            # Flags and text measures are made by cleaning and never empty.
            made = c.startswith(("is_", "has_")) or c.endswith(("_is_missing", "_length", "_word_count"))
            n = "COUNT(*) * 0" if made else nulls(c)
            rows.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n} AS null_count "
                        f"FROM {source}")
    return rows


ORACLES["null_audit"] = f"WITH {RAW.strip()},{CLEAN}\n" + union(_audit_rows())

# --- profiles --------------------------------------------------------------

TYPES = {
    "order_id": "bigint", "customer_id": "bigint", "customer_unique_id": "bigint",
    "product_id": "bigint", "seller_id": "bigint", "review_id": "bigint",
    "order_item_id": "int", "payment_sequential": "int", "payment_installments": "int",
    "review_score": "int", "product_name_lenght": "int", "product_description_lenght": "int",
    "product_photos_qty": "int", "product_weight_g": "int", "product_length_cm": "int",
    "product_height_cm": "int", "product_width_cm": "int", "price": "decimal(10,2)",
    "freight_value": "decimal(10,2)", "payment_value": "decimal(10,2)",
    "geolocation_lat": "double", "geolocation_lng": "double",
}
PROFILE = union([
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{TYPES.get(c, 'string')}' AS data_type, "
    f"COUNT({c}) AS non_null_count, {nulls(c)} AS null_count, "
    f"{percent(nulls(c), 'COUNT(*)')} AS null_pct FROM raw_{t}"
    for t, columns in TABLE_COLUMNS.items() for c in columns
])
ORACLES["profile_schema"] = over_raw(PROFILE)
ORACLES["missing_report"] = over_raw(f"""profile AS ({PROFILE})
SELECT table_name, column_name, null_count, null_pct FROM profile WHERE null_count > 0""")
ORACLES["critical_null_report"] = over_raw(union([
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, {nulls(c)} AS null_count, "
    f"CASE WHEN {nulls(c)} = 0 THEN 'No missing' ELSE 'Missing values' END AS status FROM raw_{t}"
    for t, columns in PROFILED_FIELDS.items() for c in columns
]))

MERGED = TABLE_COLUMNS["order_items"] + TABLE_COLUMNS["products"][1:] + [
    c for c in TABLE_COLUMNS["reviews"] if c != "order_id"
]


def _correlation(a: str, b: str) -> str:
    n, x, y = "COUNT(*)::DOUBLE", f"SUM({a}_e)::DOUBLE", f"SUM({b}_e)::DOUBLE"
    both = f"SUM({a}_e * {b}_e)::DOUBLE"
    spread = f"NULLIF(sqrt({x} * ({n} - {x})) * sqrt({y} * ({n} - {y})), 0)"
    return (f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
            f"{half_up(f'(({n} * {both} - {x} * {y}) / {spread})', 6)} AS correlation FROM empties")


ORACLES["null_correlation"] = over_raw("""merged AS (
  SELECT i.order_id, i.product_id, i.order_item_id, i.seller_id, i.shipping_limit_date, i.price,
    i.freight_value, p.* EXCLUDE (product_id), r.* EXCLUDE (order_id)
  FROM raw_order_items i LEFT JOIN raw_products p ON i.product_id = p.product_id
    LEFT JOIN raw_reviews r ON i.order_id = r.order_id),
empties AS MATERIALIZED (SELECT """ + ", ".join(
    f"CAST({c} IS NULL AS INTEGER) AS {c}_e" for c in MERGED
) + " FROM merged)\n" + union([_correlation(a, b) for a, b in combinations(MERGED, 2)]))
ORACLES["duplicate_report"] = over_raw(union([
    f"SELECT '{t}' AS table_name, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows, "
    f"CASE WHEN SUM(n - 1) = 0 THEN 'No duplicates' ELSE 'DUPLICATES FOUND' END AS status "
    f"FROM (SELECT COUNT(*) AS n FROM raw_{t} GROUP BY {', '.join(k)})"
    for t, k in KEYS.items()
]))


def _bad_stamps(t: str, c: str) -> str:
    bad = f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL)"
    return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, {bad} AS invalid_count, "
            f"CASE WHEN {bad} = 0 THEN 'OK' ELSE 'INVALID' END AS status FROM raw_{t}")


ORACLES["timestamp_report"] = over_raw(union([
    _bad_stamps("orders", c) for c in TABLE_COLUMNS["orders"][3:7]
] + [_bad_stamps("reviews", c) for c in TABLE_COLUMNS["reviews"][5:]]))
ORACLES["price_report"] = over_raw(f"""SELECT
  COUNT(*) FILTER (WHERE price < 0) AS negative_prices,
  COUNT(*) FILTER (WHERE price = 0) AS zero_prices,
  CAST(MIN(price) AS DOUBLE) AS min_price, CAST(MAX(price) AS DOUBLE) AS max_price,
  {ratio('SUM(price)', 'COUNT(price)', 2)} AS mean_price,
  COUNT(*) FILTER (WHERE freight_value < 0) AS negative_freight,
  CAST(MIN(freight_value) AS DOUBLE) AS min_freight,
  CAST(MAX(freight_value) AS DOUBLE) AS max_freight,
  {ratio('SUM(freight_value)', 'COUNT(freight_value)', 2)} AS mean_freight
FROM raw_order_items""")


def _relationship(name: str, child: str, parent: str, key: str) -> str:
    return f"""SELECT '{name}' AS relationship,
  (SELECT COUNT(DISTINCT {key}) FROM raw_{child}) AS child_keys,
  (SELECT COUNT(DISTINCT {key}) FROM raw_{parent}) AS parent_keys,
  (SELECT COUNT(*) FROM raw_{child}) AS child_rows,
  (SELECT COUNT(*) FROM raw_{child} WHERE {key} IN (SELECT {key} FROM raw_{parent}))
    AS matched_rows,
  (SELECT COUNT(DISTINCT {key}) FROM raw_{child}
    WHERE {key} NOT IN (SELECT {key} FROM raw_{parent})) AS orphan_keys,
  (SELECT {ratio('SUM(n)', 'COUNT(*)', 2)} FROM
    (SELECT COUNT(*) AS n FROM raw_{child} GROUP BY {key})) AS avg_children,
  (SELECT MAX(n) FROM (SELECT COUNT(*) AS n FROM raw_{child} GROUP BY {key})) AS max_children,
  (SELECT COUNT(*) FROM (SELECT 1 FROM raw_{child} GROUP BY {key} HAVING COUNT(*) > 1))
    AS parents_with_several,
  (SELECT COUNT(DISTINCT {key}) FROM raw_{parent} p
    WHERE NOT EXISTS (SELECT 1 FROM raw_{child} c WHERE c.{key} = p.{key})) AS parents_without"""


ORACLES["relationship_report"] = over_raw(union([
    _relationship("customers <- orders", "orders", "customers", "customer_id"),
    _relationship("orders <- order_items", "order_items", "orders", "order_id"),
    _relationship("products <- order_items", "order_items", "products", "product_id"),
    _relationship("orders <- payments", "payments", "orders", "order_id"),
]))


def _expect(name: str, column: str, table: str, bad: str, holds: bool = True) -> str:
    failed = f"COUNT(*) FILTER (WHERE {bad})"
    ok = f"CAST({failed} = 0 AND {holds} AS BIGINT)"
    return (f"SELECT '{name}' AS expectation, '{column}' AS column_name, COUNT(*) AS row_count, "
            f"{failed} AS failed_rows, {ok} AS success FROM raw_{table}")


STATUSES = "('delivered', 'shipped', 'canceled', 'processing', 'invoiced', 'approved')"
ORACLES["expect_column_exists"] = over_raw(union([
    _expect("expect_column_exists", "customer_id", "customers", "FALSE"),
    _expect("expect_column_exists", "no_such_column", "customers", "FALSE", False),
]))
ORACLES["expect_not_null"] = over_raw(union([
    _expect("expect_not_null", c, "customers", f"{c} IS NULL")
    for c in ("customer_id", "customer_city")
]))
ORACLES["expect_in_set"] = over_raw(union([
    _expect("expect_in_set", "order_status", "orders", f"order_status NOT IN {STATUSES}"),
    _expect("expect_in_set", "order_approved_at", "orders",
            "order_approved_at IS NULL OR order_approved_at <> 'unknown'"),
]))
ORACLES["expect_between"] = over_raw(union([
    _expect("expect_between", "payment_value", "payments", "payment_value NOT BETWEEN 0 AND 10000"),
    _expect("expect_between", "payment_installments", "payments", "payment_installments < 1"),
]))
ORACLES["expect_type"] = over_raw(union([
    _expect("expect_type", "product_weight_g", "products", "FALSE"),
    _expect("expect_type", "product_category_name", "products", "FALSE", False),
]))
ORACLES["validate_suite"] = over_raw("results AS (" + union([
    _expect("expect_column_exists", "customer_id", "customers", "FALSE"),
    _expect("expect_not_null", "customer_id", "customers", "customer_id IS NULL"),
    _expect("expect_not_null", "customer_city", "customers", "customer_city IS NULL"),
    _expect("expect_in_set", "customer_state", "customers",
            "customer_state NOT IN ('AF', 'AM', 'AS', 'EU')"),
    _expect("check_constraint", "state_has_two_letters", "customers",
            "length(customer_state) <> 2"),
]) + ") SELECT *, CAST(5 AS BIGINT) AS column_count FROM results")
ORACLES["column_defaults"] = over_raw("SELECT product_id, " + ", ".join(
    f"CAST(COALESCE({c}, 0) AS BIGINT) AS {c}" for c in TABLE_COLUMNS["products"][2:5]
) + " FROM raw_products")
ORACLES["quality_rates"] = over_raw(f"""SELECT COUNT(*) AS rows,
  {percent(' + '.join(nulls(c) for c in ('order_id', 'product_id', 'price')), 'COUNT(*) * 3', 4)}
    AS null_rate_pct,
  {percent('COUNT(*) - COUNT(DISTINCT (order_id, order_item_id))', 'COUNT(*)', 4)}
    AS duplicate_rate_pct,
  {percent('COUNT(TRY_CAST(shipping_limit_date AS TIMESTAMP))', 'COUNT(shipping_limit_date)', 4)}
    AS type_compliance_pct
FROM raw_order_items""")

# --- review text -----------------------------------------------------------

TOKENS = f"""tokens AS (
  SELECT review_id, review_comment_message AS m,
    string_split_regex(lower(review_comment_message), '{WORD_BREAK}') AS w
  FROM raw_reviews)"""


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _hits(words) -> str:
    return f"len(list_filter(w, lambda x: list_contains({_list(words)}, x)))"


def _weighted(part: int) -> str:
    total = " + ".join(f"h{i}" for i in range(len(OPINION_WORDS)))
    value = " + ".join(f"h{i} * {s[part]}::DOUBLE" for i, s in enumerate(OPINION_WORDS))
    mean = f"COALESCE(({value}) / NULLIF(({total})::DOUBLE, 0), 0.0)"
    return f"CASE WHEN length(m) > 0 THEN {half_up(mean, 6)} END"


LANGUAGE = "CASE WHEN m IS NULL OR length(m) = 0 THEN NULL WHEN greatest({0}) = 0 THEN 'unknown' {1} END".format(
    ", ".join(f"l_{c}" for c in STOP_WORDS),
    " ".join(f"WHEN l_{c} = greatest({', '.join(f'l_{x}' for x in STOP_WORDS)}) THEN '{c}'"
             for c in sorted(STOP_WORDS)),
)
EMOJI = f"len(regexp_extract_all(m, '{EMOJI_CLASS}'))"
SCORED = TOKENS + ",\nscored AS (SELECT review_id, m, " + ", ".join(
    [f"{_hits(v)} AS h{i}" for i, v in enumerate(OPINION_WORDS.values())]
    + [f"{_hits(v)} AS l_{c}" for c, v in STOP_WORDS.items()]
) + f""" FROM tokens),
features AS (SELECT review_id, {_weighted(0)} AS sentiment_polarity,
  {_weighted(1)} AS sentiment_subjectivity, {LANGUAGE} AS review_language,
  {EMOJI} AS emoji_count FROM scored)
"""
ORACLES["review_sentiment"] = over_raw(
    SCORED + "SELECT review_id, sentiment_polarity, sentiment_subjectivity FROM features")
ORACLES["review_language"] = over_raw(SCORED + "SELECT review_id, review_language FROM features")
ORACLES["emoji_count"] = over_raw(SCORED + "SELECT review_id, emoji_count FROM features")
ORACLES["text_features_nlp"] = over_raw(SCORED + """SELECT review_id,
  COALESCE(sentiment_polarity, -999.0::DOUBLE) AS sentiment_polarity,
  COALESCE(sentiment_subjectivity, -999.0::DOUBLE) AS sentiment_subjectivity,
  review_language, CASE WHEN m_empty THEN -999 ELSE emoji_count END AS emoji_count
FROM (SELECT f.*, s.m IS NULL OR length(s.m) = 0 AS m_empty
      FROM features f JOIN scored s ON f.review_id = s.review_id)""")

# Weights of words that stand in five scored reviews at least, with a prior of ten.
LEARNED = TOKENS + f""",
words AS (
  SELECT t.review_id, t.m, r.review_score AS s,
    unnest(list_distinct(list_filter(t.w, lambda x: x <> ''))) AS word
  FROM tokens t JOIN raw_reviews r ON t.review_id = r.review_id WHERE length(t.m) > 0),
counted AS (
  SELECT word, COUNT(*) FILTER (WHERE s >= 4) AS n_positive,
    COUNT(*) FILTER (WHERE s <= 2) AS n_negative
  FROM words WHERE s >= 4 OR s <= 2 GROUP BY word),
totals AS (SELECT SUM(n_positive)::DOUBLE AS p, SUM(n_negative)::DOUBLE AS n FROM counted),
weights AS (
  SELECT word, n_positive, n_negative,
    {half_up("ln((n_positive + 10.0::DOUBLE * p / (p + n)) / p)"
             " - ln((n_negative + 10.0::DOUBLE * n / (p + n)) / n)", 6)} AS weight
  FROM counted, totals WHERE p > 0 AND n > 0 AND n_positive + n_negative >= 5)
"""
ORACLES["sentiment_weights"] = over_raw(
    LEARNED + "SELECT word, n_positive, n_negative, weight FROM weights")
ORACLES["review_sentiment_learned"] = over_raw(LEARNED + f""",
means AS (
  SELECT review_id, SUM(CAST(weight AS DECIMAL(18,6)))::DOUBLE / COUNT(*) AS a
  FROM words JOIN weights USING (word) GROUP BY review_id)
SELECT r.review_id, CASE WHEN length(r.review_comment_message) > 0
  THEN {half_up("COALESCE(a / (abs(a) + 1), 0.0)", 6)} END AS learned_polarity
FROM raw_reviews r LEFT JOIN means m ON r.review_id = m.review_id""")
