"""Declared schemas, keys, cleaning rules and thresholds of the commerce model."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

TEXT, INT, MONEY = T.StringType(), T.IntegerType(), T.DecimalType(10, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


# Timestamps arrive as text and are coerced in cleaning, so that one bad value
# becomes null there and does not fail the read.
RAW_SCHEMAS: dict[str, T.StructType] = {
    "orders": _schema(
        order_id=TEXT, customer_id=TEXT, order_status=TEXT,
        order_purchase_timestamp=TEXT, order_approved_at=TEXT,
        order_delivered_carrier_date=TEXT, order_delivered_customer_date=TEXT,
        order_estimated_delivery_date=TEXT,
    ),
    "order_items": _schema(
        order_id=TEXT, order_item_id=INT, product_id=TEXT, seller_id=TEXT,
        shipping_limit_date=TEXT, price=MONEY, freight_value=MONEY,
    ),
    "customers": _schema(
        customer_id=TEXT, customer_unique_id=TEXT, customer_zip_code_prefix=TEXT,
        customer_city=TEXT, customer_state=TEXT,
    ),
    "products": _schema(
        product_id=TEXT, product_category_name=TEXT, product_name_lenght=INT,
        product_description_lenght=INT, product_photos_qty=INT,
        product_weight_g=INT, product_length_cm=INT, product_height_cm=INT,
        product_width_cm=INT,
    ),
    "payments": _schema(
        order_id=TEXT, payment_sequential=INT, payment_type=TEXT,
        payment_installments=INT, payment_value=MONEY,
    ),
    "reviews": _schema(
        review_id=TEXT, order_id=TEXT, review_score=INT,
        review_comment_title=TEXT, review_comment_message=TEXT,
        review_creation_date=TEXT, review_answer_timestamp=TEXT,
    ),
    "sellers": _schema(
        seller_id=TEXT, seller_zip_code_prefix=TEXT, seller_city=TEXT, seller_state=TEXT,
    ),
    "geolocation": _schema(
        geolocation_zip_code_prefix=TEXT, geolocation_lat=T.DoubleType(),
        geolocation_lng=T.DoubleType(), geolocation_city=TEXT, geolocation_state=TEXT,
    ),
    "category_translation": _schema(
        product_category_name=TEXT, product_category_name_english=TEXT,
    ),
}

# Free text may hold line breaks, so only this file needs the multi-line reader.
MULTILINE_TABLES = {"reviews"}

# Place of a row in its source files, where the reader was asked to note it.
FILE_ORDER = "_file_order"

STAGED_TABLES = ("orders", "order_items", "customers", "products", "payments")

PRIMARY_KEYS = {
    "dim_customers": ["customer_id"],
    "dim_products": ["product_id"],
    "dim_sellers": ["seller_id"],
    "dim_time": ["date_key"],
    "fact_order_items": ["order_id", "order_item_id"],
    "agg_customer_metrics": ["customer_id"],
    "agg_product_metrics": ["product_id"],
    "agg_monthly_revenue": ["year", "month"],
}


@dataclass(frozen=True)
class CleaningRules:
    """What to check and repair in one raw table, applied in field order."""

    critical: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    presence_flags: dict[str, str] = field(default_factory=dict)
    missing: dict[str, str] = field(default_factory=dict)
    text: tuple[str, ...] = ()
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)

    def with_ranges(self, **bounds: tuple[float, float]) -> CleaningRules:
        return replace(self, ranges={**self.ranges, **bounds})


# Which columns each table checks, repairs and bounds.
DEFAULT_RULES: dict[str, CleaningRules] = {
    "orders": CleaningRules(
        critical=("order_id", "customer_id", "order_purchase_timestamp", "order_status"),
        key=("order_id",),
        timestamps=(
            "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date",
        ),
        presence_flags={
            "order_approved_at": "is_approved",
            "order_delivered_carrier_date": "is_shipped",
            "order_delivered_customer_date": "is_delivered",
        },
        missing={
            "order_approved_at": "keep_null",
            "order_delivered_carrier_date": "keep_null",
            "order_delivered_customer_date": "keep_null",
        },
    ),
    "order_items": CleaningRules(
        critical=("order_id", "product_id", "price"),
        key=("order_id", "order_item_id"),
        timestamps=("shipping_limit_date",),
        presence_flags={"shipping_limit_date": "has_shipping_limit"},
        missing={"shipping_limit_date": "keep_null"},
        ranges={"price": (0, 100000), "freight_value": (0, 500)},
    ),
    "customers": CleaningRules(
        critical=("customer_id", "customer_city", "customer_state"),
        key=("customer_id",),
    ),
    "products": CleaningRules(
        critical=("product_id",),
        key=("product_id",),
        presence_flags={"product_category_name": "has_product_info"},
        missing={
            "product_category_name": "unknown",
            "product_name_lenght": "zero",
            "product_description_lenght": "zero",
            "product_photos_qty": "zero",
            "product_weight_g": "median",
            "product_length_cm": "median",
            "product_height_cm": "median",
            "product_width_cm": "median",
        },
    ),
    "payments": CleaningRules(
        critical=("order_id",),
        key=("order_id", "payment_sequential"),
        timestamps=("order_payment_time",),
        ranges={"payment_value": (0, 100000)},
    ),
    "reviews": CleaningRules(
        critical=("review_id", "order_id"),
        key=("review_id",),
        timestamps=("review_creation_date", "review_answer_timestamp"),
        presence_flags={
            "review_comment_title": "has_review_title",
            "review_comment_message": "has_review_message",
        },
        missing={"review_comment_title": "keep_null", "review_comment_message": "keep_null"},
        text=("review_comment_title", "review_comment_message"),
        ranges={"review_score": (1, 5)},
    ),
    # A repeated key here would multiply products, sellers and their revenue.
    "sellers": CleaningRules(key=("seller_id",)),
    "category_translation": CleaningRules(key=("product_category_name",)),
}

# The six known order states.
ORDER_STATUSES = ("delivered", "shipped", "canceled", "processing", "invoiced", "approved")

# Quality gate limits as shares of the rows.
MAX_NULL_CRITICAL = 0.05
MAX_NULL_WARNING = 0.15
MAX_DUPLICATES = 0.01
MAX_FK_VIOLATIONS = 0.02
MAX_INVALID = 0.01


@dataclass(frozen=True)
class GateRules:
    """Limits one warehouse table must meet before it is loaded."""

    critical: tuple[str, ...]
    max_null: float
    key: tuple[str, ...]
    foreign_keys: dict[str, str] = field(default_factory=dict)


# Gate limits by table.
GATE_RULES: dict[str, GateRules] = {
    "fact_order_items": GateRules(
        ("order_id", "product_id", "customer_id", "price"), 0.05, ("order_id", "order_item_id"),
        {"customer_id": "dim_customers", "product_id": "dim_products", "seller_id": "dim_sellers"},
    ),
    "dim_customers": GateRules(
        ("customer_id", "customer_city", "customer_state"), 0.10, ("customer_id",)
    ),
    "dim_products": GateRules(("product_id",), 0.20, ("product_id",)),
    "dim_sellers": GateRules(("seller_id",), 0.10, ("seller_id",)),
}
