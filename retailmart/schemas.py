"""Declared table schemas (staging, star, data-quality and monitoring tables).

Staging timestamps stay strings, as landed; they are parsed with ``try_to_timestamp``
when the fact is built.  Money is decimal end to end.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()
D = T.DateType()
TS = T.TimestampNTZType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STG_ORDERS = _struct(
    ("order_id", S), ("customer_id", S), ("order_status", S),
    ("order_purchase_timestamp", S), ("order_approved_at", S),
    ("order_delivered_customer_date", S), ("order_estimated_delivery_date", S),
)
STG_ORDER_ITEMS = _struct(
    ("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
    ("shipping_limit_date", S), ("price", dec(10, 2)), ("freight_value", dec(10, 2)),
)
STG_CUSTOMERS = _struct(
    ("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", S),
    ("customer_city", S), ("customer_state", S),
)
STG_PRODUCTS = _struct(
    ("product_id", S), ("category_name", S), ("name_length", I), ("description_length", I),
    ("photos_qty", I), ("weight_g", dec(10, 2)), ("length_cm", dec(10, 2)), ("height_cm", dec(10, 2)),
    ("width_cm", dec(10, 2)),
)
STG_SELLERS = _struct(
    ("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S), ("seller_state", S),
)
STG_PAYMENTS = _struct(
    ("order_id", S), ("payment_sequential", I), ("payment_type", S),
    ("payment_installments", I), ("payment_value", dec(10, 2)),
)
STG_REVIEWS = _struct(
    ("review_id", S), ("order_id", S), ("review_score", I), ("review_comment_title", S),
    ("review_comment_message", S), ("review_creation_date", S), ("review_answer_timestamp", S),
)
CATEGORY_LOOKUP = _struct(("product_category_name", S), ("product_category_name_english", S))
RATES = _struct(("ccy_from", S), ("ccy_to", S), ("rate", dec(12, 6)))

STAGING = {
    "stg_orders": STG_ORDERS,
    "stg_order_items": STG_ORDER_ITEMS,
    "stg_customers": STG_CUSTOMERS,
    "stg_products": STG_PRODUCTS,
    "stg_sellers": STG_SELLERS,
    "stg_payments": STG_PAYMENTS,
    "stg_reviews": STG_REVIEWS,
}

# Source file names of the raw landing files (fixed values of the public data set layout).
STAGING_FILES = {
    "stg_orders": "olist_orders_dataset.csv",
    "stg_order_items": "olist_order_items_dataset.csv",
    "stg_customers": "olist_customers_dataset.csv",
    "stg_products": "olist_products_dataset.csv",
    "stg_sellers": "olist_sellers_dataset.csv",
    "stg_payments": "olist_order_payments_dataset.csv",
    "stg_reviews": "olist_order_reviews_dataset.csv",
}

# Raw CSV header names that differ from the staging column names (products file).
STAGING_ALIASES = {
    "stg_products": {
        "product_category_name": "category_name",
        "product_name_lenght": "name_length",
        "product_description_lenght": "description_length",
        "product_photos_qty": "photos_qty",
        "product_weight_g": "weight_g",
        "product_length_cm": "length_cm",
        "product_height_cm": "height_cm",
        "product_width_cm": "width_cm",
    },
}

# Star schema column order (for documentation and for select lists).
DIM_CUSTOMER_COLS = ["customer_sk", "customer_id", "customer_unique_id", "city", "state", "zip_code"]
DIM_PRODUCT_COLS = ["product_sk", "product_id", "category_name", "category_english", "photos_qty", "weight_g"]
DIM_SELLER_COLS = ["seller_sk", "seller_id", "city", "state", "zip_code"]
DIM_DATE_COLS = ["date_sk", "full_date", "day", "month", "month_name", "quarter", "year", "is_weekend", "day_of_week"]
FACT_ORDERS_COLS = [
    "order_sk", "order_id", "customer_sk", "product_sk", "seller_sk", "date_sk", "order_item_id",
    "order_status", "price_brl", "freight_brl", "price_inr", "freight_inr", "payment_value",
    "payment_type", "review_score", "delivery_days", "is_late_delivery",
]

DQ_AUDIT = _struct(
    ("audit_id", L), ("run_id", S), ("run_date", TS), ("table_name", S), ("column_name", S),
    ("rule_name", S), ("rule_type", S), ("severity", S), ("status", S), ("total_records", L),
    ("failed_records", L), ("pass_rate", dec(5, 2)), ("threshold", dec(5, 2)), ("details", S),
)
DQ_RUN_SUMMARY = _struct(
    ("run_id", S), ("run_date", TS), ("total_checks", L), ("passed_checks", L),
    ("failed_checks", L), ("critical_fails", L), ("overall_status", S), ("report_path", S),
)
DQ_RULES = _struct(
    ("rule_id", I), ("table_name", S), ("column_name", S), ("rule_type", S), ("severity", S),
)
DQ_RESULTS = _struct(
    ("result_id", L), ("rule_id", I), ("failed_rows", L), ("total_rows", L), ("status", S),
    ("checked_at", TS), ("failure_pct", dec(5, 2)), ("check_date", D),
)
ETL_JOB_LOG = _struct(("job_name", S), ("run_time", TS), ("status", S), ("message", S))
JOBS = _struct(("job_id", S), ("name", S))
JOB_RUNS = _struct(
    ("job_id", S), ("step_id", I), ("step_name", S), ("run_date", I), ("run_time", I),
    ("run_duration", I), ("run_status", I), ("message", S),
)
JOB_SCHEDULES = _struct(("job_id", S), ("schedule_id", I))
SCHEDULES = _struct(("schedule_id", I), ("name", S))
