"""Star-schema builders: four dimensions and the order-line fact.

Input is staging-shaped (``schemas.STAGING``), whether it came from CSV files or from
the test fixture.  Every builder returns a lazy DataFrame; writing is the caller's job
(``plans.warehouse``).
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..sources.lookup import broadcast_if_small
from .keys import dense_surrogate_key

DEFAULT_DATE_START = _dt.date(2016, 1, 1)
DEFAULT_DATE_END = _dt.date(2019, 12, 31)


def build_dim_date(spark: SparkSession, start=DEFAULT_DATE_START, end=DEFAULT_DATE_END) -> DataFrame:
    """Daily calendar spine start..end inclusive (one row per day)."""
    start, end = as_date(start), as_date(end)
    days = (end - start).days + 1
    # The spine is generated in parallel from a range, not on the driver.
    n_parts = max(1, min(64, days // 2000 + 1))
    spine = spark.range(0, days, numPartitions=n_parts).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("d"))
    cal = X.calendar_fields("d")
    return spine.select(*[c.alias(n) for n, c in cal.items()])


def calendar_range(stg_orders: DataFrame, col: str = "order_purchase_timestamp") -> tuple[_dt.date, _dt.date]:
    """Whole calendar years covering the purchase dates (one small aggregate; defaults to the
    reference range when there are no orders)."""
    o_type = dict(stg_orders.dtypes)[col]
    ts = X.to_timestamp_any(col, o_type)
    row = stg_orders.agg(F.min(F.year(ts)).alias("lo"), F.max(F.year(ts)).alias("hi")).collect()[0]
    if row["lo"] is None:
        return DEFAULT_DATE_START, DEFAULT_DATE_END
    return _dt.date(row["lo"], 1, 1), _dt.date(row["hi"], 12, 31)


def as_date(v) -> _dt.date:
    return v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v))


def build_dim_customer(stg_customers: DataFrame) -> DataFrame:
    """One row per staging customer row (no de-duplication), dense key by customer_id."""
    dim = stg_customers.select(
        "customer_id", "customer_unique_id",
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
        F.col("customer_zip_code_prefix").alias("zip_code"))
    keyed = dense_surrogate_key(dim, ["customer_id", "customer_unique_id", "city", "state", "zip_code"], "customer_sk")
    return keyed.select("customer_sk", "customer_id", "customer_unique_id", "city", "state", "zip_code")


def build_dim_seller(stg_sellers: DataFrame) -> DataFrame:
    dim = stg_sellers.select(
        "seller_id",
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
        F.col("seller_zip_code_prefix").alias("zip_code"))
    keyed = dense_surrogate_key(dim, ["seller_id", "city", "state", "zip_code"], "seller_sk")
    return keyed.select("seller_sk", "seller_id", "city", "state", "zip_code")


def translate_category(df: DataFrame, lookup: DataFrame | None, col: str = "category_name",
                       out: str = "category_english", max_lookup_rows: int = 100_000) -> DataFrame:
    """Left join to the translation lookup; unmapped categories give NULL."""
    if lookup is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    lk = (lookup.groupBy("product_category_name")
          .agg(F.min("product_category_name_english").alias(out)))  # one translation per name
    lk = broadcast_if_small(lk, max_lookup_rows)
    return (df.join(lk, df[col] == lk["product_category_name"], "left")
            .drop("product_category_name"))


def build_dim_product(stg_products: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """DISTINCT product_id; a repeated id keeps the smallest known (non-null) value of each attribute."""
    picked = stg_products.groupBy("product_id").agg(*(F.min(c).alias(c) for c in ("category_name", "photos_qty", "weight_g")))
    # numbered before the lookup join, with split points from the scan: the counting job then
    # groups the ids alone, and the grouping of all attributes and the join run once
    keyed = dense_surrogate_key(picked, ["product_id"], "product_sk", sample_from=stg_products.select("product_id"))
    return translate_category(keyed, lookup).select("product_sk", "product_id", "category_name", "category_english",
                        "photos_qty", "weight_g")


def payments_per_order(stg_payments: DataFrame) -> DataFrame:
    """Per-order payment total and (max) payment type: pre-aggregated, so no fan-out."""
    return stg_payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_value"),
        F.max("payment_type").alias("payment_type"))


def reviews_per_order(stg_reviews: DataFrame) -> DataFrame:
    """Per-order review score: integer average (sum div count), as an int column would."""
    return stg_reviews.groupBy("order_id").agg(
        X.avg_int_truncated(F.sum("review_score"), F.count("review_score")).alias("review_score"))


def build_fact_orders(stg: dict[str, DataFrame], dim_customer: DataFrame, dim_product: DataFrame,
                      dim_seller: DataFrame, rate: Decimal = X.FALLBACK_RATE,
                      with_order_sk: bool = True) -> DataFrame:
    """Order-line fact: orders x items x dims, with per-order payment and review pre-aggregates.

    Join order is chosen for shuffles: orders meet customers, and items meet products and
    sellers, while their rows are narrow (small dimensions are broadcast by AQE from their
    runtime size); then everything keyed by order_id (items, payments, reviews) joins on one
    hash partitioning, and the wide lines are not shuffled again.
    """
    o_types = dict(stg["stg_orders"].dtypes)
    ts = lambda c: X.to_timestamp_any(c, o_types[c])
    # an order without a purchase time has no line; a text that is not a time stops the build
    raw, purchased = F.col("order_purchase_timestamp"), ts("order_purchase_timestamp")
    if o_types["order_purchase_timestamp"] == "string":
        purchased = F.when(raw.isNotNull() & purchased.isNull(),
                           F.raise_error(F.concat(F.lit("purchase time cannot be read: "), raw))).otherwise(purchased)
    orders = (stg["stg_orders"]
              .select("order_id", "customer_id", "order_status",
                      purchased.alias("purchased"),
                      ts("order_delivered_customer_date").alias("delivered"),
                      ts("order_estimated_delivery_date").alias("estimated"))
              .where(F.col("purchased").isNotNull()))
    cust = dim_customer.select("customer_id", "customer_sk")
    orders_c = orders.join(cust, "customer_id", "inner")
    items = stg["stg_order_items"].select("order_id", "order_item_id", "product_id", "seller_id",
                                          F.col("price").alias("price_brl"),
                                          F.col("freight_value").alias("freight_brl"))
    prod = dim_product.select("product_id", "product_sk")
    sell = dim_seller.select("seller_id", "seller_sk")
    items = items.join(prod, "product_id", "inner").join(sell, "seller_id", "inner").drop("product_id", "seller_id")
    pay = payments_per_order(stg["stg_payments"])
    rev = reviews_per_order(stg["stg_reviews"])
    lines = (orders_c.join(items, "order_id", "inner")
             .join(pay, "order_id", "left")
             .join(rev, "order_id", "left"))
    fact = lines.select(
        "order_id", "customer_sk", "product_sk", "seller_sk",
        X.date_key("purchased").alias("date_sk"),
        "order_item_id", "order_status", "price_brl", "freight_brl",
        X.currency_convert("price_brl", rate).alias("price_inr"),
        X.currency_convert("freight_brl", rate).alias("freight_inr"),
        X.null_default("payment_value", Decimal("0.00")).cast("decimal(12,2)").alias("payment_value"),
        X.null_default("payment_type", "unknown").alias("payment_type"),
        "review_score",
        X.delivery_days("delivered", "purchased").alias("delivery_days"),
        X.late_flag("delivered", "estimated").alias("is_late_delivery"),
    )
    if not with_order_sk:
        return fact
    return add_order_sk(fact, sample_from=stg["stg_order_items"])


ORDER_SK_KEY = ["order_id", "order_item_id", "product_sk", "seller_sk", "price_brl", "freight_brl"]


def add_order_sk(fact: DataFrame, sample_from: DataFrame | None = None, n_buckets: int | None = None) -> DataFrame:
    """Dense order_sk in (order_id, order_item_id, product, seller, price, freight) order.

    Buckets are cut on (order_id, order_item_id), so even an order holding a large share of
    all lines is spread over several buckets.
    """
    keyed = dense_surrogate_key(fact, ORDER_SK_KEY, "order_sk", n_buckets=n_buckets, sample_from=sample_from,
                                bucket_by=["order_id", "order_item_id"])
    cols = ["order_sk"] + [c for c in fact.columns]
    return keyed.select(*cols)
