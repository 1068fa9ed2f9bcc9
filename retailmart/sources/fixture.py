"""Test fixture: the generated TPC-H-like tables reshaped into staging tables.

The warehouse code only ever sees staging-shaped input; everything specific to the test
tables lives here (FIXTURES.md §3).  Keys stay integer.  Money operands are cast to
decimal before any multiplication, so Spark and the SQL oracle agree to the cent.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping ---------------------------------------------------
ORDER_STATUS_MAP = {"F": "delivered", "O": "shipped", "P": "processing"}
PAYMENT_TYPE_MAP = {"A": "credit_card", "N": "boleto", "R": "voucher"}
UNMAPPED_CATEGORY = "STANDARD"
FIXTURE_RATE = Decimal("18.5000")


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table (read-only input); the scan plan is reused within one application."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(path)
    return df


def _map(col: str, mapping: dict[str, str]):
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(col) == k, F.lit(v)) if expr is None else expr.when(F.col(col) == k, F.lit(v))
    return expr


def _price():
    return F.col("l_extendedprice").cast("decimal(10,2)")


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders; the delivery time is the first ship date on or after the order date."""
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
    delivered = (lines.join(orders.select("o_orderkey", "o_orderdate"),
                            F.col("l_orderkey") == F.col("o_orderkey"))
                 .where(F.col("l_shipdate") >= F.col("o_orderdate"))
                 .groupBy("l_orderkey").agg(F.min("l_shipdate").alias("delivered")))
    return (orders.join(delivered, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_custkey").alias("customer_id"),
                    _map("o_orderstatus", ORDER_STATUS_MAP).alias("order_status"),
                    F.col("o_orderdate").alias("order_purchase_timestamp"),
                    F.col("o_orderdate").alias("order_approved_at"),
                    F.col("delivered").alias("order_delivered_customer_date"),
                    (F.col("o_orderdate") + F.expr("INTERVAL 365 DAYS")).alias("order_estimated_delivery_date")))


def stg_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        _price().alias("price"),
        F.round(_price() * F.col("l_tax").cast("decimal(4,2)"), 2).cast("decimal(10,2)").alias("freight_value"),
    )


def stg_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "F")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        _map("l_returnflag", PAYMENT_TYPE_MAP).alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        _price().alias("payment_value"),
    )


def stg_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        (F.lit(1) + F.col("l_quantity").cast("int") % 5).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        F.col("l_shipdate").alias("review_creation_date"),
        F.col("l_shipdate").alias("review_answer_timestamp"),
    )


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select("n_nationkey", "n_name", "r_name"))


def _zip(col: str):
    return F.lpad((F.col(col) % 100000).cast("string"), 5, "0")


def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    geo = F.broadcast(_geo(spark, sf_dir))  # nation x region: 25 rows by the TPC-H definition
    return (c.join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.call_function("div", F.col("c_custkey"), F.lit(2)).alias("customer_unique_id"),
                    _zip("c_custkey").alias("customer_zip_code_prefix"),
                    F.col("r_name").alias("customer_city"),
                    F.col("n_name").alias("customer_state")))


def stg_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    geo = F.broadcast(_geo(spark, sf_dir))
    return (s.join(geo, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select(F.col("s_suppkey").alias("seller_id"),
                    _zip("s_suppkey").alias("seller_zip_code_prefix"),
                    F.col("r_name").alias("seller_city"),
                    F.col("n_name").alias("seller_state")))


def stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category_name"),
        F.length("p_name").alias("name_length"),
        F.length("p_brand").alias("description_length"),
        (F.col("p_size") % 5).alias("photos_qty"),
        F.col("p_size").cast("decimal(10,2)").alias("weight_g"),
        F.lit(None).cast("decimal(10,2)").alias("length_cm"),
        F.lit(None).cast("decimal(10,2)").alias("height_cm"),
        F.lit(None).cast("decimal(10,2)").alias("width_cm"),
    )


def category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translation lookup derived from the part types: lower case, one type left unmapped."""
    p = table(spark, sf_dir, "part")
    return (p.select(F.col("p_type").alias("product_category_name")).distinct()
            .where(F.col("product_category_name") != UNMAPPED_CATEGORY)
            .select("product_category_name",
                    F.lower("product_category_name").alias("product_category_name_english")))


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All seven staging tables plus the category lookup, as lazy plans."""
    return {
        "stg_orders": stg_orders(spark, sf_dir),
        "stg_order_items": stg_order_items(spark, sf_dir),
        "stg_customers": stg_customers(spark, sf_dir),
        "stg_products": stg_products(spark, sf_dir),
        "stg_sellers": stg_sellers(spark, sf_dir),
        "stg_payments": stg_payments(spark, sf_dir),
        "stg_reviews": stg_reviews(spark, sf_dir),
        "category_lookup": category_lookup(spark, sf_dir),
    }


# Dirty tables for the data-quality operators (FIXTURES.md §5) -----------------------------
# The moduli that select the rows to spoil.
NULL_ID_MOD, ORPHAN_MOD, BOGUS_STATUS_MOD, NULL_STATUS_MOD, NEGATIVE_PRICE_MOD = 97, 83, 101, 103, 89
DUP_MOD, TRIPLE_MOD = 89, 178
NEG_WEIGHT_MOD, NULL_WEIGHT_MOD = 50, 70
ORPHAN_OFFSET = 1000000000


def orders_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with NULL ids, orphan customers, bad and NULL statuses, negative prices."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    status = (F.when(k % BOGUS_STATUS_MOD == 0, F.lit("bogus"))
              .when(k % NULL_STATUS_MOD == 0, F.lit(None).cast("string"))
              .otherwise(_map("o_orderstatus", ORDER_STATUS_MAP)))
    price = F.col("o_totalprice").cast("decimal(12,2)")
    return o.select(
        F.when(k % NULL_ID_MOD == 0, F.lit(None).cast("long")).otherwise(k).alias("order_id"),
        F.when(k % ORPHAN_MOD == 0, F.col("o_custkey") + ORPHAN_OFFSET).otherwise(F.col("o_custkey")).alias("customer_id"),
        status.alias("order_status"),
        F.when(k % NEGATIVE_PRICE_MOD == 0, -price).otherwise(price).alias("price"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


def orders_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders plus repeated rows: some ids twice, some three times."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        _map("o_orderstatus", ORDER_STATUS_MAP).alias("order_status"))
    k = F.col("order_id")
    return o.unionByName(o.where(k % DUP_MOD == 0)).unionByName(o.where(k % TRIPLE_MOD == 0))


def products_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = stg_products(spark, sf_dir)
    k = F.col("product_id")
    w = (F.when(k % NULL_WEIGHT_MOD == 0, F.lit(None).cast("decimal(10,2)"))
         .when(k % NEG_WEIGHT_MOD == 0, -F.col("weight_g")).otherwise(F.col("weight_g")))
    return p.withColumn("weight_g", w)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order date (for the date-logic rule: ship >= order)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))


def empty_like(df: DataFrame) -> DataFrame:
    """Zero rows with the same schema (pass rate 0 %, failure pct 0)."""
    return df.where(F.lit(False))


def staging_dirty(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Staging tables for the rule-table checks: the orders and items are spoiled."""
    stg = staging(spark, sf_dir)
    od = orders_dirty(spark, sf_dir)
    items = stg["stg_order_items"]
    k = F.col("order_id")
    items = (items.withColumn("product_id", F.when(k % 211 == 0, F.lit(None).cast("long")).otherwise(F.col("product_id")))
             .withColumn("price", F.when(k % 89 == 0, -F.col("price")).otherwise(F.col("price"))))
    stg["stg_orders"] = orders_dup(spark, sf_dir).unionByName(
        od.select("order_id", "customer_id", "order_status").where(F.col("order_id").isNull()))
    stg["stg_order_items"] = items
    return stg


# Job-history tables derived from the event stream (for the monitoring data sets) ---------
def job_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """jobs, job_runs, job_schedules, schedules: one job per event type, one step run per
    event (status from the event id, six codes so one is unknown), one schedule per hour of
    day, and a job attached to every hour in which it has events."""
    ev = table(spark, sf_dir, "events")
    jobs = ev.select(F.col("event_type").alias("job_id")).distinct() \
        .select("job_id", F.concat(F.lit("job_"), F.col("job_id")).alias("name"))
    step = (F.col("user_id") % 3 + 1).cast("int")
    runs = ev.select(
        F.col("event_type").alias("job_id"),
        F.col("event_id").alias("instance_id"),
        step.alias("step_id"),
        F.concat(F.lit("step_"), step.cast("string")).alias("step_name"),
        (F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")).cast("int").alias("run_date"),
        (F.hour("ts") * 10000 + F.minute("ts") * 100 + F.second("ts")).cast("int").alias("run_time"),
        F.floor("value").cast("int").alias("run_duration"),
        (F.col("event_id") % 6).cast("int").alias("run_status"),
        F.col("props").alias("message"))
    hour = F.hour("ts").cast("int")
    schedules = ev.select(hour.alias("schedule_id")).distinct().select(
        "schedule_id", F.concat(F.lit("Daily_"), F.lpad(F.col("schedule_id").cast("string"), 2, "0"), F.lit("h")).alias("name"))
    job_schedules = ev.select(F.col("event_type").alias("job_id"), hour.alias("schedule_id")).distinct()
    return {"jobs": jobs, "job_runs": runs, "schedules": schedules, "job_schedules": job_schedules}
