"""One query per operator of the inventory, each over the test tables or data Spark
derives from them (staging fixture, star, dirty tables, event-derived job tables).

The named analytics (Q1-Q12, the view) and the data-quality jobs live in their own
modules; this file holds the operator-level queries (sources, sinks, scalar functions,
filters, joins, aggregates, windows and builders) that isolate one operator each.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import cleaning as C
from ..functions import scalar as X
from ..operators import keys as K
from ..operators import star as S
from ..quality import jobs as J
from ..quality import rule_table as RT
from ..session import scratch_path
from ..sources import fixture, lookup, sinks, staging
from . import analytics as A
from .warehouse import JOB_LOG, RESULTS, STAR_TABLES, read_star, run_pipeline, star_from_testdata

FACT_COLS = A.FACT_COLS


def _star(spark, sf_dir):
    return star_from_testdata(spark, sf_dir)


def _stg(spark, sf_dir):
    return fixture.staging(spark, sf_dir)


# Sources and sinks -----------------------------------------------------------------------------
def _landed(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Land one staging table as CSV and scan it back with the declared staging schema; the
    times, which staging keeps as text, are read as times."""
    path = scratch_path(spark, "csv_" + table)
    source = _stg(spark, sf_dir)[table]
    raw_names = {v: k for k, v in schemas.STAGING_ALIASES.get(table, {}).items()}
    source.withColumnsRenamed(raw_names).write.option("header", True).option("escape", '"').csv(path)
    df = staging.scan_csv_staging(spark, path, table)
    return df.withColumns({c: X.to_timestamp_any(c, "string") for c, t in source.dtypes if t.startswith("timestamp")})


def scan_csv_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "stg_order_items")


def scan_csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "stg_orders")


def scan_csv_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "stg_customers")


def scan_csv_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "stg_products")


def scan_csv_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "stg_sellers")


def scan_csv_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "stg_payments")


def scan_csv_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(spark, sf_dir, "stg_reviews")


def scan_missing_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five of the seven landing files exist; the two missing ones load as empty tables."""
    root = scratch_path(spark, "landing")
    stg = _stg(spark, sf_dir)
    present = ["stg_orders", "stg_order_items", "stg_customers", "stg_products", "stg_sellers"]
    raw_names = {v: k for k, v in schemas.STAGING_ALIASES["stg_products"].items()}
    for t in present:
        df = stg[t]
        if t == "stg_products":  # land with the raw file's header names
            df = df.toDF(*[raw_names.get(c, c) for c in df.columns])
        df.write.option("header", True).csv(f"{root}/{schemas.STAGING_FILES[t]}")
    loaded = staging.load_staging(spark, root)
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), F.lit(t in present).alias("present"), "row_count")
             for t, df in loaded.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scan_category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lookup_csv")
    _stg(spark, sf_dir)["category_lookup"].write.option("header", True).csv(path)
    return lookup.scan_category_lookup(spark, path)


def sink_staging_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refreshing a staging table twice leaves one copy."""
    path = scratch_path(spark, "stg_orders")
    df = _stg(spark, sf_dir)["stg_orders"]
    sinks.sink_staging_overwrite(df, path)
    sinks.sink_staging_overwrite(df, path)
    return spark.read.parquet(path)


def sink_reload_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "dim_seller")
    df = _star(spark, sf_dir)["dim_seller"]
    sinks.sink_reload_table(df, path)
    sinks.sink_reload_table(df, path)
    return spark.read.parquet(path)


def sink_reload_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reloading the partitioned fact twice leaves one copy."""
    path = scratch_path(spark, "fact_orders")
    df = _star(spark, sf_dir)["fact_orders"]
    sinks.sink_reload_table(df, path, partition_by=["order_year"])
    sinks.sink_reload_table(df, path, partition_by=["order_year"])
    return spark.read.parquet(path).select(*FACT_COLS)


def sink_append_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, a day apart, appended: both are kept and no id repeats."""
    path = scratch_path(spark, "dq_audit")
    for started in J.TWO_RUNS:
        sinks.sink_append_audit(J.not_null_checks(spark, sf_dir, started), path)
    return spark.read.parquet(path)


RESULT_COLS = ["result_id", "rule_id", "failed_rows", "total_rows", "status", "checked_at", "failure_pct",
               "check_date"]


def sink_replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 1 written twice (replaced, not doubled), day 2 written once next to it."""
    path = scratch_path(spark, "dq_results")
    stg = fixture.staging_dirty(spark, sf_dir)
    rules = RT.rules_frame(spark)
    day1 = RT.evaluate_rules(stg, rules, J.TEST_CHECK_TIME)
    day2 = RT.evaluate_rules(stg, rules, J.TEST_CHECK_TIME + _dt.timedelta(days=1))
    sinks.sink_replace_day(day1, path)
    sinks.sink_replace_day(day1, path)
    sinks.sink_replace_day(day2, path)
    return spark.read.parquet(path).select(*RESULT_COLS)


def rate_lookup_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices converted with the rate of an (empty) rates table: the fallback applies."""
    rates = spark.createDataFrame([], schemas.RATES)
    rate = lookup.rate_lookup_fallback(spark, rates)
    items = _stg(spark, sf_dir)["stg_order_items"]
    return (items.crossJoin(rate)  # one-row side
            .select("order_id", "order_item_id", "price",
                    X.currency_convert("price", F.col("rate")).alias("price_inr")))


def rate_lookup_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices converted with a rate that the table holds, beside that of another pair."""
    rates = spark.createDataFrame([("BRL", "INR", Decimal("16.25")), ("USD", "INR", Decimal("83.1"))], schemas.RATES)
    rate = lookup.rate_lookup_fallback(spark, rates)
    items = _stg(spark, sf_dir)["stg_order_items"]
    return (items.crossJoin(rate)  # one-row side
            .select("order_id", "order_item_id", "price",
                    X.currency_convert("price", F.col("rate")).alias("price_inr")))


def values_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inline rule rows joined with the row counts of the tables they check."""
    stg = fixture.staging_dirty(spark, sf_dir)
    rules = RT.rules_frame(spark)
    counts = None
    for t in ["stg_orders", "stg_customers", "stg_order_items", "stg_payments"]:
        c = stg[t].agg(F.count(F.lit(1)).alias("table_rows")).select(F.lit(t).alias("table_name"), "table_rows")
        counts = c if counts is None else counts.unionByName(c)
    return rules.join(counts, "table_name").select("rule_id", "table_name", "column_name", "rule_type",
                                                   "severity", "table_rows")


# Cleaning and scalar functions --------------------------------------------------------------------
def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _stg(spark, sf_dir)["stg_customers"]
    messy = df.toDF(*[f"  {c.upper()} " for c in df.columns])
    return C.normalize_columns(messy)


def _spoiled_lines(spark, sf_dir):
    li = fixture.table(spark, sf_dir, "lineitem")
    v = (F.when(F.col("l_linenumber") == 1, F.lit(float("nan")))
         .when(F.col("l_linenumber") == 2, F.lit(float("inf")))
         .when(F.col("l_linenumber") == 3, F.lit(float("-inf")))
         .otherwise(F.col("l_extendedprice")))
    return li.select("l_orderkey", "l_linenumber", v.alias("v"))


def nan_inf_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.nan_inf_to_null(_spoiled_lines(spark, sf_dir), ["v"])


def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fixture.table(spark, sf_dir, "lineitem")
    text = F.when(F.col("l_linenumber") == 4, F.lit("n/a")).otherwise(F.col("l_quantity").cast("string"))
    df = li.select("l_orderkey", "l_linenumber", text.alias("qty"))
    return C.coerce_numeric(df, {"qty": schemas.dec(10, 2)})


def _orders(spark, sf_dir):
    return _stg(spark, sf_dir)["stg_orders"]


def date_key(spark, sf_dir):
    return _orders(spark, sf_dir).select("order_id", X.date_key("order_purchase_timestamp").alias("date_sk"))


def currency_convert(spark, sf_dir):
    items = _stg(spark, sf_dir)["stg_order_items"]
    return items.select("order_id", "order_item_id",
                        X.currency_convert("price", fixture.FIXTURE_RATE).alias("price_inr"),
                        X.currency_convert("freight_value", fixture.FIXTURE_RATE).alias("freight_inr"))


def null_default(spark, sf_dir):
    stg = _stg(spark, sf_dir)
    pay = S.payments_per_order(stg["stg_payments"])
    return (stg["stg_orders"].select("order_id").join(pay, "order_id", "left")
            .select("order_id",
                    X.null_default("payment_value", Decimal("0.00")).cast("decimal(12,2)").alias("payment_value"),
                    X.null_default("payment_type", "unknown").alias("payment_type")))


def delivery_days(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "order_id", X.delivery_days("order_delivered_customer_date", "order_purchase_timestamp").alias("delivery_days"))


def late_flag(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "order_id", X.late_flag("order_delivered_customer_date", "order_estimated_delivery_date").alias("is_late_delivery"))


def _q11(spark, sf_dir):
    from ..catalog import TEST_SEGMENTS
    return A.q11_customer_segmentation(_star(spark, sf_dir), TEST_SEGMENTS, _dt.date(2001, 12, 31))


def segment_case(spark, sf_dir):
    return _q11(spark, sf_dir).select("customer_unique_id", "state", "order_count", "lifetime_value",
                                      "customer_segment")


def recency_days(spark, sf_dir):
    return _q11(spark, sf_dir).select("customer_unique_id", "state", "last_order_date", "days_since_last_order")


def status_decode(spark, sf_dir):
    runs = fixture.job_tables(spark, sf_dir)["job_runs"]
    return runs.select("instance_id", F.col("run_status").alias("run_status_code"),
                       X.status_decode("run_status").alias("run_status"))


def calendar_fields(spark, sf_dir):
    return _star(spark, sf_dir)["dim_date"]


def safe_ratio(spark, sf_dir):
    """Per customer: delivered spend over shipped spend (NULL when nothing shipped)."""
    star = _star(spark, sf_dir)
    f = star["fact_orders"].select("customer_sk", "order_status", "price_inr")
    per = f.groupBy("customer_sk").agg(
        F.sum(F.when(F.col("order_status") == "delivered", F.col("price_inr"))).alias("d"),
        F.sum(F.when(F.col("order_status") == "shipped", F.col("price_inr"))).alias("s"))
    return per.select("customer_sk", X.ratio_half_up(F.coalesce("d", F.lit(Decimal(0))), F.col("s"), 4,
                                                     num_scale=2, den_scale=2).alias("delivered_to_shipped"))


def _late_per_seller(star):
    f = (A.delivered(star["fact_orders"]).where(F.col("delivery_days").isNotNull())
         .groupBy("seller_sk").agg(F.count(F.lit(1)).alias("lines"),
                                   F.sum("is_late_delivery").cast("long").alias("late")))
    return f


def pct_decimal(spark, sf_dir):
    f = _late_per_seller(_star(spark, sf_dir))
    return f.select("seller_sk", "lines", "late", X.pct_decimal(F.col("late"), F.col("lines")).alias("late_pct"))


def int_pct_truncated(spark, sf_dir):
    f = _late_per_seller(_star(spark, sf_dir))
    return f.select("seller_sk", "lines", "late", X.int_pct_truncated(F.col("late"), F.col("lines")).alias("late_pct"))


def type_casts(spark, sf_dir):
    stg = _stg(spark, sf_dir)
    o = stg["stg_orders"].select("order_id", F.to_date("order_purchase_timestamp").alias("purchase_date"),
                                 F.col("order_purchase_timestamp").cast("string").alias("purchase_text"))
    return o.select("order_id", "purchase_date",
                    X.to_timestamp_any("purchase_text", "string").alias("purchase_ts"))


def year_of_date_key(spark, sf_dir):
    f = _star(spark, sf_dir)["fact_orders"].select("date_sk").distinct()
    return f.select(F.col("date_sk").cast("long").alias("date_sk"), X.year_of_date_key("date_sk").alias("year"))


def format_timestamp(spark, sf_dir):
    return _orders(spark, sf_dir).select("order_id", X.format_timestamp("order_purchase_timestamp").alias("purchased"))


def run_id_label(spark, sf_dir):
    return _orders(spark, sf_dir).select(
        "order_id", X.run_id_of("order_purchase_timestamp").alias("run_id"))


def number_label(spark, sf_dir):
    c = _stg(spark, sf_dir)["stg_customers"].groupBy("customer_state").agg(F.count(F.lit(1)).alias("n"))
    return c.select("customer_state", X.number_label(F.col("n") * 1000, " customers").alias("label"))


def concat_alert_line(spark, sf_dir):
    res = J.rule_table_results(spark, sf_dir)
    rules = RT.rules_frame(spark)
    r = res.join(rules, "rule_id")
    return r.select("rule_id", X.concat_alert_line(F.col("table_name"), F.col("column_name"), F.col("rule_type"),
                                                   F.col("failed_rows"), F.col("failure_pct")).alias("line"))


def text_prefix_upper(spark, sf_dir):
    a = J.suite_on_star(spark, sf_dir)
    return a.select("audit_id", F.upper("severity").alias("severity"), X.text_prefix("details", 80).alias("details"))


def inject_nulls(spark, sf_dir, n: int = 5):
    """Set order_id to NULL on the n smallest ids (a deterministic 'first n rows')."""
    o = _orders(spark, sf_dir).select("order_id", "customer_id", "order_status")
    victims = o.where(F.col("order_id").isNotNull()).select("order_id").orderBy("order_id").limit(n) \
        .withColumn("_hit", F.lit(True))
    return (o.join(victims, "order_id", "left")
            .select(F.when(F.col("_hit"), F.lit(None).cast("long")).otherwise(F.col("order_id")).alias("order_id"),
                    "customer_id", "order_status"))


# Filters ----------------------------------------------------------------------------------------
def filter_status(spark, sf_dir):
    return A.delivered(_star(spark, sf_dir)["fact_orders"]).select("order_sk", "order_id", "price_inr")


def filter_null(spark, sf_dir):
    return _star(spark, sf_dir)["fact_orders"].where(F.col("delivery_days").isNull()).select("order_sk", "order_id")


def filter_not_in_list(spark, sf_dir):
    from ..quality.rules import ORDER_STATUSES
    od = fixture.orders_dirty(spark, sf_dir)
    return od.where(F.col("order_status").isNotNull() & ~F.col("order_status").isin(list(ORDER_STATUSES))) \
        .select("order_id", "order_status")


def filter_out_of_range(spark, sf_dir):
    from ..quality.rules import ValueRange
    od = fixture.orders_dirty(spark, sf_dir)
    return od.where(ValueRange("price", min_val=1000, max_val=400000).failing()).select("order_id", "price")


def filter_optional_param(spark, sf_dir):
    return A.q10_seller_performance(_star(spark, sf_dir), top_n=10, state="NATION_1")


def filter_post_agg(spark, sf_dir):
    d = fixture.orders_dup(spark, sf_dir)
    return d.groupBy("order_id").agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def filter_same_day(spark, sf_dir, day: _dt.date = _dt.date(1998, 6, 1)):
    return _orders(spark, sf_dir).where(F.to_date("order_purchase_timestamp") == F.lit(day)) \
        .select("order_id", "customer_id", "order_status")


def filter_column_compare(spark, sf_dir):
    from ..quality.rules import DateLogic
    lines = fixture.order_lines(spark, sf_dir)
    return lines.where(DateLogic("o_orderdate", column2="l_shipdate", operator=">=").failing()) \
        .select("l_orderkey", "l_linenumber")


# Joins ------------------------------------------------------------------------------------------
def join_star_inner(spark, sf_dir):
    return _star(spark, sf_dir)["fact_orders"].select(*FACT_COLS)


def join_left_preagg(spark, sf_dir):
    stg = _stg(spark, sf_dir)
    pay = S.payments_per_order(stg["stg_payments"])
    rev = S.reviews_per_order(stg["stg_reviews"])
    return (stg["stg_orders"].select("order_id").join(pay, "order_id", "left").join(rev, "order_id", "left")
            .select("order_id", F.col("payment_value").cast("decimal(12,2)").alias("payment_value"),
                    "payment_type", "review_score"))


def join_fact_dim(spark, sf_dir):
    star = _star(spark, sf_dir)
    return star["fact_orders"].select("order_sk", "seller_sk").join(
        star["dim_seller"].select("seller_sk", "seller_id", "state"), "seller_sk").select("order_sk", "seller_id", "state")


def join_anti_orphans(spark, sf_dir):
    od = fixture.orders_dirty(spark, sf_dir).where(F.col("customer_id").isNotNull())
    cust = fixture.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    return od.join(cust, "customer_id", "left_anti").select("order_id", "customer_id")


# Aggregates -------------------------------------------------------------------------------------
def agg_sum_by_keys(spark, sf_dir):
    star = _star(spark, sf_dir)
    f = A.delivered(star["fact_orders"]).select("seller_sk", "date_sk", "price_inr")
    d = A.date_dim(star, ["date_sk", "year"])
    s = star["dim_seller"].select("seller_sk", "state")
    return (f.join(d, "date_sk").join(s, "seller_sk").groupBy("state", "year")
            .agg(A.money(F.sum("price_inr")).alias("revenue"))
            .select("state", F.col("year").cast("long").alias("year"), "revenue"))


def agg_count_distinct(spark, sf_dir):
    f = _star(spark, sf_dir)["fact_orders"]
    return f.groupBy("seller_sk").agg(F.countDistinct("order_id").alias("orders"))


def _by_category(spark, sf_dir):
    star = _star(spark, sf_dir)
    f = A.delivered(star["fact_orders"])
    p = star["dim_product"].select("product_sk", "category_name")
    return f.join(p, "product_sk").groupBy("category_name")


def agg_avg_float(spark, sf_dir):
    return _by_category(spark, sf_dir).agg(X.ratio_half_up(F.sum(F.col("review_score").cast("long")), F.count("review_score"), 2).alias("avg_review"))


def agg_avg_money(spark, sf_dir):
    return _by_category(spark, sf_dir).agg(X.ratio_half_up(F.sum("price_inr"), F.count("price_inr"), 2, num_scale=2).alias("avg_price"))


def agg_avg_int_truncated(spark, sf_dir):
    return S.reviews_per_order(_stg(spark, sf_dir)["stg_reviews"])


def agg_max_date_string(spark, sf_dir):
    star = _star(spark, sf_dir)
    f = star["fact_orders"].select("customer_sk", "date_sk", "payment_type")
    d = A.date_dim(star, ["date_sk", "full_date"])
    return f.join(d, "date_sk").groupBy("customer_sk").agg(F.max("full_date").alias("last_date"),
                                                           F.max("payment_type").alias("max_payment_type"))


def agg_flag_sum(spark, sf_dir):
    star = _star(spark, sf_dir)
    f = star["fact_orders"].select("seller_sk", "is_late_delivery")
    s = star["dim_seller"].select("seller_sk", "state")
    return f.join(s, "seller_sk").groupBy("state").agg(F.sum("is_late_delivery").cast("long").alias("late_lines"))


def agg_global(spark, sf_dir):
    f = A.delivered(_star(spark, sf_dir)["fact_orders"])
    return f.agg(A.money(F.sum("price_inr")).alias("total_revenue"), F.count(F.lit(1)).alias("lines"))


def agg_distinct_rows(spark, sf_dir):
    return _stg(spark, sf_dir)["stg_order_items"].select("product_id").distinct()


def agg_row_count(spark, sf_dir):
    star = _star(spark, sf_dir)
    out = None
    for n in ["dim_date", "dim_customer", "dim_product", "dim_seller", "fact_orders"]:
        c = star[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


# Windows ----------------------------------------------------------------------------------------
def win_ntile(spark, sf_dir, k: int = 4):
    """NTILE(4) per customer over (order count, id), cut into order-preserving buckets."""
    # written once: drawing split points, counting the buckets and numbering each read it
    path = scratch_path(spark, "customer_order_counts")
    A.customer_order_counts(_star(spark, sf_dir)).write.parquet(path)
    counts = spark.read.parquet(path)
    return K.ntile_global(counts, ["total_orders", "customer_unique_id"], k, "order_bucket")


# Star builders ----------------------------------------------------------------------------------
def build_dim_date(spark, sf_dir):
    """Calendar over the whole years of the order dates."""
    lo, hi = S.calendar_range(_orders(spark, sf_dir))
    return S.build_dim_date(spark, lo, hi)


def build_dim_customer(spark, sf_dir):
    return _star(spark, sf_dir)["dim_customer"]


def build_dim_seller(spark, sf_dir):
    return _star(spark, sf_dir)["dim_seller"]


def build_dim_product(spark, sf_dir):
    return _star(spark, sf_dir)["dim_product"]


def translate_category(spark, sf_dir):
    stg = _stg(spark, sf_dir)
    p = stg["stg_products"].select("product_id", "category_name")
    return S.translate_category(p, stg["category_lookup"])


def dense_surrogate_key(spark, sf_dir):
    """Customer keys cut into sampled buckets: must equal row_number() over the key."""
    dim = _stg(spark, sf_dir)["stg_customers"].select("customer_id", "customer_state")
    return K.dense_surrogate_key(dim, ["customer_id"], "customer_sk")


def build_fact_orders(spark, sf_dir):
    return join_star_inner(spark, sf_dir)


def clear_and_rebuild(spark, sf_dir):
    """Whole pipeline (rate from its table, landing, DQ gate, dimensions, fact) into a fresh
    root: the row count of every published table, and the stored result of every rule."""
    stg = _stg(spark, sf_dir)
    rates = spark.createDataFrame([("BRL", "INR", fixture.FIXTURE_RATE)], schemas.RATES)
    built = run_pipeline(spark, stg, rates=rates, check_time=J.TEST_CHECK_TIME)
    star = read_star(spark, built.path)
    out = None
    for n in STAR_TABLES:
        c = star[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("name"), "row_count", F.lit("BUILT").alias("status"))
        out = c if out is None else out.unionByName(c)
    results = RT.results_with_rules(spark.read.schema(schemas.DQ_RESULTS).parquet(f"{built.path}/{RESULTS}"),
                                    RT.rules_frame(spark), J.TEST_CHECK_TIME.date())
    name = F.concat_ws(".", "table_name", "column_name", "rule_type")
    jobs = spark.read.schema(schemas.ETL_JOB_LOG).parquet(f"{built.path}/{JOB_LOG}")
    return (out.unionByName(results.select(name.alias("name"), F.col("total_rows").alias("row_count"), "status"))
            .unionByName(jobs.select(F.col("job_name").alias("name"), F.lit(None).cast("long").alias("row_count"), "status")))
