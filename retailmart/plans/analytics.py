"""Named analytic queries over the star schema (functions with parameters -> DataFrame).

Conventions (decided once, SURVEY §1.4): money is summed as decimal and rounded as
decimal, then returned as double; counts and ranks are bigint; averages that the
reference takes over int columns truncate; float averages are rounded exactly (HALF_UP).
Ties under TOP/ranking get a business-key tie-break.

Lines are summed by surrogate key (and order, where orders are counted) before they meet a
dimension: map-side combining shrinks a hot key to one row a task, and the join moves one
row a key instead of every line.  Sums, counts and maxima combine; order counts are taken
distinct again after the join, since several surrogate keys may share a business key.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as X
from ..operators.keys import ntile_histogram

DELIVERED = "delivered"


def money(c: Column) -> Column:
    """round(decimal, 2) -> double (exact decimal rounding first)."""
    return F.round(c, 2).cast("double")


def delivered(fact: DataFrame, status: str | None = DELIVERED) -> DataFrame:
    return fact if status is None else fact.where(F.col("order_status") == status)


def _sums(*cols: str) -> list[Column]:
    """Partial sum and count of each column, as ``<col>_sum`` and ``<col>_n``."""
    return [x for c in cols for x in (F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))]


def _mean_of(col: str, scale: int, num_scale: int = 0) -> Column:
    """round(avg(col), scale) from partial sums and counts, exact HALF_UP."""
    return X.ratio_half_up(F.sum(f"{col}_sum"), F.sum(f"{col}_n"), scale, num_scale=num_scale)


# A calendar of up to this many days (about 270 years) is broadcast: a few MB at most.
CALENDAR_BROADCAST_MAX_DAYS = 100_000


def date_dim(star, cols: list[str]) -> DataFrame:
    """The calendar columns, broadcast when the star knows the calendar is small.

    The calendar has one row per day of its range, whatever the fact size; the warehouse
    records that row count when it builds or opens the star.  Without it the join is left
    to AQE, which broadcasts from the runtime size.
    """
    d = star["dim_date"].select(*cols)
    days = getattr(star, "calendar_days", None)
    return F.broadcast(d) if days is not None and days <= CALENDAR_BROADCAST_MAX_DAYS else d


# Q1 --------------------------------------------------------------------------------
def q01_ytd_revenue(star) -> DataFrame:
    """Monthly revenue and its running year-to-date total."""
    f = delivered(star["fact_orders"]).select("date_sk", "price_inr")
    d = date_dim(star, ["date_sk", "year", "month", "month_name"])
    monthly = (f.join(d, "date_sk").groupBy("year", "month", "month_name")
               .agg(F.sum("price_inr").alias("_rev")))
    w = Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return (monthly.select(
        F.col("year").cast("long").alias("year"), "month_name",
        money(F.col("_rev")).alias("monthly_revenue"),
        money(F.sum("_rev").over(w)).alias("ytd_revenue"),
        F.col("month").cast("long").alias("_month"))
        .orderBy("year", "_month").drop("_month"))


def _fact_year(star, year: int) -> DataFrame:
    """Fact rows of one year via the sargable key range; when the stored fact is
    partitioned by ``order_year`` the same bound also prunes partitions."""
    f = star["fact_orders"]
    cond = X.date_key_range("date_sk", year)
    if "order_year" in f.columns:
        cond = cond & (F.col("order_year") == year)
    return f.where(cond)


def _revenue_by(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.groupBy(*keys).agg(F.sum("price_inr").alias("_rev"))


# Q2 --------------------------------------------------------------------------------
def q02_seller_rank_in_state(star) -> DataFrame:
    """Seller revenue ranked within the seller's state (RANK, gaps on ties)."""
    f = delivered(star["fact_orders"]).select("seller_sk", "price_inr")
    s = star["dim_seller"].select("seller_sk", "state", "seller_id")
    agg = (_revenue_by(f, "seller_sk").join(s, "seller_sk")
           .groupBy("state", "seller_id").agg(F.sum("_rev").alias("_rev")))
    # one row per seller: a state's window holds its sellers, not their lines
    w = Window.partitionBy("state").orderBy(F.col("_rev").desc())
    return (agg.select("state", "seller_id", money(F.col("_rev")).alias("total_revenue"),
                       F.rank().over(w).cast("long").alias("state_rank"))
            .orderBy("state", "state_rank", "seller_id"))


# Q3 --------------------------------------------------------------------------------
def _monthly_revenue(star, seller_state: str | None = None) -> DataFrame:
    f = delivered(star["fact_orders"]).select("date_sk", "seller_sk", "price_inr")
    if seller_state is not None:
        sellers = star["dim_seller"].where(F.col("state") == seller_state).select("seller_sk")
        f = f.join(sellers, "seller_sk", "left_semi")
    d = date_dim(star, ["date_sk", "year", "month"])
    return f.join(d, "date_sk").groupBy("year", "month").agg(F.sum("price_inr").alias("revenue"))


def _growth_columns(monthly: DataFrame, min_base: Decimal | None = None) -> DataFrame:
    # One row per month: the ordered window runs over a calendar-bounded input.
    w = Window.orderBy("year", "month")
    prev = F.lag("revenue").over(w)
    g = X.growth_pct(F.col("revenue"), F.col("_prev"))
    if min_base is not None:
        g = F.when(F.col("_prev") >= F.lit(Decimal(min_base)), g)
    return (monthly.withColumn("_prev", prev)
            .select(F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"),
                    money(F.col("revenue")).alias("revenue"),
                    money(F.col("_prev")).alias("previous_month"),
                    g.alias("growth_pct"))
            .orderBy("year", "month"))


def q03_mom_growth(star) -> DataFrame:
    """Month-over-month growth over the months that have delivered revenue (sparse)."""
    return _growth_columns(_monthly_revenue(star))


def q03b_mom_growth_spine(star, start_year: int, end_year: int, seller_state: str | None = None,
                          min_base: Decimal | None = None) -> DataFrame:
    """Growth over every month of the range (zero-filled), NULL growth on a zero base.

    The fact is filtered and aggregated to months first, then the month spine (from the
    date dimension) is left-joined to it: same result as joining the spine to raw fact
    rows with the status predicate in ON, with one small join instead of a large one.
    """
    spine = (star["dim_date"].where(F.col("year").between(start_year, end_year))
             .select("year", "month").distinct())
    monthly = _monthly_revenue(star, seller_state)
    filled = (spine.join(monthly, ["year", "month"], "left")
              .select("year", "month", F.coalesce(F.col("revenue"), F.lit(Decimal("0.00"))).alias("revenue")))
    return _growth_columns(filled, min_base)


# Q4 --------------------------------------------------------------------------------
def q04_top3_products_per_category(star, k: int = 3) -> DataFrame:
    """Top products per category by revenue (DENSE_RANK <= k, ties kept)."""
    f = delivered(star["fact_orders"]).select("product_sk", "price_inr")
    p = star["dim_product"].select("product_sk", "category_name", "product_id")
    agg = (_revenue_by(f, "product_sk").join(p, "product_sk")
           .groupBy("category_name", "product_id").agg(F.sum("_rev").alias("_rev")))
    w = Window.partitionBy("category_name").orderBy(F.col("_rev").desc())
    return (agg.withColumn("rnk", F.dense_rank().over(w)).where(F.col("rnk") <= k)
            .select("category_name", "product_id", money(F.col("_rev")).alias("revenue"),
                    F.col("rnk").cast("long").alias("rnk"))
            .orderBy("category_name", "rnk", "product_id"))


# Q5 --------------------------------------------------------------------------------
def customer_order_counts(star) -> DataFrame:
    """Distinct orders per customer_unique_id (all statuses)."""
    f = star["fact_orders"].select("customer_sk", "order_id")
    c = star["dim_customer"].select("customer_sk", "customer_unique_id")
    return (f.distinct().join(c, "customer_sk").groupBy("customer_unique_id")
            .agg(F.countDistinct("order_id").alias("total_orders")))


def q05_order_frequency_buckets(star, k: int = 4) -> DataFrame:
    """NTILE(k) of customers by order count; customers and (int) average orders per tile.

    Only the histogram (order count -> customers) reaches the ordered step, so no
    global single-partition window runs over the customers.
    """
    hist = customer_order_counts(star).groupBy("total_orders").agg(F.count("*").alias("n"))
    tiles = ntile_histogram(hist, "total_orders", "n", k)
    return (tiles.select(F.col("bucket").cast("long").alias("order_bucket"),
                         F.col("rows").alias("customer_count"),
                         X.int_div(F.col("value_sum"), F.col("rows")).cast("long").alias("avg_orders"))
            .orderBy("order_bucket"))


# Q6 --------------------------------------------------------------------------------
def q06_late_rate_by_state(star, min_lines: int = 50) -> DataFrame:
    """Late-delivery rate per seller state over delivered lines with a delivery time."""
    f = (delivered(star["fact_orders"]).where(F.col("delivery_days").isNotNull())
         .select("seller_sk", "is_late_delivery"))
    s = star["dim_seller"].select("seller_sk", "state")
    by_seller = f.groupBy("seller_sk").agg(F.count("*").alias("_n"), F.sum("is_late_delivery").alias("_late"))
    agg = (by_seller.join(s, "seller_sk").groupBy("state")
           .agg(F.sum("_n").alias("total_orders"), F.sum("_late").cast("long").alias("late_orders")))
    return (agg.where(F.col("total_orders") >= min_lines)
            .select("state", "total_orders", "late_orders",
                    X.pct_decimal(F.col("late_orders"), F.col("total_orders")).alias("late_rate_pct"))
            .orderBy(F.col("late_rate_pct").desc(), "state"))


# Q7 --------------------------------------------------------------------------------
def q07_above_average_customers(star) -> DataFrame:
    """Customers whose (rounded) spend beats the platform average of rounded spends."""
    f = delivered(star["fact_orders"]).select("customer_sk", "price_inr")
    c = star["dim_customer"].select("customer_sk", "customer_unique_id", "state")
    spend = (_revenue_by(f, "customer_sk").join(c, "customer_sk").groupBy("customer_unique_id", "state")
             .agg(F.round(F.sum("_rev"), 2).alias("total_spend")))
    avg = spend.agg(X.ratio_half_up_decimal(F.sum("total_spend"), F.count("total_spend"), 3,
                                            num_scale=2).alias("platform_avg"))
    # one-row side: the broadcast nested-loop join carries a scalar, nothing grows
    return (spend.crossJoin(F.broadcast(avg)).where(F.col("total_spend") > F.col("platform_avg"))
            .select("customer_unique_id", "state",
                    F.col("total_spend").cast("double").alias("total_spend"),
                    F.col("platform_avg").cast("double").alias("platform_avg"),
                    money(F.col("total_spend") - F.col("platform_avg")).alias("above_avg_by"))
            .orderBy(F.col("total_spend").desc(), "customer_unique_id", "state"))


# Q8 --------------------------------------------------------------------------------
def q08_category_contribution(star, top: int = 15) -> DataFrame:
    """Category share of revenue, with the running sum of the rounded shares, top n."""
    f = delivered(star["fact_orders"]).select("product_sk", "price_inr")
    p = star["dim_product"].select("product_sk", "category_name")
    cat = (_revenue_by(f, "product_sk").join(p, "product_sk")
           .groupBy("category_name").agg(F.sum("_rev").alias("_rev")))
    total = cat.agg(F.sum("_rev").alias("_total"))
    pct = X.ratio_half_up_decimal(F.col("_rev") * 100, F.col("_total"), 2, num_scale=2, den_scale=2)
    # one row per category: the ordered window covers a domain-bounded input
    w = (Window.orderBy(F.col("_rev").desc(), F.col("category_name").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, 0))
    return (cat.crossJoin(F.broadcast(total)).withColumn("_pct", pct)
            .select("category_name", money(F.col("_rev")).alias("revenue"),
                    F.col("_pct").cast("double").alias("revenue_pct"),
                    F.sum("_pct").over(w).cast("double").alias("cumulative_pct"), "_rev")
            .orderBy(F.col("_rev").desc(), F.col("category_name").asc_nulls_first())
            .limit(top).drop("_rev"))


# Q9 --------------------------------------------------------------------------------
def q09_monthly_revenue_report(star, year: int = 2018) -> DataFrame:
    """Nine metrics per month of one year (delivered orders)."""
    f = delivered(_fact_year(star, year))
    d = date_dim(star, ["date_sk", "year", "month", "month_name"]).where(F.col("year") == year)
    orders = f.groupBy("date_sk", "order_id", "customer_sk").agg(
        *_sums("price_inr", "review_score"), F.sum("freight_inr").alias("_freight"),
        F.sum("is_late_delivery").alias("_late"))
    return (orders.join(d, "date_sk").groupBy("month", "month_name").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.countDistinct("customer_sk").alias("unique_customers"),
        money(F.sum("price_inr_sum")).alias("gross_revenue_inr"),
        money(F.sum("_freight")).alias("total_freight_inr"),
        _mean_of("price_inr", 2, num_scale=2).alias("avg_order_value"),
        _mean_of("review_score", 2).alias("avg_review_score"),
        F.sum("_late").cast("long").alias("late_deliveries"))
        .select(F.col("month").cast("long").alias("month"), "month_name", "total_orders", "unique_customers",
                "gross_revenue_inr", "total_freight_inr", "avg_order_value", "avg_review_score",
                "late_deliveries")
        .orderBy("month"))


# Q10 -------------------------------------------------------------------------------
def q10_seller_performance(star, top_n: int = 10, state: str | None = None) -> DataFrame:
    """Top n sellers by revenue with delivery and review metrics; optional state filter."""
    f = delivered(star["fact_orders"])
    s = star["dim_seller"].select("seller_sk", "seller_id", "city", "state")
    if state is not None:
        s = s.where(F.col("state") == state)
    orders = f.groupBy("seller_sk", "order_id").agg(
        *_sums("price_inr", "delivery_days", "review_score"),
        F.sum("is_late_delivery").alias("_late"), F.count("*").alias("_lines"))
    agg = orders.join(s, "seller_sk").groupBy("seller_id", "city", "state").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("price_inr_sum").alias("_rev"),
        _mean_of("price_inr", 2, num_scale=2).alias("avg_order_value"),
        _mean_of("delivery_days", 1).alias("avg_delivery_days"),
        _mean_of("review_score", 2).alias("avg_review"),
        F.sum("_late").cast("long").alias("late_deliveries"),
        X.int_pct_truncated(F.sum("_late"), F.sum("_lines")).alias("late_rate_pct"))
    return (agg.orderBy(F.col("_rev").desc(), "seller_id", "city", "state").limit(top_n)
            .select("seller_id", "city", "state", "total_orders", money(F.col("_rev")).alias("total_revenue"),
                    "avg_order_value", "avg_delivery_days", "avg_review", "late_deliveries", "late_rate_pct"))


# Q11 -------------------------------------------------------------------------------
def q11_customer_segmentation(star, segments=X.DEFAULT_SEGMENTS, as_of: _dt.date = X.DEFAULT_AS_OF) -> DataFrame:
    """Customer metrics, segment and recency (as-of date is a parameter)."""
    f = delivered(star["fact_orders"]).select("customer_sk", "date_sk", "order_id", "price_inr")
    c = star["dim_customer"].select("customer_sk", "customer_unique_id", "state")
    d = date_dim(star, ["date_sk", "full_date"])
    orders = f.groupBy("customer_sk", "date_sk", "order_id").agg(*_sums("price_inr"))
    m = (orders.join(d, "date_sk").join(c, "customer_sk").groupBy("customer_unique_id", "state").agg(
        F.countDistinct("order_id").alias("order_count"),
        F.round(F.sum("price_inr_sum"), 2).alias("_ltv"),
        _mean_of("price_inr", 2, num_scale=2).alias("avg_order_value"),
        F.max("full_date").alias("last_order_date")))
    return (m.select("customer_unique_id", "state", "order_count",
                     F.col("_ltv").cast("double").alias("lifetime_value"), "avg_order_value", "last_order_date",
                     X.segment_case("order_count", "_ltv", segments).alias("customer_segment"),
                     X.recency_days("last_order_date", as_of).cast("long").alias("days_since_last_order"),
                     "_ltv")
            .orderBy(F.col("_ltv").desc(), "customer_unique_id", "state").drop("_ltv"))


# Q12 -------------------------------------------------------------------------------
def q12_daily_revenue_range(star, year: int = 2018) -> DataFrame:
    """Daily delivered revenue of one year, sargable key range (the optimised query)."""
    f = delivered(_fact_year(star, year))
    return (f.groupBy("date_sk").agg(F.sum("price_inr").cast("double").alias("revenue"))
            .select(F.col("date_sk").cast("long").alias("date_sk"), "revenue").orderBy("date_sk"))


FACT_COLS = ["order_sk", "order_id", "customer_sk", "product_sk", "seller_sk", "date_sk", "order_item_id",
             "order_status", "price_brl", "freight_brl", "price_inr", "freight_inr", "payment_value",
             "payment_type", "review_score", "delivery_days", "is_late_delivery"]


def q12a_year_scan(star, year: int = 2018) -> DataFrame:
    """All fact rows of one year (the 'before' query), answered with the range predicate."""
    return _fact_year(star, year).select(*FACT_COLS)


def fact_key_range(star, year: int = 2018) -> DataFrame:
    """Every fact row whose date key lies in one year: BETWEEN on the key, and the year's partition only."""
    return _fact_year(star, year).select(*FACT_COLS)


def q12a_year_function(star, year: int = 2018) -> DataFrame:
    """The literal 'before' form: a function of the key (no pushdown, full scan)."""
    f = star["fact_orders"]
    return f.where(F.year(F.to_date(F.col("date_sk").cast("string"), "yyyyMMdd")) == year).select(*FACT_COLS)


# View ------------------------------------------------------------------------------
def v_daily_sales(star) -> DataFrame:
    """Daily sales view: orders, customers, revenue, averages per calendar day."""
    f = delivered(star["fact_orders"])
    d = date_dim(star, ["date_sk", "full_date", "year", "month_name", "day_of_week", "is_weekend"])
    orders = f.groupBy("date_sk", "order_id", "customer_sk").agg(*_sums("price_inr", "review_score"))
    days = orders.groupBy("date_sk").agg(
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct("customer_sk").alias("customers"),
        money(F.sum("price_inr_sum")).alias("revenue_inr"),
        _mean_of("price_inr", 2, num_scale=2).alias("avg_order_value"),
        _mean_of("review_score", 2).alias("avg_review"))
    # the calendar has one row a key, so it meets one row a day
    return (days.join(d, "date_sk")
        .select("full_date", F.col("year").cast("long").alias("year"), "month_name", "day_of_week",
                F.col("is_weekend").cast("long").alias("is_weekend"),
                "orders", "customers", "revenue_inr", "avg_order_value", "avg_review"))


def register_daily_sales_view(star, name: str = "vw_daily_sales") -> DataFrame:
    """Register the view as a temp view (and return it)."""
    df = v_daily_sales(star)
    df.createOrReplaceTempView(name)
    return df


def materialize_daily_sales(star, path: str) -> None:
    """The view as a table, partitioned by year (optional materialisation)."""
    v_daily_sales(star).write.mode("overwrite").partitionBy("year").parquet(path)
