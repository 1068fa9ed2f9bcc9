"""Scalar helpers: exact rounding, growth, calendar, status names."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from retailmart.functions import scalar as X
from retailmart.operators.star import build_dim_date


def one(spark, col):
    return spark.range(1).select(col.alias("x")).collect()[0]["x"]


def test_growth_recorded_example(spark):
    # base 2,496 -> 746,014: (746014 - 2496) / 2496 * 100 = 29788.38 (formula, not the log's rounded figure)
    assert one(spark, X.growth_pct(F.lit(Decimal("746014.00")), F.lit(Decimal("2496.00")))) == 29788.38


def test_growth_zero_base_is_null(spark):
    assert one(spark, X.growth_pct(F.lit(Decimal("10.00")), F.lit(Decimal("0.00")))) is None


def test_ratio_half_up_is_exact(spark):
    assert one(spark, X.ratio_half_up(F.lit(667), F.lit(200), 2)) == 3.34      # 3.335 -> 3.34
    assert one(spark, X.ratio_half_up(F.lit(-667), F.lit(200), 2)) == -3.34
    assert one(spark, X.ratio_half_up(F.lit(Decimal("0.05")), F.lit(2), 2, num_scale=2)) == 0.03
    assert one(spark, X.ratio_half_up(F.lit(1), F.lit(0), 2)) is None


def test_integer_semantics(spark):
    assert one(spark, X.avg_int_truncated(F.lit(7), F.lit(2))) == 3
    assert one(spark, X.int_pct_truncated(F.lit(1), F.lit(3))) == 33
    assert one(spark, X.int_div(F.lit(5), F.lit(0))) is None


def test_status_decode(spark):
    got = [one(spark, X.status_decode(F.lit(c))) for c in (0, 1, 2, 3, 4, 9)]
    assert got == ["Failed", "Succeeded", "Retry", "Cancelled", "In Progress", None]


def test_date_key_and_year(spark):
    assert one(spark, X.date_key(F.lit(dt.datetime(2018, 3, 7, 23, 59)))) == 20180307
    assert one(spark, X.year_of_date_key(F.lit(20180307))) == 2018


def test_reference_calendar_has_1461_days(spark):
    d = build_dim_date(spark)
    assert d.count() == 1461
    r = d.where(F.col("date_sk") == 20180106).collect()[0]
    assert (r["month_name"], r["day_of_week"], r["is_weekend"], r["quarter"]) == ("January", "Saturday", 1, 1)


def test_segments(spark):
    rows = [(5, Decimal("50000")), (5, Decimal("49999.99")), (3, Decimal("20000")), (2, Decimal("1")), (1, Decimal("9e9"))]
    df = spark.createDataFrame(rows, "n int, v decimal(12,2)")
    got = [r["s"] for r in df.select(X.segment_case("n", "v").alias("s")).collect()]
    assert got == ["VIP", "Loyal", "Loyal", "Returning", "One-Time"]


def test_alert_line_treats_null_as_empty(spark):
    line = one(spark, X.concat_alert_line(F.lit("t"), F.lit(None).cast("string"), F.lit("NULL_CHECK"),
                                           F.lit(5), F.lit(Decimal("1.25"))))
    assert line == "Table: t | Column:  | Rule: NULL_CHECK | Failed Rows: 5 | Failure %: 1.25"


def test_calendar_range_from_orders(spark):
    from retailmart.operators.star import DEFAULT_DATE_END, DEFAULT_DATE_START, calendar_range
    o = spark.createDataFrame([("2017-03-04 10:00:00",), ("2018-12-31 23:59:59",), ("bad",)],
                              "order_purchase_timestamp string")
    assert calendar_range(o) == (dt.date(2017, 1, 1), dt.date(2018, 12, 31))
    assert calendar_range(o.where(F.lit(False))) == (DEFAULT_DATE_START, DEFAULT_DATE_END)


def test_broadcast_only_below_the_bound(spark):
    from retailmart.sources.lookup import broadcast_if_small
    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    small = spark.range(0, 10).withColumnRenamed("id", "k")

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    assert hinted(broadcast_if_small(small, 100))
    assert not hinted(broadcast_if_small(big, 100))
