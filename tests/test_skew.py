"""Hot keys: a third of the orders on one customer and a third of the lines on one product.

Results are checked against brute-force formulations (global windows, plain counts) that
are fine on a small fixture but would not scale.
"""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from retailmart.operators.star import ORDER_SK_KEY
from retailmart.plans import analytics as A
from retailmart.plans.warehouse import run_pipeline
from retailmart.quality.rules import NoDuplicates, ReferentialIntegrity, TableChecks
from retailmart.quality.runner import run_checks
from retailmart.sources import fixture


@pytest.fixture(scope="module")
def skewed(spark):
    stg = fixture.staging(spark, SF_SMALL)
    hot_customer = stg["stg_customers"].agg(F.min("customer_id")).collect()[0][0]
    hot_product = stg["stg_products"].agg(F.min("product_id")).collect()[0][0]
    stg["stg_orders"] = stg["stg_orders"].withColumn(
        "customer_id", F.when(F.col("order_id") % 3 == 0, F.lit(hot_customer)).otherwise(F.col("customer_id")))
    stg["stg_order_items"] = stg["stg_order_items"].withColumn(
        "product_id", F.when(F.col("order_item_id") % 3 == 0, F.lit(hot_product)).otherwise(F.col("product_id")))
    star = run_pipeline(spark, stg, rate=fixture.FIXTURE_RATE)
    return star, hot_customer


def test_hot_customer_really_is_hot(skewed):
    star, hot = skewed
    f = star["fact_orders"].join(star["dim_customer"].where(F.col("customer_id") == hot), "customer_sk")
    assert f.select("order_id").distinct().count() * 3 >= star["fact_orders"].select("order_id").distinct().count() - 3


def test_order_keys_under_skew(skewed):
    star, _ = skewed
    f = star["fact_orders"]
    ref = f.withColumn("rn", F.row_number().over(Window.orderBy(*ORDER_SK_KEY)))
    per_key = {}
    for r in ref.collect():
        k = tuple(r[c] for c in ORDER_SK_KEY)
        per_key.setdefault(k, [[], []])
        per_key[k][0].append(r["order_sk"])
        per_key[k][1].append(r["rn"])
    assert all(sorted(a) == sorted(b) for a, b in per_key.values())


def test_ntile_histogram_under_skew(skewed):
    star, _ = skewed
    ours = {r["order_bucket"]: (r["customer_count"], r["avg_orders"]) for r in A.q05_order_frequency_buckets(star).collect()}
    per = A.customer_order_counts(star)
    tiles = per.withColumn("b", F.ntile(4).over(Window.orderBy("total_orders", "customer_unique_id")))
    ref = {r["b"]: (r["n"], r["s"] // r["n"]) for r in
           tiles.groupBy("b").agg(F.count("*").alias("n"), F.sum("total_orders").alias("s")).collect()}
    assert ours == ref


def test_dq_counts_under_skew(skewed):
    star, _ = skewed
    f = star["fact_orders"]
    suite = [TableChecks("fact_orders", (NoDuplicates("customer_sk"), NoDuplicates("product_sk"),
                                         ReferentialIntegrity("customer_sk", ref_table="dim_customer",
                                                              ref_col="customer_sk")))]
    audit = run_checks(star.tables, suite, "R", dt.datetime(2026, 1, 1))
    rows = {r["audit_id"] % 1_000_000: r["failed_records"] for r in audit.collect()}
    n = f.count()
    assert rows[1] == n - f.select("customer_sk").distinct().count()
    assert rows[2] == n - f.select("product_sk").distinct().count()
    assert rows[3] == 0
