"""Scaling run: the sf fixture's order-side staging replicated k times (new order ids per
copy, same customers/products/sellers), then the pipeline and a few queries.

usage: python tools/scale_run.py [sf_dir] [k]
Prints one JSON line with the build time, per-query times and fact rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from retailmart.plans import analytics as A  # noqa: E402
from retailmart.plans.warehouse import run_pipeline  # noqa: E402
from retailmart.quality import jobs as J  # noqa: E402
from retailmart.quality.rules import default_suite  # noqa: E402
from retailmart.quality.runner import run_checks  # noqa: E402
from retailmart.session import get_session, scratch_path  # noqa: E402
from retailmart.sources import fixture  # noqa: E402

OFFSET = 1_000_000_000


def replicate(df, k: int):
    copy = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_copy")
    out = df.select("*", copy)
    return out.withColumn("order_id", F.col("order_id") + F.col("_copy").cast("long") * OFFSET).drop("_copy")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    k = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    spark = get_session(shuffle_partitions=64)
    root = scratch_path(spark, f"scale-x{k}")
    stg = fixture.staging(spark, sf_dir)
    for name, df in stg.items():
        if name in ("stg_orders", "stg_order_items", "stg_payments", "stg_reviews"):
            df = replicate(df, k)
        df.write.parquet(f"{root}/{name}")
    stg = {name: spark.read.parquet(f"{root}/{name}") for name in stg}
    builds = []
    for _ in range(2):  # cold (fresh JVM) and warm
        t = time.perf_counter()
        star = run_pipeline(spark, stg, rate=fixture.FIXTURE_RATE)
        builds.append(round(time.perf_counter() - t, 3))
    res = {}
    for name, fn in {
        "q01_ytd_revenue": lambda: A.q01_ytd_revenue(star),
        "q05_order_frequency_buckets": lambda: A.q05_order_frequency_buckets(star),
        "q09_monthly_revenue_report": lambda: A.q09_monthly_revenue_report(star, 1998),
        "q11_customer_segmentation": lambda: A.q11_customer_segmentation(star),
        "v_daily_sales": lambda: A.v_daily_sales(star),
        "dq_suite": lambda: run_checks(star.tables, default_suite(), J.TEST_RUN_ID, J.TEST_RUN_DATE),
    }.items():
        fn().write.format("noop").mode("overwrite").save()  # warm-up
        t = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        res[name] = round(time.perf_counter() - t, 3)
    rows = star["fact_orders"].count()
    print(json.dumps({"k": k, "fact_rows": rows, "build_fact_orders_cold_warm": builds, "queries": res}))


if __name__ == "__main__":
    main()
