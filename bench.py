"""Benchmark: warehouse build and headline queries at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT (3).
Protocol: the fixture staging tables are landed as Parquet first (untimed, it stands for
the CSV landing); ``build_fact_orders`` times the whole star build + write from staging;
every query then runs against the written star: one warm-up, median of BENCH_REPEAT runs,
each run fully executed into the no-op sink.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from retailmart.catalog import TEST_SEGMENTS  # noqa: E402
from retailmart.plans import analytics as A  # noqa: E402
from retailmart.plans.warehouse import run_pipeline  # noqa: E402
from retailmart.quality import jobs as J  # noqa: E402
from retailmart.quality.rules import default_suite  # noqa: E402
from retailmart.quality.runner import run_checks  # noqa: E402
from retailmart.session import get_session, scratch_path  # noqa: E402
from retailmart.sources import fixture  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _time(fn, repeat: int) -> list[float]:
    _run(fn())  # warm-up
    times = []
    for _ in range(repeat):
        t = time.perf_counter()
        _run(fn())
        times.append(time.perf_counter() - t)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(master=f"local[{cpus}]", app="retailmart-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))

    # landing (untimed): fixture staging -> Parquet, as the CSV scan would produce it
    root = scratch_path(spark, "bench-staging")
    for name, df in fixture.staging(spark, sf_dir).items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    stg = {name: spark.read.parquet(f"{root}/{name}") for name in fixture.staging(spark, sf_dir)}

    def build():
        # landed above; the gate is left out, so that the figure stays that of dimensions and fact
        return run_pipeline(spark, stg, rate=fixture.FIXTURE_RATE, gate=False, land=False)

    build()  # warm-up
    builds = []
    for _ in range(max(1, repeat)):
        t = time.perf_counter()
        star = build()
        builds.append(time.perf_counter() - t)
    times = {"build_fact_orders": builds}

    import datetime as _dt
    headline = {
        "q01_ytd_revenue": lambda: A.q01_ytd_revenue(star),
        "q02_seller_rank_in_state": lambda: A.q02_seller_rank_in_state(star),
        "q03_mom_growth": lambda: A.q03_mom_growth(star),
        "q03b_mom_growth_spine": lambda: A.q03b_mom_growth_spine(star, 1995, 2001, "NATION_12"),
        "q04_top3_products_per_category": lambda: A.q04_top3_products_per_category(star),
        "q05_order_frequency_buckets": lambda: A.q05_order_frequency_buckets(star),
        "q06_late_rate_by_state": lambda: A.q06_late_rate_by_state(star, 300),
        "q07_above_average_customers": lambda: A.q07_above_average_customers(star),
        "q08_category_contribution": lambda: A.q08_category_contribution(star),
        "q09_monthly_revenue_report": lambda: A.q09_monthly_revenue_report(star, 1998),
        "q10_seller_performance": lambda: A.q10_seller_performance(star),
        "q11_customer_segmentation": lambda: A.q11_customer_segmentation(star, TEST_SEGMENTS,
                                                                         _dt.date(2001, 12, 31)),
        "q12_daily_revenue_range": lambda: A.q12_daily_revenue_range(star, 1998),
        "q12a_year_scan": lambda: A.q12a_year_scan(star, 1998),
        "v_daily_sales": lambda: A.v_daily_sales(star),
        "dq_suite": lambda: run_checks(star.tables, default_suite(), J.TEST_RUN_ID, J.TEST_RUN_DATE),
    }
    for name, fn in headline.items():
        times[name] = _time(fn, repeat)

    results = {k: statistics.median(v) for k, v in times.items()}
    total = sum(results.values())
    print(json.dumps({
        "metric": "total_median_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in results.items()},
        "min_max": {k: [round(min(v), 3), round(max(v), 3)] for k, v in times.items()},
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
