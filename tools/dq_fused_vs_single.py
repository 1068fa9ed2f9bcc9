"""Data-quality suite: fused (one plan per table) vs one job per rule, on the star.

usage: python tools/dq_fused_vs_single.py [sf_dir] [repeat]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retailmart.plans.warehouse import star_from_testdata  # noqa: E402
from retailmart.quality import jobs as J  # noqa: E402
from retailmart.quality.rules import TableChecks, default_suite  # noqa: E402
from retailmart.quality.runner import run_checks  # noqa: E402
from retailmart.session import get_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeat = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    spark = get_session(shuffle_partitions=16)
    star = star_from_testdata(spark, sf_dir)
    suite = default_suite()

    def fused():
        run_checks(star.tables, suite, J.TEST_RUN_ID, J.TEST_RUN_DATE).collect()

    def single():
        for tc in suite:
            for r in tc.rules:
                run_checks(star.tables, [TableChecks(tc.table, (r,))], J.TEST_RUN_ID, J.TEST_RUN_DATE).collect()

    out = {}
    for name, fn in (("fused", fused), ("one_job_per_rule", single)):
        fn()
        ts = []
        for _ in range(repeat):
            t = time.perf_counter()
            fn()
            ts.append(time.perf_counter() - t)
        out[name] = round(statistics.median(ts), 3)
    print(json.dumps({"sf": sf_dir, "dq_suite_sec": out}))


if __name__ == "__main__":
    main()
