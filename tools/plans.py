"""Write PLANS.md: the final (post-AQE) physical plan of each headline query at one scale.

usage: python tools/plans.py [sf_dir]
Paths and expression ids are shortened; the text is what `explain()` prints after the run.
"""

from __future__ import annotations

import datetime as _dt
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from retailmart.catalog import TEST_SEGMENTS  # noqa: E402
from retailmart.plans import analytics as A  # noqa: E402
from retailmart.plans.warehouse import star_from_testdata  # noqa: E402
from retailmart.quality import jobs as J  # noqa: E402
from retailmart.quality.rules import default_suite  # noqa: E402
from retailmart.quality.runner import run_checks  # noqa: E402
from retailmart.session import get_session  # noqa: E402


def clean(plan: str) -> str:
    plan = re.sub(r"#\d+L?", "", plan)
    plan = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: <star>", plan)
    plan = re.sub(r"\[plan_id=\d+\]", "", plan)
    if "== Initial Plan ==" in plan:  # keep the final (adaptive) plan only
        plan = plan[:plan.index("== Initial Plan ==")].rstrip().rstrip("+-").rstrip()
    lines = []
    for line in plan.splitlines():
        if "FileScan" in line:
            indent = " " * (len(line) - len(line.lstrip()) + 6)
            head, _, rest = line.partition(" Batched:")
            lines.append(head)
            for key in ("PartitionFilters", "PushedFilters", "ReadSchema"):
                m = re.search(key + r": (.*?)(, [A-Z][A-Za-z]+: |$)", rest)
                if m:
                    lines.append(f"{indent}{key}: {m.group(1)}")
            continue
        lines.append(line if len(line) <= 220 else line[:217] + "...")
    return "\n".join(lines)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session(shuffle_partitions=8, extra={"spark.sql.maxMetadataStringLength": "2000"})
    star = star_from_testdata(spark, sf_dir)
    queries = {
        "q01_ytd_revenue": A.q01_ytd_revenue(star),
        "q05_order_frequency_buckets": A.q05_order_frequency_buckets(star),
        "q07_above_average_customers": A.q07_above_average_customers(star),
        "q09_monthly_revenue_report": A.q09_monthly_revenue_report(star, 1998),
        "q11_customer_segmentation": A.q11_customer_segmentation(star, TEST_SEGMENTS, _dt.date(2001, 12, 31)),
        "q12_daily_revenue_range": A.q12_daily_revenue_range(star, 1998),
        "dq_suite (fact table part)": run_checks(star.tables, default_suite()[:1], J.TEST_RUN_ID, J.TEST_RUN_DATE),
    }
    out = ["# PLANS", "",
           f"Final physical plans (after adaptive execution) at `{os.path.basename(sf_dir)}`, `local[8]`,",
           "8 shuffle partitions, star written by `run_pipeline`. Regenerate with `python tools/plans.py`.", ""]
    for name, df in queries.items():
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        out += [f"## {name}", "", "```", clean(plan), "```", ""]
    open(os.path.join(ROOT, "PLANS.md"), "w", encoding="utf-8").write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
