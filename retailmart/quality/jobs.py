"""Ready-made data-quality jobs over the warehouse and the test fixtures.

These are what the query catalogue registers: each returns the audit / results frame of
one run, built from tables that Spark reads or derives.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.warehouse import star_from_testdata
from ..sources import fixture
from ..functions.scalar import run_id_label
from ..session import scratch_path
from . import rule_table as RT
from .rules import (CRITICAL, WARNING, AllowedValues, DateLogic, NoDuplicates, NotNull, ORDER_STATUSES,
                    ReferentialIntegrity, TableChecks, ValueRange, default_suite)
from .runner import read_audit, read_summary, run_checks, run_job, run_summary, store_audit

# Fixed run identity for reproducible test runs (a real run passes its own).
TEST_RUN_ID = "DQ_20260419_172441"
TEST_RUN_DATE = _dt.datetime(2026, 4, 19, 17, 24, 41)
TEST_CHECK_TIME = _dt.datetime(2026, 4, 19, 6, 0, 0)
TWO_RUNS = (TEST_RUN_DATE, TEST_RUN_DATE + _dt.timedelta(days=1))
D = Decimal


def _run(tables, suite, by=None, started=TEST_RUN_DATE):
    return run_checks(tables, suite, run_id_label(started), started, by)


def suite_on_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19-check suite on the warehouse built from the test tables."""
    star = star_from_testdata(spark, sf_dir)
    return _run(star.tables, default_suite())


def suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(suite_on_star(spark, sf_dir))


NOT_NULL_SUITE = [
    TableChecks("orders_dirty", (NotNull("order_id", D("100.0")), NotNull("order_status", D("95.0"), WARNING),
                                 NotNull("customer_id", D("100.0")))),
    TableChecks("orders_empty", (NotNull("order_id", D("100.0")),)),
]


def _not_null_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    od = fixture.orders_dirty(spark, sf_dir)
    return {"orders_dirty": od, "orders_empty": fixture.empty_like(od)}


def not_null_checks(spark: SparkSession, sf_dir: str, started: _dt.datetime = TEST_RUN_DATE) -> DataFrame:
    return _run(_not_null_tables(spark, sf_dir), NOT_NULL_SUITE, started=started)


def duplicate_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"orders_dup": fixture.orders_dup(spark, sf_dir)}
    return _run(tables, [TableChecks("orders_dup", (NoDuplicates("order_id", D("100.0")),
                                                    NoDuplicates("customer_id", D("95.0"), WARNING)))])


def range_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"orders_dirty": fixture.orders_dirty(spark, sf_dir),
              "products_dirty": fixture.products_dirty(spark, sf_dir)}
    return _run(tables, [
        TableChecks("orders_dirty", (ValueRange("price", min_val=0, threshold=D("99.0"), severity=CRITICAL),
                                     ValueRange("price", min_val=1000, max_val=400000, threshold=D("95.0")),
                                     ValueRange("price"))),
        TableChecks("products_dirty", (ValueRange("weight_g", min_val=0, threshold=D("95.0")),)),
    ])


def allowed_values_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"orders_dirty": fixture.orders_dirty(spark, sf_dir)}
    return _run(tables, [TableChecks("orders_dirty", (
        AllowedValues("order_status", allowed=ORDER_STATUSES, threshold=D("99.0")),))])


def ri_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"orders_dirty": fixture.orders_dirty(spark, sf_dir),
              "customer": fixture.table(spark, sf_dir, "customer")}
    return _run(tables, [TableChecks("orders_dirty", (
        ReferentialIntegrity("customer_id", ref_table="customer", ref_col="c_custkey"),))])


def date_logic_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"order_lines": fixture.order_lines(spark, sf_dir)}
    return _run(tables, [TableChecks("order_lines", (
        DateLogic("o_orderdate", column2="l_shipdate", operator=">="),
        DateLogic("o_orderdate", column2="l_shipdate", operator="<", threshold=D("40.0"), severity=CRITICAL)))])


def pass_rate_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not-null / range / allowed checks of the dirty orders, one evaluation per order year
    (``by``): pass rates per group from the same single scan."""
    od = fixture.orders_dirty(spark, sf_dir).withColumn("order_year", F.year("order_purchase_timestamp"))
    return _run({"orders_dirty": od}, [TableChecks("orders_dirty", (
        NotNull("order_id", D("99.5")), ValueRange("price", min_val=0, threshold=D("99.0")),
        AllowedValues("order_status", allowed=ORDER_STATUSES, threshold=D("99.0"))))], by=["order_year"])


def fact_suite() -> list[TableChecks]:
    return [default_suite()[0]]


def history_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit history: the fact checks evaluated once per order year, as one run each
    (run id and run date derived from the year)."""
    star = star_from_testdata(spark, sf_dir)
    fact = star["fact_orders"]
    if "order_year" not in fact.columns:
        fact = fact.withColumn("order_year", F.call_function("div", F.col("date_sk"), F.lit(10000)).cast("int"))
    tables = dict(star.tables, fact_orders=fact)
    y = F.col("order_year")
    run_id = F.concat(F.lit("DQ_"), y.cast("string"), F.lit("0101_060000"))
    run_date = F.make_timestamp_ntz(y, F.lit(1), F.lit(1), F.lit(6), F.lit(0), F.lit(0))
    return run_checks(tables, fact_suite(), run_id, run_date, by=["order_year"]).drop("order_year")


# Rule-table flavour ------------------------------------------------------------------------
def rule_table_results(spark: SparkSession, sf_dir: str, only: str | None = None) -> DataFrame:
    stg = fixture.staging_dirty(spark, sf_dir)
    rules = RT.rules_frame(spark)
    if only is not None:
        rules = rules.where(F.col("rule_type") == only)
    return RT.evaluate_rules(stg, rules, TEST_CHECK_TIME)


def rule_table_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_table_results(spark, sf_dir, RT.NULL_CHECK)


def rule_table_duplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_table_results(spark, sf_dir, RT.DUPLICATE_CHECK)


def rule_table_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_table_results(spark, sf_dir, RT.RANGE_CHECK)


def rule_table_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RT.results_with_rules(rule_table_results(spark, sf_dir), RT.rules_frame(spark), TEST_CHECK_TIME.date())


def rule_table_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RT.gate_summary(rule_table_results(spark, sf_dir), RT.rules_frame(spark), TEST_CHECK_TIME.date())


def rule_table_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RT.dq_monitor(rule_table_results(spark, sf_dir), RT.rules_frame(spark), TEST_CHECK_TIME.date(),
                         TEST_CHECK_TIME)


def rule_table_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RT.alert_body(rule_table_results(spark, sf_dir), RT.rules_frame(spark), TEST_CHECK_TIME.date())


# Monitoring data sets -------------------------------------------------------------------------
def monitor_job_history(spark: SparkSession, sf_dir: str, job_name: str = "job_purchase", last_n: int = 10):
    from ..plans.monitor import job_history
    t = fixture.job_tables(spark, sf_dir)
    return job_history(t["jobs"], t["job_runs"], job_name, last_n)


def monitor_job_schedules(spark: SparkSession, sf_dir: str, job_name: str = "job_purchase"):
    from ..plans.monitor import job_schedules
    t = fixture.job_tables(spark, sf_dir)
    return job_schedules(t["jobs"], t["job_schedules"], t["schedules"], job_name)


_HISTORY: dict[tuple[str, str], tuple[str, str]] = {}


def stored_history(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored audit and summary of the yearly runs (written once per application and data set)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _HISTORY:
        paths = scratch_path(spark, "dq_audit"), scratch_path(spark, "dq_run_summary")
        store_audit(history_runs(spark, sf_dir), *paths)
        _HISTORY[key] = paths
    audit, summary = _HISTORY[key]
    return read_audit(spark, audit), read_summary(spark, summary)


def monitor_dq_history(spark: SparkSession, sf_dir: str, last_n: int = 10):
    from ..plans.monitor import dq_history
    return dq_history(stored_history(spark, sf_dir)[1], last_n)


def monitor_latest_failures(spark: SparkSession, sf_dir: str, n: int = 20):
    from ..plans.monitor import latest_failures
    return latest_failures(stored_history(spark, sf_dir)[0], n)


def _two_stored_runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    paths = scratch_path(spark, "dq_audit"), scratch_path(spark, "dq_run_summary")
    for started in TWO_RUNS:
        run_job(spark, _not_null_tables(spark, sf_dir), NOT_NULL_SUITE, started, *paths)
    return read_audit(spark, paths[0]), read_summary(spark, paths[1])


def dq_run_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the job, a day apart: their stored summaries, with the ids of their rows."""
    audit, summary = _two_stored_runs(spark, sf_dir)
    ids = audit.groupBy("run_id").agg(F.countDistinct("audit_id").alias("audit_ids"), F.min("audit_id").alias("first_audit_id"))
    return summary.join(ids, "run_id")


def monitor_audit_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert of the latest of two stored runs."""
    from ..plans.monitor import alert_from_audit
    audit, summary = _two_stored_runs(spark, sf_dir)
    return alert_from_audit(summary, audit)
