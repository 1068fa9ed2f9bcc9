"""Monitoring data sets: job history, DQ run history, latest failures, schedules.

Presentation (HTML, e-mail) is out of scope; these frames are what a dashboard or an
alert reads.  Each "latest n" set is a top-k (``TakeOrderedAndProject``): every task
keeps its own n best rows, so nothing unbounded is sorted in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import format_timestamp, status_decode


def job_history(jobs: DataFrame, runs: DataFrame, job_name: str, last_n: int = 10) -> DataFrame:
    """Latest step runs of one job, newest first, with the status code decoded."""
    j = jobs.where(F.col("name") == job_name).select("job_id", F.col("name").alias("job_name"))
    return (runs.join(j, "job_id")
            .orderBy(F.col("run_date").desc(), F.col("run_time").desc(), F.col("instance_id").desc())
            .limit(last_n)
            .select("job_name", "step_id", "step_name", "run_date", "run_time", "run_duration",
                    status_decode("run_status").alias("run_status"), "message"))


def dq_history(summaries: DataFrame, last_n: int = 10) -> DataFrame:
    """Latest run summaries, run date as 'yyyy-MM-dd HH:mm:ss' text."""
    return (summaries.orderBy(F.col("run_date").desc(), F.col("run_id").desc()).limit(last_n)
            .select("run_id", format_timestamp("run_date").alias("run_date"), "total_checks", "passed_checks",
                    "failed_checks", "critical_fails", "overall_status"))


def latest_failures(audit: DataFrame, n: int = 20) -> DataFrame:
    """Most recent failing audit rows (across runs, as the dashboard shows them)."""
    return (audit.where(F.col("status") == "FAIL")
            .orderBy(F.col("run_date").desc(), F.col("run_id").desc(), F.col("audit_id").asc()).limit(n)
            .select("run_id", "table_name", "column_name", "rule_name", "severity", "status",
                    "pass_rate", "failed_records", "details"))


def job_schedules(jobs: DataFrame, job_schedules: DataFrame, schedules: DataFrame, job_name: str) -> DataFrame:
    """Schedules attached to a job, through the job-schedule bridge table."""
    j = jobs.where(F.col("name") == job_name).select("job_id", F.col("name").alias("job_name"))
    return (j.join(job_schedules, "job_id").join(schedules, "schedule_id")
            .select("job_name", "schedule_id", "name"))


def alert_from_audit(summaries: DataFrame, audit: DataFrame) -> DataFrame:
    """Alert data of the latest run, when it has critical failures: one row with the run id,
    the number of critical failures and the newline-joined lines
    ' table.column [rule] - n rows failed (p% pass rate)'.  No row when nothing to send.

    Only the latest run's rows are joined (one run = one row per rule), so the joined text
    is bounded by the size of the rule suite.
    """
    latest = (summaries.orderBy(F.col("run_date").desc(), F.col("run_id").desc()).limit(1)
              .where(F.col("critical_fails") > 0).select("run_id"))
    fails = (audit.join(latest, "run_id", "left_semi")
             .where((F.col("status") == "FAIL") & (F.col("severity") == "critical")))
    line = F.concat(F.lit(" "), F.col("table_name"), F.lit("."), F.col("column_name"), F.lit(" ["),
                    F.col("rule_name"), F.lit("] - "), F.format_number(F.col("failed_records"), 0),
                    F.lit(" rows failed ("), F.col("pass_rate").cast("string"), F.lit("% pass rate)"))
    return (fails.select("run_id", "audit_id", line.alias("_line")).groupBy("run_id")
            .agg(F.count(F.lit(1)).alias("critical_failures"),
                 F.expr("listagg(_line, '\\n') WITHIN GROUP (ORDER BY audit_id)").alias("body")))
