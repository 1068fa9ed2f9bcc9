"""Rule-table flavour of data quality: rules are rows of a ``dq_rules`` table.

Zero tolerance: any failing row makes the rule FAIL.  Rule rows are configuration (a
few dozen at most); they are read on the driver only to *build* plans, never data.
Rules of one table are evaluated together: NULL and RANGE checks are ``count_if``s of a
single scan, DUPLICATE checks one grouping each.  Results for a check date replace that
day's partition (idempotent re-runs), see ``sources.sinks.sink_replace_day``.
"""

from __future__ import annotations

import datetime as _dt
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalar import concat_alert_line, ratio_half_up_decimal, stored_id, ts_ntz

NULL_CHECK, DUPLICATE_CHECK, RANGE_CHECK = "NULL_CHECK", "DUPLICATE_CHECK", "RANGE_CHECK"
HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"

# The seed rules (table, column, rule type, severity).
DEFAULT_RULES = [
    ("stg_orders", "order_id", NULL_CHECK, HIGH),
    ("stg_orders", "order_id", DUPLICATE_CHECK, HIGH),
    ("stg_orders", "customer_id", NULL_CHECK, HIGH),
    ("stg_customers", "customer_id", NULL_CHECK, HIGH),
    ("stg_customers", "customer_unique_id", NULL_CHECK, HIGH),
    ("stg_order_items", "order_id", NULL_CHECK, HIGH),
    ("stg_order_items", "product_id", NULL_CHECK, HIGH),
    ("stg_order_items", "price", RANGE_CHECK, MEDIUM),
    ("stg_payments", "payment_value", RANGE_CHECK, HIGH),
]


def rules_frame(spark: SparkSession, rules=DEFAULT_RULES) -> DataFrame:
    """The ``dq_rules`` table from inline rows (rule_id = 1..n in insertion order)."""
    rows = [(i + 1, t, c, rt, sev) for i, (t, c, rt, sev) in enumerate(rules)]
    return spark.createDataFrame(rows, schemas.DQ_RULES)


def _failure_pct(failed: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(0).cast("decimal(5,2)")).otherwise(
        ratio_half_up_decimal(failed * 100, total, 2).cast("decimal(5,2)"))


def evaluate_rules(tables: dict[str, DataFrame], rules: DataFrame, checked_at: _dt.datetime,
                   range_min=0) -> DataFrame:
    """``dq_results`` rows for every rule: failed_rows, total_rows, status, failure_pct.

    NULL_CHECK: NULL values.  DUPLICATE_CHECK: number of values that occur more than once.
    RANGE_CHECK: non-NULL values below ``range_min``.
    """
    by_table: dict[str, list[tuple[int, str, str]]] = defaultdict(list)
    for r in rules.select("rule_id", "table_name", "column_name", "rule_type").collect():
        if r["rule_type"] not in (NULL_CHECK, RANGE_CHECK, DUPLICATE_CHECK):
            raise ValueError(f"rule {r['rule_id']} has an unknown type: {r['rule_type']}")
        by_table[r["table_name"]].append((r["rule_id"], r["column_name"], r["rule_type"]))
    parts = []
    for table, rs in by_table.items():
        df = tables[table]
        scalar = [(rid, c, rt) for rid, c, rt in rs if rt in (NULL_CHECK, RANGE_CHECK)]
        aggs = [F.count(F.lit(1)).alias("_total")]
        for rid, c, rt in scalar:
            cond = F.col(c).isNull() if rt == NULL_CHECK else (F.col(c).isNotNull() & (F.col(c) < F.lit(range_min)))
            aggs.append(F.count_if(cond).alias(f"_f{rid}"))
        wide = df.agg(*aggs)
        if scalar:
            entries = [F.struct(F.lit(rid).alias("rule_id"), F.col(f"_f{rid}").alias("failed_rows"))
                       for rid, _, _ in scalar]
            parts.append(wide.select("_total", F.explode(F.array(*entries)).alias("_r")).select("_total", "_r.*"))
        for rid, c, rt in rs:
            if rt == DUPLICATE_CHECK:
                # one grouping gives the total as well
                counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("_c"))
                parts.append(counts.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_total"), F.count_if(F.col("_c") > 1).alias("failed_rows"))
                             .select("_total", F.lit(rid).alias("rule_id"), "failed_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    ts = ts_ntz(checked_at)
    return out.select(
        stored_id(ts, "rule_id").alias("result_id"),
        F.col("rule_id").cast("int").alias("rule_id"),
        F.col("failed_rows").cast("long").alias("failed_rows"),
        F.col("_total").cast("long").alias("total_rows"),
        F.when(F.col("failed_rows") > 0, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"),
        ts.alias("checked_at"),
        _failure_pct(F.col("failed_rows"), F.col("_total")).alias("failure_pct"),
        F.to_date(ts).alias("check_date"))


def results_with_rules(results: DataFrame, rules: DataFrame, day: _dt.date) -> DataFrame:
    """One day's results with the rule metadata."""
    same_day = results.where(F.to_date("checked_at") == F.lit(day))
    return (same_day.join(rules, "rule_id")
            .select("table_name", "column_name", "rule_type", "severity", "failed_rows", "total_rows", "status"))


class DataQualityGateError(RuntimeError):
    """Raised when a HIGH severity rule fails: the pipeline must stop."""


def gate_summary(results: DataFrame, rules: DataFrame, day: _dt.date) -> DataFrame:
    """Per severity: rules, failing rules; plus the decision column (STOP / CONTINUE)."""
    r = results_with_rules(results, rules, day)
    agg = r.groupBy("severity").agg(F.count(F.lit(1)).alias("rules"),
                                    F.count_if(F.col("status") == "FAIL").alias("failed_rules"))
    # at most one row per severity level: the unpartitioned window is over three rows
    high_fail = F.max(F.when(F.col("severity") == HIGH, F.col("failed_rules"))).over(Window.partitionBy())
    return agg.withColumn("decision", F.when(F.coalesce(high_fail, F.lit(0)) > 0, "STOP").otherwise("CONTINUE"))


def dq_gate(results: DataFrame, rules: DataFrame, day: _dt.date) -> list[str]:
    """Evaluate the whole result set, then stop on HIGH failures.

    Returns the log lines of the day's results (HIGH/MEDIUM/LOW failures first).
    Only the day's result rows (one per rule) reach the driver.
    """
    rows = (results_with_rules(results, rules, day)
            .orderBy(F.col("status").asc(), "severity", "table_name", "column_name", "rule_type").collect())
    expected = rules.count()
    if len(rows) < expected:
        raise DataQualityGateError(f"Stopping pipeline: {len(rows)} results for {expected} rules on {day}")
    lines, high = [], 0
    for t, c, rt, sev, failed, total, status in rows:
        lines.append(f"{sev} | {t}.{c} | {rt} | Failed: {failed}/{total} | {status}")
        if sev == HIGH and status == "FAIL":
            high += 1
    if high:
        raise DataQualityGateError(f"Stopping pipeline: {high} HIGH severity rule(s) failed\n" + "\n".join(lines))
    return lines


# Fixed values in dq_monitor and dq_gate: the job name, its messages and the layout of the log lines.
def dq_monitor(results: DataFrame, rules: DataFrame, day: _dt.date, run_time: _dt.datetime,
               job_name: str = "DQ_MONITOR") -> DataFrame:
    """One ``etl_job_log`` row: FAIL if any HIGH rule failed on ``day``, else SUCCESS."""
    r = results_with_rules(results, rules, day)
    n = r.agg(F.count_if((F.col("status") == "FAIL") & (F.col("severity") == HIGH)).alias("_n"))
    fail = F.col("_n") > 0
    return n.select(F.lit(job_name).alias("job_name"), ts_ntz(run_time).alias("run_time"),
                    F.when(fail, "FAIL").otherwise("SUCCESS").alias("status"),
                    F.when(fail, "High severity DQ issues found").otherwise("All checks passed").alias("message"))


def alert_body(results: DataFrame, rules: DataFrame, day: _dt.date) -> DataFrame:
    """One row: the number of HIGH failures and the newline-joined alert lines (ordered)."""
    same_day = results.where(F.to_date("checked_at") == F.lit(day))
    r = (same_day.join(rules, "rule_id")
         .where((F.col("status") == "FAIL") & (F.col("severity") == HIGH)))
    line = concat_alert_line(F.col("table_name"), F.col("column_name"), F.col("rule_type"),
                             F.col("failed_rows"), F.col("failure_pct"))
    # one line per failing HIGH rule of the day: bounded by the rule table, not the data
    return r.select(line.alias("_line"), F.col("rule_id").alias("_rid")).agg(
        F.count(F.lit(1)).alias("high_failures"),
        F.expr("listagg(_line, '\\n') WITHIN GROUP (ORDER BY _rid)").alias("body"))
