"""Data-quality goldens (recorded outputs and hand-made edge cases)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailmart.quality import rule_table as RT
from retailmart.quality.rules import (AllowedValues, DateLogic, NoDuplicates, NotNull, ReferentialIntegrity,
                                      TableChecks, ValueRange, default_suite)
from retailmart.quality.runner import overall_status, pass_rate, run_checks, run_summary

RUN = ("DQ_TEST", dt.datetime(2026, 1, 1, 0, 0, 0))


def test_recorded_pass_rate(spark):
    # 110,920 of 112,650 rows failing -> 1.54 % pass rate, FAIL at threshold 99
    r = spark.range(1).select(pass_rate(F.lit(112650), F.lit(110920)).alias("p")).collect()[0]["p"]
    assert r == Decimal("1.54")


@pytest.mark.parametrize("total,failed,expected", [
    (0, 0, Decimal("0.00")),           # empty table -> 0 %
    (100000, 4, Decimal("100.00")),    # 99.996 rounds up: passes a 100 % rule (reference contract)
    (3, 1, Decimal("66.67")),
    (8, 1, Decimal("87.50")),
    (200, 1, Decimal("99.50")),
])
def test_pass_rate_edges(spark, total, failed, expected):
    r = spark.range(1).select(pass_rate(F.lit(total), F.lit(failed)).alias("p")).collect()[0]["p"]
    assert r == expected


@pytest.mark.parametrize("critical,failed,expected", [(0, 0, "PASSED"), (0, 1, "WARNING"), (1, 1, "FAILED")])
def test_overall_status(spark, critical, failed, expected):
    r = spark.range(1).select(overall_status(F.lit(critical), F.lit(failed)).alias("s")).collect()[0]["s"]
    assert r == expected


def test_rules_on_a_small_table(spark):
    df = spark.createDataFrame(
        [(1, "a", 5, "delivered", dt.date(2020, 1, 1), dt.date(2020, 1, 3)),
         (1, None, -1, "bogus", dt.date(2020, 1, 5), dt.date(2020, 1, 4)),
         (None, "b", 7, None, None, dt.date(2020, 1, 1)),
         (None, "b", 3, "shipped", dt.date(2020, 1, 1), dt.date(2020, 1, 1))],
        "id int, s string, v int, st string, d1 date, d2 date")
    ref = spark.createDataFrame([("a",)], "s string")
    suite = [TableChecks("t", (
        NotNull("id", Decimal("100")),
        NoDuplicates("id", Decimal("100")),     # groups {1:2, NULL:2} -> 2 surplus rows
        ValueRange("v", min_val=0, max_val=6),  # -1 and 7
        AllowedValues("st", allowed=("delivered", "shipped")),  # 'bogus' (NULL not counted)
        ReferentialIntegrity("s", ref_table="ref", ref_col="s"),  # 'b' twice
        DateLogic("d1", column2="d2"),          # 2020-01-04 < 2020-01-05
        ValueRange("v"),                        # no bounds -> no audit row
    ))]
    rows = {r["rule_name"]: r for r in run_checks({"t": df, "ref": ref}, suite, *RUN).collect()}
    assert rows["not_null"]["failed_records"] == 2
    assert rows["no_duplicates"]["failed_records"] == 2
    assert rows["value_range(0, 6)"]["failed_records"] == 2
    assert rows["allowed_values"]["failed_records"] == 1
    assert rows["rel_integrity -> ref.s"]["failed_records"] == 2
    assert rows["date_logic(d2>=d1)"]["failed_records"] == 1
    assert rows["date_logic(d2>=d1)"]["column_name"] == "d1 / d2"
    assert "value_range(None, None)" not in rows
    assert rows["not_null"]["details"] == "2 null values found"
    assert rows["allowed_values"]["details"] == "1 values not in ['delivered', 'shipped']"
    assert rows["not_null"]["pass_rate"] == Decimal("50.00") and rows["not_null"]["status"] == "FAIL"


def test_fused_scan_equals_single_rules(spark):
    df = spark.range(0, 500).select(
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("a"),
        (F.col("id") % 11 - 1).alias("b"))
    rules = (NotNull("a"), ValueRange("b", min_val=0), ValueRange("a", max_val=400), NotNull("b"))
    fused = {r["audit_id"] % 1_000_000: r["failed_records"] for r in
             run_checks({"t": df}, [TableChecks("t", rules)], *RUN).collect()}
    single = {}
    for i, r in enumerate(rules, start=1):
        row = run_checks({"t": df}, [TableChecks("t", (r,))], *RUN).collect()[0]
        single[i] = row["failed_records"]
    assert fused == single


def test_grouped_evaluation_matches_per_group(spark):
    df = spark.range(0, 300).select((F.col("id") % 3).alias("g"),
                                    F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).alias("x"))
    out = {r["g"]: r["failed_records"] for r in
           run_checks({"t": df}, [TableChecks("t", (NotNull("x"),))], *RUN, by=["g"]).collect()}
    for g in range(3):
        assert out[g] == df.where((F.col("g") == g) & F.col("x").isNull()).count()


def test_run_summary_recorded_runs(spark):
    # 19 checks, all pass -> PASSED; one warning fail -> WARNING
    def audit(statuses):
        return spark.createDataFrame([("R", RUN[1], s, sev) for s, sev in statuses],
                                     "run_id string, run_date timestamp_ntz, status string, severity string")
    s1 = run_summary(audit([("PASS", "critical")] * 19)).collect()[0]
    assert (s1["total_checks"], s1["passed_checks"], s1["overall_status"]) == (19, 19, "PASSED")
    s2 = run_summary(audit([("PASS", "critical")] * 18 + [("FAIL", "warning")])).collect()[0]
    assert (s2["failed_checks"], s2["critical_fails"], s2["overall_status"]) == (1, 0, "WARNING")


def test_default_suite_has_19_checks():
    assert sum(len(tc.rules) for tc in default_suite()) == 19


def test_gate_stops_on_high_failure(spark):
    orders = spark.createDataFrame([(None, 1, "x"), (2, 1, "y"), (2, None, "z")],
                                   "order_id long, customer_id long, order_status string")
    empty_items = spark.createDataFrame([], "order_id long, product_id long, price decimal(10,2)")
    tables = {"stg_orders": orders, "stg_customers": spark.createDataFrame([(1, 1)], "customer_id long, customer_unique_id long"),
              "stg_order_items": empty_items,
              "stg_payments": spark.createDataFrame([(1, Decimal("1.00"))], "order_id long, payment_value decimal(10,2)")}
    rules = RT.rules_frame(spark)
    when = dt.datetime(2026, 1, 1, 6, 0, 0)
    res = RT.evaluate_rules(tables, rules, when)
    by_rule = {r["rule_id"]: r for r in res.collect()}
    assert by_rule[1]["failed_rows"] == 1 and by_rule[2]["failed_rows"] == 1 and by_rule[3]["failed_rows"] == 1
    assert by_rule[6]["total_rows"] == 0 and by_rule[6]["failure_pct"] == Decimal("0.00")
    with pytest.raises(RT.DataQualityGateError):
        RT.dq_gate(res, rules, when.date())
    log = RT.dq_monitor(res, rules, when.date(), when).collect()[0]
    assert log["status"] == "FAIL"


def test_alert_from_audit_latest_critical_run(spark):
    from retailmart.plans.monitor import alert_from_audit
    df = spark.range(0, 100).select((F.col("id") % 10).alias("x"))
    suite = [TableChecks("t", (NotNull("x", Decimal("100")), ValueRange("x", max_val=5, threshold=Decimal("90"),
                                                                      severity="critical")))]
    old = run_checks({"t": df}, suite, "DQ_OLD", dt.datetime(2026, 1, 1))
    new = run_checks({"t": df}, suite, "DQ_NEW", dt.datetime(2026, 1, 2))
    audit = old.unionByName(new)
    summaries = run_summary(audit)
    rows = alert_from_audit(summaries, audit).collect()
    assert len(rows) == 1 and rows[0]["run_id"] == "DQ_NEW" and rows[0]["critical_failures"] == 1
    assert rows[0]["body"] == " t.x [value_range(None, 5)] - 40 rows failed (60.00% pass rate)"
    clean = run_checks({"t": df}, [TableChecks("t", (NotNull("x"),))], "DQ_CLEAN", dt.datetime(2026, 1, 3))
    assert alert_from_audit(run_summary(clean), clean).count() == 0


def test_exact_mode_fails_a_rounded_pass(spark):
    df = spark.range(0, 100000).select(F.when(F.col("id") < 4, None).otherwise(F.col("id")).alias("x"))
    suite = [TableChecks("t", (NotNull("x", Decimal("100")),))]
    rounded = run_checks({"t": df}, suite, *RUN).collect()[0]
    exact = run_checks({"t": df}, suite, *RUN, exact=True).collect()[0]
    assert rounded["pass_rate"] == Decimal("100.00") and rounded["status"] == "PASS"
    assert exact["pass_rate"] == Decimal("100.00") and exact["status"] == "FAIL"


def test_several_integrity_rules_grouped(spark):
    fact = spark.range(0, 600).select((F.col("id") % 3).alias("g"), (F.col("id") % 50).alias("a"),
                                      (F.col("id") % 70).alias("b"))
    refs = {"f": fact, "ra": spark.range(0, 45).withColumnRenamed("id", "a"),
            "rb": spark.range(0, 60).withColumnRenamed("id", "b")}
    suite = [TableChecks("f", (ReferentialIntegrity("a", ref_table="ra", ref_col="a"),
                               ReferentialIntegrity("b", ref_table="rb", ref_col="b")))]
    got = {(r["g"], r["column_name"]): r["failed_records"] for r in run_checks(refs, suite, *RUN, by=["g"]).collect()}
    for g in range(3):
        part = fact.where(F.col("g") == g)
        assert got[(g, "a")] == part.where("a >= 45").count()
        assert got[(g, "b")] == part.where("b >= 60").count()


def test_unknown_rule_type_and_missing_results_stop(spark):
    import datetime as dt

    from retailmart.quality.rule_table import DataQualityGateError, dq_gate, evaluate_rules, rules_frame

    df = spark.createDataFrame([(1,), (1,)], "k int")
    now = dt.datetime(2020, 1, 1)
    with pytest.raises(ValueError, match="unknown type"):
        evaluate_rules({"t": df}, rules_frame(spark, [("t", "k", "NO_SUCH_CHECK", "HIGH")]), now)
    rules = rules_frame(spark, [("t", "k", "DUPLICATE_CHECK", "LOW")])
    results = evaluate_rules({"t": df}, rules, now)
    assert [(r.failed_rows, r.total_rows) for r in results.collect()] == [(1, 2)]
    assert len(dq_gate(results, rules, now.date())) == 1
    with pytest.raises(DataQualityGateError, match="0 results for 1 rules"):
        dq_gate(results, rules, dt.date(2020, 1, 2))


def test_run_job_stores_each_run_once_with_its_own_ids(spark, tmp_path):
    from retailmart.quality.runner import read_audit, read_summary, run_job

    audit, summary = str(tmp_path / "audit"), str(tmp_path / "summary")
    df = spark.createDataFrame([(1,), (None,)], "k int")
    suite = [TableChecks("t", (NotNull("k", Decimal("100")), ValueRange("k", min_val=0)))]
    first, second = dt.datetime(2026, 1, 1, 6, 0, 0), dt.datetime(2026, 1, 1, 6, 0, 1, 5000)
    assert run_job(spark, {"t": df}, suite, first, audit, summary) == ("DQ_20260101_060000", "FAILED")
    assert run_job(spark, {"t": df.dropna()}, suite, second, audit, summary) == ("DQ_20260101_060001", "PASSED")
    with pytest.raises(FileExistsError, match="already stored"):
        run_job(spark, {"t": df}, suite, first, audit, summary)
    ids = [r["audit_id"] for r in read_audit(spark, audit).collect()]
    assert len(ids) == len(set(ids)) == 4
    assert sorted(r["overall_status"] for r in read_summary(spark, summary).collect()) == ["FAILED", "PASSED"]
