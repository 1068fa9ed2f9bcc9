"""Query catalogue: key -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from .aliases import ALIASES
from .plans import analytics as A
from .plans import operator_queries as O
from .quality import jobs as J
from .plans.warehouse import star_from_testdata

# Test parameter values (FIXTURES.md §4): same semantics, thresholds scaled to the data.
TEST_SEGMENTS = (("VIP", 5, Decimal("25000000")), ("Loyal", 3, Decimal("12000000")), ("Returning", 2, None))

QueryFn = Callable[[SparkSession, str], DataFrame]


def _on_star(fn, **kw) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(star_from_testdata(spark, sf_dir), **kw)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def queries() -> dict[str, QueryFn]:
    q = _named()
    q.update({name: getattr(O, name) for name in OPERATOR_QUERIES})
    for alias, target in ALIASES.items():
        q[alias] = q[target]
    return q


# Operator-level queries (functions of the same name in plans.operator_queries).
OPERATOR_QUERIES = [
    "scan_csv_staging", "scan_csv_orders", "scan_csv_customers", "scan_csv_products", "scan_csv_sellers",
    "scan_csv_payments", "scan_csv_reviews", "scan_missing_optional", "scan_category_lookup", "sink_staging_overwrite",
    "sink_reload_table", "sink_reload_fact", "rate_lookup_table", "sink_append_audit", "sink_replace_day", "rate_lookup_fallback", "values_rows",
    "normalize_columns", "nan_inf_to_null", "coerce_numeric", "date_key", "currency_convert", "null_default",
    "delivery_days", "late_flag", "segment_case", "recency_days", "status_decode", "calendar_fields",
    "safe_ratio", "pct_decimal", "int_pct_truncated", "type_casts", "year_of_date_key", "format_timestamp",
    "run_id_label", "number_label", "concat_alert_line", "text_prefix_upper", "inject_nulls",
    "filter_status", "filter_null", "filter_not_in_list", "filter_out_of_range", "filter_optional_param",
    "filter_post_agg", "filter_same_day", "filter_column_compare",
    "join_star_inner", "join_left_preagg", "join_fact_dim", "join_anti_orphans",
    "agg_sum_by_keys", "agg_count_distinct", "agg_avg_float", "agg_avg_money", "agg_avg_int_truncated",
    "agg_max_date_string", "agg_flag_sum", "agg_global", "agg_distinct_rows", "agg_row_count",
    "win_ntile", "build_dim_date", "build_dim_customer", "build_dim_seller",
    "build_dim_product", "translate_category", "dense_surrogate_key", "build_fact_orders", "clear_and_rebuild",
]


def _named() -> dict[str, QueryFn]:
    return {
        "q01_ytd_revenue": _on_star(A.q01_ytd_revenue),
        "q02_seller_rank_in_state": _on_star(A.q02_seller_rank_in_state),
        "q03_mom_growth": _on_star(A.q03_mom_growth),
        "q03b_mom_growth_spine": _on_star(A.q03b_mom_growth_spine, start_year=1995, end_year=2001),
        "q04_top3_products_per_category": _on_star(A.q04_top3_products_per_category),
        "q05_order_frequency_buckets": _on_star(A.q05_order_frequency_buckets),
        "q06_late_rate_by_state": _on_star(A.q06_late_rate_by_state, min_lines=300),
        "q07_above_average_customers": _on_star(A.q07_above_average_customers),
        "q08_category_contribution": _on_star(A.q08_category_contribution),
        "q09_monthly_revenue_report": _on_star(A.q09_monthly_revenue_report, year=1998),
        "q10_seller_performance": _on_star(A.q10_seller_performance, top_n=10),
        "q11_customer_segmentation": _on_star(A.q11_customer_segmentation, segments=TEST_SEGMENTS,
                                              as_of=_dt.date(2001, 12, 31)),
        "q12_daily_revenue_range": _on_star(A.q12_daily_revenue_range, year=1998),
        "q12a_year_scan": _on_star(A.q12a_year_scan, year=1998),
        "filter_year_function": _on_star(A.q12a_year_function, year=1998),
        "filter_date_key_range": _on_star(A.fact_key_range, year=1998),
        "v_daily_sales": _on_star(A.v_daily_sales),
        # data quality
        "dq_suite": J.suite_on_star,
        "dq_run_summary": J.suite_summary,
        "dq_not_null": J.not_null_checks,
        "dq_no_duplicates": J.duplicate_checks,
        "dq_value_range": J.range_checks,
        "dq_allowed_values": J.allowed_values_checks,
        "dq_referential_integrity": J.ri_checks,
        "dq_date_logic": J.date_logic_checks,
        "dq_pass_rate": J.pass_rate_by_year,
        "dq_rule_table_run": J.rule_table_results,
        "dq_rule_table_null": J.rule_table_null,
        "dq_rule_table_duplicate": J.rule_table_duplicate,
        "dq_rule_table_range": J.rule_table_range,
        "dq_results_with_rules": J.rule_table_joined,
        "dq_gate": J.rule_table_gate,
        "dq_monitor": J.rule_table_monitor,
        "mon_alert_body": J.rule_table_alert,
        "mon_job_history": J.monitor_job_history,
        "mon_job_schedules": J.monitor_job_schedules,
        "mon_dq_history": J.monitor_dq_history,
        "mon_latest_failures": J.monitor_latest_failures,
        "dq_history_runs": J.history_runs,
        "dq_run_job": J.dq_run_job,
        "mon_audit_alert": J.monitor_audit_alert,
        # the reference's TOP 15
        "topk_fixed": _on_star(A.q08_category_contribution, top=15),
        # top-k below the number of rows, so that the cut shows
        "topk_latest_runs": lambda spark, sf_dir: J.monitor_dq_history(spark, sf_dir, last_n=3),
        "topk_latest_failures": lambda spark, sf_dir: J.monitor_latest_failures(spark, sf_dir, n=3),
        "q03b_mom_growth_spine_state": _on_star(A.q03b_mom_growth_spine, start_year=1995, end_year=2001, seller_state="NATION_12"),
        "filter_vs_scalar_agg": _on_star(A.q07_above_average_customers),
    }
