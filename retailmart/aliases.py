"""Inventory keys answered by a named query they are part of.

Same plan, same oracle: an alias names where an operator is used and is no check of its own.
"""

ALIASES = {
    "join_cross_scalar": "q08_category_contribution",
    "join_spine_left": "q03b_mom_growth_spine",
    "join_results_rules": "dq_results_with_rules",
    "join_job_history": "mon_job_history",
    "join_job_schedule": "mon_job_schedules",
    "agg_multi_distinct": "q09_monthly_revenue_report",
    "agg_of_agg": "q05_order_frequency_buckets",
    "agg_duplicate_surplus": "dq_no_duplicates",
    "agg_duplicate_groups": "dq_rule_table_duplicate",
    "agg_string_concat": "mon_alert_body",
    "agg_status_counts": "dq_run_summary",
    "win_running_sum_partitioned": "q01_ytd_revenue",
    "win_rank": "q02_seller_rank_in_state",
    "win_lag": "q03_mom_growth",
    "win_dense_rank_topn": "q04_top3_products_per_category",
    "win_running_sum_global": "q08_category_contribution",
    "sort_multi_key": "q02_seller_rank_in_state",
    "topk_param": "q10_seller_performance",
    "union_results": "dq_suite",
}
