"""Plan checks: pushdown, pruning, no Python UDFs, no single-partition exchange over big inputs."""

import datetime as dt

import pytest

from conftest import SF_SMALL
from retailmart.catalog import TEST_SEGMENTS
from retailmart.plans import analytics as A
from retailmart.plans.warehouse import star_from_testdata


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return star_from_testdata(spark, SF_SMALL)


def test_year_queries_push_range_and_prune_partitions(star):
    p = plan(A.q12_daily_revenue_range(star, 1998))
    assert "PushedFilters" in p and "GreaterThanOrEqual(date_sk,19980101)" in p
    assert "PartitionFilters" in p and "order_year" in p


def test_no_python_udfs_anywhere(star):
    queries = [A.q01_ytd_revenue(star), A.q05_order_frequency_buckets(star), A.q07_above_average_customers(star),
               A.q11_customer_segmentation(star, TEST_SEGMENTS, dt.date(2001, 12, 31)), A.v_daily_sales(star)]
    for q in queries:
        p = plan(q)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_ntile_query_never_gathers_customers(star):
    # the only single-partition step is over the order-count histogram, after aggregation
    p = A.q05_order_frequency_buckets(star)._jdf.queryExecution().optimizedPlan().toString()
    assert "ntile" not in p.lower()


def test_status_filter_is_pushed_to_the_scan(star):
    p = plan(A.q02_seller_rank_in_state(star))
    assert "EqualTo(order_status,delivered)" in p


@pytest.mark.parametrize("query", [A.q02_seller_rank_in_state, A.q04_top3_products_per_category, A.q05_order_frequency_buckets,
                                   A.q06_late_rate_by_state, A.q07_above_average_customers, A.q08_category_contribution])
def test_lines_are_combined_before_they_meet_a_dimension(star, query):
    # every path from a join down to the fact scan passes an aggregate
    tree = query(star)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scans = 0
    for i, line in enumerate(tree):
        if "Relation" in line and "order_sk" in line:
            scans += 1
            above, d = [], depth(line)
            for up in reversed(tree[:i]):
                if depth(up) < d:
                    above.append(up.strip(" :+-"))
                    d = depth(up)
            join = next(k for k, u in enumerate(above) if u.startswith("Join"))
            assert any(u.startswith("Aggregate") for u in above[:join])
    assert scans
