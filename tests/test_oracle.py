"""Every catalogue query against its SQL oracle (DuckDB) on the smallest test tables."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE
from retailmart import catalog

QUERIES = catalog.queries()
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return None if v is None else str(v)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


SIMPLE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
          "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _same_type(spark_t, duck_t):
    if spark_t.startswith("decimal"):
        return duck_t.replace(" ", "") == spark_t.upper().replace(" ", "")
    return SIMPLE.get(spark_t) == duck_t


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_ORACLE)
    rows, cols = df.collect(), df.columns
    rel = duck.execute(ORACLE[key])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    otypes = {d[0]: str(d[1]) for d in rel.description}
    assert [(c, t) for c, t in df.dtypes if not _same_type(t, otypes[c])] == []
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    sidx = [cols.index(ocols[i]) for i in order]
    a = sorted((tuple(_norm(r[i]) for i in sidx) for r in rows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in order) for r in orows), key=repr)
    assert len(a) == len(b)
    assert a == b


# results whose order is total: the rows are compared as they come
ORDERED = ("q01_ytd_revenue", "q03_mom_growth", "q05_order_frequency_buckets", "q08_category_contribution",
           "q09_monthly_revenue_report", "q10_seller_performance", "q12_daily_revenue_range", "mon_job_history",
           "mon_dq_history", "mon_latest_failures")


@pytest.mark.parametrize("key", ORDERED)
def test_row_order_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_ORACLE)
    rel = duck.execute(ORACLE[key])
    names = [d[0] for d in rel.description]
    assert [[_norm(r[n]) for n in names] for r in df.collect()] == [[_norm(v) for v in r] for r in rel.fetchall()]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "month_name", "monthly_revenue", "ytd_revenue"]
    assert df.count() > 0
