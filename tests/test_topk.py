"""TOP 15 of the categories: own tables with more of them than the limit keeps."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pyarrow as pa
import pyarrow.parquet as pq

from conftest import SF_SMALL
from retailmart import catalog, oracle

# p_type -> l_extendedprice of its one delivered line: 18 categories, two of them of the same revenue
PRICES = {f"TYPE_{i:02d}": 100 + 7 * i for i in range(17)} | {"TYPE_SAME": 100 + 7 * 16}
RATE = Decimal("18.5")


def _write(sf_dir, name, rows):
    schema = pq.read_schema(f"{SF_SMALL}/{name}.parquet")
    pq.write_table(pa.Table.from_pylist(rows, schema=schema), f"{sf_dir}/{name}.parquet")


def _tables(sf_dir):
    day = dt.datetime(1998, 3, 5)
    _write(sf_dir, "region", [{"r_regionkey": 0, "r_name": "ASIA"}])
    _write(sf_dir, "nation", [{"n_nationkey": 0, "n_name": "NATION_0", "n_regionkey": 0}])
    _write(sf_dir, "customer", [{"c_custkey": 1, "c_name": "c", "c_nationkey": 0, "c_acctbal": 0.0,
                                 "c_mktsegment": "FURNITURE"}])
    _write(sf_dir, "supplier", [{"s_suppkey": 1, "s_name": "s", "s_nationkey": 0, "s_acctbal": 0.0}])
    _write(sf_dir, "part", [{"p_partkey": k, "p_name": "p", "p_brand": "Brand#1", "p_type": t, "p_size": 5,
                             "p_retailprice": 1.0} for k, t in enumerate(PRICES)])
    # order 1 is delivered; the one of status O would turn the ranking round
    _write(sf_dir, "orders", [{"o_orderkey": k, "o_custkey": 1, "o_orderstatus": s, "o_totalprice": 1.0,
                               "o_orderdate": day, "o_orderpriority": "1-URGENT"} for k, s in ((1, "F"), (2, "O"))])
    lines = [(1, k, float(p)) for k, p in enumerate(PRICES.values())] + [(2, 0, 90000.0)]
    _write(sf_dir, "lineitem", [{"l_orderkey": o, "l_partkey": k, "l_suppkey": 1, "l_linenumber": n, "l_quantity": 1.0,
                                 "l_extendedprice": p, "l_discount": 0.0, "l_tax": 0.0, "l_returnflag": "N",
                                 "l_linestatus": "F", "l_shipdate": day + dt.timedelta(days=3)}
                                for n, (o, k, p) in enumerate(lines, 1)])


def _expected():
    rev = {t: p * RATE for t, p in PRICES.items()}
    total, running, rows = sum(rev.values()), Decimal(0), []
    for t in sorted(rev, key=lambda t: (-rev[t], t)):
        pct = (rev[t] * 100 / total).quantize(Decimal("0.01"), ROUND_HALF_UP)
        running += pct
        rows.append((t, float(rev[t]), float(pct), float(running)))
    return rows


def test_topk_fixed_keeps_the_fifteen_categories_of_most_revenue(spark, tmp_path):
    _tables(tmp_path)
    rows = [tuple(r) for r in catalog.queries()["topk_fixed"](spark, str(tmp_path)).collect()]
    assert len(PRICES) == 18 and len(rows) == 15
    assert rows == _expected()[:15]


def test_topk_fixed_sql_keeps_them_too(tmp_path):
    import duckdb
    _tables(tmp_path)
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    assert con.execute(oracle.QUERIES["topk_fixed"]).fetchall() == _expected()[:15]
