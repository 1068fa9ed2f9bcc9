import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("RETAILMART_TEST_SF", SF_SMALL)


@pytest.fixture(scope="session")
def spark():
    from retailmart.session import checkpoint_dir, get_session
    s = get_session(master="local[*]", app="retailmart-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    names = ("region nation customer supplier part orders lineitem events documents embeddings "
             "pages benchmark labels conversations").split()
    for t in names:
        p = f"{SF_ORACLE}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con
