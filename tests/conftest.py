import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from propensa.session import local_session, shared_dir

    s = local_session("*", shuffle_partitions=8)
    shared_dir(s)
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from propensa.sources.tables import TABLES

    def make(sf_dir):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con

    return make
