import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from loanscope.session import get_session
    s = get_session("local[*]", shuffle_partitions=8)
    if not (s.sparkContext.getCheckpointDir() or s.conf.get("spark.checkpoint.dir", None)):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loanscope-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from loanscope.sources.tables import DRIVER_TABLES
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{SF_ORACLE}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="loanscope-test-")
