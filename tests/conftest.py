import os
import sys
import tempfile

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from homestat.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "pages"]


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[8]", app="homestat-tests", conf={"spark.sql.shuffle.partitions": "8"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="homestat-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="homestat-test-")
