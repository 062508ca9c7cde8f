import os
import sys
import tempfile

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import fixture  # noqa: E402


@pytest.fixture(scope="session")
def corpus():
    return fixture.write(tempfile.mkdtemp(prefix="homestat-llm-"))


@pytest.fixture(scope="session")
def plain_corpus():
    return fixture.write(tempfile.mkdtemp(prefix="homestat-llm-"), with_odd_ids=False)


@pytest.fixture(scope="session")
def sql():
    def run(root: str, query: str) -> tuple[list[str], list[tuple]]:
        con = duckdb.connect()
        for name in os.listdir(root):
            if name.endswith(".parquet"):
                con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{root}/{name}'")
        out = con.execute(query)
        return [c[0] for c in out.description], out.fetchall()
    return run
