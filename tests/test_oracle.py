"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE
from threadlens.plans import catalog, files_catalog
from tools.oracle_check import digest, duck

NAMES = sorted({**catalog.QUERIES, **files_catalog.QUERIES})
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "checkpoint_count" in df.columns


def test_every_query_has_oracle_or_is_file_based():
    missing = [n for n in NAMES if n not in SQL]
    assert missing == ["file_inventory"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMOKE)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(rows, cols) == digest(drows, dcols)
