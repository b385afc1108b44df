"""Every registered query on empty tables: no failure; global aggregates give one row."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE
from threadlens.plans import catalog, files_catalog

ONE_ROW = {"null_wide", "rescued_rows"}
ROWS_PER_ITEM = {"null_profile": 13, "column_stats": 8, "expect_report": 4, "checks": 14,
                 "file_inventory": 2, "expect_warn_counts": 1, "column_stats_state": 8}
NAMES = sorted({**catalog.QUERIES, **files_catalog.QUERIES})


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in ["events", "orders", "conversations"]:
        spark.read.parquet(f"{SMOKE}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("name", NAMES)
def test_query_on_empty_tables(spark, empty_dir, name):
    rows = E.queries()[name](spark, empty_dir).collect()
    if name in ONE_ROW:
        assert len(rows) == 1
    elif name in ROWS_PER_ITEM:
        assert len(rows) == ROWS_PER_ITEM[name]
    else:
        assert rows == []


def test_checks_pass_vacuously_but_flag_empty_layers(spark, empty_dir):
    res = {r.check: r.passed for r in E.queries()["checks"](spark, empty_dir).collect()}
    assert res["orphan_thread_ratio"] and res["null_user_ratio"] and res["team_coverage"]
    assert not res["smallest_layer_rows"]
