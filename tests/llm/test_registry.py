"""The corpus queries and the pipeline: registered, and defined on empty tables."""

import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.conftest import SMOKE
from threadlens.llm import queries

NAMES = [*queries.OPERATORS, "pipeline"]


def test_every_corpus_query_is_registered():
    registered, sql = E.queries(), E.oracle_sql()
    assert set(NAMES) <= set(registered) and set(queries.SQL) <= set(sql)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.OPERATORS) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "decontamination", "mixing", "sharding"]


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for t in ["documents", "pages", "benchmark", "conversations"]:
        spark.read.parquet(f"{SMOKE}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return d


@pytest.mark.parametrize("name", NAMES)
def test_query_on_empty_tables(spark, empty_dir, name):
    assert E.queries()[name](spark, empty_dir).collect() == []
