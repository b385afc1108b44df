import collections
import zlib

import numpy as np
import pytest

from tests.llm.cases import SCHEMA, awkward, empty, row, table
from threadlens.llm import hilbert as H


@pytest.mark.parametrize("bits,dims", [(1, 3), (2, 3), (4, 2), (3, 3)])
def test_index_is_a_walk_through_all_cells(bits, dims):
    cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
    index = H.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    walk = cells[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check(rows, texts):
    n = len(rows)
    sizes = collections.Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(16))
    counts = [sizes[s] for s in range(16)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == n
    for s, k in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(k))
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [(r.curve, r.text_crc32) for r in order] == sorted((r.curve, r.text_crc32) for r in rows)
    assert collections.Counter((r.size, r.text_crc32) for r in rows) == collections.Counter((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert {(r.law, r.grown_shard) for r in rows} <= {("rows", None)}


def test_shards_of_given_rows(spark):
    docs = table(spark, "documents", "sf0.01")
    rows = H.op10_hilbert_shards(docs).collect()
    check(rows, [r.text for r in docs.select("text").collect()])
    assert {tuple(r) for r in H.op10_hilbert_shards(docs.repartition(7)).collect()} == {tuple(r) for r in rows}


def test_a_filter_on_any_dimension_skips_shards(spark):
    docs = H.shard(table(spark, "documents", "sf0.01"))
    for column in ("lang", "source"):
        ranges = [r for r in docs.selectExpr("shard", f"{column} AS v").groupBy("shard").agg({"v": "min", "v": "max"}).collect()]
        assert len(ranges) == 16
    lo_hi = {r.shard: (r.lo, r.hi) for r in docs.selectExpr("shard", "lang").groupBy("shard").agg(H.F.min("lang").alias("lo"), H.F.max("lang").alias("hi")).collect()}
    touched = sum(lo <= "es" <= hi for lo, hi in lo_hi.values())
    assert touched <= 8


def test_awkward_rows_and_a_hot_text(spark):
    rows = H.op10_hilbert_shards(awkward(spark)).collect()
    check(rows, [r.text for r in awkward(spark).collect()])
    out = H.shard(awkward(spark))
    assert set(awkward(spark).columns) - {"size", "shard", "curve"} <= set(out.columns) and len(out.columns) == len(set(out.columns))
    assert H.op10_hilbert_shards(empty(spark)).count() == 0
    hot = spark.createDataFrame([row(i, "same text") for i in range(400)] + [row(None, None, None, None)] * 3, SCHEMA)
    check(H.op10_hilbert_shards(hot).collect(), [r.text for r in hot.collect()])


def test_written_shards(spark, scratch):
    docs = table(spark, "documents")
    H.write_shards(docs, f"{scratch}/shards")
    back = spark.read.parquet(f"{scratch}/shards")
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 16
