import collections

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import PROSE, SCHEMA, WORDS, awkward, empty, row, table
from threadlens.llm import mixing as M


def filled(sizes, ratio=1.5, most=2, weights=(5, 2, 1)):
    """Targets by capping and resharing until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, done = ratio * sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in done]
        if not open_:
            return done
        level = (total - sum(done.values())) / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > most * sizes[s]]
        if not over:
            return done | {s: level * w[s] for s in open_}
        done |= {s: most * sizes[s] for s in over}


def check(rows, texts):
    sizes, taken, targets = collections.Counter(), collections.Counter(), {}
    for r, (text, source) in zip(rows, texts):
        assert r.size == len(WORDS.findall(text or ""))
        assert r.size == 0 or r.taken in (0, r.size, 2 * r.size)
        sizes[source] += r.size
        taken[source] += r.taken
        targets[source] = r.target
    want = filled(dict(sizes))
    largest = max((r.size for r in rows), default=0)
    for s in sizes:
        assert targets[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= largest


def test_targets_and_words_taken(spark):
    docs = table(spark, "documents", "sf0.01")
    by = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    rows = M.op5_source_mix(docs).collect()
    check(rows, [by[r.doc_id] for r in rows])
    assert {tuple(r) for r in M.op5_source_mix(docs.repartition(5)).collect()} == {tuple(r) for r in rows}


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 10, "b": 1000, "c": 5}, {"a": 0, "b": 7, None: 9}, {"b": 1, "a": 1, "c": 1, "d": 500, "e": 3}])
def test_filling_equals_repeated_resharing(spark, sizes):
    masses = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in M.source_targets(masses).collect()}
    assert got == pytest.approx(filled(sizes))


def test_smaller_budget_takes_a_subset(spark):
    docs = table(spark, "documents", "sf0.01").select("doc_id", "source", M.word_count(F.col("text")).alias("size"), M.mixing_key(F.col("doc_id"), F.col("text")).alias("key"))
    masses = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    below = [{r.source: r.below for r in M.thresholds(docs, masses.withColumn("target", F.col("source_size") * share)).collect()} for share in (0.2, 0.5, 0.9)]
    assert all(below[0][s] <= below[1][s] <= below[2][s] for s in below[0])


def test_awkward_rows(spark):
    rows = M.op5_source_mix(awkward(spark)).collect()
    assert len(rows) == 13 and all(r.taken == 0 for r in rows if r.size == 0)
    assert len({r.taken for r in rows if r.doc_id == 5}) == 1
    out = M.repeat_taken(awkward(spark))
    assert out.columns == awkward(spark).columns
    want = collections.Counter({r.doc_id: 0 for r in rows})
    for r in rows:
        want[r.doc_id] += r.taken // r.size if r.size else 0
    assert collections.Counter(r.doc_id for r in out.collect()) == +want
    assert M.op5_source_mix(empty(spark)).count() == 0 and M.repeat_taken(empty(spark)).count() == 0


def test_hot_source_and_huge_document(spark):
    docs = spark.createDataFrame([row(i, PROSE, "en", "hot") for i in range(300)] + [row(1000, " ".join([PROSE] * 500), "en", "b"), row(1001, "one", "en", "b")], SCHEMA)
    by = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    rows = M.op5_source_mix(docs).collect()
    check(rows, [by[r.doc_id] for r in rows])
