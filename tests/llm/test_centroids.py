import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.cases import SCHEMA, awkward, empty, row, table
from threadlens.llm import centroids as L


def test_held_out_accuracy_and_inputs(spark):
    docs = table(spark, "documents", "sf0.01")
    rows = {r.doc_id: r for r in L.op9_centroid_language(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    out = [i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(rows[i].held_out == (i in set(out)) for i in rows)
    assert np.mean([rows[i].lang_pred == lang[i] for i in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())
    # languages of held-out documents don't matter
    changed = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    assert {tuple(r) for r in L.op9_centroid_language(changed).collect()} == {tuple(r) for r in rows.values()}


def test_counts_equal_a_loop():
    text = "ab C\U000000e9 d"
    data = np.frombuffer(text.encode(), np.uint8)
    got = L.counts(np.concatenate([data, data]), np.array([0, len(data), 2 * len(data)]))
    t = [int(L._LETTERS[b]) for b in data]
    want = np.zeros(1 << L.BITS, int)
    for n in (1, 2, 3):
        for i in range(len(t) - n + 1):
            g = t[i: i + n]
            if (n == 1 and g[0] != 32) or (n == 2 and set(g) != {32}) or (n == 3 and g[1] != 32):
                code = np.array([sum(b << (8 * j) for j, b in enumerate(g))], np.uint32)
                want[L._cell(code, n)[0]] += 1
    assert (got[0] == want).all() and (got[1] == want).all()


def test_clusters_and_rejection(spark):
    x = np.eye(6, dtype=np.float32)[[0, 0, 0, 1, 1, 2, 3]]
    c, r = L.cluster(x, 3)
    assert len(c) == 3 and len(r) == 3 and (r >= -1e-6).all()
    docs = table(spark, "documents", "sf0.01")
    model = L.learn(docs)
    odd = spark.createDataFrame([row(1, "qqqzzzxxx jjjkkkwww " * 30), row(2, docs.where("lang = 'de'").first().text)], SCHEMA)
    got = {r.doc_id: r for r in L.identify(odd, model).collect()}
    assert got[1].rejected and not got[2].rejected and got[2].lang_pred == "de"
    assert len(model.languages) > len(set(model.languages))


def test_awkward_rows(spark):
    got = L.op9_centroid_language(awkward(spark)).collect()
    assert len(got) == 13
    for r in got:
        if r.doc_id in (1, 2, 3):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert {r.lang_pred for r in got} <= {"und", "en", "fr"}
    none = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.op9_centroid_language(none).collect()} == {"und"}
    assert L.op9_centroid_language(empty(spark)).count() == 0
