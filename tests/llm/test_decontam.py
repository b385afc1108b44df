import collections
import re

import numpy as np
import pytest

from tests.llm.cases import PROSE, awkward, empty, row, SCHEMA, table
from threadlens.llm import decontam as D

WORD = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")


def brute(text, items, least=0.8):
    """item ids whose best window of equal length is similar enough, by counting."""
    words, out = WORD.findall((text or "").lower()), {}
    for item, content in items:
        own = WORD.findall((content or "").lower())
        n, k = len(own), min(5, len(own))
        if not n:
            continue
        a = collections.Counter(zip(*[own[i:] for i in range(k)]))
        for s in range(len(words) - n + 1):
            b = collections.Counter(zip(*[words[s: s + n][i:] for i in range(k)]))
            both = sum((a & b).values())
            j = both / (sum(a.values()) + sum(b.values()) - both)
            if j >= least:
                out[item] = max(out.get(item, 0), j)
    return out


def test_query_equals_brute_force_on_planted_and_given_rows(spark):
    items = [(r.item_id, r.text) for r in table(spark, "benchmark").collect()]
    rng, rows = np.random.default_rng(3), []
    for i in range(60):
        words = items[i % len(items)][1].split()
        for _ in range(i % 4):
            words[int(rng.integers(len(words)))] = "changed"
        rows.append(row(1000 + i, f"{PROSE} {' '.join(words).upper()}! {PROSE}"))
    docs = spark.createDataFrame(rows, SCHEMA).select("doc_id", "text").union(table(spark, "documents").select("doc_id", "text"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = 0
    for r in D.op1_simhash_decontam(docs, table(spark, "benchmark")).collect():
        want = brute(texts[r.doc_id], items) if r.doc_id >= 1000 or r.leaked else {}
        if r.doc_id >= 1000 or r.leaked:
            assert r.item_ids == ",".join(map(str, sorted(want))), r.doc_id
            assert r.similarity == pytest.approx(max(want.values(), default=0))
            found += bool(want)
    assert found > 20


def test_documents_shorter_than_an_item_are_the_window(spark):
    items = [(r.item_id, r.text) for r in table(spark, "benchmark").collect()]
    items += [(9000, "a b c d e f g a b c d e f g a b c d e f g"), (9001, "one two three four five six seven eight nine"), (9002, "one two three four")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rng, texts = np.random.default_rng(5), ["one two three four five six seven eight", "one two three", "two three four five six seven eight nine", "one two three four five six"]
    for i, (_, text) in enumerate(items[:40] + items[-3:-2]):
        own = text.split()
        for cut in (1, 2, 4, 7):
            texts += [" ".join(own[cut:]), " ".join(own[:-cut])]
        own[int(rng.integers(len(own)))] = "changed"
        texts += [" ".join(own[1:]), " ".join(own[1:-1])]
    asked = [[(item, WORD.findall(text.lower())) for item, text in items], [WORD.findall(t.lower()) for t in texts]]
    found = 0
    for r in D.op1_simhash_decontam(spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], SCHEMA), bench).collect():
        words, want = asked[1][r.doc_id], brute(texts[r.doc_id], items)
        for item, own in asked[0]:
            if len(words) < len(own) and len(words) >= 5:
                a, b = (collections.Counter(zip(*[x[i:] for i in range(5)])) for x in (own, words))
                j = sum((a & b).values()) / sum((a | b).values())
                if j >= 0.8:
                    want[item], found = j, found + 1
        assert r.item_ids == ",".join(map(str, sorted(want))), texts[r.doc_id]
        assert r.similarity == pytest.approx(max(want.values(), default=0))
    assert found > 100


def test_blocks_find_every_fingerprint_within_the_radius(monkeypatch):
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    monkeypatch.setattr(D, "simhash", lambda sums, starts, size: sums)
    monkeypatch.setattr(D, "bit_sums", lambda g: g)
    index = D.index_of(9, list(range(300)), [np.array([x]) for x in prints])
    asked = prints[:100].copy()
    for i in range(100):
        for bit in rng.choice(63, int(rng.integers(0, 26)), replace=False):
            asked[i] ^= np.uint64(1) << np.uint64(bit)
    want = {(w, i) for w in range(100) for i in range(300) if bin(int(asked[w] ^ prints[i])).count("1") <= D.RADIUS}
    assert set(zip(*[x.tolist() for x in index.candidates(asked, D.RADIUS)])) == want


def test_small_blocks_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    one = {tuple(r) for r in D.op1_simhash_decontam(docs, bench).collect()}
    monkeypatch.setattr(D, "BLOCK_WORDS", 2500)
    assert {tuple(r) for r in D.op1_simhash_decontam(docs, bench).collect()} == one


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, " ".join(PROSE.split()[:16])), (2, None), (None, PROSE), (3, ""), (4, "lazy dog"), (5, "lazy dog")], "item_id long, text string")
    got = D.op1_simhash_decontam(awkward(spark), bench).collect()
    assert len(got) == 13
    for r in got:
        if r.doc_id in (4, 5, 6, 7, 10):
            assert r.item_ids == "1,4,5"
        if r.doc_id in (1, 2, 3, 8, 9):
            assert not r.leaked and r.item_ids == "" and r.similarity == 0
    kept = D.keep_clean(awkward(spark), bench)
    assert kept.columns == awkward(spark).columns and kept.count() == 6
    assert D.op1_simhash_decontam(empty(spark), bench).count() == 0
    assert not any(r.leaked for r in D.op1_simhash_decontam(awkward(spark), bench.limit(0)).collect())
