import collections
import random

import numpy as np
import pytest

from tests.llm.cases import SCHEMA, WORDS, awkward, empty, row, table
from threadlens.llm import ngram_join as J

LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, k=4):
    words = WORDS.findall((text or "").translate(LOWER))
    return frozenset(zip(*[words[i:] for i in range(k)])) if len(words) >= k else frozenset([tuple(words)] if words else [])


def brute(texts, k=4, percent=85):
    """doc -> (set size, smallest reachable id, links) from all pairs."""
    sets = {i: shingle_set(t, k) for i, t in texts.items()}
    root, degree = {i: i for i in sets}, collections.Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                continue
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                degree[i] += 1
                degree[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), degree[i]) for i in sets}


def copies(n_bases, each, edits, seed):
    rng, out = random.Random(seed), {}
    for b in range(n_bases):
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa mu nu".split()) + str(rng.randrange(40)) for _ in range(rng.randrange(5, 120))]
        for _ in range(each):
            own = words[:]
            for _ in range(rng.randrange(edits + 1)):
                at, how = rng.randrange(len(own)), rng.random()
                if how < 0.5:
                    own[at] = f"new{rng.randrange(999)}"
                elif how < 0.75 and len(own) > 1:
                    del own[at]
                else:
                    own.insert(at, f"put{rng.randrange(999)}")
            out[len(out)] = " ".join(own)
    return out


def run(spark, texts, **how):
    docs = spark.createDataFrame([row(i, t) for i, t in texts.items()], SCHEMA)
    return {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in J.similar(docs, **how).collect()}


def test_query_equals_brute_force_on_given_rows(spark):
    docs = table(spark, "documents", "sf0.01")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in J.op8_ngram_jaccard(docs).collect()} == brute(texts)


def test_edited_copies_equal_brute_force(spark):
    texts = copies(12, 14, 5, 1)
    assert run(spark, texts) == brute(texts)
    assert run(spark, texts, k=5, percent=80) == brute(texts, 5, 80)


def test_large_groups_are_cut_into_blocks_without_loss(spark, monkeypatch):
    texts = copies(3, 60, 4, 2)
    monkeypatch.setattr(J, "BLOCK_NODES", 9)
    assert run(spark, texts) == brute(texts)


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_cut_groups_link_shorter_and_longer_copies(spark, monkeypatch, percent):
    texts = copies(3, 30, 3, 5)
    for words in (21, 30, 60, 90, 399):
        longer = words * 100 // percent
        own = [f"w{words}x{i}" for i in range(longer + 4)]  # 5-word shingles: n + 4 words
        for text in (own, own[: words + 4], own[longer - words:]):
            texts[len(texts)] = " ".join(text)
    want = brute(texts, 5, percent)
    monkeypatch.setattr(J, "BLOCK_NODES", 1)
    assert run(spark, texts, k=5, percent=percent) == want
    assert all(want[i][2] for i in range(90, len(texts)))  # the shorter and the longer copies are links


def test_keys_share_an_adjacent_pair():
    rng, excess = np.random.default_rng(0), np.zeros(1 << J.SKETCH_BITS)
    excess[rng.integers(0, len(excess), len(excess) // 10)] = 500
    checked = 0
    for _ in range(3000):
        both, x, y = int(rng.integers(5, 80)), int(rng.integers(0, 9)), int(rng.integers(0, 9))
        if 100 * both < 85 * (both + x + y) or x + y == 0:
            continue
        draw = rng.integers(0, 1 << 63, both + x + y, dtype=np.uint64) * np.uint64(2)
        a, b = np.unique(draw[: both + x]), np.unique(np.concatenate([draw[:both], draw[both + x:]]))
        assert len(np.intersect1d(J.keys(a, excess), J.keys(b, excess)))
        (pa, la), (pb, lb) = J.prefix(a, excess), J.prefix(b, excess)
        assert len(np.intersect1d(pa, pb)) >= min(la, lb)
        checked += 1
    assert checked > 300


def test_costly_prefixes_ask_for_more_matches():
    s = np.unique(np.random.default_rng(4).integers(0, 1 << 63, 100, dtype=np.uint64) * np.uint64(2))
    plain, hot = np.zeros(1 << J.SKETCH_BITS), np.full(1 << J.SKETCH_BITS, 1000.0)
    assert J.prefix(s, plain)[1] == 1 and J.prefix(s, hot)[1] > 4
    assert len(J.prefix(s, hot)[0]) == len(J.prefix(s, plain)[0]) + J.prefix(s, hot)[1] - 1


def test_overlaps_equal_intersections(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, int(rng.integers(1, 40))).astype(np.uint64)) for _ in range(20)] + [np.zeros(0, np.uint64)]
    want = [[len(np.intersect1d(a, b)) if i != j else None for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    for cells in (J.CELLS, 100):
        monkeypatch.setattr(J, "CELLS", cells)
        got = J.overlaps(sets)
        assert all(got[i, j] == want[i][j] for i in range(21) for j in range(21) if i != j)


def test_awkward_rows(spark):
    got = J.op8_ngram_jaccard(awkward(spark)).collect()
    assert len(got) == 13
    for r in got:
        if r.doc_id in (1, 2, 3):
            assert (r.n_shingles, r.component_id, r.n_links) == (0, r.doc_id, 0)
        if r.doc_id in (4, 5, 6):
            assert r.component_id == 4
    assert sorted((r.component_id for r in got if r.doc_id is None), key=str) == [4, None]
    kept = J.one_of_each(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 7, 8, 9, None, None], key=str)  # 10 repeats the text of 4
    assert J.op8_ngram_jaccard(empty(spark)).count() == 0 and J.one_of_each(empty(spark)).count() == 0


@pytest.mark.parametrize("text,n", [("a", 1), ("a b c", 1), ("a b c d", 1), ("a b c d e", 2), ("a a a a a", 1)])
def test_short_texts(text, n):
    import pyarrow as pa
    assert len(next(J.doc_sets(pa.array([text]), 4))) == n


def test_an_id_with_several_texts_is_linked_through_all_of_them(spark):
    """Id 5 has two texts; copies of the second are 7 and 8, near copies of the first 1 and 2."""
    words = [f"w{i}" for i in range(400)]
    one, two, alone = " ".join(words[:120]), " ".join(words[200:330]), " ".join(words[340:400])
    near = " ".join([*words[:119], "other"])
    rows = [row(5, one), row(5, two), row(7, two), row(8, two), row(1, near), row(2, near), row(3, alone), row(9, alone), row(9, two), row(11, "x y"), row(11, one)]
    got = collections.defaultdict(set)
    for r in J.op8_ngram_jaccard(spark.createDataFrame(rows, SCHEMA)).collect():
        got[r.doc_id].add(r.component_id)
    assert got == {i: {1} for i in (1, 2, 3, 5, 7, 8, 9, 11)}
