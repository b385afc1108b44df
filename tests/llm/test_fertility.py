import collections
import re

import pytest

from tests.llm.cases import PROSE, WORDS, awkward, empty, row, SCHEMA, table
from threadlens.llm import fertility as Q


def brute(text):
    words = WORDS.findall(text or "")
    windows = collections.Counter(tuple(words[i: i + 5]) for i in range(len(words) - 4))
    again = {j for i in range(len(words) - 4) if windows[tuple(words[i: i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(again)


def check_base(rows, texts):
    for r in rows:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_base_figures_equal_brute_force(spark):
    docs = table(spark, "documents", "sf0.01")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = Q.op2_token_fertility(docs).collect()
    assert len(got) == len(texts)
    check_base(got, texts)
    labels = {r.doc_id: r.quality for r in table(spark, "labels", "sf0.01").collect()}
    good = [r.kept for r in got if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in got if labels.get(r.doc_id) == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.5


def test_junk_that_the_base_rules_leave_is_rejected_by_kind(spark):
    docs = table(spark, "documents", "sf0.1")
    labels = {r.doc_id: r.quality for r in table(spark, "labels", "sf0.1").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in labels}
    kept = collections.defaultdict(list)
    for r in Q.op2_token_fertility(docs.repartition(16)).collect():
        if r.doc_id in labels and not r.base_failed:
            text = texts[r.doc_id]
            junk = "table" if len(re.findall(r" \| ", text)) > 5 else "symbols" if re.search(r"[#%$*&<>!]{3}", text) else "other"
            kept["good" if labels[r.doc_id] else junk].append(r.kept)
    share = {k: sum(v) / len(v) for k, v in kept.items()}
    assert len(kept["table"]) > 100 and len(kept["symbols"]) > 100 and len(kept["good"]) > 3000
    assert share["good"] > 0.99 and share["table"] < 0.25 and share["symbols"] < 0.05


def test_measures_equal_whole_text_tokenisation(monkeypatch):
    import numpy as np
    import pyarrow as pa
    vocab = Q.vocabularies(Q.TOKENIZERS)
    texts = [f"{PROSE}. {PROSE}\nété 漢字 \U0001f600", "x" * 300 + " y z " * 100]
    whole = Q.measure(pa.array(texts), Q.TOKENIZERS)
    for text, pieces, share, tokens, h in zip(texts, whole["piece_fertility"], whole["byte_share"], whole["n_tokens"], whole["entropy"]):
        ids = [i for w in WORDS.findall(text) for i in vocab.pieces.encode(w)]
        words = WORDS.findall(text)
        assert pieces == pytest.approx((sum(map(len, words)) + len(words)) / len(ids))
        assert share == pytest.approx(np.mean([vocab.pieces.is_byte(i) for i in ids]))
        own = vocab.bytes.encode_ordinary(text)
        p = np.array(list(collections.Counter(own).values())) / len(own)
        assert tokens == len(own) and h == pytest.approx(float(-(p * np.log2(p)).sum()))
    monkeypatch.setattr(Q, "PART_CHARS", 64)
    assert "".join(Q.parts(texts[0] * 5)) == texts[0] * 5
    assert Q.measure(pa.array(texts[:1]), Q.TOKENIZERS)["n_tokens"] == whole["n_tokens"][:1]


def test_bands_reject_odd_texts_and_keep_the_rest(spark):
    base = [r.text for r in table(spark, "documents", "sf0.01").where("lang = 'en' and n_chars between 600 and 3000").limit(120).collect()]
    rows = [row(i, t) for i, t in enumerate(base)] + [row(900, " ".join(f"{w}%%%###" for w in base[0].split())), row(901, " ".join("qxz%d" % (i % 7) for i in range(300)))]
    got = {r.doc_id: r for r in Q.op2_token_fertility(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not got[900].kept and not got[901].kept
    kept = [got[i].kept for i, t in enumerate(base) if not got[i].base_failed and "!!" not in t and "%%%" not in t and "###" not in t]
    assert sum(kept) >= 0.97 * len(kept)


def test_awkward_rows(spark):
    got = Q.op2_token_fertility(awkward(spark)).collect()
    assert len(got) == 13
    check_base([r for r in got if r.doc_id], {r.doc_id: r.text for r in awkward(spark).collect()})
    for r in got:
        if r.doc_id in (1, 2, 3, 8):
            assert r.base_failed and not r.kept
        if r.doc_id in (4, 5, 6):
            assert r.kept  # too few alike texts for bands
    kept = Q.keep_good(awkward(spark))
    assert kept.columns == awkward(spark).columns and {r["a b"] for r in kept.collect()} == {"x"}
    assert Q.op2_token_fertility(empty(spark)).count() == 0 and Q.keep_good(empty(spark)).count() == 0
