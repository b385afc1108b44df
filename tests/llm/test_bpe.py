import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.cases import awkward, by_id, empty, table
from threadlens.llm import bpe as B

PATH = B.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def check(rows, texts, library):
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids)))), r.doc_id
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False)), r.doc_id


def test_documents_equal_the_library(spark, library):
    docs = table(spark, "documents", "sf0.01")
    rows = B.op11_bpe_backtrack(docs).collect()
    assert len(rows) == docs.count()
    check(rows, {r.doc_id: r.text for r in docs.collect()}, library)


def test_awkward_and_empty_tables(spark, library):
    docs = awkward(spark)
    rows = B.op11_bpe_backtrack(docs).collect()
    assert len(rows) == docs.count()
    check([r for r in rows if r.doc_id is not None], {k: r["text"] for k, r in by_id(docs).items()}, library)
    assert B.op11_bpe_backtrack(empty(spark)).count() == 0


ALPHABETS = ["ab", "aeinrst", "aàáâéñ ßΣσİıÅ", "🎉👍🏽漢字 かな한글", "<|>/w endoftx", "'stremdlv ", "!?.,-#*=_ ", "͸Ɤ\x1c\x85 a"]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.sampled_from(ALPHABETS).flatmap(lambda a: st.text(a, max_size=120))))
def test_any_text_equals_the_library(text):
    t = Tokenizer.from_file(PATH) if not hasattr(B, "_of_tests") else B._of_tests
    B._of_tests = t
    assert B.vocabulary(PATH).encode(text) == t.encode(text, add_special_tokens=False).ids


def test_special_strings_and_long_words(library):
    bpe = B.vocabulary(PATH)
    rng = random.Random(5)
    texts = ["<|endoftext|>a<|startoftext|>", "a<|endoftext|", "<|endoftext|>" * 3, "x" * 5000, "ab" * 3000,
             "".join(rng.choice("abcdeinorst") for _ in range(20_000)), "é" * 50]
    for text in texts:
        assert bpe.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_compatible_pairs_are_those_that_merging_keeps():
    """Merging by rank, written out plainly, against the pair table."""
    bpe = B.vocabulary(PATH)

    def merged(symbols):
        tokens = [bpe.token_of[s] for s in symbols]
        while True:
            found = [(bpe.join[p], i) for i, p in enumerate(zip(tokens, tokens[1:])) if p in bpe.join]
            if not found:
                return tokens
            rank, i = min(found)
            made = next(t for t, parts in bpe.parts.items() if parts == (tokens[i], tokens[i + 1])) if (tokens[i], tokens[i + 1]) not in made_of else made_of[tokens[i], tokens[i + 1]]
            tokens[i: i + 2] = [made]

    made_of = {parts: t for t, parts in bpe.parts.items()}
    spelled = {t: s for s, t in bpe.token_of.items()}
    inner = [t for t, s in spelled.items() if ord(s[-1]) < 256]
    rng = random.Random(9)
    for _ in range(3000):
        a, b = rng.choice(inner[:3000]), rng.choice(list(spelled)[:4000])
        assert bpe.compatible(a, b) == (merged(spelled[a] + spelled[b]) == [a, b])


def test_operators_keep_other_columns_and_round_trip(spark, library):
    docs = spark.createDataFrame([(1, "Hello  World", "x"), (2, None, "y"), (3, "", None)], "doc_id long, text string, ids string")
    out = B.decoded(B.encoded(docs, out="ids")).orderBy("doc_id").collect()
    assert out[0].ids == library.encode("Hello  World", add_special_tokens=False).ids
    assert [r.decoded for r in out] == [library.decode(out[0].ids, skip_special_tokens=False), "", ""]
    lists = spark.createDataFrame([(1, None), (2, [3306, 49407])], "k long, ids array<int>")
    assert [r.decoded for r in B.decoded(lists).orderBy("k").collect()] == ["", library.decode([3306, 49407], skip_special_tokens=False)]


def test_frequent_words_survive_a_full_cache(monkeypatch):
    from threadlens.llm import bpe

    monkeypatch.setattr(bpe, "CACHE_WORDS", 8)
    asked = []
    pieces = bpe.Pieces(lambda w: asked.append(w) or [len(w)])
    for i in range(40):
        assert list(pieces["often"]) == [5] and list(pieces[f"w{i}"]) == [len(f"w{i}")]
        assert len(pieces) + len(pieces.before) <= 8
    assert asked.count("often") == 1


def test_a_cache_holds_packed_ids_of_as_many_words_as_texts_bring(library):
    """Ids are kept as 32-bit integers (no tuple of numbers a word), and 140,000 words that come in turn are each encoded once."""
    bpe = B.Bpe(PATH)
    words = ["".join(chr(97 + n // 26 ** k % 26) for k in range(4)) + "qx" for n in range(140_000)]
    asked = []
    bpe.pieces.encode = lambda w: asked.append(w) or [len(w)]
    for _ in range(2):
        for at in range(0, len(words), 5000):
            bpe.encode(" ".join(words[at: at + 5000]))
    assert len(asked) == len(words)
    fresh, text = B.Bpe(PATH), "<|endoftext|>einpfkeitge and the, and <|startoftext|>"
    ids = library.encode(text, add_special_tokens=False).ids
    assert fresh.encode_packed(text) == B.packed(ids) and fresh.encode(text) == ids
    assert all(isinstance(v, bytes) for v in fresh.pieces.values())
