import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import WORDS
from threadlens.llm import words as W

TEXT = st.lists(st.one_of(st.none(), st.text(alphabet="ab É\n\t\x0b😀 .", max_size=40)), max_size=8)


@given(TEXT)
@settings(max_examples=200, deadline=None)
def test_words_equal_the_pattern(texts):
    data, offsets = W.buffers(pa.array(texts, pa.string()))
    found = W.find_words(data, offsets)
    assert len(offsets) == len(texts) + 1
    for i, text in enumerate(texts):
        want = [w.encode() for w in WORDS.findall(text or "")]
        got = [data[a:b].tobytes() for a, b in zip(found.starts, found.ends)][found.first[i]: found.first[i + 1]]
        assert got == want
        assert len(set(found.of(i).tolist())) == len(set(want))


def test_hashes_follow_the_word_not_its_place():
    texts = ["alpha beta", "x beta alpha", None, "Alpha"]
    for slice_at in (0, 1):
        column = pa.array(texts, pa.string())[slice_at:]
        found = W.find_words(*W.buffers(column), lower=True)
        words = [w for t in texts[slice_at:] for w in (t or "").lower().split()]
        by_word = {}
        for w, h in zip(words, found.hashes.tolist()):
            assert by_word.setdefault(w, h) == h


def test_shingles_of_short_and_long():
    words = np.arange(10, dtype=np.uint64)
    assert len(W.shingles(words, 4)) == 7 and len(W.shingles(words[:2], 4)) == 1 and len(W.shingles(words[:0], 4)) == 0
    assert W.shingles(words[3:7], 4)[0] == W.shingles(words, 4)[3]


def test_slices_cover_all_rows():
    offsets = np.array([0, 0, 5, 5, 100, 101, 101])
    assert [r for lo, hi in W.slices(offsets, 10) for r in range(lo, hi)] == list(range(6))
