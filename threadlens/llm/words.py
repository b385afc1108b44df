"""Words, shingles and hashes of whole texts, vectorised over Arrow buffers.

A text column arrives as one UTF-8 buffer with offsets.  Separators are ASCII
bytes, so words are found on bytes without decoding; a null text has no words.
Work goes through slices of a few megabytes, so memory follows the largest
single text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once (a longer text is a slice of its own).
SLICE_BYTES = 1 << 20

_U = np.uint64
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_MULT = _U(0x9E3779B97F4A7C15)


def space_table() -> np.ndarray:
    """True at the separators of ``[^\\x20\\x09-\\x0D]+``."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def punct_table() -> np.ndarray:
    """True at every ASCII byte that is neither a letter nor a digit."""
    table = np.zeros(256, bool)
    table[:128] = [not chr(b).isalnum() for b in range(128)]
    return table


def lower_table() -> np.ndarray:
    """Bytes with A-Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


SPACE, PUNCT, LOWER = space_table(), punct_table(), lower_table()


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def powers(n: int, base: np.uint64 = _MULT) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offs, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset: column.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or one longer row."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


@dataclass
class Words:
    """Words of consecutive texts: byte ranges, hashes, and where each text's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # n_texts + 1

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i]: self.first[i + 1]]


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE, *, lower: bool = False, hashed: bool = True) -> Words:
    """All words of the texts in ``data``; a text's end also ends a word."""
    inside = ~separators[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = before[1:].copy()
    after[:-1] = inside[1:]
    if len(data):
        after[-1] = False
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    head = before[:-1].copy()
    head[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~head)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    if not hashed or not len(starts):
        return Words(starts, ends, np.zeros(0, np.uint64), first)
    at = np.flatnonzero(inside)
    lens = ends - starts
    begin = np.zeros(len(starts), np.int64)
    np.cumsum(lens[:-1], out=begin[1:])
    place = np.arange(len(at)) - np.repeat(begin, lens)
    chars = data[at]
    value = _BYTE[LOWER[chars] if lower else chars] * powers(int(lens.max()))[place]
    return Words(starts, ends, mix64(np.add.reduceat(value, begin) + lens.astype(np.uint64)), first)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows of one text, in order; with fewer words, of the whole sequence."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    weight = powers(k + 1, _U(0xD6E8FEB86659FD93))[1:]
    total = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        total += words[j: n - k + 1 + j] * weight[j]
    return mix64(total + _U(k))
