"""Benchmark decontamination by SimHash over item-sized windows.

Text is lower-cased (ASCII and Latin-1) words of letters and digits; a passage is the multiset of
its 5-word shingles.  For every benchmark item, windows of the item's length
slide over the whole document.  A window and an item of equal length can only
reach the similarity t if 2t/(1+t) of the window's shingles are the
benchmark's, so other windows are never fingerprinted; the rest get a 64-bit
SimHash of their weighted shingles.  Fingerprints meet through a multi-index:
four blocks of 16 bits, and every item with a block within a quarter of the
radius is a candidate, which finds all fingerprints within the radius
(pigeonhole); there is one multi-index per item length.  Candidates are verified by the exact weighted Jaccard
similarity of the shingle multisets.

A document shorter than an item is itself the window, as an item that was cut
off.  It is similar only if its shingles are at least t of the item's in number
and t/(1+t) of both are shared, so few items come into question; they are
looked up by their shingles, without fingerprints.

The benchmark reaches the tasks in blocks of at most BLOCK_WORDS words, one
pass each in the same stage; nothing is shuffled and documents are never cut.

Defined cases: null or empty texts and items match nothing; an item of fewer
than five words is one shingle and matches where its words occur in a row;
items of equal text are all reported; rows of a null item_id are ignored;
repeated documents are judged alike; empty tables give empty or clean results;
input columns that bear an output name are replaced (in ``keep_clean`` all
input columns come back as they were).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm import words as W
from threadlens.llm.shared import ship

#: Words of a shingle, least similarity, and radius of the fingerprints (a window of similarity t differs by 10 bits on average).
K, SIMILARITY, RADIUS = 5, 0.8, 19
#: Benchmark words that one pass holds in memory (some 100 bytes each).
BLOCK_WORDS = 1_000_000
BLOCKS = 4
#: Window starts of a stretch of text that is fingerprinted at once.
CHUNK_WINDOWS = 4096

_POP = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)
LEAKS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()),
                                  T.StructField("word", T.LongType()), T.StructField("words", T.LongType())]))


def bit_sums(grams: np.ndarray) -> np.ndarray:
    """(64, n + 1) running counts of each fingerprint bit over a run of shingles."""
    spread = W.mix64(grams ^ np.uint64(0x5851F42D4C957F2D))
    out = np.zeros((64, len(grams) + 1), np.int32)
    np.cumsum((spread[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1), axis=1, out=out[:, 1:])
    return out


def simhash(sums: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """64-bit SimHash of windows of ``size`` consecutive shingles: a shingle weighs as often as it occurs."""
    ones = sums[:, starts + size] - sums[:, starts]
    return ((2 * ones > size).astype(np.uint64) << np.arange(64, dtype=np.uint64)[:, None]).sum(axis=0, dtype=np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two multisets of shingles."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    both = int(np.minimum(ca[i], cb[j]).sum())
    return both / (len(a) + len(b) - both) if len(a) + len(b) > both else 0.0


@dataclass
class Index:
    """The multi-index of the items of one length."""

    length: int  # words
    ids: np.ndarray
    grams: list[np.ndarray]
    prints: np.ndarray
    blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # distinct values, first, items in order of value
    held: tuple[np.ndarray, np.ndarray]  # distinct shingles of each item in order, and their items

    def holders(self, grams: np.ndarray, enough: int) -> np.ndarray:
        """Items that may share ``enough`` shingles, counted as often as in ``grams``."""
        own, many = np.unique(grams, return_counts=True)
        lo, hi = (np.searchsorted(self.held[0], own, side) for side in ("left", "right"))
        size = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
        return np.flatnonzero(np.bincount(self.held[1][at], np.repeat(many, size), len(self.ids)) >= enough)

    def candidates(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, through the blocks."""
        near = radius // BLOCKS
        found = []
        for b, (values, first, items) in enumerate(self.blocks):
            own = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            w, v = np.nonzero(_POP[own[:, None] ^ values[None, :]] <= near)
            many = first[v + 1] - first[v]
            at = np.repeat(first[v] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(int(many.sum()))
            found.append(np.repeat(w, many) * len(self.ids) + items[at])
        pairs = np.unique(np.concatenate(found))
        w, i = pairs // len(self.ids), pairs % len(self.ids)
        x = prints[w] ^ self.prints[i]
        far = sum(_POP[((x >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)].astype(np.int64) for b in range(BLOCKS))
        return w[far <= radius], i[far <= radius]


@dataclass
class Items:
    """One block of the benchmark: an index per length, and the sorted shingles of all items."""

    lengths: list[Index]
    vocabulary: np.ndarray


def index_of(length: int, ids: list[int], grams: list[np.ndarray]) -> Index:
    prints = np.array([simhash(bit_sums(g), np.zeros(1, np.int64), len(g))[0] for g in grams], np.uint64)
    blocks = []
    for b in range(BLOCKS):
        own = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
        order = np.argsort(own, kind="stable")
        values, first = np.unique(own[order], return_index=True)
        blocks.append((values, np.append(first, len(own)), order))
    distinct = [np.unique(g) for g in grams]
    flat, item = np.concatenate(distinct), np.repeat(np.arange(len(grams)), [len(g) for g in distinct])
    order = np.argsort(flat, kind="stable")
    return Index(length, np.array(ids, np.int64), grams, prints, blocks, (flat[order], item[order]))


def build_items(ids: list[int], texts: list[str], k: int = K) -> Items | None:
    found = _words(*W.buffers(pa.array(texts, pa.string())))
    by_length: dict[int, tuple[list[int], list[np.ndarray]]] = {}
    for i in range(len(ids)):
        own = found.of(i)
        if len(own):
            kept = by_length.setdefault(len(own), ([], []))
            kept[0].append(ids[i])
            kept[1].append(W.shingles(own, k))
    if not by_length:
        return None
    return Items([index_of(n, *by_length[n]) for n in sorted(by_length)], np.unique(np.concatenate([g for _, gs in by_length.values() for g in gs])))


def _words(data: np.ndarray, offsets: np.ndarray) -> W.Words:
    at = np.flatnonzero(data[:-1] == 0xC3) + 1
    at = at[(data[at] >= 0x80) & (data[at] <= 0x9E) & (data[at] != 0x97)]
    if len(at):  # capital Latin-1 letters
        data = data.copy()
        data[at] += 0x20
    return W.find_words(data, offsets, W.PUNCT, lower=True)


def search(words: np.ndarray, items: Items, hit: np.ndarray, k: int, least: float, radius: int) -> dict[int, tuple[float, int, int]]:
    """item -> (similarity, first word, words) of its best window in one document.

    ``hit`` marks the positions whose k-word shingle is the benchmark's (for
    lengths of at least k).
    """
    best: dict[int, tuple[float, int, int]] = {}
    n, whole = len(words), None
    total = np.concatenate([[0], np.cumsum(hit)])
    asked = []  # (index, shingles, window starts) of each length with a window that may be similar
    for index in items.lengths:
        size = max(index.length - k + 1, 1)
        if index.length > n:  # the whole document is the window
            if n < k or n - k + 1 < least * size - 1e-9:
                break
            enough = math.ceil(least / (1 + least) * (size + n - k + 1) - 1e-9)
            if total[-1] < enough:
                break
            whole = W.shingles(words, k) if whole is None else whole
            for i in index.holders(whole, enough).tolist():
                s, item = similarity(whole, index.grams[i]), int(index.ids[i])
                if s >= least and s > best.get(item, (0.0,))[0]:
                    best[item] = (s, 0, n)
            continue
        if index.length < k:
            grams = W.shingles(words, index.length)
            starts = np.flatnonzero(np.isin(grams, items.vocabulary))
        else:
            enough = math.ceil(2 * least / (1 + least) * size - 1e-9)
            if total[-1] < enough:
                continue
            whole = W.shingles(words, k) if whole is None else whole
            grams = whole
            starts = np.flatnonzero(total[size: n - k + 2] - total[: n - k + 2 - size] >= enough)
        if len(starts):
            asked.append((index, grams, size, starts))
    # windows of all lengths share the bit counts of a stretch of the text
    for at in sorted({int(c) for *_, starts in asked for c in np.unique(starts // CHUNK_WINDOWS)}):
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for index, grams, size, starts in asked:
            own = starts[(starts >= at * CHUNK_WINDOWS) & (starts < (at + 1) * CHUNK_WINDOWS)]
            if not len(own):
                continue
            if id(grams) not in sums:
                mine = [(s[s // CHUNK_WINDOWS == at], m) for _, g, m, s in asked if g is grams]
                lo, hi = min(int(s[0]) for s, _ in mine if len(s)), max(int(s[-1]) + m for s, m in mine if len(s))
                sums[id(grams)] = lo, bit_sums(grams[lo:hi])
            lo, counts = sums[id(grams)]
            w, found = index.candidates(simhash(counts, own - lo, size), radius)
            for x, i in zip(own[w].tolist(), found.tolist()):
                s, item = similarity(grams[x: x + size], index.grams[i]), int(index.ids[i])
                if s >= least and s > best.get(item, (0.0,))[0]:
                    best[item] = (s, x, index.length)
    return best


def _pass(index, k: int, least: float, radius: int, at: int):
    """A pass over documents that adds what one block of the benchmark finds to the leaks so far."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = index.value
        for batch in batches:
            data, offsets = W.buffers(batch.column(at))
            found: list[list[dict]] = []
            for lo, hi in W.slices(offsets):
                words = _words(data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
                hits = _hits(words.hashes, items.vocabulary, k)
                short = items.lengths[0].length < k
                for i in range(hi - lo):
                    own = words.of(i)
                    hit = hits[words.first[i]: max(words.first[i + 1] - k + 1, words.first[i])]
                    got = search(own, items, hit, k, least, radius) if len(own) and (short or hit.any()) else {}
                    found.append([{"item_id": x, "similarity": s, "word": w, "words": m} for x, (s, w, m) in sorted(got.items())])
            new = pa.array(found, _LEAKS)
            old = batch.column(batch.num_columns - 1)
            new = pa.array([a + b for a, b in zip(old.to_pylist(), found)], _LEAKS) if old.null_count == 0 and len(old.flatten()) else new
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], new], names=batch.schema.names)

    return run


_LEAKS = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("word", pa.int64()), ("words", pa.int64())]))


def _hits(words: np.ndarray, vocabulary: np.ndarray, k: int) -> np.ndarray:
    """Whether the k words from each position on are a shingle of the benchmark (positions near the end: no)."""
    out = np.zeros(len(words), bool)
    if len(words) >= k:
        grams = W.shingles(words, k)
        at = np.minimum(np.searchsorted(vocabulary, grams), len(vocabulary) - 1)
        out[: len(grams)] = vocabulary[at] == grams
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, k: int = K, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``docs`` (with a column ``text``) and ``leaks``: the items found, with similarity and place of the best window."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.where("item_id is not null and text is not null").select("item_id", "text")
    words = items.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(words / 2 / BLOCK_WORDS))
    out = docs.drop("leaks").withColumn("leaks", F.array().cast(LEAKS))
    at = out.columns.index("text")
    for b in range(n):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id").toArrow() if n > 1 else items.orderBy("item_id").toArrow()
        held = build_items(own["item_id"].to_pylist(), own["text"].to_pylist(), k)
        if held is not None:
            out = out.mapInArrow(_pass(spark.sparkContext.broadcast(held), k, least, radius, at), out.schema)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a leak, with the columns of ``docs``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "text")
    return find_leaks(rows, benchmark).where(F.size("leaks") == 0).select("_row.*")


def op1_simhash_decontam(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, leaked, n_items, item_ids (ascending, comma-joined) and best similarity of every document."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark)
    ids = F.array_sort(F.array_distinct(F.transform("leaks", lambda x: x["item_id"])))
    return found.select(
        "doc_id", (F.size("leaks") > 0).alias("leaked"), F.size(ids).cast("long").alias("n_items"),
        F.concat_ws(",", F.transform(ids, lambda x: x.cast("string"))).alias("item_ids"),
        F.coalesce(F.array_max(F.transform("leaks", lambda x: x["similarity"])), F.lit(0.0)).alias("similarity"))
