"""Language identification by nearest centroid.

A text is a vector of hashed 1- to 3-byte n-grams within words, weighted by
TF-IDF (document frequencies from all learning documents) and normalised.
Each language has several centroids, from spherical k-means over a bounded,
hash-chosen sample of its learning documents.  A text gets the language of the
centroid with the largest cosine; it is marked rejected where its distance
exceeds that centroid's radius, the largest distance seen in learning plus a
margin.

Learning reads only text and language of documents with a non-null language
whose crc32(doc_id) mod 4 is not 2.

Defined cases: a null text or one without a letter is ``und`` with score 0; a
null doc_id is never learned from and not held out; ties go to the language
that sorts first; without any learning document everything is ``und``; repeated
rows are predicted alike; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm import words as W
from threadlens.llm.shared import ship

#: Dimensions of the hashed n-grams; learning documents per language that are clustered; centroids per language.
BITS, SAMPLE, CENTROIDS = 12, 500, 4
#: Texts that are vectors at once.
CHUNK = 128
#: Margin on a centroid's radius.
MARGIN = 1.2

_LETTERS = np.where(W.PUNCT | np.isin(np.arange(256), np.arange(0x30, 0x3A)), 0x20, W.LOWER).astype(np.uint32)


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """n-gram counts (texts, dimensions) of a few texts."""
    n, dims = len(offsets) - 1, 1 << BITS
    t = _LETTERS[data]
    owner = np.repeat(np.arange(n), np.diff(offsets))
    word = t != 0x20
    code, valid = t, word
    cells = [_cell(code, 1)[valid] + owner[valid] * dims]
    if len(t) > 1:
        together = owner[1:] == owner[:-1]
        code = code[:-1] | t[1:] << np.uint32(8)
        valid = together & (word[:-1] | word[1:])
        cells.append(_cell(code, 2)[valid] + owner[:-1][valid] * dims)
    if len(t) > 2:
        code = code[:-1] | t[2:] << np.uint32(16)
        valid = together[:-1] & together[1:] & word[1:-1]
        cells.append(_cell(code, 3)[valid] + owner[:-2][valid] * dims)
    return np.bincount(np.concatenate(cells), minlength=n * dims).reshape(n, dims)


def _cell(code: np.ndarray, length: int) -> np.ndarray:
    return ((code * np.uint32(0x9E3779B1) + np.uint32(length * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35) >> np.uint32(32 - BITS)).astype(np.int64)


def _chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of a few texts at a time."""
    data, offsets = W.buffers(column)
    for lo, hi in W.slices(offsets):
        for at in range(lo, hi, CHUNK):
            to = min(at + CHUNK, hi)
            yield at, data[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at]


def has_letter(own: np.ndarray) -> bool:
    if (_ASCII_LETTER[own]).any():
        return True
    return bool((own >= 0x80).any()) and any(c.isalpha() for c in own.tobytes().decode("utf-8", "replace"))


_ASCII_LETTER = np.isin(np.arange(256), [*range(0x41, 0x5B), *range(0x61, 0x7B)])


def vectors(raw: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors of n-gram counts."""
    x = np.log1p(raw.astype(np.float32)) * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1e-12)


@dataclass
class Model:
    idf: np.ndarray
    languages: list[str]  # of each centroid, in order of name
    centroids: np.ndarray
    radius: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, cosine) of every vector."""
        cosine = x @ self.centroids.T
        best = np.argmax(cosine, axis=1)
        return best, np.clip(cosine[np.arange(len(x)), best], 0.0, 1.0)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, radii) of unit vectors: spherical k-means from the vectors farthest apart."""
    seeds = [int(np.argmax(x @ x.mean(axis=0)))]
    near = x @ x[seeds[0]]
    while len(seeds) < min(k, len(x)):
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = np.array([x[own == j].mean(axis=0) for j in range(len(c)) if (own == j).any()])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    cosine = x @ c.T
    own = np.argmax(cosine, axis=1)
    keep = [j for j in range(len(c)) if (own == j).any()]
    return c[keep], np.array([float(1 - cosine[own == j, j].min()) for j in keep])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> Model | None:
    """A model from the learning documents of ``docs``; None if there are none."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text", "doc_id")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, langs = np.zeros(1 << BITS, np.int64), {}
        for batch in batches:
            for _, data, offsets in _chunks(batch.column(1)):
                df += (counts(data, offsets) > 0).sum(axis=0)
            for lang in batch.column(0).to_pylist():
                langs[lang] = langs.get(lang, 0) + 1
        yield pa.RecordBatch.from_arrays([
            pa.array([*range(len(df)), *[None] * len(langs)], pa.int64()), pa.array([*[None] * len(df), *langs], pa.string()),
            pa.array([*df.tolist(), *langs.values()], pa.int64())], names=["cell", "lang", "n"])

    # a row per dimension and per language
    totals = rows.select("lang", "text").mapInArrow(frequencies, "cell long, lang string, n long").groupBy("cell", "lang").agg(F.sum("n").alias("n")).toArrow().to_pylist()
    langs = {r["lang"]: r["n"] for r in totals if r["lang"] is not None}
    if not langs:
        return None
    df = np.zeros(1 << BITS)
    for r in totals:
        if r["cell"] is not None:
            df[r["cell"]] = r["n"]
    idf = (np.log((1 + sum(langs.values())) / (1 + df)) + 1).astype(np.float32)
    share = spark.createDataFrame([(lang, min(1.0, SAMPLE / n)) for lang, n in langs.items()], "lang string, share double")
    sample = rows.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("doc_id", F.crc32(F.col("text").cast("binary"))), F.lit(1 << 30)) < F.col("share") * (1 << 30))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = [], []
            for _, data, offsets in _chunks(batch.column(1)):
                for row in counts(data, offsets):
                    cells = np.flatnonzero(row)
                    at.append(cells.astype(np.int32))
                    n.append(row[cells].astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.list_(pa.int32())), pa.array(n, pa.list_(pa.int32()))], names=["lang", "cells", "n"])

    # at most about SAMPLE rows a language
    got = sample.select("lang", "text").mapInArrow(sparse, "lang string, cells array<int>, n array<int>").toArrow()
    own_lang = np.array(got["lang"].to_pylist())
    raw = np.zeros((len(own_lang), 1 << BITS), np.float32)
    for i, (cells, n) in enumerate(zip(got["cells"].to_pylist(), got["n"].to_pylist())):
        raw[i, cells] = n
    x = vectors(raw, idf)
    # the order of the rows must not matter
    order = np.lexsort((np.round(x @ idf, 4), own_lang))
    x, own_lang = x[order], own_lang[order]
    names, centroids, radii = [], [], []
    for lang in sorted(langs):
        mine = x[(own_lang == lang) & (x.sum(axis=1) > 0)]
        if len(mine):
            c, r = cluster(mine, CENTROIDS)
            names += [lang] * len(c)
            centroids.append(c)
            radii.append(r)
    if not names:
        return None
    return Model(idf, names, np.vstack(centroids).astype(np.float32), np.minimum(np.concatenate(radii) * MARGIN + 0.02, 1.0))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id with ``lang_pred``, ``score`` and ``rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            lang, score, rejected = ["und"] * batch.num_rows, [0.0] * batch.num_rows, [True] * batch.num_rows
            for at, data, offsets in _chunks(batch.column(1)) if model else ():
                x = vectors(counts(data, offsets), model.idf)
                best, cosine = model.predict(x)
                for i in range(len(offsets) - 1):
                    if has_letter(data[offsets[i]: offsets[i + 1]]):
                        lang[at + i], score[at + i] = model.languages[best[i]], float(cosine[i])
                        rejected[at + i] = bool(1 - cosine[i] > model.radius[best[i]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def op9_centroid_language(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every document."""
    return identify(docs, learn(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
