"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

A word becomes a string of symbols: one per UTF-8 byte, the last byte of a
word being a symbol of its own, so that no token crosses a word's end.  An
Aho-Corasick automaton of the reversed tokens, run over the reversed symbols,
gives the longest token that starts at every place.  The encoder goes from
left to right: it takes the longest token that is compatible with the token
before it; failing that the next shorter one; failing all, it gives up the
last token and marks the place as dead, so that no place is tried twice.  Two
tokens are compatible if the merges, applied to both spellings side by side,
never join across their border; pairwise compatible tokens are exactly what
merging in order of rank gives.  The table of compatible pairs is filled as
pairs occur.

Decoding gathers the tokens' spellings from one buffer with offsets.

Texts are prepared as the vocabulary file says: added tokens are cut out
first; the rest is put into NFC, white space runs become a space, letters are
lowered one by one, and words are the matches of the split pattern.

Defined cases: a null or empty text has no tokens and decodes to the empty
text; a null list decodes to the empty text; very long words are encoded whole
(they are not remembered); repeated rows are encoded alike; an empty table
gives an empty result; input columns that bear an output name are replaced.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm import words as W
from threadlens.llm.shared import ship

VOCABULARY = "word_bpe_49k.json"
#: Words whose tokens a task remembers, the longest such word, and remembered pairs of tokens.
CACHE_WORDS, CACHE_CHARS, CACHE_PAIRS = 300_000, 64, 500_000


def vocabulary_path() -> str:
    """The vocabulary of the environment, where ``CORPUS_TOKENIZERS`` names no other folder."""
    folder = os.environ.get("CORPUS_TOKENIZERS")
    if folder:
        return f"{folder}/{VOCABULARY}"
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + i): b for i, b in enumerate(rest)}}


def packed(ids: list[int]) -> bytes:
    """Token ids as 32-bit integers."""
    return array("i", ids).tobytes()


class Pieces(dict):
    """word -> its token ids, filled on demand and bounded: half of the words, and the half before it."""

    def __init__(self, encode: Callable, kept: Callable = tuple):
        self.encode, self.kept, self.before = encode, kept, {}

    def __missing__(self, word: str) -> tuple[int, ...] | bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.kept(self.encode(word))
        if len(word) <= CACHE_CHARS:
            if 2 * len(self) >= CACHE_WORDS:
                self.before = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Bpe:
    """Encoder of a word-end BPE vocabulary, with its table of pairs."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path, self.ids, self.suffix = path, model["vocab"], model["end_of_word_suffix"]
        self._symbols(model["merges"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.split = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        self.pairs: dict[int, bool] = {}
        self.pieces = Pieces(self.encode_word, packed)
        self.library = None
        #: tokens that merging never gives for their own spelling are no candidates
        self.own = own = {s: t for s, t in self.token_of.items() if self._reachable(t)}
        self.automaton = ahocorasick.Automaton()
        for s, t in own.items():
            self.automaton.add_word(s[::-1], t)
        self.automaton.make_automaton()
        self.shorter = {t: next((own[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in own), -1) for s, t in own.items()}

    def _symbols(self, merges: list) -> None:
        """Spelling in symbols, parts and creating rank of every token."""
        letters, end = byte_letters(), self.suffix
        spelled = {}
        for c, b in letters.items():
            spelled[c], spelled[c + end] = chr(b), chr(256 + b)
        self.join: dict[tuple[int, int], int] = {}
        self.rank = {self.ids[t]: -1 for t in spelled if t in self.ids}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            spelled[a + b] = spelled[a] + spelled[b]
            left, right, t = self.ids[a], self.ids[b], self.ids[a + b]
            self.join[left, right] = rank
            self.rank[t], self.parts[t] = rank, (left, right)
        self.token_of = {s: self.ids[t] for t, s in spelled.items() if t in self.ids}
        self.length = {t: len(s) for s, t in self.token_of.items()}

    def _edge(self, token: int, side: int) -> Iterator[tuple[int, float]]:
        """Tokens at an edge of ``token`` as merging proceeds, last first, each with the rank that ends it."""
        until = float("inf")
        while True:
            yield token, until
            if token not in self.parts:
                return
            until, token = self.rank[token], self.parts[token][side]

    def meet(self, left: int, right: int, before: float = float("inf")) -> bool:
        """Whether merging joins two neighbours across their border at a rank below ``before``.

        A rule joins them while its left part is the last of one side and its
        right part the first of the other.  Of equal pairs the leftmost is
        joined first: a tie with the left side's own merge leaves the border.
        """
        for a, a_until in self._edge(left, 1):
            for b, b_until in self._edge(right, 0):
                rank = self.join.get((a, b))
                if rank is not None and rank < before and self.rank[a] < rank < a_until and self.rank[b] < rank <= b_until:
                    return True
        return False

    def _reachable(self, token: int) -> bool:
        return token not in self.parts or not self.meet(*self.parts[token], before=self.rank[token])

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = not self.meet(left, right)
        return known

    def encode_word(self, word: str) -> list[int]:
        """Token ids of one word, in time linear in its length."""
        raw = word.encode("utf-8")
        symbols = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        whole = self.own.get(symbols)
        if whole is not None:
            return [whole]
        n = len(symbols)
        # the automaton gives the longest match of a place first: from behind, it is the one that stays
        found = dict(list(self.automaton.iter(symbols[::-1]))[::-1])
        longest, length, shorter, known, compatible = found.get, self.length, self.shorter, self.pairs.get, self.compatible
        dead = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest(n - 1, -1)
        while at < n:
            while token >= 0 and (dead[at + length[token]] or (out and not (known(out[-1] << 32 | token) or compatible(out[-1], token)))):
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest(n - 1 - at, -1)
            else:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
        return out

    def words(self, text: str) -> list[str]:
        """The words of a text between added tokens."""
        if not text.isascii():
            if any(unicodedata.category(c) == "Cn" for c in set(text)):
                return self._library_words(text)
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.split.findall(text.lower())

    def _library_words(self, text: str) -> list[str]:
        """Words of a text with characters newer than Python's tables: their classes are the tokenizers library's."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        normal = self.library.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def encode_packed(self, text: str) -> bytes:
        """Token ids of a whole text as 32-bit integers."""
        out: list[bytes] = []
        pieces = self.pieces
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.added:
                out.append(packed([self.added[part]]))
            elif part:
                out.extend(map(pieces.__getitem__, self.words(part)))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        """Token ids of a whole text."""
        return array("i", self.encode_packed(text)).tolist()


class Spellings:
    """Decoder: the spellings of all ids, each with the space that joins it to the one before, in one buffer with offsets."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        spelled = {**{i: t for t, i in spec["model"]["vocab"].items()}, **{t["id"]: t["content"] for t in spec["added_tokens"]}}
        coded = [(" " + spelled[i]).encode("utf-8") if i in spelled else b"" for i in range(max(spelled) + 1)]
        self.buffer = np.frombuffer(b"".join(coded), np.uint8)
        self.offsets = np.zeros(len(coded) + 1, np.int64)
        np.cumsum([len(c) for c in coded], out=self.offsets[1:])

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the texts whose ids are ``ids[first[i]:first[i + 1]]``."""
        begin, size = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        heads = first[:-1][first[:-1] < first[1:]]
        begin[heads] += 1
        size[heads] -= 1
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        place = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], size)
        return self.buffer[place], ends[first]


_loaded: dict[tuple, Bpe | Spellings] = {}


def vocabulary(path: str, kind: type = Bpe) -> Bpe | Spellings:
    """A task's one encoder or decoder of a vocabulary file."""
    if (path, kind) not in _loaded:
        _loaded[path, kind] = kind(path)
    return _loaded[path, kind]


def _replaced(df: DataFrame, column: str, out: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    """``df`` without ``out`` and with the input last, and the schema with ``out`` in the input's place."""
    keep = [c for c in df.columns if c not in (column, out)]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{column}`").alias("_in"))
    return rows, T.StructType([f for f in rows.schema if f.name != "_in"] + [T.StructField(out, kind)])


def encoded(docs: DataFrame, column: str = "text", out: str = "ids", path: str | None = None) -> DataFrame:
    """``docs`` with the token ids of ``column`` in ``out`` in its place."""
    ship(docs.sparkSession)
    path = path or vocabulary_path()
    rows, schema = _replaced(docs, column, out, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            _, offsets = W.buffers(batch.column(batch.num_columns - 1))
            for lo, hi in W.slices(offsets):
                part = batch.slice(lo, hi - lo)
                ids = [bpe.encode_packed(t) if t else b"" for t in part.column(part.num_columns - 1).to_pylist()]
                first = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(i) // 4 for i in ids], out=first[1:])
                flat = pa.Array.from_buffers(pa.int32(), int(first[-1]), [None, pa.py_buffer(b"".join(ids))])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.ListArray.from_arrays(pa.array(first), flat)], names=schema.names)

    return rows.mapInArrow(run, schema)


def decoded(docs: DataFrame, column: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``docs`` with the text of the token ids in ``column`` added as ``out``."""
    ship(docs.sparkSession)
    path = path or vocabulary_path()
    rows = docs.drop(out).withColumn("_in", F.col(f"`{column}`"))
    schema = T.StructType([f for f in rows.schema if f.name != "_in"] + [T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spellings = vocabulary(path, Spellings)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1).cast(pa.large_list(pa.int32()))
            sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
            flat = np.asarray(lists.drop_null().flatten(), np.int64)
            first = np.zeros(len(sizes) + 1, np.int64)
            np.cumsum(sizes, out=first[1:])
            for lo, hi in W.slices(first):
                data, ends = spellings.decode(flat[first[lo]: first[hi]], first[lo: hi + 1] - first[lo])
                texts = pa.LargeStringArray.from_buffers(hi - lo, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns[:-1], texts], names=schema.names)

    return rows.mapInArrow(run, schema)


def op11_bpe_backtrack(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    both = decoded(encoded(docs.select("doc_id", "text"), path=path), path=path)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"), sha(F.col("decoded")).alias("decoded_sha256"))
