"""Quality rules on tokeniser fertility.

Two public vocabularies measure every whole text: characters per token of a
byte-level BPE and of a BPE with byte fallback, the latter's share of byte
tokens, and the entropy of the former's tokens.  Rejection bands are medians
plus and minus a spread, per language and script, from all rows of the table:

* characters per token: the spread shrinks with the root of the token count,
  and is 5 % of the median at least;
* entropy: per language, script and power of two of the token count, 8 % of
  the median at least;
* byte tokens: an upper limit, five points above the median at least.

Languages of fewer than MIN_GROUP texts use the bands of their script; a
script with fewer has no bands and its texts pass.  Base rules (too few words,
repeated 5-word windows) hold everywhere.

Defined cases: a null or empty text has no words and fails the base rule; a
null language is a group of its own; repeated rows are measured and judged
alike; an empty table gives an empty result; input columns that bear an output
name are replaced (in ``keep_good`` all input columns come back as they were).
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm import words as W
from threadlens.llm.shared import ship, written

TOKENIZERS = os.environ.get("CORPUS_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE, PIECE_BPE = "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"
#: Pre-tokenisation pattern of the byte-level vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

MIN_GROUP = 30
#: Spreads in standard deviations, and the least relative widths (README: measured spreads and shares rejected).
SIGMAS, FERTILITY_WIDTH, ENTROPY_WIDTH, BYTE_WIDTH = 4.0, 0.05, 0.08, 0.05
#: Words whose pieces are remembered by a task.
CACHE_WORDS = 600_000
#: Texts are tokenised in parts of about this many characters, cut at white space.
PART_CHARS = 1 << 16

# UTF-8 lead bytes of the letters of each script.
SCRIPTS = ("latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "kana", "han", "hangul")
LEADS = (
    [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCC)], [0xCE, 0xCF], [0xD0, 0xD1, 0xD2, 0xD3], [0xD6, 0xD7],
    [0xD8, 0xD9, 0xDA, 0xDB], [0xE0], [0xE3], [0xE4, 0xE5, 0xE6, 0xE7, 0xE8, 0xE9], [0xEA, 0xEB, 0xEC, 0xED],
)
SYMBOLS = b"#*$%&|<>"

METRICS = T.StructType([
    *[T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")],
    T.StructField("script", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in ("fertility", "piece_fertility", "byte_share", "entropy")],
])
_ARROW = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.StringType(): pa.string()}


class Vocabularies:
    """Both tokenisers of a task, with a bounded memory of words."""

    def __init__(self, folder: str):
        import base64

        import sentencepiece
        import tiktoken

        with open(f"{folder}/{BYTE_BPE}") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.bytes = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECE_BPE}")
        self.fallback = frozenset(i for i in range(self.pieces.get_piece_size()) if self.pieces.is_byte(i))
        self.seen: dict[str, int] = {}

    def byte_tokens(self, text: str) -> np.ndarray:
        """Counts of the byte-level tokens that occur in a text."""
        if len(text) <= PART_CHARS:
            ids = np.array(self.bytes.encode_ordinary(text), np.int64)
            return np.unique(ids, return_counts=True)[1] if len(ids) < 5000 else (c := np.bincount(ids))[c > 0]
        total = np.zeros(self.size, np.int64)
        for part in parts(text):
            total += np.bincount(self.bytes.encode_ordinary(part), minlength=self.size)
        return total[total > 0]

    def piece_tokens(self, tokens: list[str]) -> tuple[int, int]:
        """(pieces, byte pieces) of a list of words: its merges never cross white space."""
        seen = self.seen
        new = set(tokens).difference(seen)
        if new:
            if len(seen) > CACHE_WORDS:
                seen.clear()
                new = set(tokens)
            short, none = [w for w in new if len(w) <= PART_CHARS], self.fallback.isdisjoint
            for w, ids in zip(short, self.pieces.encode(short, num_threads=1)):
                seen[w] = len(ids) if none(ids) else self._packed(ids)
            for w in new.difference(short):
                seen[w] = sum(map(self._packed, self.pieces.encode(list(parts(w)), num_threads=1)))
        total = sum(map(seen.__getitem__, tokens))
        return total & 0xFFFFFFFF, total >> 32

    def _packed(self, ids: list[int]) -> int:
        """Pieces in the low 32 bits, byte pieces above."""
        return len(ids) + (sum(i in self.fallback for i in ids) << 32)


def parts(text: str) -> Iterator[str]:
    """Consecutive parts of a text, cut before a space where there is one."""
    at = 0
    while at < len(text):
        to = at + PART_CHARS
        if to < len(text):
            to = max(text.rfind(" ", at + 1, to), 0) or to
        yield text[at:to]
        at = to


_vocabularies: dict[str, Vocabularies] = {}


def vocabularies(folder: str) -> Vocabularies:
    if folder not in _vocabularies:
        _vocabularies[folder] = Vocabularies(folder)
    return _vocabularies[folder]


def repeat_words(words: np.ndarray, k: int = 5) -> int:
    """Words inside k-word windows that occur twice or more."""
    n = len(words)
    if n <= k:
        return 0
    grams = W.shingles(words, k)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(grams), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    edge[: len(grams)] += again
    edge[k: k + len(grams)] -= again
    return int((np.cumsum(edge)[:n] > 0).sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip("\x20\t\n\v\f\r")]
    return len(lines) - len(set(lines))


def measure(column: pa.Array, folder: str) -> dict[str, list]:
    """The METRICS of every text of a column."""
    vocab = vocabularies(folder)
    out: dict[str, list] = {f.name: [] for f in METRICS}
    data, offsets = W.buffers(column)
    for lo, hi in W.slices(offsets):
        raw, offs = data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo]
        found = W.find_words(raw, offs)
        letters = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(((raw & 0xC0) != 0x80) & ~W.SPACE[raw], out=letters[1:])
        for i in range(hi - lo):
            own = raw[offs[i]: offs[i + 1]]
            text = own.tobytes().decode("utf-8", "replace")
            n = int(found.first[i + 1] - found.first[i])
            kinds = np.bincount(own, minlength=256)
            share = [int(kinds[lead].sum()) for lead in LEADS]
            counts = vocab.byte_tokens(text)
            tokens = int(counts.sum())
            p = counts / max(tokens, 1)
            pieces, fallback = vocab.piece_tokens(text.split())
            chars = int(letters[offs[i + 1]] - letters[offs[i]])
            row = (n, chars, int(kinds[list(SYMBOLS)].sum()), dup_lines(text), repeat_words(found.of(i)), tokens,
                   SCRIPTS[int(np.argmax(share))] if any(share) else "none",
                   len(text) / tokens if tokens else None, (chars + n) / pieces if pieces else None,
                   fallback / pieces if pieces else None, float(-(p * np.log2(p)).sum()) if tokens else None)
            for name, v in zip(out, row):
                out[name].append(v)
    return out


def measured(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """``docs`` without its text unless kept by the caller: every column but ``_text``, and the struct ``_m`` of METRICS."""
    ship(docs.sparkSession)
    schema = T.StructType([f for f in docs.schema if f.name != "_text"] + [T.StructField("_m", METRICS)])
    kinds = pa.struct([(f.name, _ARROW[f.dataType]) for f in METRICS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("_text")
            got = measure(batch.column(at), folder)
            struct = pa.StructArray.from_arrays([pa.array(got[f.name], kinds.field(i).type) for i, f in enumerate(METRICS)], fields=list(kinds))
            keep = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in keep], struct], names=[*[batch.schema.names[i] for i in keep], "_m"])
        vocabularies(folder).seen.clear()  # the worker goes on to other stages

    return docs.mapInArrow(run, schema)


def _fertility(name: str) -> Column:
    return F.round(f"_m.{name}", 3)


def bands(m: DataFrame, by: list[str]) -> DataFrame:
    """Medians and spreads of the fertilities and of the byte share per group ``by``."""
    median = m.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.percentile(_fertility("fertility"), F.lit(0.5)).alias("mid"),
        F.percentile(_fertility("piece_fertility"), F.lit(0.5)).alias("piece_mid"),
        F.percentile(F.round("_m.byte_share", 4), F.array(F.lit(0.5), F.lit(0.75))).alias("bytes"),
    ).where(F.col("n") >= MIN_GROUP)
    root = F.sqrt(F.col("_m.n_tokens").cast("double"))
    quarts = F.array(F.lit(0.25), F.lit(0.75))
    spread = m.join(F.broadcast(median) if _small(median) else median, by).groupBy(*by).agg(
        F.percentile(F.round((_fertility("fertility") - F.col("mid")) * root, 2), quarts).alias("q"),
        F.percentile(F.round((_fertility("piece_fertility") - F.col("piece_mid")) * root, 2), quarts).alias("piece_q"))
    wide = lambda q: (q[1] - q[0]) / 1.349 * SIGMAS
    return median.join(spread, by).select(
        *by, "mid", "piece_mid", wide(F.col("q")).alias("wide"), wide(F.col("piece_q")).alias("piece_wide"),
        (F.col("bytes")[0] + F.greatest(F.lit(BYTE_WIDTH), (F.col("bytes")[1] - F.col("bytes")[0]) / 0.6745 * SIGMAS)).alias("most_bytes"))


def entropy_bands(m: DataFrame, by: list[str]) -> DataFrame:
    """Median entropy and allowed distance per group ``by`` (one of its columns is the size class)."""
    q = F.percentile(F.round("_m.entropy", 2), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    got = m.groupBy(*by).agg(F.count("*").alias("n"), q.alias("q")).where(F.col("n") >= MIN_GROUP)
    return got.select(*by, F.col("q")[1].alias("h_mid"), F.greatest((F.col("q")[2] - F.col("q")[0]) / 1.349 * SIGMAS, F.col("q")[1] * ENTROPY_WIDTH).alias("h_wide"))


def _small(df: DataFrame, rows: int = 20_000) -> bool:
    """Whether a table of groups is small enough to broadcast (some 100 bytes a row)."""
    return df.limit(rows + 1).count() <= rows


def judged(m: DataFrame) -> DataFrame:
    """Rows with ``_lang`` and ``_m`` -> with ``_base_failed`` and ``_kept``."""
    m = m.withColumns({"_script": F.col("_m.script"), "_class": F.floor(F.log2(F.greatest(F.col("_m.n_tokens"), F.lit(1)).cast("double"))).cast("int")})
    known = m.where("_m.n_tokens > 0").select("_lang", "_script", "_class", "_m")
    out = m
    for name, by in (("own", ["_lang", "_script"]), ("any", ["_script"])):
        for kind, table, keys in (("f", bands(known, by), by), ("h", entropy_bands(known, [*by, "_class"]), [*by, "_class"])):
            table = written(table.select(*keys, F.struct(*[c for c in table.columns if c not in keys]).alias(f"_{name}_{kind}")), f"bands-{name}-{kind}")
            out = out.join(F.broadcast(table) if _small(table) else table, keys, "left")
    f, h = F.coalesce("_own_f", "_any_f"), F.coalesce("_own_h", "_any_h")
    root = F.sqrt(F.greatest(F.col("_m.n_tokens"), F.lit(1)).cast("double"))

    def off(value: Column, mid: Column, wide: Column) -> Column:
        return F.abs(value - mid) > F.greatest(mid * FERTILITY_WIDTH, wide / root)

    bad = (off(_fertility("fertility"), f["mid"], f["wide"]) | off(_fertility("piece_fertility"), f["piece_mid"], f["piece_wide"])
           | (F.round("_m.byte_share", 4) > f["most_bytes"] + F.lit(SIGMAS) * F.sqrt(f["most_bytes"]) / root)
           | (F.abs(F.round("_m.entropy", 2) - h["h_mid"]) > h["h_wide"]))
    failed = (F.col("_m.n_words") < 10) | (100 * F.col("_m.n_repeat_words") > 20 * F.col("_m.n_words"))
    return out.withColumn("_base_failed", failed).withColumn("_kept", ~failed & ~F.coalesce(bad, F.lit(False)))


def keep_good(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col("text").alias("_text"), F.coalesce(F.col("lang"), F.lit("")).alias("_lang"))
    return judged(written(measured(rows, folder), "fertility-rows")).where("_kept").select("_row.*")


def op2_token_fertility(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """doc_id, base figures, base_failed, kept and the measures of every document."""
    rows = docs.select("doc_id", F.col("text").alias("_text"), F.coalesce(F.col("lang"), F.lit("")).alias("_lang"))
    return judged(written(measured(rows, folder), "fertility")).select(
        "doc_id", *[F.col(f"_m.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
        *[F.col(f"_m.{c}") for c in ("n_tokens", "script", "fertility", "piece_fertility", "byte_share", "entropy")])
