"""Sharding along a Hilbert curve over quantised metadata.

Language, source and text length are quantised to 4 bits each; the curve index
of the cell orders the documents, so a run of the order is compact in all
three dimensions and a filter on any of them skips most shards.  The order is
a distributed range sort by (index, hash of the text, hash of the id); a row's
global rank is its place in its sorted partition plus the rows of the
partitions before.  Equal ranges of ranks are the shards, so counts differ by
one at most (law ``rows``) even where one source or text has most rows.

Categories are quantised by equal depth: a value's code is the share of rows
with a smaller value, in sixteenths; length by its power of two.

Defined cases: a null category sorts before all others, a null text counts
as empty; repeated rows get ranks of their own next to each other; an empty
table gives an empty result; fewer rows than shards leave shards empty.
Columns of the input that bear an output name are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.shared import ship, written

BITS, SHARDS = 4, 16
#: Category tables of up to this many values are broadcast.
BROADCAST_VALUES = 20_000


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of integer points (n, d) with ``bits`` bits a coordinate (Skilling's transposition, vectorised)."""
    x = np.asarray(coords, np.int64).copy()
    n, dims = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            on = (x[:, i] & q) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(on, p, swap)
            if i:
                x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(n, np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[:, dims - 1] & q, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    index = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[:, i] >> b) & 1)
    return index


def _curve(bits: int):
    @F.pandas_udf("long")
    def curve(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.column_stack([a, b, c]), bits))

    return curve


def depth_codes(docs: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """value -> code of equal depth, from counts over all rows."""
    counts = docs.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    before = Window.orderBy(F.col("value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n").over(Window.partitionBy())
    share = F.coalesce(F.sum("n").over(before), F.lit(0)) * (1 << bits)
    return counts.select("value", F.expr("int(0)").alias("zero"), F.floor(share / total).cast("int").alias("code")).drop("zero")


def with_curve(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes and one), ``text_crc32`` and the ``curve`` index."""
    ship(docs.sparkSession)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    out = docs.drop("size", "text_crc32", "curve").select(
        "*", size.alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    names = []
    for column in ("lang", "source"):
        codes = depth_codes(docs, column, bits).withColumnsRenamed({"value": f"_{column}", "code": f"_{column}_code"})
        codes = written(codes, f"codes-{column}")
        small = codes.limit(BROADCAST_VALUES + 1).count() <= BROADCAST_VALUES
        out = out.join(F.broadcast(codes) if small else codes, F.col(column).eqNullSafe(F.col(f"_{column}")), "left").drop(f"_{column}")
        names.append(f"_{column}_code")
    length = F.least(F.greatest(F.length(F.bin("size")) - 4, F.lit(0)), F.lit((1 << bits) - 1)).cast("int")
    return out.withColumn("curve", _curve(bits)(*names, length)).drop(*names)


def shard(docs: DataFrame, shards: int = SHARDS, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of every document with ``size``, ``text_crc32``, ``curve``, ``shard`` and ``slot``."""
    keep = docs.columns if keep is None else keep
    added = ["size", "text_crc32", "curve", "shard", "slot"]
    keep = [c for c in keep if c not in added]
    narrow = with_curve(docs).select(*keep, "size", "text_crc32", "curve", F.xxhash64("doc_id").alias("_tie"))
    order = ["curve", "text_crc32", "_tie"]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.select(
        *keep, "size", "text_crc32", "curve", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos")), "hilbert-sorted")
    parts = placed.groupBy("_part").agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"), F.sum("n").over(Window.partitionBy()).alias("_all"))
    rank = F.col("_base") + F.col("_pos")
    # one row per sorted partition: as many as tasks wrote
    out = placed.join(F.broadcast(parts), "_part").withColumn("_rank", rank)
    out = out.withColumn("shard", F.floor(((F.col("_rank") + 1) * shards - 1) / F.col("_all")).cast("int"))
    start = F.expr(f"shard * _all div {shards}")
    return out.withColumn("slot", F.col("_rank") - start).select(*keep, "size", "text_crc32", "curve", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """One folder per shard, rows in curve order, for pruning by the files' column statistics."""
    shard(docs, shards).repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op10_hilbert_shards(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, curve of every document."""
    return shard(docs, keep=["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
