"""The corpus pipeline: quality rules, near-duplicate removal, benchmark
decontamination, source mixing and sharding, over the whole of ``documents``.

Each stage gets all that the one before kept, as a table written to the shared
folder, and returns the columns of its input; the last adds its shard columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadlens.llm import decontam, fertility, hilbert, mixing, ngram_join
from threadlens.llm.shared import read_table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Words of a shingle and least similarity, in hundredths, of near copies.
SHINGLE, PERCENT = 5, 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the fertility bands of their language."""
    return fertility.keep_good(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.one_of_each(docs, SHINGLE, PERCENT)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontam.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.repeat_taken(docs)


def into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot."""
    return hilbert.shard(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_copies", no_near_copies),
    ("decontamination", no_benchmark),
    ("mixing", mix_sources),
    ("sharding", into_shards),
]
#: Model verdicts, similarity components and the curve have no SQL form; the stages are tested one by one.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
