"""Tables of partial results by batch: what the states of views and metrics are kept in.

A partial result is computed from the rows of one batch alone and written to
``<path>/_batch=<id>`` (staged, then published by one rename), so a repeated
batch replaces its own partial and a reader merges all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadlens.session import batch_ids, path_exists, publish

BATCH_COL = "_batch"


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: list[str] | None = None) -> None:
    """Publish the partial of one batch; a batch without rows still has its folder."""
    path = path.rstrip("/")
    staged = f"{path}/_staging_{batch_id}"
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(staged)
    publish(df.sparkSession, staged, f"{path}/{BATCH_COL}={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The partials of all batches (with ``_batch``); empty before the first."""
    schema = f"{schema}, {BATCH_COL} int"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def missing_batches(spark: SparkSession, table_dir: str, path: str) -> list[int]:
    """Published batches of a table that have no partial yet."""
    return sorted(set(batch_ids(spark, table_dir)) - set(batch_ids(spark, path)))
