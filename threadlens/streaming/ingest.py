"""Incremental CSV ingestion with Structured Streaming.

A file stream source over the feed folder (glob allowed) hands every
micro-batch the lines of the new files; ``foreachBatch`` parses them by
header name (``threadlens.sources.csv_feed``), stamps ``ingested_at`` and
writes them to ``<table>/_batch=<id>`` (staged, then published by one
rename).  The write of a batch id replaces its own folder, so a retried
micro-batch does not duplicate rows; the stream
checkpoint records which files were consumed, so a re-run only adds new
files.  ``trigger(availableNow=True)`` processes everything present and
stops, like a scheduled pipeline update.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.schemas import INGESTED_AT
from threadlens.session import publish
from threadlens.sources import csv_split
from threadlens.sources.csv_feed import (
    RECORD_OPTIONS,
    bind_multiline,
    multiline_records,
    parse_by_name,
    widest_header,
)

BATCH_COL = "_batch"
# Files per micro-batch (the rest come in the next ones).
MAX_FILES_PER_TRIGGER = 10_000


def stream_lines(spark: SparkSession, source: str, max_files_per_trigger: int | None = None,
                 line_separator: str | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option(
        "maxFilesPerTrigger", str(max_files_per_trigger or MAX_FILES_PER_TRIGGER))
    if line_separator is not None:
        reader = reader.option("lineSep", line_separator)
    return reader.load(source).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )


def ingest_csv(spark: SparkSession, source: str, expected: list[str], table_dir: str,
               checkpoint: str, max_files_per_trigger: int | None = None,
               options: dict | None = None, on_batch=None, multi_line: bool | str = False,
               max_columns: int | None = None):
    """Run the ingestion stream until the files present now are consumed.

    ``on_batch(batch_df, batch_id)`` is called after each batch was written
    (used to chain the change-data-capture step).  ``multi_line`` accepts quoted
    line breaks: True reads a file by one task, "split" by many (``csv_split``).
    Returns the finished query.
    """
    in_splits = multi_line == "split"

    def parse(batch: DataFrame) -> DataFrame:
        if multi_line and not in_splits:
            return bind_multiline(batch, expected)
        lines = batch.select(
            F.col("value").alias("line"), "file_path", "block_start", "file_time",
            F.monotonically_increasing_id().alias("line_no"),
        )
        if in_splits:
            return parse_by_name(csv_split.records(lines), expected, {**RECORD_OPTIONS, **(options or {})}, max_columns)
        return parse_by_name(lines, expected, options, max_columns)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = parse(batch).withColumn(INGESTED_AT, F.current_timestamp())
        out = f"{table_dir.rstrip('/')}/{BATCH_COL}={batch_id}"
        staged = f"{table_dir.rstrip('/')}/_staging_{batch_id}"
        rows.write.mode("overwrite").parquet(staged)
        publish(batch.sparkSession, staged, out)
        if on_batch is not None:
            on_batch(batch.sparkSession.read.parquet(out), batch_id)

    if in_splits:
        source_df = stream_lines(spark, source, max_files_per_trigger, csv_split.LINE_SEPARATOR)
    elif multi_line:
        # of the files present now; records of later, wider files are rescued whole
        width = max(max_columns or widest_header(spark, source), len(expected))
        reader = spark.readStream.option(
            "maxFilesPerTrigger", str(max_files_per_trigger or MAX_FILES_PER_TRIGGER))
        source_df = multiline_records(reader, source, width, options)
    else:
        source_df = stream_lines(spark, source, max_files_per_trigger)
    query = (
        source_df
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_table(spark: SparkSession, table_dir: str) -> DataFrame:
    """The ingested table (all batch folders; ``_batch`` is a partition column)."""
    return spark.read.parquet(table_dir)

