"""Registered queries that go through files and streams.

Each query writes feed files derived from the driver's tables into a fresh
folder under ``spark.checkpoint.dir`` (shared storage on a cluster), runs the
streaming ingestion / CDC / upkeep job over them, and returns what the job
wrote.  The work therefore grows with the tables.  Where the written result
is deterministic, ``FILE_ORACLE_SQL`` holds its DuckDB equivalent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.schemas import CHECKPOINT_FEED_COLUMNS, INGESTED_AT, RESCUE_COLUMN
from threadlens.operators import upkeep
from threadlens.operators.enrich import parse_checkpoints
from threadlens.plans import gold_state, lag_state, oracle, stats_state, view_state
from threadlens.plans.batch_state import write_batch
from threadlens.plans.layers import SILVER_RULES, TRACKED, Layers
from threadlens.session import path_exists, work_dir
from threadlens.streaming import ingest, scd2_stream, split_sink

LOOKUP_EVENT_COLUMNS = ["thread_id", "user_id", "team", "updated_at", "event_id"]
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _layout_group(id_col: str) -> F.Column:
    """0: columns in feed order, 1: reversed order, 2: feed order + extra column."""
    return (F.substring(F.col(id_col), 2, 20).cast("bigint") % 3).cast("int")


def write_csv_feed(df: DataFrame, out: str, group: F.Column, files_per_group: int = 2) -> str:
    """Write ``df`` as header CSV files in three column layouts; returns the glob."""
    cols = df.columns
    tagged = df.withColumn("_g", group)
    layouts = {
        0: [F.col(c) for c in cols],
        1: [F.col(c) for c in reversed(cols)],
        2: [F.col(c) for c in cols] + [F.lit("feed_v2").alias("source_system")],
    }
    for g, sel in layouts.items():
        (tagged.filter(F.col("_g") == g).select(*sel)
         .repartition(files_per_group)
         .write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
         .csv(f"{out}/layout{g}"))
    return f"{out}/layout*/*.csv"


def _ingest_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = Layers(spark, sf_dir)
    base = work_dir(spark, "ingest_checkpoints")
    feed = L.bronze.select(*CHECKPOINT_FEED_COLUMNS)
    glob = write_csv_feed(feed, f"{base}/raw", _layout_group("checkpoint_id"))
    ingest.ingest_csv(spark, glob, CHECKPOINT_FEED_COLUMNS, f"{base}/bronze", f"{base}/_chk")
    t = ingest.read_table(spark, f"{base}/bronze")
    return t.select(*CHECKPOINT_FEED_COLUMNS, F.col(RESCUE_COLUMN).isNotNull().alias("rescued"))


def _ingest_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose JSON cells hold line breaks, ingested in splits."""
    base = work_dir(spark, "ingest_multiline")
    broken = F.replace(F.col("checkpoint"), F.lit(',"'), F.lit(',\n"'))
    feed = Layers(spark, sf_dir).bronze.withColumn("checkpoint", broken).select(*CHECKPOINT_FEED_COLUMNS)
    glob = write_csv_feed(feed, f"{base}/raw", _layout_group("checkpoint_id"))
    ingest.ingest_csv(spark, glob, CHECKPOINT_FEED_COLUMNS, f"{base}/bronze", f"{base}/_chk", multi_line="split")
    t = ingest.read_table(spark, f"{base}/bronze")
    return t.select(*CHECKPOINT_FEED_COLUMNS, F.col(RESCUE_COLUMN).isNotNull().alias("rescued"))


def _lookup_text(L: Layers) -> DataFrame:
    return L.lookup_feed.select(
        "thread_id", "user_id", "team",
        F.date_format("updated_at", TS_TEXT).alias("updated_at"),
        F.col("event_id").cast("string").alias("event_id"),
    )


def _ingest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = Layers(spark, sf_dir)
    base = work_dir(spark, "ingest_lookup")
    glob = write_csv_feed(_lookup_text(L), f"{base}/raw", (F.col("event_id").cast("bigint") % 3).cast("int"))
    ingest.ingest_csv(spark, glob, LOOKUP_EVENT_COLUMNS, f"{base}/bronze", f"{base}/_chk")
    t = ingest.read_table(spark, f"{base}/bronze")
    return t.select(*LOOKUP_EVENT_COLUMNS, F.col(RESCUE_COLUMN).isNotNull().alias("rescued"))


def _rescue_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rescued text of every delivery whose file has an unexpected column."""
    L = Layers(spark, sf_dir)
    base = work_dir(spark, "rescue_feed")
    glob = write_csv_feed(_lookup_text(L), f"{base}/raw", (F.col("event_id").cast("bigint") % 3).cast("int"))
    ingest.ingest_csv(spark, glob, LOOKUP_EVENT_COLUMNS, f"{base}/bronze", f"{base}/_chk")
    return ingest.read_table(spark, f"{base}/bronze").select(
        "event_id", F.get_json_object(RESCUE_COLUMN, "$.source_system").alias("rescued"))


def _scd2_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup files -> ingestion stream -> CDC stream, one file per micro-batch."""
    L = Layers(spark, sf_dir)
    base = work_dir(spark, "scd2_stream")
    glob = write_csv_feed(_lookup_text(L), f"{base}/raw", (F.col("event_id").cast("bigint") % 3).cast("int"))

    def prepare(df: DataFrame) -> DataFrame:
        return df.filter(F.col("thread_id").isNotNull()).select(
            "thread_id", "user_id", "team",
            F.to_timestamp_ntz("updated_at").alias("updated_at"),
            F.col("event_id").cast("bigint").alias("event_id"),
        )

    def fold(batch: DataFrame, batch_id: int) -> None:
        scd2_stream.apply_changes(
            prepare(batch), batch_id, f"{base}/log", f"{base}/history",
            keys=["thread_id"], sequence_by="updated_at", tiebreak=["event_id"],
            track_columns=["user_id", "team"], buckets=16)

    ingest.ingest_csv(spark, glob, LOOKUP_EVENT_COLUMNS, f"{base}/bronze", f"{base}/_chk",
                      max_files_per_trigger=1, on_batch=fold)
    schema = ("thread_id string, user_id string, team string, updated_at timestamp_ntz, "
              "event_id bigint, __START_AT timestamp_ntz, __END_AT timestamp_ntz")
    return scd2_stream.read_history(spark, f"{base}/history", schema).select(
        "thread_id", "user_id", "team", "updated_at", "__START_AT", "__END_AT")


def _small_files_copy(spark: SparkSession, L: Layers, name: str, files: int = 24) -> str:
    path = work_dir(spark, name)
    L.bronze.repartition(files).write.mode("overwrite").parquet(path)
    return path


def _file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    L = Layers(spark, sf_dir)
    bronze = _small_files_copy(spark, L, "inventory_bronze")
    hist = work_dir(spark, "inventory_history")
    L.history.write.mode("overwrite").parquet(hist)
    return upkeep.file_inventory(spark, {"bronze_checkpoints": bronze, "silver_thread_lookup_history": hist}).select(
        "table_name", "num_files", "needs_compaction")


def _compact(spark: SparkSession, sf_dir: str, zorder: bool) -> DataFrame:
    L = Layers(spark, sf_dir)
    src = _small_files_copy(spark, L, "compact_src")
    dst = work_dir(spark, "compact_dst")
    cols = ["ingested_at", "checkpoint_id"] if zorder else ["thread_id", "checkpoint_id"]
    upkeep.compact(spark, src, dst, cols, target_file_mb=1, zorder=zorder)
    return spark.read.parquet(dst)


def _split_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: kept and quarantined checkpoints of two batches, each from one staged write."""
    base = work_dir(spark, "split_sink")
    parsed = parse_checkpoints(Layers(spark, sf_dir).bronze)
    for batch in (0, 1):
        rows = parsed.filter(F.pmod(F.crc32(F.col("checkpoint_id").cast("binary")), F.lit(2)) == batch)
        split_sink.write_split(rows, SILVER_RULES, batch, f"{base}/kept", f"{base}/aside", partition_by="checkpoint_date")

    def part(folder: str, verdict: str) -> DataFrame:
        columns = ["thread_id", "checkpoint_ns", "checkpoint_id", "checkpoint_ts"]
        rows = spark.read.schema(parsed.schema).parquet(f"{base}/{folder}") if path_exists(spark, f"{base}/{folder}") else parsed.limit(0)
        return rows.select(*columns, F.lit(verdict).alias("verdict"))

    return part("kept", "kept").unionByName(part("aside", "quarantined")).withColumn("checkpoint_ts", F.col("checkpoint_ts").cast("timestamp_ntz"))


def _daily_counts_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts summed from partials of two batches, two history deltas and dates."""
    L = Layers(spark, sf_dir)
    base = work_dir(spark, "daily_counts_state")
    late = F.pmod(F.crc32(F.col("thread_id").cast("binary")), F.lit(2)).cast("int")
    for batch in (0, 1):
        view_state.fold_batches(base, "bronze_checkpoints", L.bronze.withColumn(view_state.BATCH_COL, late).filter(F.col(view_state.BATCH_COL) == batch))
        # every other delivery comes a batch late, so versions appear, change and vanish
        scd2_stream.apply_changes(L.lookup_feed.filter(F.col("event_id") % 2 == batch), batch, f"{base}/log", f"{base}/history",
                                  keys=["thread_id"], sequence_by="updated_at", tiebreak=["event_id"], track_columns=TRACKED, buckets=8)
    if path_exists(spark, f"{base}/history"):
        view_state.fold_batches(base, view_state.HISTORY, spark.read.parquet(f"{base}/history"), view_state.delta_weight())
    for layer, df in zip(view_state.BY_DATE, (L.silver, L.gold_user, L.gold_team)):
        view_state.replace_dates(base, layer, df, None)
    return view_state.daily_counts(spark, base)


def _halves(df: DataFrame, key: str) -> list[DataFrame]:
    """The rows in two batches, by a hash of ``key``."""
    return [df.filter(F.pmod(F.crc32(F.col(key).cast("binary")), F.lit(2)) == batch) for batch in (0, 1)]


def _lag_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles from the merged sketches of two batches, beside the exact bounds of their rank error."""
    path = work_dir(spark, "lag_sketch")
    rows = parse_checkpoints(Layers(spark, sf_dir).bronze, keep=[INGESTED_AT])
    for batch, part in enumerate(_halves(rows, "checkpoint_id")):
        lag_state.fold(part, path, batch)
    return lag_state.compare(spark, path, rows)


def _column_stats_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: column statistics merged from two batches, beside the exact number of distinct values."""
    base = work_dir(spark, "column_stats_state")
    bronze = Layers(spark, sf_dir).bronze
    for batch, part in enumerate(_halves(bronze, "checkpoint_id")):
        write_batch(part, f"{base}/table", batch)
        stats_state.refresh_stats(spark, f"{base}/table", f"{base}/stats", STATS_COLUMNS)
    stats = stats_state.column_stats(spark, f"{base}/stats", bronze, STATS_COLUMNS)
    return stats_state.with_exact_distinct(stats, spark.read.parquet(f"{base}/table"), STATS_COLUMNS)


def _gold_state(spark: SparkSession, sf_dir: str, which: int) -> DataFrame:
    """A1/A2/A4: a gold table merged from the partials of two batches."""
    L = Layers(spark, sf_dir)
    path = work_dir(spark, "gold_state")
    parsed = parse_checkpoints(L.bronze).filter("checkpoint_ts IS NOT NULL")
    for batch, part in enumerate(_halves(parsed, "checkpoint_id")):
        gold_state.fold(part, path, batch)
    out = gold_state.gold(spark, path, L.current_owner)[which]
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_checkpoint_ts", "last_checkpoint_ts")})


STATS_COLUMNS = ["thread_id", "checkpoint_ns", "checkpoint_id", "parent_checkpoint_id", "type", "checkpoint", "metadata", "_rescued_data"]

QUERIES = {
    "lag_sketch": _lag_sketch,
    "column_stats_state": _column_stats_state,
    "gold_user_state": lambda spark, sf: _gold_state(spark, sf, 0),
    "gold_team_state": lambda spark, sf: _gold_state(spark, sf, 1),
    "split_sink": _split_sink,
    "daily_counts_state": _daily_counts_state,
    "ingest_checkpoints": _ingest_checkpoints,
    "ingest_lookup": _ingest_lookup,
    "ingest_multiline": _ingest_multiline,
    "rescue_feed": _rescue_feed,
    "scd2_stream": _scd2_stream,
    "file_inventory": _file_inventory,
    "compact": lambda spark, sf: _compact(spark, sf, zorder=False),
    "compact_zorder": lambda spark, sf: _compact(spark, sf, zorder=True),
}

_BRONZE_ALL = ("thread_id, checkpoint_ns, checkpoint_id, parent_checkpoint_id, type, checkpoint, "
               "metadata, _rescued_data, ingested_at")

_STATS_ARMS = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
  min({c}) AS min_value, max({c}) AS max_value, count(DISTINCT {c}) AS distinct_count, true AS within FROM bronze"""
    for c in STATS_COLUMNS)


def _at_rank(p: float) -> str:
    return f"min(lag) FILTER (WHERE cum >= greatest(1, least(n, ceil(n * CAST({p} AS DOUBLE)))))"


_LAG_SKETCH = f"""
SELECT event_date, CAST(max(n) AS BIGINT) AS record_count, min(lag) AS min_lag, max(lag) AS max_lag,
  CAST(sum(lag * w) AS BIGINT) AS total_lag,
  {_at_rank(0.49)} AS median_low, {_at_rank(0.51)} AS median_high, {_at_rank(0.94)} AS p95_low, {_at_rank(0.96)} AS p95_high,
  true AS median_within, true AS p95_within
FROM (
  SELECT event_date, lag, w, sum(w) OVER (PARTITION BY event_date ORDER BY lag) AS cum, sum(w) OVER (PARTITION BY event_date) AS n
  FROM (
    SELECT CAST(f.checkpoint_ts AS DATE) AS event_date, b.lag_end - date_diff('second', TIMESTAMP '1970-01-01', date_trunc('second', f.checkpoint_ts)) AS lag,
      count(*) AS w
    FROM (
      SELECT CASE WHEN json_valid(checkpoint) THEN TRY_CAST(json_extract_string(checkpoint, '$.ts') AS TIMESTAMP) END AS checkpoint_ts,
        ingested_at FROM bronze) f,
      LATERAL (SELECT date_diff('second', TIMESTAMP '1970-01-01', date_trunc('second', f.ingested_at)) AS lag_end) b
    WHERE f.checkpoint_ts IS NOT NULL GROUP BY ALL))
GROUP BY event_date"""

FILE_ORACLE_SQL = {
    "lag_sketch": _LAG_SKETCH,
    "column_stats_state": _STATS_ARMS,
    "gold_user_state": oracle.QUERIES_SQL["gold_user_team_metrics"],
    "gold_team_state": oracle.QUERIES_SQL["gold_team_summary"],
    "split_sink": """
SELECT thread_id, checkpoint_ns, checkpoint_id, checkpoint_ts,
  CASE WHEN checkpoint_ts IS NOT NULL THEN 'kept' ELSE 'quarantined' END AS verdict FROM fields""",
    "daily_counts_state": oracle.QUERIES_SQL["daily_counts"],
    "ingest_checkpoints": """
SELECT thread_id, checkpoint_ns, checkpoint_id, parent_checkpoint_id, type, checkpoint, metadata,
  CAST(substr(checkpoint_id, 2) AS BIGINT) % 3 = 2 AS rescued
FROM bronze""",
    "ingest_multiline": """
SELECT thread_id, checkpoint_ns, checkpoint_id, parent_checkpoint_id, type,
  replace(checkpoint, ',"', ',' || chr(10) || '"') AS checkpoint, metadata,
  CAST(substr(checkpoint_id, 2) AS BIGINT) % 3 = 2 AS rescued
FROM bronze""",
    "ingest_lookup": """
SELECT thread_id, user_id, team, strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') AS updated_at,
  CAST(event_id AS VARCHAR) AS event_id, event_id % 3 = 2 AS rescued
FROM feed""",
    "rescue_feed": """
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 3 = 2 THEN 'feed_v2' END AS rescued FROM feed""",
    "scd2_stream": "SELECT thread_id, user_id, team, updated_at, __START_AT, __END_AT FROM hist",
    "compact": f"SELECT {_BRONZE_ALL} FROM bronze",
    "compact_zorder": f"SELECT {_BRONZE_ALL} FROM bronze",
}
