"""One pipeline update over written tables.

``refresh(spark, raw_dir, out_dir)`` runs the layers in dependency order,
each step a plain Spark job reading the previous step's table:

1. checkpoint CSV files -> ``bronze_checkpoints`` (ingestion stream,
   ``availableNow``; a re-run only reads new files);
2. lookup CSV files -> ``bronze_thread_lookup_stream``, and in the same
   micro-batch the cleaned, expectation-checked rows are folded into
   ``silver_thread_lookup_history`` (streaming SCD2 on parquet);
3. ``silver_checkpoints`` = parsed checkpoints LEFT JOIN the current owner.
   Every bronze batch is parsed and checked once, as it arrives
   (``checkpoints_parsed``, partitioned by batch and date); the silver table
   (skipped with ``materialize_silver=False``) is rewritten for the touched
   dates only, like gold below;
4. gold tables: recomputed for the touched dates only -- dates of newly
   ingested checkpoints, and every date of threads whose ownership changed
   (silver joins the *current* owner, so an ownership change re-attributes
   old checkpoints).  They are merged from the partials by thread and day that
   every batch leaves (``gold_state``), without a look at old checkpoints, and
   written with dynamic partition overwrite, clustered by the gold keys inside
   each date;
5. the monitoring views.  Daily counts and NULL percentages are sums over
   partial aggregates of batches, history deltas and dates (``view_state``), the
   delivery lag merges a quantile sketch per batch and day (``lag_state``): an
   update reads only what is new.  Duplicates and processing lag are recomputed.

6. the cross-layer checks, run on the written tables, into ``check_results``.

Expectation counts of every parsed batch are appended to ``expectation_log``
(observed while the batch is written, no extra pass).  ``on_violation`` says what
becomes of rows that break a rule: they go to ``checkpoints_quarantine``, beside
their batch, are dropped, or fail the update before any row of the batch is
visible in the parsed table.

What is still to be applied is read from the tables, not from memory:
``applied_batches`` holds the last batch of either feed that silver, gold, the
views and the checks include, and is replaced after all of them are written.
An update that fails at any step leaves it as it was, and the next one takes
the same batches up again.  A feed without a file yet is an empty table.

Paths live under ``out_dir``; stream checkpoints under ``out_dir/_checkpoints``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.functions.schemas import (
    CHECKPOINT_FEED_COLUMNS,
    END_AT,
    INGESTED_AT,
    LOOKUP_FEED_COLUMNS,
    RESCUE_COLUMN,
    START_AT,
)
from threadlens.operators import checks, monitor, scd2, upkeep
from threadlens.operators.enrich import SILVER_COLUMNS, clean_thread_lookup, parse_checkpoints
from threadlens.operators.expectations import apply_rules
from threadlens.plans import gold_state, lag_state, view_state
from threadlens.plans.batch_state import missing_batches
from threadlens.plans.layers import LOOKUP_RULES, SILVER_RULES, TRACKED
from threadlens.session import batch_ids, ensure_defaults, path_exists, publish, work_dir
from threadlens.sources.csv_feed import DELIVERY_ORDER, SOURCE_FILE, SOURCE_LINE, SOURCE_TIME
from threadlens.streaming import ingest, scd2_stream, split_sink


@dataclass
class Tables:
    out: str

    def __getattr__(self, name: str) -> str:
        return f"{self.out.rstrip('/')}/{name}"


def refresh(spark: SparkSession, raw_dir: str, out_dir: str, *,
            checkpoint_files: str = "checkpoints_*.csv", lookup_files: str = "thread_teams_*.csv",
            buckets: int = 64, incremental: bool = True, materialize_silver: bool = True,
            on_violation: str = "quarantine") -> dict:
    ensure_defaults(spark)
    t = Tables(out_dir)
    chk = f"{out_dir.rstrip('/')}/_checkpoints"

    # 1. bronze checkpoints; each new batch is parsed and checked once, into
    #    checkpoints_parsed/_batch=<id>/checkpoint_date=<d> (staged, published)
    def parse_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_checkpoints(batch, keep=[INGESTED_AT])
        counts = split_sink.write_split(parsed, SILVER_RULES, batch_id, t.checkpoints_parsed,
                                        t.checkpoints_quarantine, action=on_violation, partition_by="checkpoint_date")
        log_expectations(spark, t.expectation_log, "silver_checkpoints", SILVER_RULES, counts, batch_id)
        rows = spark.read.schema(parsed.schema).parquet(f"{t.checkpoints_parsed}/{ingest.BATCH_COL}={batch_id}")
        lag_state.fold(rows, t._lag_state, batch_id)
        gold_state.fold(rows, t._gold_state, batch_id)

    ingest.ingest_csv(spark, f"{raw_dir}/{checkpoint_files}", CHECKPOINT_FEED_COLUMNS,
                      t.bronze_checkpoints, f"{chk}/bronze_checkpoints", on_batch=parse_batch)

    # 2. bronze lookup + CDC into the history, per micro-batch
    def fold(batch: DataFrame, batch_id: int) -> None:
        # one processing time per micro-batch: deliveries of the same batch are
        # ordered by the age of their file, then its name and their position in it
        cleaned = apply_rules(clean_thread_lookup(batch, keep=DELIVERY_ORDER), LOOKUP_RULES, "drop")
        scd2_stream.apply_changes(cleaned, batch_id, t.thread_lookup_log, t.silver_thread_lookup_history,
                                  keys=["thread_id"], sequence_by="updated_at", tiebreak=DELIVERY_ORDER,
                                  track_columns=TRACKED, buckets=buckets)
        scd2_stream.write_owner_changes(cleaned, batch_id, t.silver_thread_lookup_history, t.owner_changes,
                                        keys=["thread_id"], track_columns=TRACKED)

    ingest.ingest_csv(spark, f"{raw_dir}/{lookup_files}", LOOKUP_FEED_COLUMNS,
                      t.bronze_thread_lookup_stream, f"{chk}/bronze_thread_lookup_stream", on_batch=fold)

    bronze = _table(spark, t.bronze_checkpoints, _empty_feed(spark, CHECKPOINT_FEED_COLUMNS))
    lookup = _table(spark, t.bronze_thread_lookup_stream, _empty_feed(spark, LOOKUP_FEED_COLUMNS)).drop(ingest.BATCH_COL)
    history = scd2_stream.read_history(spark, t.silver_thread_lookup_history, HISTORY_SCHEMA)
    new_batches = pending_batches(spark, t)
    fold_missing(spark, t, bronze)

    # 3. silver = parsed checkpoints LEFT JOIN the current owner; the parsed
    #    rows are never parsed again.  Touched dates are the only silver/gold
    #    partitions this update can change: the date filter prunes the parsed
    #    table's partitions, so the owner join and the aggregates run on those
    #    dates only.  An update without new files rewrites nothing.
    owners = scd2.current(history).select("thread_id", "user_id", "team")
    parsed = _table(spark, t.checkpoints_parsed, parse_checkpoints(bronze.limit(0))).select(*SILVER_COLUMNS)
    silver_view = parsed.join(owners, "thread_id", "left")
    changed = bool(new_batches["checkpoints"] or new_batches["lookup"])
    targets = [t.gold_user_team_metrics, t.gold_team_summary] + ([t.silver_checkpoints] if materialize_silver else [])
    missing = not all(path_exists(spark, p) for p in targets)
    if incremental and changed and not missing:
        dates = gold_state.prunable(_kept(spark, touched_dates(spark, t, new_batches), "touched_dates"))
        source = silver_view.join(dates, "checkpoint_date", "left_semi")
    else:
        dates, source = None, silver_view
    rewrite = changed or not incremental or missing
    if materialize_silver:
        if rewrite:
            _write_layer(source, t, "silver_checkpoints")
        silver = spark.read.schema(silver_view.schema).parquet(t.silver_checkpoints)
    else:
        silver = silver_view

    # 4. gold, touched dates only, from the partials
    gold_user, gold_team = gold_state.gold(spark, t._gold_state, owners, dates)
    if rewrite:
        _write_layer(gold_user, t, "gold_user_team_metrics")
        _write_layer(gold_team, t, "gold_team_summary")

    # 5. monitoring views (skipped, like 6, when nothing changed)
    if not rewrite and path_exists(spark, t.check_results):
        return new_batches
    gold_user = spark.read.schema(gold_user.schema).parquet(t.gold_user_team_metrics)
    gold_team = spark.read.schema(gold_team.schema).parquet(t.gold_team_summary)
    update_view_state(spark, t, new_batches, dates, bronze, history, silver, gold_user, gold_team)
    views = {
        t.monitoring_daily_counts: view_state.daily_counts(spark, t.out),
        t.monitoring_null_percentages: view_state.null_profile(spark, t.out),
        t.monitoring_duplicates: monitor.duplicates(bronze, history, silver),
        t.monitoring_processing_lag: monitor.processing_lag(silver, bronze),
        t.monitoring_delivery_lag: lag_state.delivery_lag(spark, t._lag_state),
    }
    for path, df in views.items():
        replace_table(spark, path, lambda p, df=df: df.write.mode("overwrite").parquet(p))

    # 6. cross-layer checks over the written tables (one row per check)
    newest = silver.agg(F.max("checkpoint_date")).scalar()
    results = checks.run_checks(bronze, lookup, history, owners, silver, gold_user, gold_team, as_of=newest)
    replace_table(spark, t.check_results, lambda p: results.withColumn(
        "checked_at", F.current_timestamp()).write.mode("overwrite").parquet(p))

    # all of the above includes these batches
    done = [(feed, max(ids)) for feed, ids in new_batches.items() if ids]
    if done:
        kept = [(feed, last) for feed, last in applied_batches(spark, t).items() if feed not in dict(done)]
        marker = spark.createDataFrame(done + kept, "feed string, batch_id bigint")
        replace_table(spark, t.applied_batches, lambda p: marker.write.mode("overwrite").parquet(p))
    return new_batches


def fold_missing(spark: SparkSession, t: Tables, bronze: DataFrame) -> None:
    """Partials of batches that have none: those of an update that failed after parsing, or of an older release."""
    for batch in missing_batches(spark, t.checkpoints_parsed, t._lag_state):
        rows = parse_checkpoints(bronze.filter(F.col(ingest.BATCH_COL) == batch), keep=[INGESTED_AT])
        lag_state.fold(rows, t._lag_state, batch)
    for batch in missing_batches(spark, t.checkpoints_parsed, f"{t._gold_state}/ids"):
        schema = parse_checkpoints(bronze.limit(0)).schema
        rows = spark.read.schema(schema).parquet(f"{t.checkpoints_parsed}/{ingest.BATCH_COL}={batch}")
        gold_state.fold(rows, t._gold_state, batch)


def update_view_state(spark: SparkSession, t: Tables, new_batches: dict, dates: DataFrame | None, bronze: DataFrame,
                      history: DataFrame, silver: DataFrame, gold_user: DataFrame, gold_team: DataFrame) -> None:
    """The partial aggregates of the views, from the new batches and touched dates alone where they exist."""
    base = view_state.base_batch(spark, t.out)
    if dates is None or base is None or any(b <= base for b in new_batches["lookup"]):
        last = max(batch_ids(spark, t.bronze_thread_lookup_stream), default=-1)
        view_state.rebuild(spark, t.out, bronze, history, last, silver, gold_user, gold_team)
        return
    if new_batches["checkpoints"]:
        view_state.fold_batches(t.out, "bronze_checkpoints", bronze.filter(F.col(ingest.BATCH_COL).isin(new_batches["checkpoints"])))
    deltas = [b for b in batch_ids(spark, t.silver_thread_lookup_history) if b in new_batches["lookup"]]
    if deltas:
        rows = spark.read.parquet(t.silver_thread_lookup_history).filter(F.col(ingest.BATCH_COL).isin(deltas))
        view_state.fold_batches(t.out, monitor.HISTORY_LAYER, rows, view_state.delta_weight())
    for layer, df in zip(view_state.BY_DATE, (silver, gold_user, gold_team)):
        view_state.replace_dates(t.out, layer, df.join(dates, "checkpoint_date", "left_semi"), dates)


def _kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A small table that several steps use, written once."""
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Columns of the ownership history before any batch has written it.
HISTORY_SCHEMA = (f"thread_id string, user_id string, team string, updated_at timestamp, {SOURCE_TIME} timestamp, "
                  f"{SOURCE_FILE} string, {SOURCE_LINE} bigint, {START_AT} timestamp, {END_AT} timestamp")


def _empty_feed(spark: SparkSession, columns: list[str]) -> DataFrame:
    """A bronze table of which no file has arrived yet."""
    cells = ", ".join(f"{c} string" for c in [*columns, RESCUE_COLUMN])
    return spark.createDataFrame([], f"{cells}, {SOURCE_TIME} timestamp, {SOURCE_FILE} string, {SOURCE_LINE} bigint, "
                                     f"{INGESTED_AT} timestamp, {ingest.BATCH_COL} int")


def _table(spark: SparkSession, path: str, empty: DataFrame) -> DataFrame:
    """A table of batch folders; ``empty`` as long as it has none."""
    return spark.read.parquet(path) if batch_ids(spark, path) else empty


def applied_batches(spark: SparkSession, t: Tables) -> dict[str, int]:
    """Per feed, the last batch that the output tables include."""
    if not path_exists(spark, t.applied_batches):
        return {}
    return {r.feed: r.batch_id for r in spark.read.parquet(t.applied_batches).collect()}


def pending_batches(spark: SparkSession, t: Tables) -> dict[str, list[int]]:
    """Per feed, the published batches that the output tables don't include yet."""
    applied = applied_batches(spark, t)
    tables = {"checkpoints": t.checkpoints_parsed, "lookup": t.bronze_thread_lookup_stream}
    return {feed: [b for b in batch_ids(spark, path) if b > applied.get(feed, -1)] for feed, path in tables.items()}


def _write_layer(df: DataFrame, t: Tables, name: str) -> None:
    """Clustered, date-partitioned write (dynamic partition overwrite) of a layer."""
    cluster_by, partition_by = upkeep.REFRESH_LAYOUT[name]
    upkeep.write_clustered(df, getattr(t, name), cluster_by, partition_by=partition_by)


def replace_table(spark: SparkSession, path: str, write) -> None:
    """Full rewrite of a table: written beside it, then swapped in by rename.

    A plain overwrite deletes the old files before writing, so a failed job
    would leave the table empty; here readers see the old or the new table.
    """
    parent, name = path.rstrip("/").rsplit("/", 1)
    staged = f"{parent}/_staging_{name}"
    write(staged)
    publish(spark, staged, path)


def log_expectations(spark: SparkSession, path: str, dataset: str, rules, counts: dict, batch_id: int) -> None:
    """One row per rule: the counts observed while a batch was written (a retried batch replaces its own)."""
    rows = [(dataset, batch_id, r.name, r.condition, int(counts.get("total", 0)), int(counts.get(r.name, 0)))
            for r in rules]
    (spark.createDataFrame(rows, "dataset string, batch_id bigint, rule string, condition string, "
                                 "total bigint, failed bigint")
     .withColumn("measured_at", F.current_timestamp())
     .write.mode("overwrite").parquet(f"{path}/{ingest.BATCH_COL}={batch_id}"))


def touched_dates(spark: SparkSession, t: Tables, new_batches: dict) -> DataFrame:
    """Dates whose silver and gold rows can change in this update (distributed, distinct)."""
    parts = []
    if new_batches["checkpoints"]:
        # partition values of the new parsed batches: no data columns read
        parts.append(spark.read.parquet(t.checkpoints_parsed)
                     .filter(F.col(ingest.BATCH_COL).isin(new_batches["checkpoints"]))
                     .select("checkpoint_date"))
    if new_batches["lookup"]:
        moved = (spark.read.parquet(t.owner_changes)
                 .filter(F.col(ingest.BATCH_COL).isin(new_batches["lookup"]))
                 .select("thread_id").distinct())
        parts.append(gold_state.thread_days(spark, t._gold_state).join(moved, "thread_id", "left_semi").select("checkpoint_date"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter(F.col("checkpoint_date").isNotNull()).distinct()


if __name__ == "__main__":
    import sys

    if len(sys.argv) != 3:
        sys.exit("usage: spark-submit threadlens/plans/refresh.py RAW_DIR OUT_DIR")
    # the session of spark-submit (cluster), or a local one when run directly
    print(refresh(SparkSession.builder.appName("threadlens-refresh").getOrCreate(), sys.argv[1], sys.argv[2]))
