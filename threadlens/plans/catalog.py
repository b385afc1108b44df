"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the driver's tables (through the adapters) over their
whole extent.  Outputs are normalised to oracle-comparable types: zoned
timestamps are emitted as ``timestamp_ntz`` (the session is pinned to UTC,
so the wall-clock value is the instant).  Processing-time columns
(``measured_at``/``detected_at``) are left out of compared outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from threadlens.operators import checks, expectations, metrics, monitor, reports, scd2, upkeep
from threadlens.operators.enrich import SILVER_COLUMNS, clean_thread_lookup, parse_checkpoints
from threadlens.operators.expectations import Rule
from threadlens.plans.layers import LOOKUP_RULES, SILVER_RULES, Layers
from threadlens.sources import adapters

HISTORY_COLS = ["thread_id", "user_id", "team", "updated_at", "__START_AT", "__END_AT"]
SILVER_OUT = SILVER_COLUMNS + ["user_id", "team"]


def oracle_types(df: DataFrame) -> DataFrame:
    """Zoned timestamps -> timestamp_ntz (same wall clock under UTC)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _q(build: Callable[[Layers], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return oracle_types(build(Layers.shared(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


def _feed_asof(L: Layers):
    """Midnight 15 days before the newest lookup delivery date."""
    newest = L.lookup_feed.agg(F.max(F.to_date("updated_at"))).scalar()
    return F.date_sub(newest, 15).cast("timestamp_ntz")


def _orders_history(L: Layers) -> DataFrame:
    return scd2.scd2_history(
        adapters.orders_feed(L.table("orders")), keys=["o_custkey"], sequence_by="o_orderdate",
        tiebreak=["o_orderkey"], track_columns=["o_orderstatus"],
    )


def _split_history(L: Layers) -> DataFrame:
    """C2 through the hot-key plan: every thread with more than 16 deliveries
    is treated as hot and cut into sequence chunks."""
    return scd2.scd2_history(
        L.lookup_feed, keys=["thread_id"], sequence_by="updated_at", tiebreak=L.lookup_tiebreak,
        track_columns=["user_id", "team"], split_hot_keys=True, hot_key_rows=16,
    ).select(*HISTORY_COLS)


def _owner_at_the_time(L: Layers, **how) -> DataFrame:
    """Every parsed checkpoint with the owner its thread had at the checkpoint's own time."""
    return scd2.asof_join(parse_checkpoints(L.bronze), L.history, ["thread_id"], "checkpoint_ts", ["user_id", "team"], **how)


# The silver rule and the gold user-metrics rules, counted on the enriched rows.
REPORT_RULES = SILVER_RULES + [
    Rule("valid_user_id", "user_id IS NOT NULL"),
    Rule("valid_team", "team IS NOT NULL"),
    Rule("valid_checkpoint_date", "checkpoint_date IS NOT NULL"),
]


_THIRD_OF_USERS = "CAST(substr(user_id, 2) AS BIGINT) % 3 = 0"


def _with_null_threads(feed: DataFrame) -> DataFrame:
    """The lookup feed with a NULL key in every 17th delivery (Q1 must drop them)."""
    return feed.withColumn("thread_id", F.when(F.col("event_id") % 17 != 0, F.col("thread_id")))


def _warned(L: Layers) -> DataFrame:
    """Q6: the counts that ``warn`` observed while the enriched rows were written."""
    seen = Observation("warned")
    rows = expectations.apply_rules(L.silver_unchecked, SILVER_RULES, "warn", observation=seen)
    rows.write.format("noop").mode("overwrite").save()
    return L.spark.createDataFrame([(r.name, seen.get["total"], seen.get[r.name]) for r in SILVER_RULES],
                                   "rule string, total bigint, failed bigint")


STAT_COLUMNS = ["thread_id", "checkpoint_ns", "checkpoint_id", "parent_checkpoint_id",
                "type", "checkpoint", "metadata", "_rescued_data"]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lookup_cleaned": _q(lambda L: clean_thread_lookup(adapters.raw_lookup_feed(L.table("events")), "ts")),
    "checkpoint_json_fields": _q(lambda L: parse_checkpoints(L.bronze).select(
        "thread_id", "checkpoint_id", "checkpoint_ts", "checkpoint_v", "checkpoint_id_parsed",
        "metadata_step_int", "metadata_source", "channel_versions_start")),
    "silver_checkpoints": _q(lambda L: L.silver.select(*SILVER_OUT)),
    "gold_user_team_metrics": _q(lambda L: L.gold_user),
    "gold_team_summary": _q(lambda L: L.gold_team),
    "team_daily": _q(lambda L: metrics.team_daily(L.gold_user)),
    "scd2_history": _q(lambda L: L.history_all.select(*HISTORY_COLS)),
    "scd2_collapsed": _q(lambda L: L.history.select(*HISTORY_COLS)),
    "scd2_hot_split": _q(_split_history),
    "scd2_current": _q(lambda L: reports.current_ownership(L.history)),
    "scd2_asof": _q(lambda L: scd2.as_of(L.history, _feed_asof(L)).select(
        "thread_id", "user_id", "team", "__START_AT", "__END_AT")),
    "scd2_asof_join": _q(lambda L: _owner_at_the_time(L).select(
        "thread_id", "checkpoint_ns", "checkpoint_id", "checkpoint_ts", "user_id", "team")),
    "scd2_asof_join_split": _q(lambda L: _owner_at_the_time(L, hot_key_rows=16).select(
        "thread_id", "checkpoint_ns", "checkpoint_id", "checkpoint_ts", "user_id", "team")),
    "scd2_orders_ties": _q(lambda L: _orders_history(L).select(
        "o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey", "__START_AT", "__END_AT")),
    "thread_history": _q(lambda L: reports.thread_history(L.history, reports.most_changed_thread(L.history))),
    "daily_counts": _q(lambda L: monitor.daily_counts(L.bronze, L.history, L.silver, L.gold_user, L.gold_team)),
    "null_profile": _q(lambda L: monitor.layer_null_profile(L.bronze, L.history, L.silver, with_time=False)),
    "null_wide": _q(lambda L: monitor.null_wide(L.silver)),
    "dup_bronze": _q(lambda L: monitor.dup_bronze(L.bronze)),
    "dup_lookup": _q(lambda L: monitor.dup_lookup(L.history)),
    "dup_lookup_current": _q(lambda L: monitor.dup_lookup(L.history, current_only=True)),
    "dup_silver": _q(lambda L: monitor.dup_silver(L.silver)),
    "duplicates": _q(lambda L: monitor.duplicates(L.bronze, L.history, L.silver, with_time=False)),
    "processing_lag": _q(lambda L: monitor.processing_lag(L.silver, L.bronze, with_time=False)),
    "volume_by_date": _q(lambda L: monitor.volume_by_date(L.silver)),
    "user_metrics_last7": _q(lambda L: reports.user_metrics_recent(L.gold_user, L.newest_date(), 7)),
    "team_summary_last7": _q(lambda L: reports.team_summary_recent(L.gold_team, days=7)),
    "team_dashboard": _q(lambda L: reports.team_dashboard(L.gold_team, days=30)),
    "latest_bronze": _q(lambda L: reports.latest_bronze(L.bronze, 10)),
    "latest_lookup": _q(lambda L: reports.latest_lookup(L.history, 50)),
    "latest_silver": _q(lambda L: reports.latest_silver(L.silver, 20)),
    "orphan_threads": _q(lambda L: reports.orphan_threads(L.silver, L.current_owner)),
    "missing_teams": _q(lambda L: reports.missing_teams(L.silver, L.gold_team)),
    "expect_lookup": _q(lambda L: L.lookup_feed.select("thread_id", "user_id", "team", "updated_at")),
    "expect_silver": _q(lambda L: expectations.apply_rules(
        L.silver_unchecked, SILVER_RULES, "warn").select(*SILVER_OUT)),
    "expect_lookup_nulls": _q(lambda L: expectations.apply_rules(
        _with_null_threads(L.lookup_feed), LOOKUP_RULES, "drop").select("thread_id", "user_id", "team", "updated_at")),
    "expect_warn_counts": _q(_warned),
    "open_version_duplicates": _q(lambda L: scd2.duplicate_current_versions(
        L.history.unionByName(L.history.filter(_THIRD_OF_USERS)), ["thread_id"])),
    "missing_teams_found": _q(lambda L: reports.missing_teams(L.silver, L.gold_team.filter("team <> 'team_0'"))),
    "expect_quarantine": _q(lambda L: expectations.apply_rules(
        L.silver_unchecked, SILVER_RULES, "quarantine").select(*SILVER_OUT)),
    "expect_report": _q(lambda L: expectations.expectation_report(
        L.silver_unchecked, REPORT_RULES, "silver_checkpoints")),
    "checks": _q(lambda L: checks.run_checks(
        L.bronze, L.lookup_feed, L.history, L.current_owner, L.silver, L.gold_user, L.gold_team,
        as_of=L.newest_date())),
    "conversation_checkpoints": _q(lambda L: parse_checkpoints(
        adapters.conversation_feed(L.table("conversations")))),
    "rescued_rows": _q(lambda L: expectations.rescued_rows(L.bronze)),
    "column_stats": _q(lambda L: upkeep.column_stats(L.bronze, STAT_COLUMNS, approx=False)),
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gold_user_team_metrics end to end: feeds -> SCD2 -> silver -> gold."""
    return QUERIES["gold_user_team_metrics"](spark, sf_dir)
