"""Ready-made report queries.

Time-bounded reports take ``as_of`` (a date or a Column such as a scalar
subquery over the data) instead of reading the wall clock, so a report can be
re-run for any day.  Top-k reports order by a full key so the k rows are
well defined; Spark plans ``orderBy().limit(k)`` as TakeOrderedAndProject
(a per-partition heap of k rows, then one merge of k x partitions rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions.schemas import END_AT, START_AT


def _since(as_of, days: int) -> Column:
    day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return F.date_sub(day, days)


def user_metrics_recent(gold_user: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Daily user metrics for the last ``days`` days."""
    return (
        gold_user.filter(F.col("checkpoint_date") >= _since(as_of, days))
        .select("checkpoint_date", "user_id", "team", "checkpoint_count",
                "thread_count", "avg_step")
        .orderBy(F.col("checkpoint_date").desc(), F.col("checkpoint_count").desc())
    )


def newest_day(gold_team: DataFrame) -> DataFrame:
    """The team summary with its newest date as ``_newest``.

    It has one row per team and day, so the window over all of it is small;
    the date comes with the rows, without a second pass over the feed.
    """
    return gold_team.withColumn("_newest", F.max("checkpoint_date").over(Window.partitionBy()))


def team_dashboard(gold_team: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """R2: team activity with checkpoints per user, up to ``as_of`` (default: the newest date of the summary)."""
    if as_of is None:
        gold_team, as_of = newest_day(gold_team), F.col("_newest")
    per_user = F.round(F.try_divide(F.col("checkpoint_count"), F.col("user_count")), 2)
    return (
        gold_team.filter(F.col("checkpoint_date") >= _since(as_of, days))
        .select("checkpoint_date", "team", "user_count", "thread_count",
                "checkpoint_count", per_user.cast("double").alias("avg_checkpoints_per_user"))
        .orderBy("team", "checkpoint_date")
    )


def team_summary_recent(gold_team: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """Team summary for the last ``days`` days up to ``as_of`` (default: the newest date of the summary)."""
    if as_of is None:
        gold_team, as_of = newest_day(gold_team), F.col("_newest")
    return (
        gold_team.filter(F.col("checkpoint_date") >= _since(as_of, days))
        .select("team", "checkpoint_date", "checkpoint_count", "user_count",
                "thread_count", "avg_step")
        .orderBy("checkpoint_date", "team")
    )


def current_ownership(history: DataFrame) -> DataFrame:
    """Who owns each thread now."""
    return history.filter(F.col(END_AT).isNull()).select("thread_id", "user_id", "team")


def thread_history(history: DataFrame, threads: DataFrame) -> DataFrame:
    """The ownership versions of the threads in ``threads`` (a key frame)."""
    return (
        history.join(threads.select("thread_id"), "thread_id", "left_semi")
        .select("thread_id", "user_id", "team",
                F.col(START_AT).alias("valid_from"), F.col(END_AT).alias("valid_to"))
        .orderBy("thread_id", "valid_from")
    )


def most_changed_thread(history: DataFrame) -> DataFrame:
    """The thread with the most versions (ties: smallest id), as a key frame."""
    return (
        history.groupBy("thread_id").agg(F.count(F.lit(1)).alias("_v"))
        .orderBy(F.col("_v").desc(), F.col("thread_id"))
        .limit(1)
        .select("thread_id")
    )


def latest_bronze(bronze: DataFrame, k: int = 10) -> DataFrame:
    """Newest raw deliveries."""
    return (
        bronze.orderBy(F.col("ingested_at").desc(), F.col("checkpoint_id").desc(),
                       F.col("thread_id").desc())
        .limit(k)
        .select("thread_id", "checkpoint_id", "type", "checkpoint", "metadata", "ingested_at")
    )


def latest_lookup(history: DataFrame, k: int = 50) -> DataFrame:
    """Newest ownership rows."""
    return (
        history.orderBy(F.col("updated_at").desc(), F.col("thread_id").desc())
        .limit(k)
        .select("thread_id", "user_id", "team", "updated_at")
    )


def latest_silver(silver: DataFrame, k: int = 20) -> DataFrame:
    """Newest enriched checkpoints."""
    return (
        silver.orderBy(F.col("checkpoint_ts").desc(), F.col("thread_id").desc(),
                       F.col("checkpoint_id").desc())
        .limit(k)
        .select("thread_id", "user_id", "team", "checkpoint_ts", "checkpoint_date",
                "checkpoint_v", "metadata_step_int", "metadata_source")
    )


def orphan_threads(silver: DataFrame, owners: DataFrame) -> DataFrame:
    """Checkpoint threads without a current owner (left anti join)."""
    return (
        silver.select("thread_id").distinct()
        .join(owners.select("thread_id"), "thread_id", "left_anti")
    )


def missing_teams(silver: DataFrame, gold_team: DataFrame) -> DataFrame:
    """Teams seen in silver but absent from the team summary."""
    return (
        silver.filter(F.col("team").isNotNull()).select("team").distinct()
        .join(gold_team.select("team"), "team", "left_anti")
    )
