"""Gold metrics from stored partials by thread and day, exact distinct counts included (A1, A2, A4).

Silver joins the *current* owner of a thread, so user and team are functions of
the thread, and an owner change re-attributes old checkpoints without changing
them.  What a batch contributes is therefore kept apart from owners:

* ``threads``: per (date, thread) rows, first and last time, least, greatest,
  sum and number of steps;
* ``ids``: the distinct (date, thread, parsed checkpoint id).

Both are narrow and typed, partitioned by batch and date.  The metrics of the
touched dates merge the partials of those dates (partition pruning), join the
owners and aggregate: no old checkpoint row is read, joined or parsed again.
A thread has one owner, so threads of a group are counted as rows, users of a team
as rows of (date, user, team), and ids after one ``distinct`` of (group, id): no
Expand, and every shuffle but the last is keyed by thread, user or id, so a hot
team or day is spread.

The ids table has as many rows as there are distinct ids; exact counts that can
be re-attributed need the values themselves.  Expects one current owner per
thread, which ``scd2.current`` gives and the checks watch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.operators.expectations import apply_rules
from threadlens.operators.metrics import TEAM_KEYS, TEAM_RULES, USER_TEAM_KEYS, USER_TEAM_RULES
from threadlens.plans.batch_state import read_batches, write_batch

DAY = "checkpoint_date"
THREADS = (f"thread_id string, n long, first_ts timestamp, last_ts timestamp, min_step int, max_step int, "
           f"sum_step long, n_step long, {DAY} date")
IDS = f"thread_id string, checkpoint_id_parsed string, {DAY} date"


def fold(rows: DataFrame, path: str, batch_id: int) -> None:
    """Keep the partials of one batch of parsed rows."""
    threads = rows.groupBy("thread_id", DAY).agg(
        F.count(F.lit(1)).alias("n"), F.min("checkpoint_ts").alias("first_ts"), F.max("checkpoint_ts").alias("last_ts"),
        F.min("metadata_step_int").alias("min_step"), F.max("metadata_step_int").alias("max_step"),
        F.sum("metadata_step_int").alias("sum_step"), F.count("metadata_step_int").alias("n_step"))
    ids = rows.filter("checkpoint_id_parsed IS NOT NULL").select("thread_id", "checkpoint_id_parsed", DAY).distinct()
    for name, df in (("threads", threads), ("ids", ids)):
        write_batch(df, f"{path.rstrip('/')}/{name}", batch_id, [DAY])


def thread_days(spark: SparkSession, path: str) -> DataFrame:
    """(thread_id, checkpoint_date) of all batches: which dates an owner change touches."""
    return read_batches(spark, f"{path.rstrip('/')}/threads", THREADS).select("thread_id", DAY)


def prunable(dates: DataFrame) -> DataFrame:
    """``dates`` with a comparison that holds for every date: partitions are pruned at run time only by a filtered side."""
    return dates.filter(F.col(DAY) >= F.expr("DATE '0001-01-01'"))


def _of_dates(df: DataFrame, dates: DataFrame | None) -> DataFrame:
    return df if dates is None else df.join(dates.select(DAY), DAY, "left_semi")


def gold(spark: SparkSession, path: str, owners: DataFrame, dates: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(gold_user_team_metrics, gold_team_summary) of ``dates`` (all without them)."""
    base = path.rstrip("/")
    owners = owners.select("thread_id", "user_id", "team")
    threads = _of_dates(read_batches(spark, f"{base}/threads", THREADS), dates).groupBy("thread_id", DAY).agg(*_merge())
    ids = _of_dates(read_batches(spark, f"{base}/ids", IDS), dates)
    # one row per (date, user, team), NULL owners included: both metrics come from it
    groups = threads.join(owners, "thread_id", "left").groupBy(*USER_TEAM_KEYS).agg(
        *_merge(), F.count("thread_id").alias("thread_count"))
    owned_ids = ids.join(owners, "thread_id", "left")
    users = _metrics(apply_rules(groups, USER_TEAM_RULES, "drop"), owned_ids, USER_TEAM_KEYS, ["checkpoint_count", "thread_count"])
    per_team = groups.groupBy(*TEAM_KEYS).agg(
        *_merge(), F.count("user_id").alias("user_count"), F.sum("thread_count").alias("thread_count"))
    teams = _metrics(apply_rules(per_team, TEAM_RULES, "drop"), owned_ids, TEAM_KEYS, ["checkpoint_count", "user_count", "thread_count"])
    return users, teams


def _merge() -> list:
    return [F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
            F.min("min_step").alias("min_step"), F.max("max_step").alias("max_step"),
            F.sum("sum_step").alias("sum_step"), F.sum("n_step").alias("n_step")]


def _metrics(groups: DataFrame, owned_ids: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """The output columns of ``operators.metrics``, with the distinct ids of every group."""
    uniques = owned_ids.select(*keys, "checkpoint_id_parsed").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("unique_checkpoints"))
    return groups.withColumnRenamed("n", "checkpoint_count").join(uniques, keys, "left").select(
        *keys, *counts, F.coalesce("unique_checkpoints", F.lit(0)).alias("unique_checkpoints"),
        F.col("first_ts").alias("first_checkpoint_ts"), F.col("last_ts").alias("last_checkpoint_ts"), "min_step", "max_step",
        F.try_divide(F.col("sum_step").cast("double"), F.col("n_step")).alias("avg_step"))
