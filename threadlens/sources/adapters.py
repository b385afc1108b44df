"""Adapters from the driver's test tables to the pipeline's feeds.

The test data has no checkpoint feed, so one is derived from ``events``:
every event is a checkpoint of thread ``t<user_id*4 + event_id%4>``, every
50th event is delivered twice (one hour later), some payloads are malformed
or missing, and the thread lookup feed re-sends ownership with event time as
sequence.  Everything is a projection/filter/union of the scan, so the feeds
grow with the tables and stay partitioned like them.

Fixed values (the oracle SQL uses the same ones): malformed checkpoint JSON
when event_id % 97 = 0, NULL metadata when event_id % 41 = 0, duplicate
delivery when event_id % 50 = 0, rescued cells when event_id % 13 = 0,
orphan users when user_id % 11 = 0, five teams, team re-assignment every
2500 events.
"""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SCANS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()
_SPLITS: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The scan of one test table.

    The scan DataFrame is kept per session: later queries reuse its file
    index instead of listing and reading footers again (the test tables are
    read-only).  Every execution still reads the files.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    cache = _SCANS.setdefault(spark, {})
    if path not in cache:
        cache[path] = spark.read.parquet(path)
    return cache[path]


def spread(events: DataFrame) -> DataFrame:
    """The events over as many partitions as there are cores, if their files give fewer splits.

    A table of one Parquet row group is read by one task, and building and
    parsing the JSON payloads after it would run on one core.  Rows are
    hashed by ``event_id`` (the same rows meet whenever a task is retried).  A
    large table has many splits and comes back unchanged: no shuffle at scale.
    """
    spark = events.sparkSession
    splits = _SPLITS.setdefault(spark, {})
    key = tuple(sorted(events.inputFiles()))
    if key not in splits:
        splits[key] = events.rdd.getNumPartitions()
    cores = spark.sparkContext.defaultParallelism
    return events.repartition(cores, "event_id") if 0 < splits[key] < cores else events


def _s(col: Column) -> Column:
    return col.cast("string")


def events_with_threads(events: DataFrame) -> DataFrame:
    thread = F.concat(F.lit("t"), _s(F.col("user_id") * 4 + F.col("event_id") % 4))
    return events.withColumn("thread_id", thread)


def checkpoint_feed(events: DataFrame) -> DataFrame:
    """Bronze-shaped checkpoint rows (with one duplicate delivery per 50)."""
    # every 50th event is delivered a second time: one row per delivery,
    # generated from the same scan (no second pass, no self-union)
    eid = F.col("event_id")
    deliveries = events_with_threads(spread(events)).select(
        "thread_id", "event_id", "ts", "user_id", "event_type",
        F.explode(F.when(eid % 50 == 0, F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("_d"),
    )
    ts_text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    checkpoint = F.when(eid % 97 == 0, F.lit('{"v":')).otherwise(
        F.concat(
            F.lit('{"v":"4","id":"c'), _s(eid), F.lit('","ts":"'), ts_text,
            F.lit('","channel_versions":{"__start__":"'), _s(eid % 7), F.lit('"}}'),
        )
    )
    metadata = F.when(eid % 41 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit('{"step":"'), _s(eid % 20), F.lit('","source":"'),
                 F.col("event_type"), F.lit('"}'))
    )
    rescued = F.when(eid % 13 == 0, F.concat(F.lit('{"user_id":"'), _s(F.col("user_id")), F.lit('"}')))
    lag_seconds = eid % 600 + F.col("_d") * 3600
    return deliveries.select(
        "thread_id",
        F.col("event_type").alias("checkpoint_ns"),
        F.concat(F.lit("c"), _s(eid)).alias("checkpoint_id"),
        F.when(eid < 4, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("c"), _s(eid - 4))).alias("parent_checkpoint_id"),
        F.lit("checkpoint").alias("type"),
        checkpoint.alias("checkpoint"),
        metadata.alias("metadata"),
        rescued.alias("_rescued_data"),
        F.timestamp_add("SECOND", lag_seconds, F.col("ts")).alias("ingested_at"),
    )


def raw_lookup_feed(events: DataFrame) -> DataFrame:
    """Lookup deliveries with numeric ids (as a CSV with inferred types would be)."""
    team = F.concat(
        F.lit("team_"),
        _s((F.col("user_id") + F.floor(F.col("event_id") / 2500)) % 5),
    )
    return events.filter(F.col("user_id") % 11 != 0).select(
        (F.col("user_id") * 4 + F.col("event_id") % 4).alias("thread_id"),
        F.col("user_id"),
        team.alias("team"),
        F.col("ts"),
        F.col("event_id"),
    )


def lookup_feed(events: DataFrame) -> DataFrame:
    """Cleaned lookup change feed: text ids, event-time sequence, tiebreak."""
    raw = raw_lookup_feed(events)
    return raw.select(
        F.concat(F.lit("t"), _s(F.col("thread_id"))).alias("thread_id"),
        F.concat(F.lit("u"), _s(F.col("user_id"))).alias("user_id"),
        "team",
        F.col("ts").alias("updated_at"),
        "event_id",
    )


def orders_feed(orders: DataFrame) -> DataFrame:
    """Orders as a change feed of customer status (ties on o_orderdate)."""
    return orders.select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey")


def conversation_feed(conversations: DataFrame) -> DataFrame:
    """Conversations as checkpoints: thread = conv_id, step = turn (a JSON
    number), source = role; turn n happens n minutes after a fixed start."""
    cid = F.concat(F.lit("k"), _s(F.col("conv_id")), F.lit("_"), _s(F.col("turn")))
    ts = F.timestamp_add("MINUTE", F.col("turn"), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    return conversations.select(
        F.concat(F.lit("conv"), _s(F.col("conv_id"))).alias("thread_id"),
        F.col("role").alias("checkpoint_ns"),
        cid.alias("checkpoint_id"),
        F.lit(None).cast("string").alias("parent_checkpoint_id"),
        F.lit("checkpoint").alias("type"),
        F.concat(F.lit('{"v":1,"id":"'), cid, F.lit('","ts":"'), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
                 F.lit('"}')).alias("checkpoint"),
        F.concat(F.lit('{"step":'), _s(F.col("turn")), F.lit(',"source":"'),
                 F.col("role"), F.lit('"}')).alias("metadata"),
    )
