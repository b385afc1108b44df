"""Delivery lag by event day from stored quantile sketches.

Every batch leaves, per event day, the number of its deliveries, the sum, least
and greatest of their lags (seconds from a checkpoint's time to its ingestion)
and a KLL sketch of them.  Counts, sums and extremes merge exactly, sketches by
``kll_merge_agg_bigint``; an update reads its own batch only, and the view reads
one row a batch and day.

``monitor.processing_lag`` weighs every pair of a silver and a bronze row of one
key, so a key delivered k times counts k * k; here a delivery counts once.
Without repeated deliveries both have the same rows.

A sketch with ``SKETCH_K`` has a normalised rank error of about 0.4 % (99 %
confidence); ``RANK_ERROR`` is what the view promises: a median or 95th
percentile lies between the exact values at ranks one hundredth lower and higher.
Rows without an event time are left out, empty tables give no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadlens.functions.schemas import INGESTED_AT
from threadlens.plans.batch_state import read_batches, write_batch

SKETCH_K = 800
RANK_ERROR = 0.01
PERCENTILES = {"median": 0.5, "p95": 0.95}
SCHEMA = "event_date date, n long, total long, lo long, hi long, sketch binary"


def lags(rows: DataFrame) -> DataFrame:
    """(event_date, lag): seconds from event to ingestion of every row that has both times."""
    return rows.select(
        F.to_date("checkpoint_ts").alias("event_date"),
        (F.unix_timestamp(INGESTED_AT) - F.unix_timestamp("checkpoint_ts")).alias("lag"),
    ).filter("event_date IS NOT NULL AND lag IS NOT NULL")


def partial(rows: DataFrame) -> DataFrame:
    """The partial of a batch: one row a day."""
    return lags(rows).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("lag").alias("total"), F.min("lag").alias("lo"), F.max("lag").alias("hi"),
        F.kll_sketch_agg_bigint("lag", SKETCH_K).alias("sketch"))


def fold(rows: DataFrame, path: str, batch_id: int) -> None:
    """Keep the partial of one batch of parsed rows (with ``ingested_at``)."""
    write_batch(partial(rows).coalesce(1), path, batch_id)


def merged(spark: SparkSession, path: str) -> DataFrame:
    """One row a day over all batches, with the merged sketch."""
    return read_batches(spark, path, SCHEMA).groupBy("event_date").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"))


def _minutes(seconds: Column) -> Column:
    return F.round(seconds / 60, 2)


def delivery_lag(spark: SparkSession, path: str, with_time: bool = True) -> DataFrame:
    """The view: count, mean, extremes (exact) and percentiles (within the rank error), in minutes."""
    out = merged(spark, path).select(
        "event_date", F.col("n").alias("record_count"),
        _minutes(F.col("total") / F.col("n")).alias("avg_lag_minutes"),
        _minutes(F.col("lo")).alias("min_lag_minutes"), _minutes(F.col("hi")).alias("max_lag_minutes"),
        *[_minutes(F.kll_sketch_get_quantile_bigint("sketch", F.lit(p))).alias(f"{name}_lag_minutes")
          for name, p in PERCENTILES.items()])
    return out.withColumn("measured_at", F.current_timestamp()) if with_time else out


def exact_bounds(rows: DataFrame) -> DataFrame:
    """Per day and percentile, the exact lags (seconds) at the ranks that bound the sketch's answer.

    Exact weighted ranks over (day, lag second), a table bounded by the range of lags.
    """
    per_lag = lags(rows).groupBy("event_date", "lag").agg(F.count(F.lit(1)).alias("w"))
    day = Window.partitionBy("event_date")
    ranked = per_lag.select(
        "event_date", "lag", F.sum("w").over(day.orderBy("lag").rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
        F.sum("w").over(day).alias("n"))

    def at(p: float) -> Column:
        rank = F.greatest(F.lit(1), F.least(F.col("n"), F.ceil(F.col("n") * F.lit(p))))
        return F.min(F.when(F.col("cum") >= rank, F.col("lag")))

    return ranked.groupBy("event_date").agg(*[
        at(round(p + sign * RANK_ERROR, 4)).alias(f"{name}_{side}")
        for name, p in PERCENTILES.items() for side, sign in (("low", -1), ("high", 1))])


def compare(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """The sketch's percentiles beside the exact bounds over ``rows``: one row a day."""
    answers = merged(spark, path).select(
        "event_date", F.col("n").alias("record_count"), F.col("lo").alias("min_lag"), F.col("hi").alias("max_lag"),
        F.col("total").alias("total_lag"),
        *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias(f"_{name}") for name, p in PERCENTILES.items()])
    bounds = exact_bounds(rows)
    return answers.join(bounds, "event_date", "full").select(
        "event_date", "record_count", "min_lag", "max_lag", "total_lag", *[c for c in bounds.columns if c != "event_date"],
        *[F.coalesce(F.col(f"_{name}").between(F.col(f"{name}_low"), F.col(f"{name}_high")), F.lit(False)).alias(f"{name}_within")
          for name in PERCENTILES])
