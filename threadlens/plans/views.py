"""SQL access: the layers as temporary views under their table names.

``register_layers`` exposes the lazy layer plans (``Layers``), and
``register_tables`` exposes the tables written by ``refresh``.  Reports then
run as plain Spark SQL (``spark.sql("SELECT ... FROM gold_team_summary ...")``)
and Catalyst optimises the view body together with the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadlens.operators import monitor
from threadlens.plans.layers import Layers
from threadlens.plans.refresh import Tables
from threadlens.session import path_exists
from threadlens.streaming import ingest, scd2_stream


def _register(frames: dict[str, DataFrame]) -> list[str]:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)


def register_layers(L: Layers) -> list[str]:
    """Views over the lazily built layers (test tables or given feeds)."""
    return _register({
        "bronze_checkpoints": L.bronze,
        "thread_lookup_cleaned": L.lookup_feed,
        "silver_thread_lookup_history": L.history,
        "silver_checkpoints": L.silver,
        "gold_user_team_metrics": L.gold_user,
        "gold_team_summary": L.gold_team,
        "monitoring_daily_counts": monitor.daily_counts(L.bronze, L.history, L.silver, L.gold_user, L.gold_team),
        "monitoring_null_percentages": monitor.layer_null_profile(L.bronze, L.history, L.silver),
        "monitoring_duplicates": monitor.duplicates(L.bronze, L.history, L.silver),
        "monitoring_processing_lag": monitor.processing_lag(L.silver, L.bronze),
    })


def register_tables(spark: SparkSession, out_dir: str) -> list[str]:
    """Views over the tables written by ``refresh(spark, raw_dir, out_dir)``."""
    t = Tables(out_dir)
    frames = {}
    for name in ["bronze_checkpoints", "bronze_thread_lookup_stream"]:
        if path_exists(spark, getattr(t, name)):
            frames[name] = ingest.read_table(spark, getattr(t, name)).drop(ingest.BATCH_COL)
    if path_exists(spark, t.silver_thread_lookup_history):
        frames["silver_thread_lookup_history"] = scd2_stream.read_history(spark, t.silver_thread_lookup_history)
    for name in ["silver_checkpoints", "gold_user_team_metrics", "gold_team_summary", "expectation_log",
                 "monitoring_daily_counts", "monitoring_null_percentages", "monitoring_duplicates",
                 "monitoring_processing_lag", "check_results"]:
        if path_exists(spark, getattr(t, name)):
            frames[name] = spark.read.parquet(getattr(t, name))
    return _register(frames)
