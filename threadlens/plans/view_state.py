"""Monitoring views kept from partial aggregates that merge and retract.

A view over a growing table need not read the table again.  Per layer, small
tables below ``<out>/_view_state`` hold partial aggregates: rows and NULLs of
the profiled columns, by date.

* ``bronze_checkpoints`` only grows: one partial per batch, by the batch;
* the ownership history changes by deltas: a version that is new counts +1, one
  that is gone -1, one that is only closed 0, per batch as well;
* silver and gold are rewritten by date: the partials of the touched dates are
  replaced, with zeros where a date has lost its rows.

The views are sums over these tables, whose size follows batches and dates, not
rows.  A partial is written under the batch (or date) it comes from, by dynamic
partition overwrite, so a repeated update writes the same again.  ``rebuild``
makes all partials from the whole tables: for a first update, or on demand.  It
takes the history as one batch, whose id it notes first: deltas up to that one
are in it already, and an update that still has them pending rebuilds again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.operators import monitor
from threadlens.session import path_exists

BATCH_COL = "_batch"
HISTORY = monitor.HISTORY_LAYER
#: The date of a row of each layer.
DAY = {
    "bronze_checkpoints": F.to_date, HISTORY: F.to_date, "silver_checkpoints": F.col, "gold_user_team_metrics": F.col, "gold_team_summary": F.col,
}
DAY_COLUMN = {
    "bronze_checkpoints": "ingested_at", HISTORY: "updated_at", "silver_checkpoints": "checkpoint_date",
    "gold_user_team_metrics": "checkpoint_date", "gold_team_summary": "checkpoint_date",
}
BY_DATE = ("silver_checkpoints", "gold_user_team_metrics", "gold_team_summary")


def state_dir(out: str, layer: str) -> str:
    return f"{out.rstrip('/')}/_view_state/{layer}"


def partial(rows: DataFrame, layer: str, weight: Column | None = None, by: list[str] | None = None) -> DataFrame:
    """(by, date, rows, nulls): weighted counts of rows and of NULLs in each profiled column."""
    weight = F.lit(1) if weight is None else weight
    columns = monitor.NULL_PROFILE_COLUMNS.get(layer, [])
    day = DAY[layer](DAY_COLUMN[layer]).alias("date")
    out = rows.groupBy(*(by or []), day).agg(
        F.sum(weight).cast("long").alias("rows"),
        *[F.coalesce(F.sum(F.when(F.col(c).isNull(), weight)), F.lit(0)).cast("long").alias(f"_n{i}") for i, c in enumerate(columns)])
    nulls = F.array(*[F.col(f"_n{i}") for i in range(len(columns))]).cast("array<long>")
    return out.select(*(by or []), "date", "rows", nulls.alias("nulls"))


def _write(df: DataFrame, path: str, partition: str) -> None:
    (df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))


def fold_batches(out: str, layer: str, rows: DataFrame, weight: Column | None = None) -> None:
    """Partials of batches of rows (with their ``_batch``)."""
    _write(partial(rows, layer, weight, [BATCH_COL]), state_dir(out, layer), BATCH_COL)


def delta_weight() -> Column:
    """What a row of a history delta adds to the number of versions."""
    return F.when(F.col("_gone"), F.lit(-1)).when(F.col("_new"), F.lit(1)).otherwise(F.lit(0))


def replace_dates(out: str, layer: str, rows: DataFrame, dates: DataFrame | None) -> None:
    """Partials of the rows of whole dates; of ``dates`` without rows, zeros."""
    got = partial(rows, layer)
    if dates is not None:
        got = dates.select(F.col("checkpoint_date").alias("date")).join(got, "date", "left").select(
            "date", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "nulls")
    _write(got.withColumn("day", F.col("date")), state_dir(out, layer), "day")


def base_batch(spark: SparkSession, out: str) -> int | None:
    """The last lookup batch that a rebuild took in; None without complete partials."""
    if not all(path_exists(spark, state_dir(out, layer)) for layer in (*DAY, "base")):
        return None
    return spark.read.parquet(state_dir(out, "base")).first()["last"]


def rebuild(spark: SparkSession, out: str, bronze: DataFrame, history: DataFrame, last_lookup_batch: int,
            silver: DataFrame, gold_user: DataFrame, gold_team: DataFrame) -> None:
    """All partials from the whole tables (the history's as one batch, the last)."""
    spark.createDataFrame([(last_lookup_batch,)], "last long").coalesce(1).write.mode("overwrite").parquet(state_dir(out, "base"))
    whole = {
        "bronze_checkpoints": (partial(bronze, "bronze_checkpoints", by=[BATCH_COL]), BATCH_COL),
        HISTORY: (partial(history, HISTORY).withColumn(BATCH_COL, F.lit(last_lookup_batch)), BATCH_COL),
        **{layer: (partial(df, layer).withColumn("day", F.col("date")), "day")
           for layer, df in zip(BY_DATE, (silver, gold_user, gold_team))},
    }
    for layer, (df, partition) in whole.items():
        df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(partition).parquet(state_dir(out, layer))


def read_state(spark: SparkSession, out: str, layer: str) -> DataFrame:
    schema = "date date, rows long, nulls array<long>"
    path = state_dir(out, layer)
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def daily_counts(spark: SparkSession, out: str) -> DataFrame:
    """A8 from the partials: what ``monitor.daily_counts`` gives over the whole tables."""
    arms = None
    for layer in DAY:
        arm = read_state(spark, out, layer).groupBy("date").agg(F.sum("rows").alias("record_count")).where("record_count > 0").select(
            F.lit(layer).alias("layer"), "date", "record_count")
        arms = arm if arms is None else arms.unionByName(arm)
    return arms


def null_profile(spark: SparkSession, out: str, with_time: bool = True) -> DataFrame:
    """A9 from the partials: what ``monitor.layer_null_profile`` gives over the whole tables."""
    arms = None
    for layer, columns in monitor.NULL_PROFILE_COLUMNS.items():
        wide = read_state(spark, out, layer).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("_total"),
            *[F.coalesce(F.sum(F.get("nulls", F.lit(i))), F.lit(0)).alias(f"_n{i}") for i in range(len(columns))])
        pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(columns))
        arm = wide.selectExpr("_total", f"stack({len(columns)}, {pairs}) AS (column_name, _nulls)").select(
            F.lit(layer).alias("table_name"), "column_name",
            F.when(F.col("_total") > 0, F.round(F.col("_nulls").cast("double") * 100.0 / F.col("_total"), 2)).cast("double").alias("null_percentage"),
            F.col("_total").alias("total_records"))
        arms = arm if arms is None else arms.unionByName(arm)
    return arms.withColumn("measured_at", F.current_timestamp()) if with_time else arms
