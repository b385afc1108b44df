"""Profiling views (A8-A17): daily volumes, NULL shares, duplicate keys, lag.

Each view is a DataFrame function; refreshing a view means recomputing it
(``write.mode("overwrite")``).  ``measured_at``/``detected_at`` are the
processing time, as in the reference's views.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HISTORY_LAYER = "silver_thread_lookup_history"
# The profiled columns of each layer (the NULL-percentage view).
NULL_PROFILE_COLUMNS = {
    "bronze_checkpoints": ["thread_id", "checkpoint_id", "checkpoint_ns", "type", "metadata"],
    HISTORY_LAYER: ["thread_id", "user_id", "team"],
    "silver_checkpoints": ["checkpoint_ts", "user_id", "team", "metadata_step_int", "metadata_source"],
}


def daily_counts(bronze: DataFrame, history: DataFrame, silver: DataFrame,
                 gold_user: DataFrame, gold_team: DataFrame) -> DataFrame:
    """Rows per day and layer (five union arms, each partially aggregated)."""
    arms = [
        ("bronze_checkpoints", bronze, F.to_date("ingested_at")),
        (HISTORY_LAYER, history, F.to_date("updated_at")),
        ("silver_checkpoints", silver, F.col("checkpoint_date")),
        ("gold_user_team_metrics", gold_user, F.col("checkpoint_date")),
        ("gold_team_summary", gold_team, F.col("checkpoint_date")),
    ]
    out = None
    for layer, df, day in arms:
        arm = df.groupBy(day.alias("date")).agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(layer).alias("layer"), "date", "record_count"
        )
        out = arm if out is None else out.unionByName(arm)
    return out


def _pct(part: Column, total: Column) -> Column:
    """Percentage rounded to 2 places; NULL for an empty table."""
    return F.when(total > 0, F.round(part.cast("double") * 100.0 / total, 2)).cast("double")


def layer_null_profile(bronze: DataFrame, history: DataFrame, silver: DataFrame,
                       with_time: bool = True) -> DataFrame:
    """A9 over the three layers with ``NULL_PROFILE_COLUMNS``."""
    frames = {"bronze_checkpoints": bronze, HISTORY_LAYER: history, "silver_checkpoints": silver}
    return null_profile([(t, frames[t], cols) for t, cols in NULL_PROFILE_COLUMNS.items()], with_time)


def null_profile(tables: list[tuple[str, DataFrame, list[str]]], with_time: bool = True) -> DataFrame:
    """NULL share of each listed column.

    One scan and one global aggregate per table (all columns at once), then
    ``stack`` turns the wide row into one row per column.
    """
    out = None
    for name, df, cols in tables:
        wide = df.agg(
            F.count(F.lit(1)).alias("_total"),
            *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)],
        )
        pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
        arm = wide.selectExpr(
            "_total", f"stack({len(cols)}, {pairs}) AS (column_name, _nulls)"
        ).select(
            F.lit(name).alias("table_name"),
            "column_name",
            _pct(F.col("_nulls"), F.col("_total")).alias("null_percentage"),
            F.col("_total").alias("total_records"),
        )
        out = arm if out is None else out.unionByName(arm)
    return out.withColumn("measured_at", F.current_timestamp()) if with_time else out


def null_wide(silver: DataFrame) -> DataFrame:
    """The user/team NULL shares of silver in one row."""
    total = F.count(F.lit(1))
    return silver.agg(
        F.lit("silver_checkpoints").alias("table_name"),
        _pct(F.count_if(F.col("user_id").isNull()), total).alias("user_id_null_pct"),
        _pct(F.count_if(F.col("team").isNull()), total).alias("team_null_pct"),
    )


def _quoted(values: Column, distinct: bool) -> Column:
    """``["a","b",...]`` from an array of struct(v, n): non-NULL values,
    sorted, each repeated n times (once if ``distinct``); all-NULL -> ``[]``."""
    kept = F.array_sort(F.filter(values, lambda s: s["v"].isNotNull()))
    quoted = F.transform(kept, lambda s: F.concat(F.lit('"'), s["v"], F.lit('"')))
    if distinct:
        items = F.array_distinct(quoted)
    else:
        items = F.flatten(F.transform(kept, lambda s: F.array_repeat(
            F.concat(F.lit('"'), s["v"], F.lit('"')), s["n"].cast("int"))))
    return F.concat(F.lit("["), F.concat_ws(",", items), F.lit("]"))


def _dup_with_lists(df: DataFrame, keys: list[str], seen: str, distinct: bool) -> DataFrame:
    """Keys with more than one row, with their sorted owner lists.

    Two stacked aggregates, no join: rows are first counted per
    (key, user, team) -- a partial aggregate, skew-safe -- and only those
    combinations (not rows) are gathered per key, then re-expanded from
    their counts.
    """
    combos = df.groupBy(*keys, "user_id", "team").agg(
        F.count(F.lit(1)).alias("_n"), F.min(seen).alias("_lo"), F.max(seen).alias("_hi"))
    per_key = combos.groupBy(*keys).agg(
        F.sum("_n").alias("duplicate_count"),
        F.min("_lo").alias("first_seen"),
        F.max("_hi").alias("last_seen"),
        F.collect_list(F.struct(F.col("user_id").alias("v"), F.col("_n").alias("n"))).alias("_u"),
        F.collect_list(F.struct(F.col("team").alias("v"), F.col("_n").alias("n"))).alias("_t"),
    ).filter(F.col("duplicate_count") > 1)
    return per_key.select(
        *keys, _quoted(F.col("_u"), distinct).alias("user_id"), _quoted(F.col("_t"), distinct).alias("team"),
        "duplicate_count", "first_seen", "last_seen")


def _dup_frame(name, counts: DataFrame, users, teams, keys_out) -> DataFrame:
    cols = []
    for k in ["thread_id", "checkpoint_ns", "checkpoint_id"]:
        cols.append(F.col(k) if k in keys_out else F.lit(None).cast("string").alias(k))
    return counts.select(
        F.lit(name).alias("table_name"), *cols,
        users.alias("user_ids"), teams.alias("teams"),
        "duplicate_count", "first_seen", "last_seen",
    )


def _dup_counts(df: DataFrame, keys: list[str], seen: str) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("duplicate_count"),
             F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"))
        .filter(F.col("duplicate_count") > 1)
    )


def dup_bronze(bronze: DataFrame) -> DataFrame:
    """A10: bronze rows delivered more than once (thread, ns, id)."""
    keys = ["thread_id", "checkpoint_ns", "checkpoint_id"]
    counts = _dup_counts(bronze, keys, "ingested_at")
    none = F.lit(None).cast("string")
    return _dup_frame("bronze_checkpoints", counts, none, none, keys)


def dup_lookup(history: DataFrame, current_only: bool = False) -> DataFrame:
    """A11 (all versions) / C6 (open versions only): threads with >1 rows."""
    src = history.filter(F.col("__END_AT").isNull()) if current_only else history
    keys = ["thread_id"]
    full = _dup_with_lists(src, keys, "updated_at", distinct=False)
    return _dup_frame(HISTORY_LAYER, full, F.col("user_id"), F.col("team"), keys)


def dup_silver(silver: DataFrame) -> DataFrame:
    """Silver rows with the same (thread, ns, id), distinct owners listed."""
    keys = ["thread_id", "checkpoint_ns", "checkpoint_id"]
    full = _dup_with_lists(silver, keys, "checkpoint_ts", distinct=True)
    return _dup_frame("silver_checkpoints", full, F.col("user_id"), F.col("team"), keys)


def duplicates(bronze: DataFrame, history: DataFrame, silver: DataFrame, with_time: bool = True) -> DataFrame:
    """The three duplicate arms in one view."""
    out = dup_bronze(bronze).unionByName(dup_lookup(history)).unionByName(dup_silver(silver))
    return out.withColumn("detected_at", F.current_timestamp()) if with_time else out


def processing_lag(silver: DataFrame, bronze: DataFrame, with_time: bool = True) -> DataFrame:
    """Minutes from event time to ingestion, per event day.

    Same numbers as the inner join on (thread, ns, id), including its
    fan-out over duplicate deliveries (SURVEY D9), but without emitting the
    pairs: each side is first reduced to its distinct values per key with a
    count (a group of k identical copies becomes one row), the reduced sides
    are joined, and every pair carries the weight c * m.  Count, mean, min and
    max follow from the weights.  The percentiles are exact weighted ranks
    (the value at rank ceil(p * n), which ``percentile_approx`` also returns
    on data this size).  They use weights summed per (day, lag second): that
    table's size is bounded by the range of lag values, not by the row count.
    """
    keys = ["thread_id", "checkpoint_ns", "checkpoint_id"]
    s = (silver.filter(F.col("checkpoint_ts").isNotNull())
         .groupBy(*keys, "checkpoint_ts").agg(F.count(F.lit(1)).alias("_c")))
    b = bronze.groupBy(*keys, "ingested_at").agg(F.count(F.lit(1)).alias("_m"))
    pairs = s.join(b, keys, "inner").select(
        F.to_date("checkpoint_ts").alias("event_date"),
        (F.unix_timestamp("ingested_at") - F.unix_timestamp("checkpoint_ts")).alias("_lag"),
        (F.col("_c") * F.col("_m")).alias("_w"),
    )
    per_lag = pairs.groupBy("event_date", "_lag").agg(F.sum("_w").alias("_w"))
    running = Window.partitionBy("event_date").orderBy("_lag").rowsBetween(Window.unboundedPreceding, 0)
    ranked = per_lag.select(
        "event_date", "_lag", "_w",
        F.sum("_w").over(running).alias("_cum"),
        F.sum("_w").over(Window.partitionBy("event_date")).alias("_n"),
    )

    def at_rank(p: float) -> Column:
        return F.min(F.when(F.col("_cum") >= F.ceil(F.col("_n") * p), F.col("_lag")))

    out = ranked.groupBy("event_date").agg(
        F.sum("_w").alias("record_count"),
        F.round(F.sum(F.col("_w") * F.col("_lag")) / F.sum("_w") / 60, 2).alias("avg_lag_minutes"),
        F.round(F.min("_lag") / 60, 2).alias("min_lag_minutes"),
        F.round(F.max("_lag") / 60, 2).alias("max_lag_minutes"),
        F.round(at_rank(0.5) / 60, 2).alias("median_lag_minutes"),
        F.round(at_rank(0.95) / 60, 2).alias("p95_lag_minutes"),
    )
    return out.withColumn("measured_at", F.current_timestamp()) if with_time else out


def volume_by_date(silver: DataFrame) -> DataFrame:
    """Rows and distinct threads per checkpoint date, newest first."""
    return (
        silver.groupBy("checkpoint_date")
        .agg(F.count(F.lit(1)).alias("row_count"),
             F.countDistinct("thread_id").alias("distinct_threads"))
        .orderBy(F.col("checkpoint_date").desc())
    )
