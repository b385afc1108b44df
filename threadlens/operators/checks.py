"""Cross-layer consistency checks.

``run_checks`` returns one row per check: (check, observed, threshold,
passed).  Each check is a global aggregate (one row), reconciliations compare
at equal grain (SURVEY D4) via joins of aggregates.  Ratio checks pass on
empty input, as the reference guards ``total > 0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from threadlens.operators.metrics import USER_TEAM_RULES
from threadlens.operators.expectations import all_pass

# Fixed values (thresholds of the reference's consistency checks):
ORPHAN_RATIO_MAX = 0.5        # share of checkpoint threads without an owner
NULL_USER_RATIO_MAX = 0.2     # share of silver rows without a user
USER_COVERAGE_MIN = 0.8       # share of silver rows with a user
TEAM_COVERAGE_MIN = 0.8       # share of silver teams present in the team summary
TS_MIN, TS_MAX = "2020-01-01", "2030-12-31"   # plausible checkpoint time range
FRESHNESS_DAYS = 730          # newest checkpoint at most this old


def _metrics(name_value_frames: list[DataFrame]) -> DataFrame:
    """One row with every metric as a column, from one-row aggregate frames.

    Each frame is unpivoted to (metric, value) rows, the frames are unioned
    and folded back by one global aggregate: no join without keys.
    """
    long = None
    for df in name_value_frames:
        cols = df.columns
        pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
        part = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (metric, value)")
        long = part if long is None else long.unionByName(part)
    names = [c for df in name_value_frames for c in df.columns]
    return long.agg(*[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names])


def run_checks(bronze: DataFrame, lookup_feed: DataFrame, history: DataFrame,
               owners: DataFrame, silver: DataFrame, gold_user: DataFrame,
               gold_team: DataFrame, as_of=None) -> DataFrame:
    """One row per check: (check, observed, threshold, passed).

    Checks on a single table share one aggregate over it (silver, gold and
    bronze are each scanned once for all of them); only the distinct counts
    and the reconciliations at equal grain have plans of their own.
    """
    cnt = F.count(F.lit(1))
    lo, hi = F.lit(TS_MIN).cast("timestamp"), F.lit(TS_MAX).cast("timestamp")
    ts = F.col("checkpoint_ts")
    silver_m = silver.agg(
        cnt.alias("s_rows"),
        F.count_if(F.col("thread_id").isNull()).alias("s_null_thread"),
        F.count_if(F.col("user_id").isNull()).alias("s_null_user"),
        F.count_if((ts < lo) | (ts > hi)).alias("s_out_of_range"),
        F.count_if(F.col("thread_id").isNotNull()).alias("s_with_thread"),
        F.count_if(F.col("thread_id").isNotNull() & F.col("user_id").isNotNull()).alias("s_with_user"),
        F.count_if(all_pass(USER_TEAM_RULES)).alias("s_gold_rows"),
        F.unix_date(F.to_date(F.max(ts))).alias("s_newest_day"),
    )
    gold_m = gold_user.agg(
        cnt.alias("g_rows"),
        F.coalesce(F.sum("checkpoint_count"), F.lit(0)).alias("g_sum"),
        F.count_if(F.col("checkpoint_count") <= 0).alias("g_nonpositive"),
        F.count_if(F.col("first_checkpoint_ts") > F.col("last_checkpoint_ts")).alias("g_misordered"),
    )
    bronze_m = bronze.agg(cnt.alias("b_rows"))
    # V1: distinct threads of the history and of the feed
    hist_m = history.agg(F.countDistinct("thread_id").alias("h_threads"))
    feed_m = lookup_feed.agg(F.countDistinct("thread_id").alias("f_threads"))
    # V2: checkpoint threads without a current owner
    marked = silver.select("thread_id").distinct().join(
        owners.select("thread_id", F.lit(1).alias("_owned")).distinct(), "thread_id", "left")
    orphan_m = marked.agg(cnt.alias("o_threads"), F.count_if(F.col("_owned").isNull()).alias("o_orphans"))
    # V8: team summary == re-aggregated user metrics, per (team, date)
    from_users = gold_user.groupBy("team", "checkpoint_date").agg(
        F.sum("checkpoint_count").alias("_c"), F.countDistinct("user_id").alias("_u"))
    v8_m = gold_team.join(from_users, ["team", "checkpoint_date"], "full_outer").agg(
        F.count_if(~F.coalesce((F.col("checkpoint_count") == F.col("_c"))
                               & (F.col("user_count") == F.col("_u")), F.lit(False))).alias("v8_mismatch"))
    # Teams of silver present in the team summary
    covered = silver.filter(F.col("team").isNotNull()).select("team").distinct().join(
        gold_team.select("team", F.lit(1).alias("_g")).distinct(), "team", "left")
    v10_m = covered.agg(cnt.alias("t_teams"), F.count_if(F.col("_g").isNotNull()).alias("t_covered"))
    # Gold counts == silver detail, per (date, user, team)
    detail = silver.filter(all_pass(USER_TEAM_RULES)).groupBy(
        "checkpoint_date", "user_id", "team").agg(cnt.alias("_n"))
    v11_m = gold_user.join(detail, ["checkpoint_date", "user_id", "team"], "full_outer").agg(
        F.count_if(~F.coalesce(F.col("checkpoint_count") == F.col("_n"), F.lit(False))).alias("v11_mismatch"))

    m = _metrics([silver_m, gold_m, bronze_m, hist_m, feed_m, orphan_m, v8_m, v10_m, v11_m])
    c = F.col

    def ratio(a: str, b: str):
        return F.try_divide(c(a), c(b))

    checks = [
        ("history_threads_within_feed", c("h_threads"), c("f_threads"), c("h_threads") <= c("f_threads")),
        ("orphan_thread_ratio", ratio("o_orphans", "o_threads"), F.lit(ORPHAN_RATIO_MAX),
         F.coalesce(ratio("o_orphans", "o_threads") < ORPHAN_RATIO_MAX, F.lit(True))),
        ("gold_sum_equals_silver_rows", c("g_sum"), c("s_gold_rows"), c("g_sum") == c("s_gold_rows")),
        ("null_thread_ids", c("s_null_thread"), F.lit(0.0), c("s_null_thread") == 0),
        ("null_user_ratio", ratio("s_null_user", "s_rows"), F.lit(NULL_USER_RATIO_MAX),
         F.coalesce(ratio("s_null_user", "s_rows") < NULL_USER_RATIO_MAX, F.lit(True))),
        ("timestamps_out_of_range", c("s_out_of_range"), F.lit(0.0), c("s_out_of_range") == 0),
        ("nonpositive_counts", c("g_nonpositive"), F.lit(0.0), c("g_nonpositive") == 0),
        ("team_totals_match_user_metrics", c("v8_mismatch"), F.lit(0.0), c("v8_mismatch") == 0),
        ("user_mapping_coverage", ratio("s_with_user", "s_with_thread"), F.lit(USER_COVERAGE_MIN),
         F.coalesce(ratio("s_with_user", "s_with_thread") >= USER_COVERAGE_MIN, F.lit(True))),
        ("team_coverage", ratio("t_covered", "t_teams"), F.lit(TEAM_COVERAGE_MIN),
         F.coalesce(ratio("t_covered", "t_teams") >= TEAM_COVERAGE_MIN, F.lit(True))),
        ("gold_counts_match_silver_detail", c("v11_mismatch"), F.lit(0.0), c("v11_mismatch") == 0),
        ("first_not_after_last", c("g_misordered"), F.lit(0.0), c("g_misordered") == 0),
        ("smallest_layer_rows", F.least(c("b_rows"), c("s_rows"), c("g_rows")), F.lit(1.0),
         F.least(c("b_rows"), c("s_rows"), c("g_rows")) >= 1),
    ]
    if as_of is not None:
        day = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
        age = (F.unix_date(day) - c("s_newest_day")).cast("double")
        checks.append(("days_since_newest_checkpoint", age, F.lit(float(FRESHNESS_DAYS)),
                       F.coalesce(age <= FRESHNESS_DAYS, F.lit(False))))
    rows = F.array(*[
        F.struct(F.lit(n).alias("check"), o.cast("double").alias("observed"),
                 t.cast("double").alias("threshold"), p.alias("passed"))
        for n, o, t, p in checks
    ])
    return m.select(F.inline(rows))


def missing_columns(df: DataFrame, required: dict[str, DataType | None]) -> list[str]:
    """Required columns (optionally typed) absent from ``df``'s schema."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    bad = []
    for name, dtype in required.items():
        if name not in fields or (dtype is not None and fields[name] != dtype):
            bad.append(name)
    return bad

