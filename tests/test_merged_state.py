"""States by batch: quantile sketches (A14/A15), gold partials (A1, A2, A4), column statistics (M2)."""

import datetime as dt
import glob
import os
import random

import pytest

from tests.test_refresh import HEADER, _write, cp_line
from threadlens.functions.schemas import INGESTED_AT
from threadlens.operators import metrics, upkeep
from threadlens.plans import gold_state, lag_state, stats_state
from threadlens.plans.batch_state import write_batch
from threadlens.plans.refresh import refresh

LOOKUP = "thread_id,user_id,team\n"
DAY = dt.datetime(2026, 4, 1, 10)


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def gold_equals_recompute(spark, out):
    silver = spark.read.parquet(f"{out}/silver_checkpoints")
    assert rows_of(spark.read.parquet(f"{out}/gold_user_team_metrics")) == rows_of(metrics.gold_user_team_metrics(silver))
    assert rows_of(spark.read.parquet(f"{out}/gold_team_summary")) == rows_of(metrics.gold_team_summary(silver))


def test_gold_follows_updates_and_owner_changes_from_partials(spark, scratch):
    raw, out = f"{scratch}/raw", f"{scratch}/out"
    _write(f"{raw}/checkpoints_1.csv", HEADER + cp_line("t1", "c1", "2026-04-01T10:00:00Z", 1) + cp_line("t1", "c1", "2026-04-01T10:00:00Z", 1)
           + cp_line("t2", "c1", "2026-04-01T09:00:00Z", "x") + cp_line("t3", "c3", "2026-04-02T09:00:00Z", 5) + cp_line("t9", "c9", "no time", 1))
    _write(f"{raw}/thread_teams_1.csv", LOOKUP + "t1,u1,a\nt2,u2,a\nt3,,a\n")
    refresh(spark, raw, out)
    gold_equals_recompute(spark, out)
    old = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/_gold_state/*/_batch=0/*/*.parquet")}
    assert old
    # more checkpoints on an old date, one with a known id; two threads come to one user
    _write(f"{raw}/checkpoints_2.csv", HEADER + cp_line("t2", "c1", "2026-04-01T12:00:00Z", 7) + cp_line("t4", "c8", "2026-04-03T12:00:00Z", 7))
    _write(f"{raw}/thread_teams_2.csv", LOOKUP + "t2,u1,a\nt4,u4,b\n")
    refresh(spark, raw, out)
    gold_equals_recompute(spark, out)
    _write(f"{raw}/thread_teams_3.csv", LOOKUP + "t1,u7,b\nt3,u3,b\n")
    refresh(spark, raw, out)
    gold_equals_recompute(spark, out)
    assert {f: os.stat(f).st_mtime_ns for f in old} == old
    # an output of an older release has no partials: the next update makes them
    os.rename(f"{out}/_gold_state", f"{scratch}/gold_aside")
    os.rename(f"{out}/_lag_state", f"{scratch}/lag_aside")
    _write(f"{raw}/checkpoints_3.csv", HEADER + cp_line("t4", "c10", "2026-04-02T12:00:00Z", 7))
    refresh(spark, raw, out)
    gold_equals_recompute(spark, out)
    lag = spark.read.parquet(f"{out}/monitoring_delivery_lag")
    assert {str(r.event_date): r.record_count for r in lag.collect()} == {"2026-04-01": 4, "2026-04-02": 2, "2026-04-03": 1}


def test_gold_plan_reads_partials_of_the_dates_without_expand(spark, scratch):
    schema = ("thread_id string, checkpoint_ts timestamp, checkpoint_date date, checkpoint_id_parsed string, metadata_step_int int")
    rows = [(f"t{i % 5}", DAY + dt.timedelta(days=i % 3), (DAY + dt.timedelta(days=i % 3)).date(), f"c{i % 7}", i) for i in range(60)]
    gold_state.fold(spark.createDataFrame(rows, schema), scratch, 0)
    owners = spark.createDataFrame([(f"t{i}", f"u{i // 2}", "a") for i in range(5)], "thread_id string, user_id string, team string")
    dates = spark.createDataFrame([(DAY.date(),)], "checkpoint_date date")
    users, teams = gold_state.gold(spark, scratch, owners, gold_state.prunable(dates))
    for df in (users, teams):
        plan = df._jdf.queryExecution().toString()
        assert "Expand" not in plan and "dynamicpruning" in plan
    got = teams.collect()
    assert [(r.checkpoint_count, r.user_count, r.thread_count, r.unique_checkpoints) for r in got] == [(20, 3, 5, 7)]


@pytest.mark.parametrize("n", [1, 2, 5000])
def test_merged_sketch_keeps_its_rank_error(spark, scratch, n):
    rnd = random.Random(n)
    rows = [(DAY, DAY + dt.timedelta(seconds=int(rnd.paretovariate(0.8) * 10))) for _ in range(n)]
    rows += [(DAY, None), (None, DAY)]
    df = spark.createDataFrame(rows, f"checkpoint_ts timestamp, {INGESTED_AT} timestamp")
    for batch in range(3):
        part = spark.createDataFrame(rows[batch::3], df.schema)
        lag_state.fold(part, scratch, batch)
        lag_state.fold(part, scratch, batch)  # a repeated batch replaces its partial
    (r,) = lag_state.compare(spark, scratch, df).collect()
    lags = sorted(int((b - a).total_seconds()) for a, b in rows if a and b)
    assert (r.record_count, r.min_lag, r.max_lag, r.total_lag) == (n, lags[0], lags[-1], sum(lags))
    assert r.median_within and r.p95_within
    (v,) = lag_state.delivery_lag(spark, scratch).collect()
    assert v.record_count == n and v.min_lag_minutes <= v.median_lag_minutes <= v.p95_lag_minutes <= v.max_lag_minutes


def test_no_deliveries_no_lag(spark, scratch):
    assert lag_state.delivery_lag(spark, f"{scratch}/none").collect() == []
    empty = spark.createDataFrame([], f"checkpoint_ts timestamp, {INGESTED_AT} timestamp")
    lag_state.fold(empty, f"{scratch}/lag", 0)
    assert lag_state.delivery_lag(spark, f"{scratch}/lag").collect() == []


def test_statistics_merge_and_read_only_new_batches(spark, scratch):
    columns = ["s", "n", "d"]
    schema = "s string, n int, d date, other int"
    table, state = f"{scratch}/table", f"{scratch}/stats"
    rows = [(f"v{i % 9000}" if i % 10 else None, i % 100 - 50, (DAY + dt.timedelta(days=i % 40)).date(), i) for i in range(20000)]
    everything = spark.createDataFrame(rows, schema)
    empty = stats_state.column_stats(spark, state, everything, columns).collect()
    assert [(r.row_count, r.null_count, r.min_value, r.approx_distinct) for r in empty] == [(0, 0, None, 0)] * 3
    write_batch(spark.createDataFrame(rows[:12000], schema), table, 0)
    assert stats_state.refresh_stats(spark, table, state, columns) == [0]
    kept = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{state}/_batch=0/*.parquet")}
    write_batch(spark.createDataFrame(rows[12000:], schema), table, 1)
    write_batch(spark.createDataFrame([], schema), table, 2)
    assert stats_state.refresh_stats(spark, table, state, columns) == [1, 2]
    assert {f: os.stat(f).st_mtime_ns for f in kept} == kept
    stats = stats_state.column_stats(spark, state, everything, columns)
    exact = ["column_name", "row_count", "null_count", "min_value", "max_value"]
    assert rows_of(stats.select(*exact)) == rows_of(upkeep.column_stats(everything, columns, approx=False))
    checked = {r.column_name: (r.distinct_count, r.within) for r in stats_state.with_exact_distinct(stats, everything, columns).collect()}
    assert checked == {"s": (len({r[0] for r in rows} - {None}), True), "n": (100, True), "d": (40, True)}
    # a batch delivered again is folded again on demand
    write_batch(spark.createDataFrame(rows[:10], schema), table, 1)
    assert stats_state.refresh_stats(spark, table, state, columns, again=[1]) == [1]
    assert stats_state.column_stats(spark, state, everything, columns).first().row_count == 12010
