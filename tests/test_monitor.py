"""Profiling views, reports and cross-layer checks on small fixtures."""

import datetime as dt

from threadlens.operators import checks, monitor, reports
from threadlens.plans.layers import Layers
from tests.conftest import SMOKE


def test_null_profile_single_pass(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("c", "x"), ("d", "y")], "a string, b string")
    out = {r.column_name: r for r in monitor.null_profile([("t", df, ["a", "b"])]).collect()}
    assert out["a"].null_percentage == 25.0 and out["b"].null_percentage == 50.0
    assert out["a"].total_records == 4 and out["a"].measured_at is not None


def test_null_profile_empty_table(spark):
    df = spark.createDataFrame([], "a string")
    r = monitor.null_profile([("t", df, ["a"])], with_time=False).first()
    assert r.total_records == 0 and r.null_percentage is None


def test_lookup_duplicate_lists(spark):
    h = spark.createDataFrame(
        [("t1", "u2", "b", dt.datetime(2024, 1, 1), None),
         ("t1", "u1", None, dt.datetime(2024, 1, 2), None),
         ("t1", "u1", "a", dt.datetime(2024, 1, 3), None),
         ("t2", None, None, dt.datetime(2024, 1, 1), None),
         ("t2", None, None, dt.datetime(2024, 1, 2), None),
         ("t3", "u", "a", dt.datetime(2024, 1, 1), None)],
        "thread_id string, user_id string, team string, updated_at timestamp, __END_AT timestamp")
    out = {r.thread_id: r for r in monitor.dup_lookup(h).collect()}
    assert set(out) == {"t1", "t2"}
    assert out["t1"].user_ids == '["u1","u1","u2"]' and out["t1"].teams == '["a","b"]'
    assert out["t2"].user_ids == "[]" and out["t1"].duplicate_count == 3
    assert out["t1"].checkpoint_ns is None


def test_reports_and_checks_on_smoke_data(spark):
    L = Layers(spark, SMOKE)
    newest = L.newest_date()
    recent = reports.user_metrics_recent(L.gold_user, newest, 7)
    dates = [r.checkpoint_date for r in recent.collect()]
    assert dates == sorted(dates, reverse=True)
    res = {r.check: r for r in checks.run_checks(
        L.bronze, L.lookup_feed, L.history, L.current_owner, L.silver, L.gold_user, L.gold_team,
        as_of=newest).collect()}
    assert len(res) == 14
    failed = [k for k, r in res.items() if not r.passed]
    assert failed == [], failed


def test_checks_detect_broken_gold(spark):
    L = Layers(spark, SMOKE)
    broken = L.gold_user.withColumn("checkpoint_count", L.gold_user.checkpoint_count + 1)
    res = {r.check: r.passed for r in checks.run_checks(
        L.bronze, L.lookup_feed, L.history, L.current_owner, L.silver, broken, L.gold_team).collect()}
    assert not res["gold_sum_equals_silver_rows"]
    assert not res["gold_counts_match_silver_detail"]
    assert not res["team_totals_match_user_metrics"]


def test_required_columns(spark):
    L = Layers(spark, SMOKE)
    assert checks.missing_columns(L.silver, {"thread_id": None, "checkpoint_ts": None, "user_id": None}) == []
    assert checks.missing_columns(L.gold_user, {"first_checkpoint": None}) == ["first_checkpoint"]


def test_processing_lag_hot_copy_group_without_pairs(spark):
    import math

    base = dt.datetime(2024, 1, 1, 12)
    k = 60  # one checkpoint delivered k times: the SQL join would emit k * k pairs
    silver = [("t1", "ns", "c1", base)] * k + [("t2", "ns", "c2", base)]
    bronze = [("t1", "ns", "c1", base + dt.timedelta(seconds=7 * i)) for i in range(k)] + \
             [("t2", "ns", "c2", base + dt.timedelta(seconds=30))]
    s = spark.createDataFrame(silver, "thread_id string, checkpoint_ns string, checkpoint_id string, checkpoint_ts timestamp")
    b = spark.createDataFrame(bronze, "thread_id string, checkpoint_ns string, checkpoint_id string, ingested_at timestamp")
    r = monitor.processing_lag(s, b, with_time=False).first()
    lags = sorted([7 * i for i in range(k) for _ in range(k)] + [30])  # brute force over all pairs
    n = len(lags)
    assert r.record_count == n
    assert r.avg_lag_minutes == round(sum(lags) / n / 60, 2)
    assert (r.min_lag_minutes, r.max_lag_minutes) == (0.0, round(max(lags) / 60, 2))
    assert r.median_lag_minutes == round(lags[math.ceil(0.5 * n) - 1] / 60, 2)
    assert r.p95_lag_minutes == round(lags[math.ceil(0.95 * n) - 1] / 60, 2)
