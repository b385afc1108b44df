"""K4: views from merged partials equal a recompute over several updates; Q6: split sink of the pipeline."""

import glob
import os

import pytest

from tests.test_refresh import HEADER, _write, cp_line
from threadlens.operators import monitor
from threadlens.operators.expectations import ExpectationFailed, Rule
from threadlens.plans import view_state
from threadlens.plans.refresh import refresh
from threadlens.streaming.scd2_stream import read_history
from threadlens.streaming.split_sink import write_split

LOOKUP = "thread_id,user_id,team\n"


def views_equal_recompute(spark, out):
    bronze, silver = spark.read.parquet(f"{out}/bronze_checkpoints"), spark.read.parquet(f"{out}/silver_checkpoints")
    history = read_history(spark, f"{out}/silver_thread_lookup_history")
    gold = [spark.read.parquet(f"{out}/gold_{n}") for n in ("user_team_metrics", "team_summary")]
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(view_state.daily_counts(spark, out)) == rows(monitor.daily_counts(bronze, history, silver, *gold))
    assert rows(view_state.null_profile(spark, out, with_time=False)) == rows(monitor.layer_null_profile(bronze, history, silver, with_time=False))
    assert rows(spark.read.parquet(f"{out}/monitoring_daily_counts")) == rows(view_state.daily_counts(spark, out))


def test_views_follow_three_updates_and_read_only_new_batches(spark, scratch):
    raw, out = f"{scratch}/raw", f"{scratch}/out"
    _write(f"{raw}/checkpoints_1.csv", HEADER + cp_line("t1", "c1", "2026-04-01T10:00:00Z", 1) + cp_line("t2", "c2", "2026-04-02T09:00:00Z", "x")
           + cp_line("t9", "c3", "not a time", 1))
    _write(f"{raw}/thread_teams_1.csv", LOOKUP + "t1,u1,a\nt2,u2,b\n")
    refresh(spark, raw, out)
    views_equal_recompute(spark, out)
    quarantine = spark.read.parquet(f"{out}/checkpoints_quarantine")
    assert [(r.thread_id, r._broken) for r in quarantine.collect()] == [("t9", ["checkpoint_ts_not_null"])]
    assert spark.read.parquet(f"{out}/checkpoints_parsed").count() + quarantine.count() == spark.read.parquet(f"{out}/bronze_checkpoints").count()

    # the state of old batches is not made again, and their deltas are not read
    old = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{out}/_view_state/*/_batch=0/*.parquet")}
    assert len(old) == 2
    _write(f"{raw}/checkpoints_2.csv", HEADER + cp_line("t1", "c5", "2026-04-01T11:00:00Z", 3) + cp_line("t3", "c6", "2026-04-03T08:00:00Z", 3))
    _write(f"{raw}/thread_teams_2.csv", LOOKUP + "t2,u3,a\nt3,u1,\n")
    refresh(spark, raw, out)
    views_equal_recompute(spark, out)
    assert {f: os.stat(f).st_mtime_ns for f in old} == old

    # owners change only; then an update repeated after a loss of its marker
    _write(f"{raw}/thread_teams_3.csv", LOOKUP + "t1,u1,b\nt2,u3,a\nt3,u4,c\n")
    refresh(spark, raw, out)
    views_equal_recompute(spark, out)
    os.rename(f"{out}/applied_batches", f"{scratch}/marker_aside")
    refresh(spark, raw, out)
    views_equal_recompute(spark, out)


def test_a_failing_rule_leaves_no_trace(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "n int, s string")
    rules = [Rule("n_there", "n IS NOT NULL"), Rule("s_there", "s <> ''")]
    kept, aside = f"{scratch}/kept", f"{scratch}/aside"
    with pytest.raises(ExpectationFailed):
        write_split(df, rules, 0, kept, aside, action="fail")
    assert glob.glob(f"{kept}/*") == [] and not os.path.exists(aside)
    counts = write_split(df, rules, 0, kept, aside)
    assert (counts["total"], counts["n_there"], counts["s_there"]) == (3, 1, 1)
    assert spark.read.parquet(kept).count() + spark.read.parquet(aside).count() == df.count()
    assert sorted((r.n or 0, r._broken) for r in spark.read.parquet(aside).collect()) == [(0, ["n_there"]), (3, ["s_there"])]
    # a repeated batch replaces both parts, also by nothing
    write_split(df.filter("n = 1"), rules, 0, kept, aside)
    assert spark.read.parquet(kept).count() == 1 and glob.glob(f"{aside}/_batch=*") == []
    write_split(df.filter("n = 3"), rules, 1, kept, aside, action="drop")
    assert sorted(os.path.basename(p) for p in glob.glob(f"{kept}/_batch=*")) == ["_batch=0", "_batch=1"]
    assert write_split(df.filter("n = 1"), rules, 2, kept, aside, action="fail")["total"] == 1
    with pytest.raises(ValueError):
        write_split(df, rules, 3, kept, aside, action="ignore")
