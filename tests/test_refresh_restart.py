"""Updates that fail, feeds without files, file order and unchanged deliveries."""

import os

import pytest

from tests.test_refresh import HEADER, _write, cp_line
from threadlens.operators import metrics, monitor
from threadlens.plans import refresh as R
from threadlens.streaming.scd2_stream import read_history
from tests.test_view_state import views_equal_recompute

LOOKUP = "thread_id,user_id,team\n"
GOLD = ["checkpoint_date", "user_id", "team", "checkpoint_count", "thread_count"]


def gold_rows(spark, out):
    return sorted(map(str, spark.read.parquet(f"{out}/gold_user_team_metrics").select(GOLD).collect()))


def full_gold(spark, out):
    owners = read_history(spark, f"{out}/silver_thread_lookup_history").filter("__END_AT IS NULL").select("thread_id", "user_id", "team")
    silver = spark.read.parquet(f"{out}/checkpoints_parsed").drop("_batch").join(owners, "thread_id", "left")
    return sorted(map(str, metrics.gold_user_team_metrics(silver).select(GOLD).collect()))


def first_update(spark, scratch):
    raw, out = f"{scratch}/raw", f"{scratch}/out"
    _write(f"{raw}/checkpoints_1.csv", HEADER + cp_line("thread_1", "c1", "2026-04-01T10:00:00Z", 1) + cp_line("thread_2", "c2", "2026-04-02T10:00:00Z", 1))
    _write(f"{raw}/thread_teams_1.csv", LOOKUP + "thread_1,user_1,team_a\nthread_2,user_2,team_b\n")
    R.refresh(spark, raw, out)
    return raw, out


@pytest.mark.parametrize("step", ["_write_layer", "monitor", "checks"])
def test_an_update_that_fails_is_taken_up_by_the_next(spark, scratch, monkeypatch, step):
    raw, out = first_update(spark, scratch)
    _write(f"{raw}/checkpoints_2.csv", HEADER + cp_line("thread_1", "c3", "2026-04-03T10:00:00Z", 2))
    _write(f"{raw}/thread_teams_2.csv", LOOKUP + "thread_2,user_3,team_a\n")

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "_write_layer":
            m.setattr(R, "_write_layer", crash)
        elif step == "monitor":
            m.setattr(monitor, "duplicates", crash)  # after the views' partials have taken the batches in
        else:
            m.setattr(R.checks, "run_checks", crash)
        with pytest.raises(RuntimeError):
            R.refresh(spark, raw, out)
    assert R.refresh(spark, raw, out) == {"checkpoints": [1], "lookup": [1]}
    assert gold_rows(spark, out) == full_gold(spark, out) and len(gold_rows(spark, out)) == 3
    views_equal_recompute(spark, out)
    assert R.refresh(spark, raw, out) == {"checkpoints": [], "lookup": []}
    log = spark.read.parquet(f"{out}/expectation_log")
    assert log.count() == log.select("batch_id", "rule").distinct().count() == 2


@pytest.mark.parametrize("feed", ["checkpoints", "lookup"])
def test_a_feed_without_files_is_an_empty_table(spark, scratch, feed):
    raw, out = f"{scratch}/raw", f"{scratch}/out"
    if feed == "lookup":
        _write(f"{raw}/checkpoints_1.csv", HEADER + cp_line("thread_1", "c1", "2026-04-01T10:00:00Z", 1))
    else:
        _write(f"{raw}/thread_teams_1.csv", LOOKUP + "thread_1,user_1,team_a\n")
    R.refresh(spark, raw, out)
    _write(f"{raw}/checkpoints_2.csv", HEADER + cp_line("thread_1", "c2", "2026-04-02T10:00:00Z", 1))
    _write(f"{raw}/thread_teams_2.csv", LOOKUP + "thread_1,user_2,team_b\n")
    R.refresh(spark, raw, out)
    assert gold_rows(spark, out) == full_gold(spark, out)
    assert "user_2" in gold_rows(spark, out)[-1]


def test_files_are_ordered_by_age_and_not_by_name(spark, scratch):
    raw, out = f"{scratch}/raw", f"{scratch}/out"
    _write(f"{raw}/checkpoints_1.csv", HEADER + cp_line("thread_1", "c1", "2026-04-01T10:00:00Z", 1))
    for n, team in ((2, "old"), (10, "new")):
        _write(f"{raw}/thread_teams_{n}.csv", LOOKUP + f"thread_1,user_1,{team}\n")
        os.utime(f"{raw}/thread_teams_{n}.csv", (1_770_000_000 + n, 1_770_000_000 + n))
    R.refresh(spark, raw, out)
    assert [r.team for r in read_history(spark, f"{out}/silver_thread_lookup_history").filter("__END_AT IS NULL").collect()] == ["new"]


def test_an_unchanged_delivery_touches_no_date(spark, scratch):
    raw, out = first_update(spark, scratch)
    files = lambda: sorted(os.path.join(d, f) for d, _, names in os.walk(f"{out}/gold_user_team_metrics") for f in names if f.endswith(".parquet"))
    before = files()
    _write(f"{raw}/thread_teams_2.csv", LOOKUP + "thread_1,user_1,team_a\nthread_2,user_2,team_b\n")
    assert R.refresh(spark, raw, out) == {"checkpoints": [], "lookup": [1]}
    assert files() == before
    assert spark.read.parquet(f"{out}/owner_changes").filter("_batch = 1").count() == 0
