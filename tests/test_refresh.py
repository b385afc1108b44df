"""A pipeline update end to end over CSV files, then an incremental one."""

import os

from threadlens.operators import metrics
from threadlens.plans.refresh import refresh
from threadlens.streaming.scd2_stream import read_history

HEADER = "thread_id,checkpoint_ns,checkpoint_id,parent_checkpoint_id,type,checkpoint,metadata\n"


def cp_line(thread, cid, ts, step):
    cp = f'"{{""v"":""4"",""id"":""{cid}"",""ts"":""{ts}"",""channel_versions"":{{""__start__"":""1""}}}}"'
    md = f'"{{""step"":""{step}"",""source"":""user_input""}}"'
    return f"{thread},1,{cid},,checkpoint,{cp},{md}\n"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_refresh_twice(spark, scratch):
    raw, out = f"{scratch}/raw", f"{scratch}/out"
    _write(f"{raw}/checkpoints_1.csv", HEADER
           + cp_line("thread_1", "checkpoint_1", "2026-04-01T10:00:00Z", 1)
           + cp_line("thread_1", "checkpoint_2", "2026-04-01T10:05:00Z", 2)
           + cp_line("thread_2", "checkpoint_3", "2026-04-02T09:00:00Z", 1)
           + cp_line("thread_9", "checkpoint_4", "not a time", 1))
    _write(f"{raw}/thread_teams_1.csv", "thread_id,user_id,team\nthread_1,user_1,team_alpha\n"
                                        "thread_2,user_2,team_beta\n,user_x,team_x\n")
    _write(f"{raw}/checkpoints_1b.csv", HEADER + cp_line("thread_2", "checkpoint_3", "2026-04-02T09:00:00Z", 1))
    refresh(spark, raw, out)
    silver = spark.read.parquet(f"{out}/silver_checkpoints")
    assert silver.count() == 4
    gold = spark.read.parquet(f"{out}/gold_user_team_metrics")
    r = gold.filter("user_id = 'user_1'").first()
    assert (r.checkpoint_count, r.thread_count, r.avg_step) == (2, 1, 1.5)
    assert read_history(spark, f"{out}/silver_thread_lookup_history").count() == 2
    for view in ["monitoring_daily_counts", "monitoring_null_percentages", "monitoring_duplicates",
                 "monitoring_processing_lag"]:
        assert spark.read.parquet(f"{out}/{view}").count() > 0
    checks = {r.check: r.passed for r in spark.read.parquet(f"{out}/check_results").collect()}
    assert len(checks) == 14
    assert [k for k, ok in checks.items() if not ok] == []
    log = spark.read.parquet(f"{out}/expectation_log").first()
    assert (log.rule, log.total, log.failed) == ("checkpoint_ts_not_null", 5, 1)
    dups = spark.read.parquet(f"{out}/monitoring_duplicates")
    assert sorted(r.table_name for r in dups.collect()) == ["bronze_checkpoints", "silver_checkpoints"]

    # new day of checkpoints and an ownership change of thread_2
    _write(f"{raw}/checkpoints_2.csv", HEADER + cp_line("thread_1", "checkpoint_5", "2026-04-03T08:00:00Z", 3))
    _write(f"{raw}/thread_teams_2.csv", "thread_id,user_id,team\nthread_2,user_3,team_alpha\n")
    batches = refresh(spark, raw, out)
    assert batches == {"checkpoints": [1], "lookup": [1]}
    silver = spark.read.parquet(f"{out}/silver_checkpoints")
    gold = spark.read.parquet(f"{out}/gold_user_team_metrics")
    want = metrics.gold_user_team_metrics(silver)
    cols = ["checkpoint_date", "user_id", "team", "checkpoint_count"]
    assert gold.select(cols).exceptAll(want.select(cols)).count() == 0
    assert want.select(cols).exceptAll(gold.select(cols)).count() == 0
    assert gold.filter("user_id = 'user_2'").count() == 0
    # silver was rewritten for touched dates only, and equals a full recompute
    full = spark.read.parquet(f"{out}/checkpoints_parsed").drop("_batch").join(
        read_history(spark, f"{out}/silver_thread_lookup_history").filter("__END_AT IS NULL")
        .select("thread_id", "user_id", "team"), "thread_id", "left")
    scols = ["thread_id", "checkpoint_id", "checkpoint_date", "user_id", "team"]
    assert silver.count() == full.count() == 5
    assert silver.select(scols).exceptAll(full.select(scols)).count() == 0
    history = read_history(spark, f"{out}/silver_thread_lookup_history")
    versions = sorted((r.team, r["__END_AT"] is None) for r in history.filter("thread_id = 'thread_2'").collect())
    assert versions == [("team_alpha", True), ("team_beta", False)]
    from threadlens.plans.views import register_tables

    names = register_tables(spark, out)
    assert "expectation_log" in names and "silver_thread_lookup_history" in names
    r = spark.sql("SELECT team, SUM(checkpoint_count) AS n FROM gold_user_team_metrics "
                  "WHERE team = 'team_alpha' GROUP BY team").first()
    assert r.n == spark.sql("SELECT COUNT(*) AS n FROM silver_checkpoints WHERE team = 'team_alpha' "
                            "AND user_id IS NOT NULL").first().n


def test_same_batch_deliveries_follow_file_order(spark, scratch):
    raw, out = f"{scratch}/raw", f"{scratch}/out"
    _write(f"{raw}/checkpoints_1.csv", HEADER + cp_line("thread_1", "checkpoint_1", "2026-04-01T10:00:00Z", 1))
    _write(f"{raw}/thread_teams_1.csv", "thread_id,user_id,team\nthread_1,user_1,team_a\n"
                                        "thread_1,user_1,team_b\nthread_1,user_1,team_c\n")
    refresh(spark, raw, out)
    hist = read_history(spark, f"{out}/silver_thread_lookup_history")
    current = [r.team for r in hist.filter("__END_AT IS NULL").collect()]
    assert current == ["team_c"] and hist.count() == 3
    gold = spark.read.parquet(f"{out}/gold_user_team_metrics").first()
    assert gold.team == "team_c"


def test_optimize_refresh_tables(spark, scratch):
    from threadlens.operators.upkeep import analyze_tables, optimize_tables

    raw, out = f"{scratch}/raw", f"{scratch}/out"
    for i in range(3):
        _write(f"{raw}/checkpoints_{i}.csv", HEADER + cp_line("thread_1", f"checkpoint_{i}", f"2026-04-0{i + 1}T10:00:00Z", 1))
    _write(f"{raw}/thread_teams_1.csv", "thread_id,user_id,team\nthread_1,user_1,team_a\n")
    refresh(spark, raw, out)
    before = sorted(map(tuple, spark.read.parquet(f"{out}/gold_user_team_metrics").collect()))
    inv = {r.table_name: r.num_files for r in optimize_tables(spark, out).collect()}
    after = sorted(map(tuple, spark.read.parquet(f"{out}/gold_user_team_metrics").collect()))
    assert after == before and set(inv) == {"silver_checkpoints", "gold_user_team_metrics", "gold_team_summary"}
    assert all(n >= 1 for n in inv.values())
    stats = {(r.table_name, r.column_name): r for r in analyze_tables(spark, out).collect()}
    r = stats[("gold_user_team_metrics", "checkpoint_count")]
    assert (r.row_count, r.null_count, r.min_value, r.max_value) == (3, 0, "1", "1")


def test_refresh_without_new_files_rewrites_nothing(spark, scratch):
    import os as _os

    raw, out = f"{scratch}/raw", f"{scratch}/out"
    _write(f"{raw}/checkpoints_1.csv", HEADER + cp_line("thread_1", "checkpoint_1", "2026-04-01T10:00:00Z", 1))
    _write(f"{raw}/thread_teams_1.csv", "thread_id,user_id,team\nthread_1,user_1,team_a\n")
    refresh(spark, raw, out)
    gold_dir = f"{out}/gold_user_team_metrics/checkpoint_date=2026-04-01"
    before = sorted(_os.listdir(gold_dir))
    checks_before = sorted(_os.listdir(f"{out}/check_results"))
    assert refresh(spark, raw, out) == {"checkpoints": [], "lookup": []}
    assert sorted(_os.listdir(gold_dir)) == before
    assert sorted(_os.listdir(f"{out}/check_results")) == checks_before
    assert spark.read.parquet(f"{out}/gold_user_team_metrics").count() == 1
