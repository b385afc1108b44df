"""CSV feeds by header name, streaming ingestion and streaming SCD2."""

import os

from pyspark.sql import functions as F

from threadlens.functions.schemas import CHECKPOINT_FEED_COLUMNS, LOOKUP_FEED_COLUMNS
from threadlens.operators import scd2
from threadlens.sources.csv_feed import read_feed
from threadlens.streaming import ingest, scd2_stream


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_by_name_rescue(spark, scratch):
    _write(f"{scratch}/raw/thread_teams_1.csv", "thread_id,user_id,team\nt1,u1,a\n")
    _write(f"{scratch}/raw/thread_teams_2.csv", "team,thread_id,user_id\nb,t2,u2\n")
    _write(f"{scratch}/raw/thread_teams_3.csv", "thread_id,team,extra\nt3,c,xx\nt4,d,1,2\n\n")
    rows = {r.thread_id: r for r in read_feed(spark, f"{scratch}/raw/*.csv", LOOKUP_FEED_COLUMNS).collect()}
    assert (rows["t2"].user_id, rows["t2"].team) == ("u2", "b")
    assert rows["t3"].user_id is None and '"extra":"xx"' in rows["t3"]._rescued_data
    assert "_file_path" in rows["t3"]._rescued_data
    assert '"_line":"t4,d,1,2"' in rows["t4"]._rescued_data
    assert rows["t1"]._rescued_data is None and rows["t1"].ingested_at is not None
    assert len(rows) == 4


def test_csv_quoted_json(spark, scratch):
    cp = '"{""v"":""4"",""id"":""c1"",""ts"":""2026-04-01T10:00:00Z""}"'
    _write(f"{scratch}/raw/checkpoints_1.csv",
           "thread_id,checkpoint_ns,checkpoint_id,parent_checkpoint_id,type,checkpoint,metadata\n"
           f"thread_1,1,c1,,checkpoint,{cp},\n")
    r = read_feed(spark, f"{scratch}/raw/*.csv", CHECKPOINT_FEED_COLUMNS).first()
    assert r.checkpoint == '{"v":"4","id":"c1","ts":"2026-04-01T10:00:00Z"}'
    assert r.parent_checkpoint_id is None and r._rescued_data is None


def test_stream_ingest_is_incremental(spark, scratch):
    _write(f"{scratch}/raw/thread_teams_1.csv", "thread_id,user_id,team\nt1,u1,a\n")
    args = (spark, f"{scratch}/raw/*.csv", LOOKUP_FEED_COLUMNS, f"{scratch}/bronze", f"{scratch}/chk")
    ingest.ingest_csv(*args)
    assert ingest.read_table(spark, f"{scratch}/bronze").count() == 1
    ingest.ingest_csv(*args)  # nothing new: no batch, no duplicate
    assert ingest.read_table(spark, f"{scratch}/bronze").count() == 1
    _write(f"{scratch}/raw/thread_teams_2.csv", "user_id,thread_id,team\nu2,t2,b\n")
    ingest.ingest_csv(*args)
    t = ingest.read_table(spark, f"{scratch}/bronze")
    assert sorted((r.thread_id, r.user_id) for r in t.collect()) == [("t1", "u1"), ("t2", "u2")]


def test_stream_scd2_matches_batch(spark, scratch):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    feed = events.select(
        F.concat(F.lit("t"), (F.col("user_id") % 7).cast("string")).alias("thread_id"),
        F.lit("u").alias("user_id"),
        F.concat(F.lit("team_"), (F.col("event_id") % 3).cast("string")).alias("team"),
        F.col("ts").alias("updated_at"), "event_id")
    feed.repartition(5).write.parquet(f"{scratch}/src")
    kw = dict(keys=["thread_id"], sequence_by="updated_at", tiebreak=["event_id"], track_columns=["user_id", "team"])
    scd2_stream.run_scd2_stream(spark, f"{scratch}/src", f"{scratch}/log", f"{scratch}/hist",
                                f"{scratch}/chk", max_files_per_trigger=1, buckets=4, **kw)
    got = scd2_stream.read_history(spark, f"{scratch}/hist")
    want = scd2.scd2_history(spark.read.parquet(f"{scratch}/src"), **kw)
    cols = ["thread_id", "team", "__START_AT", "__END_AT"]
    assert got.count() == want.count()
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0
    # a retried micro-batch id rewrites its own folders only
    batch = spark.read.parquet(f"{scratch}/src")
    scd2_stream.apply_changes(batch.limit(0), 0, f"{scratch}/log", f"{scratch}/hist", buckets=4, **kw)
    assert scd2_stream.read_history(spark, f"{scratch}/hist").count() == want.count()


def test_history_compaction_keeps_current_state(spark, scratch):
    from threadlens.streaming.scd2_stream import compact_history, read_history

    kw = dict(keys=["thread_id"], sequence_by="updated_at", tiebreak=["event_id"], track_columns=["team"], buckets=4)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    feed = events.select(F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")).alias("thread_id"),
                         F.concat(F.lit("team_"), (F.col("event_id") % 2).cast("string")).alias("team"),
                         F.col("ts").alias("updated_at"), "event_id")
    for i, part in enumerate(feed.randomSplit([0.5, 0.5], seed=7)):
        scd2_stream.apply_changes(part, i, f"{scratch}/log", f"{scratch}/hist", **kw)
    before = sorted(map(tuple, read_history(spark, f"{scratch}/hist").collect()))
    compact_history(spark, f"{scratch}/hist", snapshot_batch=2)
    after = sorted(map(tuple, read_history(spark, f"{scratch}/hist").collect()))
    assert after == before and len(after) > 0


MULTI = ('thread_id,user_id,team\nt1,"u\n1",a\n"t2",u2,"b, c"\n'
         't3,u3,a,extra_cell\n')


def test_multiline_batch(spark, scratch):
    _write(f"{scratch}/raw/thread_teams_1.csv", MULTI)
    _write(f"{scratch}/raw/thread_teams_2.csv", 'team,thread_id,user_id\n"x\ny",t4,u4\n')
    rows = {r.thread_id: r for r in read_feed(spark, f"{scratch}/raw/*.csv", LOOKUP_FEED_COLUMNS,
                                                multi_line=True).collect()}
    assert rows["t1"].user_id == "u\n1" and rows["t2"].team == "b, c"
    assert (rows["t4"].user_id, rows["t4"].team) == ("u4", "x\ny")
    assert "_line" in rows["t3"]._rescued_data and rows["t1"]._rescued_data is None


def test_multiline_stream(spark, scratch):
    _write(f"{scratch}/raw/thread_teams_1.csv", MULTI)
    ingest.ingest_csv(spark, f"{scratch}/raw/*.csv", LOOKUP_FEED_COLUMNS, f"{scratch}/bronze",
                      f"{scratch}/chk", multi_line=True)
    rows = {r.thread_id: r for r in ingest.read_table(spark, f"{scratch}/bronze").collect()}
    assert rows["t1"].user_id == "u\n1" and len(rows) == 3


def test_byte_order_mark_in_header(spark, scratch):
    _write(f"{scratch}/raw/thread_teams_1.csv", "\ufeffthread_id,user_id,team\nt1,u1,a\n")
    r = read_feed(spark, f"{scratch}/raw/*.csv", LOOKUP_FEED_COLUMNS).first()
    assert (r.thread_id, r.user_id, r._rescued_data) == ("t1", "u1", None)


def test_failed_batch_is_replayed_without_duplicates(spark, scratch):
    import pytest
    from pyspark.errors import StreamingQueryException

    _write(f"{scratch}/raw/thread_teams_1.csv", "thread_id,user_id,team\nt1,u1,a\nt2,u2,b\n")
    args = (spark, f"{scratch}/raw/*.csv", LOOKUP_FEED_COLUMNS, f"{scratch}/bronze", f"{scratch}/chk")

    def crash(df, batch_id):  # after the batch folder is published, before the commit
        raise RuntimeError("executor lost")

    with pytest.raises(StreamingQueryException):
        ingest.ingest_csv(*args, on_batch=crash)
    assert ingest.read_table(spark, f"{scratch}/bronze").count() == 2   # written once
    ingest.ingest_csv(*args)                                             # replays batch 0
    t = ingest.read_table(spark, f"{scratch}/bronze")
    assert t.count() == 2 and sorted(r._batch for r in t.collect()) == [0, 0]


def test_scd2_batch_failing_between_log_and_history_is_replayed(spark, scratch, monkeypatch):
    import pytest

    kw = dict(keys=["thread_id"], sequence_by="updated_at", tiebreak=["event_id"], track_columns=["team"], buckets=4)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    feed = events.select(F.concat(F.lit("t"), (F.col("user_id") % 5).cast("string")).alias("thread_id"),
                         F.concat(F.lit("team_"), (F.col("event_id") % 3).cast("string")).alias("team"),
                         F.col("ts").alias("updated_at"), "event_id")
    first, second = feed.randomSplit([0.5, 0.5], seed=11)
    scd2_stream.apply_changes(first, 0, f"{scratch}/log", f"{scratch}/hist", **kw)

    real = scd2_stream._write_batch

    def failing(df, table_dir, batch_id):
        if table_dir.endswith("hist"):
            raise RuntimeError("driver lost before the history was published")
        real(df, table_dir, batch_id)

    monkeypatch.setattr(scd2_stream, "_write_batch", failing)
    with pytest.raises(RuntimeError):
        scd2_stream.apply_changes(second, 1, f"{scratch}/log", f"{scratch}/hist", **kw)
    monkeypatch.setattr(scd2_stream, "_write_batch", real)
    scd2_stream.apply_changes(second, 1, f"{scratch}/log", f"{scratch}/hist", **kw)   # replay

    got = sorted(map(tuple, scd2_stream.read_history(spark, f"{scratch}/hist")
                     .select("thread_id", "team", "__START_AT", "__END_AT").collect()), key=repr)
    want = sorted(map(tuple, scd2.scd2_history(feed, **{k: v for k, v in kw.items() if k != "buckets"})
                      .select("thread_id", "team", "__START_AT", "__END_AT").collect()), key=repr)
    assert got == want and len(got) > 0
