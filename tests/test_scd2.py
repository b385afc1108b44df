"""SCD2 history (C1-C6, J5), including the hot-key split plan."""

import datetime as dt

import pytest

from threadlens.operators import scd2
from threadlens.sources import adapters

SCHEMA = "thread_id string, user_id string, team string, updated_at timestamp, seq_no bigint"


def T(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def hist(spark, rows, track=("user_id", "team"), **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = scd2.scd2_history(df, ["thread_id"], "updated_at", tiebreak=["seq_no"],
                            track_columns=list(track) if track else None, **kw)
    rows = [(r.thread_id, r.team, r["__START_AT"], r["__END_AT"]) for r in out.collect()]
    return sorted(rows, key=lambda x: (x[0], x[2], str(x[1]), str(x[3])))


def test_every_row_a_version(spark):
    rows = [("t1", "u", "a", T(1), 1), ("t1", "u", "a", T(2), 2), ("t1", "u", "b", T(3), 3)]
    assert hist(spark, rows, track=None) == [("t1", "a", T(1), T(2)), ("t1", "a", T(2), T(3)), ("t1", "b", T(3), None)]


def test_unchanged_resend_collapses(spark):
    rows = [("t1", "u", "a", T(1), 1), ("t1", "u", "a", T(2), 2), ("t1", "u", "b", T(3), 3),
            ("t1", "u", "a", T(4), 4)]
    assert hist(spark, rows) == [("t1", "a", T(1), T(3)), ("t1", "b", T(3), T(4)), ("t1", "a", T(4), None)]


def test_late_row_recuts_intervals(spark):
    rows = [("t1", "u", "a", T(1), 1), ("t1", "u", "c", T(5), 3), ("t1", "u", "b", T(3), 2)]
    assert hist(spark, rows) == [("t1", "a", T(1), T(3)), ("t1", "b", T(3), T(5)), ("t1", "c", T(5), None)]


def test_equal_sequence_uses_tiebreak(spark):
    rows = [("t1", "u", "b", T(1), 2), ("t1", "u", "a", T(1), 1)]
    assert hist(spark, rows) == [("t1", "a", T(1), T(1)), ("t1", "b", T(1), None)]


def test_null_key_and_sequence_dropped(spark):
    rows = [(None, "u", "a", T(1), 1), ("t1", "u", "a", None, 2), ("t1", "u", "a", T(2), 3)]
    assert hist(spark, rows) == [("t1", "a", T(2), None)]


def test_null_tracked_value_compares_equal(spark):
    rows = [("t1", "u", None, T(1), 1), ("t1", "u", None, T(2), 2), ("t1", "u", "a", T(3), 3)]
    assert hist(spark, rows) == [("t1", None, T(1), T(3)), ("t1", "a", T(3), None)]


@pytest.mark.parametrize("track", [None, ("user_id", "team")])
def test_hot_key_split_equals_window_by_key(spark, track):
    rows = []
    for i in range(60):  # one hot key with re-sent states, plus small keys
        rows.append(("hot", "u", "abc"[(i // 4) % 3], T(i // 6, i % 6 * 10), i))
    rows += [("t2", "u", "a", T(1), 100), ("t2", "u", "b", T(2), 101), ("t3", "u", "a", T(3), 102)]
    by_key = hist(spark, rows, track=track, split_hot_keys=False)
    for n in (2, 5, 13):
        assert hist(spark, rows, track=track, split_hot_keys=True, hot_key_rows=n) == by_key


def test_hot_key_split_on_orders_feed(spark):
    orders = adapters.orders_feed(adapters.table(spark, "/root/testdata/sf0.001", "orders"))
    kw = dict(keys=["o_custkey"], sequence_by="o_orderdate", tiebreak=["o_orderkey"], track_columns=["o_orderstatus"])
    a = scd2.scd2_history(orders, split_hot_keys=False, **kw)
    b = scd2.scd2_history(orders, split_hot_keys=True, hot_key_rows=3, **kw)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_current_asof_and_history(spark):
    rows = [("t1", "u1", "a", T(1), 1), ("t1", "u2", "b", T(3), 2), ("t2", "u3", "c", T(2), 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    h = scd2.scd2_history(df, ["thread_id"], "updated_at", tiebreak=["seq_no"], track_columns=["user_id", "team"])
    assert sorted((r.thread_id, r.team) for r in scd2.current(h).collect()) == [("t1", "b"), ("t2", "c")]
    assert sorted((r.thread_id, r.team) for r in scd2.as_of(h, T(2, 30)).collect()) == [("t1", "a"), ("t2", "c")]
    assert scd2.as_of(h, T(0)).count() == 0
    keys = spark.createDataFrame([("t1",)], "thread_id string")
    assert [r.team for r in scd2.key_history(h, keys).collect()] == ["a", "b"]
    assert scd2.duplicate_current_versions(h, ["thread_id"]).count() == 0


def test_hot_key_is_cut_into_bounded_chunks(spark):
    """A key with a third of the rows is spread over many (key, chunk) tasks."""
    from pyspark.sql import functions as F

    n, hot_rows = 9000, 3000
    df = spark.range(n).select(
        F.when(F.col("id") < hot_rows, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("thread_id"),
        F.lit("u").alias("user_id"),
        (F.col("id") % 3).cast("string").alias("team"),
        F.timestamp_seconds(F.col("id") * 7).alias("updated_at"),
        F.col("id").alias("seq_no"),
    )
    sizes = (scd2.with_chunks(df, ["thread_id"], ["updated_at", "seq_no"], 100)
             .groupBy("thread_id", "_scd_chunk").count())
    hot = sizes.filter("thread_id = 'hot'")
    assert hot.count() >= 30
    assert hot.agg(F.max("count")).first()[0] <= 2 * 100
    kw = dict(keys=["thread_id"], sequence_by="updated_at", tiebreak=["seq_no"], track_columns=["team"])
    a = scd2.scd2_history(df, split_hot_keys=True, hot_key_rows=100, **kw)
    b = scd2.scd2_history(df, split_hot_keys=False, **kw)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


@pytest.mark.parametrize("feed", ["one sequence value", "an outlier"])
def test_chunks_are_bounded_whatever_the_sequence(spark, feed):
    from pyspark.sql import functions as F

    second = F.lit(0) if feed == "one sequence value" else F.when(F.col("id") == 0, F.lit(-10**9)).otherwise(F.col("id"))
    df = spark.range(5000).select(
        F.lit("hot").alias("thread_id"), F.lit("u").alias("user_id"), (F.floor(F.col("id") / 7) % 3).cast("string").alias("team"),
        F.timestamp_seconds(second).alias("updated_at"), F.col("id").alias("seq_no"))
    sizes = scd2.with_chunks(df, ["thread_id"], ["updated_at", "seq_no"], 100).groupBy("_scd_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 200 and sizes.count() >= 25
    kw = dict(keys=["thread_id"], sequence_by="updated_at", tiebreak=["seq_no"], track_columns=["team"])
    a = scd2.scd2_history(df, hot_key_rows=100, **kw)
    b = scd2.scd2_history(df, split_hot_keys=False, **kw)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_small_chunks_cost_no_tasks_of_their_own(spark):
    from pyspark.sql import functions as F

    df = spark.range(5000).select(
        F.concat(F.lit("k"), (F.col("id") % 40).cast("string")).alias("thread_id"), F.lit("u").alias("user_id"),
        (F.floor(F.col("id") / 90) % 3).cast("string").alias("team"), F.timestamp_seconds(F.col("id")).alias("updated_at"), F.col("id").alias("seq_no"))
    chunked = scd2.with_chunks(df, ["thread_id"], ["updated_at", "seq_no"], 4)
    sizes = chunked.groupBy("thread_id", "_scd_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 4 and sizes.count() >= 1250
    assert len(chunked.inputFiles()) <= 2
    kw = dict(keys=["thread_id"], sequence_by="updated_at", tiebreak=["seq_no"], track_columns=["team"])
    a = scd2.scd2_history(df, hot_key_rows=4, **kw)
    b = scd2.scd2_history(df, split_hot_keys=False, **kw)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0
