"""K2: a micro-batch writes what it changes, whatever the size of the history."""

import datetime as dt
import random

import pytest

from threadlens.operators import scd2
from threadlens.streaming.scd2_stream import apply_changes, compact_history, read_history

KW = dict(keys=["thread_id"], sequence_by="updated_at", tiebreak=["n"], track_columns=["team"])
SCHEMA = "thread_id string, team string, updated_at timestamp_ntz, n int"
BASE = dt.datetime(2026, 4, 1)


def rows_of(rng, threads, each, n0=0):
    out = []
    for t in range(threads):
        for i in range(each):
            out.append((f"t{t}", rng.choice("ab"), BASE + dt.timedelta(minutes=10 * i), n0 + len(out)))
    return out


def late_batch(rng):
    """Five threads: rows after the history, rows in the middle of it, an unchanged re-delivery and a new thread."""
    out = []
    for t in range(5):
        out.append((f"t{t}", "c", BASE + dt.timedelta(minutes=10_000), 900_000 + t))
    out += [("t1", "c", BASE + dt.timedelta(minutes=25), 900_010), ("t2", "b", BASE + dt.timedelta(minutes=-5), 900_011)]
    out += [("new", "a", BASE, 900_012), (None, "a", BASE, 900_013), ("t3", "a", None, 900_014)]
    return out


def same(spark, history_dir, rows, **kw):
    args = {**KW, **kw}
    want = scd2.scd2_history(spark.createDataFrame(rows, SCHEMA), **args)
    cols = ["thread_id", "team", "updated_at", "n", "__START_AT", "__END_AT"]
    got = sorted(map(tuple, read_history(spark, history_dir).select(cols).collect()), key=repr)
    assert got == sorted(map(tuple, want.select(cols).collect()), key=repr)


def delta_rows(spark, history_dir, batch):
    return spark.read.parquet(f"{history_dir}/_batch={batch}").count()


def test_rows_written_follow_the_batch(spark, scratch):
    written = {}
    for threads in (20, 400):
        base = f"{scratch}/{threads}"
        rng = random.Random(2)
        first, second = rows_of(rng, threads, 12), late_batch(rng)
        apply_changes(spark.createDataFrame(first, SCHEMA), 0, f"{base}/log", f"{base}/hist", buckets=4, **KW)
        for _ in range(2):  # and a replayed batch
            apply_changes(spark.createDataFrame(second, SCHEMA), 1, f"{base}/log", f"{base}/hist", buckets=4, **KW)
            same(spark, f"{base}/hist", first + second)
        written[threads] = delta_rows(spark, f"{base}/hist", 1)
    assert written[20] == written[400] <= 3 * len(late_batch(random.Random(2)))


@pytest.mark.parametrize("track", [["team"], None])
def test_any_order_of_delivery_gives_the_batch_history(spark, scratch, track):
    rng = random.Random(11)
    rows = rows_of(rng, 9, 8) + [("t0", "a", BASE, 0)] * 2
    rng.shuffle(rows)
    kw = {**KW, "track_columns": track}
    for i in range(5):
        apply_changes(spark.createDataFrame(rows[i::5], SCHEMA), i, f"{scratch}/log", f"{scratch}/hist", buckets=3, **kw)
        if i == 2:
            compact_history(spark, f"{scratch}/hist", 2)
    same(spark, f"{scratch}/hist", rows, track_columns=track)


def test_in_order_batches_do_not_read_the_log(spark, scratch):
    import glob
    import os

    first = [(f"t{i}", "a", BASE, i) for i in range(6)]
    apply_changes(spark.createDataFrame(first, SCHEMA), 0, f"{scratch}/log", f"{scratch}/hist", buckets=2, **KW)
    for f in glob.glob(f"{scratch}/log/_batch=0/*/*.parquet"):
        os.truncate(f, 0)  # unreadable
    second = [("t1", "b", BASE + dt.timedelta(minutes=5), 10), ("t2", "a", BASE + dt.timedelta(minutes=6), 11)]
    apply_changes(spark.createDataFrame(second, SCHEMA), 1, f"{scratch}/log", f"{scratch}/hist", buckets=2, **KW)
    same(spark, f"{scratch}/hist", first + second)
    assert delta_rows(spark, f"{scratch}/hist", 1) == 3  # t1 closed and opened, t2 confirmed


def test_versions_are_worked_out_once(spark, scratch, monkeypatch):
    from threadlens.streaming import scd2_stream

    rng = random.Random(4)
    first, second = rows_of(rng, 10, 6), late_batch(rng)
    apply_changes(spark.createDataFrame(first, SCHEMA), 0, f"{scratch}/log", f"{scratch}/hist", buckets=2, **KW)
    plans = []
    real = scd2_stream._write_batch

    def watched(df, table_dir, batch_id):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        real(df, table_dir, batch_id)

    monkeypatch.setattr(scd2_stream, "_write_batch", watched)
    apply_changes(spark.createDataFrame(second, SCHEMA), 1, f"{scratch}/log", f"{scratch}/hist", buckets=2, **KW)
    assert plans[-1].count("row_number()") == 1
    same(spark, f"{scratch}/hist", first + second)
