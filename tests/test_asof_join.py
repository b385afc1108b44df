"""J5 for a table of instants: against a plain loop, and with a hot key cut into chunks."""

import datetime as dt
import random

import pytest

from threadlens.operators import scd2

BASE = dt.datetime(2026, 4, 1)


def at(minutes):
    return None if minutes is None else BASE + dt.timedelta(minutes=minutes)


def brute(facts, history):
    out = []
    for k, t, n in facts:
        hit = [v for key, s, e, v in history if k is not None and t is not None and key == k and s <= t and (e is None or t < e)]
        assert len(hit) <= 1
        out.append((k, at(t), n, hit[0] if hit else None))
    return sorted(out, key=repr)


def run(spark, facts, history, **kw):
    f = spark.createDataFrame([(k, at(t), n) for k, t, n in facts], "k string, t timestamp_ntz, n int")
    h = spark.createDataFrame([(k, at(s), at(e), v) for k, s, e, v in history], "k string, __START_AT timestamp_ntz, __END_AT timestamp_ntz, team string")
    return scd2.asof_join(f, h, ["k"], "t", ["team"], **kw)


def feed(rng, keys, versions, instants, hot):
    history, facts = [], []
    for key in keys:
        cuts = sorted(rng.randint(0, 300) for _ in range(versions * (hot if key == "k0" else 1)))
        for i, s in enumerate(cuts):
            closed = rng.random() < 0.2
            history.append((key, s, cuts[i + 1] if i + 1 < len(cuts) else (s + 5 if closed else None), f"{key}v{i}"))
    for n in range(instants):
        key = "k0" if n % 3 == 0 else rng.choice([*keys, "unknown", None])
        facts.append((key, rng.choice([None, *range(-5, 310)]), n))
    return facts, history


@pytest.mark.parametrize("hot_key_rows", [1_000_000, 40, 3])
def test_equals_a_loop_over_intervals(spark, hot_key_rows):
    facts, history = feed(random.Random(3), [f"k{i}" for i in range(8)], 6, 900, 10)
    got = run(spark, facts, history, hot_key_rows=hot_key_rows)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(facts, history)


def test_a_hot_thread_is_split_and_nothing_is_nested(spark):
    facts, history = feed(random.Random(8), [f"k{i}" for i in range(30)], 4, 3000, 100)
    got = run(spark, facts, history, hot_key_rows=100)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("_scd_chunk") > 0
    assert sorted(map(tuple, got.collect()), key=repr) == brute(facts, history)


def test_empty_sides_and_ties_at_one_instant(spark):
    assert run(spark, [], [("a", 0, None, "x")]).count() == 0
    assert [tuple(r) for r in run(spark, [("a", 1, 0)], []).collect()] == [("a", at(1), 0, None)]
    history = [("a", 5, 5, "zero"), ("a", 5, 9, "real"), ("a", 9, None, "next")]
    facts = [("a", 4, 0), ("a", 5, 1), ("a", 8, 2), ("a", 9, 3), ("a", 9, 3)]
    for hot in (1_000_000, 1):
        assert sorted(map(tuple, run(spark, facts, history, hot_key_rows=hot).collect()), key=repr) == brute(facts, history)


def test_small_chunks_need_few_files(spark, monkeypatch):
    facts, history = feed(random.Random(5), [f"k{i}" for i in range(9)], 12, 2000, 10)
    cut = []
    real = scd2.with_chunks
    monkeypatch.setattr(scd2, "with_chunks", lambda *a: cut.append(real(*a)) or cut[-1])
    got = run(spark, facts, history, hot_key_rows=4)
    assert len(cut[0].inputFiles()) <= 2
    assert sorted(map(tuple, got.collect()), key=repr) == brute(facts, history)


def test_facts_are_worked_out_once(spark):
    facts, history = feed(random.Random(6), [f"k{i}" for i in range(9)], 6, 600, 10)
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    f = spark.createDataFrame([(k, at(t), n) for k, t, n in facts], "k string, t timestamp_ntz, n int")
    h = spark.createDataFrame([(k, at(s), at(e), v) for k, s, e, v in history], "k string, __START_AT timestamp_ntz, __END_AT timestamp_ntz, team string")
    got = scd2.asof_join(f.mapInArrow(counted, f.schema), h, ["k"], "t", ["team"], hot_key_rows=10).collect()
    assert sorted(map(tuple, got), key=repr) == brute(facts, history)
    assert rows.value == len(facts)


@pytest.mark.parametrize("hot_key_rows, share", [(200, 0.2), (200, 0.9)])
def test_ordinary_keys_beside_one_hot_key(spark, hot_key_rows, share):
    """Few hot rows are cut alone, many together with the others."""
    rng = random.Random(4)
    facts, history = feed(rng, [f"k{i}" for i in range(60)], 3, 1200, 10)
    facts = [("k0" if rng.random() < share else k, t, n) for k, t, n in facts if k != "k0" or share > 0.5 or n % 2]
    got = run(spark, facts, history, hot_key_rows=hot_key_rows)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(facts, history)
