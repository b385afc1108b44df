"""Silver operators: lookup cleaning, JSON parsing, enrichment."""

from pyspark.sql import functions as F

from threadlens.operators.enrich import clean_thread_lookup, enrich_checkpoints, parse_checkpoints
from threadlens.operators.expectations import apply_rules
from threadlens.plans.layers import SILVER_RULES


def test_clean_casts_ids_to_string(spark):
    df = spark.createDataFrame([(1, 100, "team_a")], "thread_id int, user_id bigint, team string")
    out = clean_thread_lookup(df)
    assert dict(out.dtypes) == {"thread_id": "string", "user_id": "string", "team": "string",
                                "updated_at": "timestamp"}
    r = out.first()
    assert (r.thread_id, r.user_id, r.team) == ("1", "100", "team_a")
    assert r.updated_at is not None


def test_clean_keeps_duplicates(spark, thread_lookup):
    twice = thread_lookup.limit(1).unionByName(thread_lookup.limit(1))
    assert clean_thread_lookup(twice).count() == 2


def test_clean_with_event_time(spark):
    df = spark.createDataFrame([("t", "u", "x", "2024-01-01 00:00:00")], "thread_id string, user_id string, team string, ts string")
    out = clean_thread_lookup(df, F.to_timestamp("ts"))
    assert str(out.first().updated_at) == "2024-01-01 00:00:00"


def test_enrich_keeps_rows_and_joins_owner(spark, raw_checkpoints, thread_lookup):
    out = enrich_checkpoints(raw_checkpoints, thread_lookup)
    assert out.count() == 3
    r = out.filter("checkpoint_id = 'checkpoint_1'").first()
    assert (r.user_id, r.team) == ("user_1", "team_alpha")
    assert r.checkpoint_v == 4 and dict(out.dtypes)["checkpoint_v"] == "int"
    assert r.metadata_step_int == 1 and r.metadata_source == "user_input"
    assert r.channel_versions_start == "1" and r.checkpoint_id_parsed == "checkpoint_1"
    assert str(r.checkpoint_date) == "2026-04-01"
    assert str(r.checkpoint_hour) == "2026-04-01 10:00:00"
    assert r.checkpoint_ns == "1"  # a long id column is accepted and read as text


def test_enrich_projects_dimension(spark, raw_checkpoints, thread_lookup):
    dim = thread_lookup.withColumn("__END_AT", F.lit(None).cast("timestamp"))
    cols = enrich_checkpoints(raw_checkpoints, dim).columns
    assert "__END_AT" not in cols and "updated_at" not in cols


def test_thread_without_owner_kept_with_nulls(spark, raw_checkpoints, thread_lookup):
    out = enrich_checkpoints(raw_checkpoints, thread_lookup.filter("thread_id <> 'thread_2'"))
    r = out.filter("thread_id = 'thread_2'").first()
    assert r.user_id is None and r.team is None


def test_bad_payloads_drop_without_failing(spark):
    rows = [
        ("t", "c1", '{"v":', None),                                  # malformed
        ("t", "c2", "", '{"step":"x","source":"s"}'),                # empty, non-numeric step
        ("t", "c3", None, None),                                     # NULL
        ("t", "c4", '{"v":"a","id":"c4","ts":"not a time"}', None),  # bad ts, non-numeric v
        ("t", "c5", '{"v":4,"id":"c5","ts":"2024-01-01 00:00:00"}', '{"step":7}'),  # numbers, no map
    ]
    b = spark.createDataFrame(rows, "thread_id string, checkpoint_id string, checkpoint string, metadata string") \
        .select("thread_id", F.lit("ns").alias("checkpoint_ns"), "checkpoint_id",
                F.lit(None).cast("string").alias("parent_checkpoint_id"), F.lit("checkpoint").alias("type"),
                "checkpoint", "metadata")
    parsed = parse_checkpoints(b)
    got = {r.checkpoint_id: r for r in parsed.collect()}
    assert got["c2"].metadata_step_int is None
    assert got["c4"].checkpoint_ts is None and got["c4"].checkpoint_v is None
    c5 = got["c5"]
    assert c5.checkpoint_v == 4 and c5.metadata_step_int == 7 and c5.channel_versions_start is None
    kept = apply_rules(parsed, SILVER_RULES, "drop")
    assert [r.checkpoint_id for r in kept.collect()] == ["c5"]


def test_empty_input(spark, thread_lookup, raw_checkpoints):
    out = enrich_checkpoints(raw_checkpoints.limit(0), thread_lookup)
    assert out.count() == 0


def test_hot_thread_join_is_split_by_aqe(spark):
    """A thread with a third of all checkpoints: AQE splits its join partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",          # force a shuffled join
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30000
        cp = '{"v":"4","id":"c","ts":"2024-01-01 00:00:00"}'
        facts = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 997).cast("string"))).alias("thread_id"),
            F.lit("ns").alias("checkpoint_ns"), F.col("id").cast("string").alias("checkpoint_id"),
            F.lit(None).cast("string").alias("parent_checkpoint_id"), F.lit("checkpoint").alias("type"),
            F.lit(cp).alias("checkpoint"), F.lit('{"step":"1"}').alias("metadata"))
        owners = spark.range(997).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("thread_id"),
                                         F.lit("u").alias("user_id"), F.lit("x").alias("team")) \
            .unionByName(spark.createDataFrame([("hot", "uh", "y")], "thread_id string, user_id string, team string"))
        per_team = enrich_checkpoints(facts, owners).groupBy("team").count()
        rows = per_team.collect()
        assert {r.team: r["count"] for r in rows} == {"y": n // 3, "x": n - n // 3}
        plan = per_team._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
