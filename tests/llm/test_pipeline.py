import collections

import corpus_pipeline
from tests.llm.cases import awkward_rows, SCHEMA, table
from threadlens.llm import decontam, fertility, mixing, ngram_join, queries
from tests.llm.test_ngram_join import brute

SF = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark):
    docs = table(spark, "documents", "sf0.01")
    (_, quality), (_, near), (_, clean), (_, mix), (_, shards) = corpus_pipeline.STAGES
    first = quality(spark, docs, SF)
    kept = {r.doc_id for r in fertility.op2_token_fertility(docs).collect() if r.kept}
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == kept
    second = near(spark, first, SF)
    classes = brute({r.doc_id: r.text for r in first.collect()}, 5, 80)
    assert collections.Counter(r.doc_id for r in second.collect()) == collections.Counter({c for _, c, _ in classes.values()})
    third = clean(spark, second, SF)
    leaked = {r.doc_id for r in decontam.op1_simhash_decontam(second, table(spark, "benchmark", "sf0.01")).collect() if r.leaked}
    assert leaked and {r.doc_id for r in third.collect()} == {r.doc_id for r in second.collect()} - leaked
    fourth = mix(spark, third, SF)
    taken = {r.doc_id: r.taken // r.size for r in mixing.op5_source_mix(third).collect() if r.size}
    assert fourth.columns == docs.columns
    assert collections.Counter(r.doc_id for r in fourth.collect()) == collections.Counter({i: n for i, n in taken.items() if n})
    last = shards(spark, fourth, SF)
    assert last.count() == fourth.count() and set(docs.columns) <= set(last.columns)
    assert collections.Counter(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "shard", "slot").collect()) == collections.Counter(
        tuple(r) for r in last.select("doc_id", "shard", "slot").collect())


def test_awkward_and_empty_tables(spark, scratch):
    table(spark, "benchmark").write.parquet(f"{scratch}/benchmark.parquet")
    for rows in (awkward_rows(), []):
        docs = spark.createDataFrame(rows, SCHEMA)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, scratch)
            if k + 1 < len(corpus_pipeline.STAGES):
                assert docs.columns == spark.createDataFrame([], SCHEMA).columns
        assert (docs.count() > 0) == bool(rows)


def test_registry_has_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())
    assert ngram_join.PERCENT == 85 and corpus_pipeline.PERCENT == 80
