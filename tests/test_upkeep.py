"""Upkeep jobs: column stats, compaction (range / z-order), file inventory (M1-M3, K5, K6)."""

import os

from pyspark.sql import functions as F

from threadlens.operators import upkeep


def test_column_stats(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "n int, s string")
    out = {r.column_name: r for r in upkeep.column_stats(df).collect()}
    assert (out["n"].row_count, out["n"].null_count, out["n"].min_value, out["n"].max_value) == (3, 0, "1", "3")
    assert out["s"].null_count == 1 and out["s"].approx_distinct == 2


def test_compact_and_inventory(spark, scratch):
    src, dst = f"{scratch}/src", f"{scratch}/dst"
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 17).alias("k"))
    df.repartition(30).write.parquet(src)
    inv = upkeep.file_inventory(spark, {"src": src}).first()
    assert inv.num_files == 30 and not inv.needs_compaction
    out = upkeep.compact(spark, src, dst, ["k", "id"], target_file_mb=128).first()
    assert out.num_files == 1
    back = spark.read.parquet(dst)
    assert back.count() == 5000 and back.exceptAll(df).count() == 0


def test_zorder_keeps_rows(spark, scratch):
    src, dst = f"{scratch}/src", f"{scratch}/dst"
    df = spark.range(0, 2000).select("id", (F.col("id") * 7 % 101).alias("b"),
                                     F.current_date().alias("d"))
    df.repartition(10).write.parquet(src)
    upkeep.compact(spark, src, dst, ["id", "b"], zorder=True, bits=4)
    assert spark.read.parquet(dst).exceptAll(spark.read.parquet(src)).count() == 0


def test_write_clustered_dynamic_partitions(spark, scratch):
    path = f"{scratch}/gold"
    df = spark.createDataFrame([("2024-01-01", "a", 1), ("2024-01-02", "b", 2)], "day string, team string, n int")
    upkeep.write_clustered(df, path, ["team"], partition_by=["day"])
    upkeep.write_clustered(df.filter("day = '2024-01-02'").withColumn("n", F.lit(9)), path, ["team"],
                           partition_by=["day"])
    rows = sorted((r.day, r.n) for r in spark.read.parquet(path).collect())
    assert [(str(d), n) for d, n in rows] == [("2024-01-01", 1), ("2024-01-02", 9)]
    assert os.path.isdir(f"{path}/day=2024-01-01")


def test_zorder_on_strings_lets_a_point_filter_skip_files(spark, scratch):
    src, dst = f"{scratch}/src", f"{scratch}/dst"
    df = spark.range(0, 8000).select(F.format_string("thread_%05d", F.col("id") * 7919 % 8000).alias("thread_id"),
                                     F.format_string("user_%03d", F.col("id") % 400).alias("user_id"), "id")
    df.repartition(8).write.parquet(src)
    laid = upkeep._layout(spark.read.parquet(src), ["thread_id", "user_id"], 16, True, 8)
    laid.write.parquet(dst)
    files = (spark.read.parquet(dst).withColumn("f", F.col("_metadata.file_path")).groupBy("f")
             .agg(*[g(c).alias(f"{g.__name__}_{c}") for c in ("thread_id", "user_id") for g in (F.min, F.max)]).collect())
    assert len(files) >= 12
    for c, value in (("thread_id", "thread_04000"), ("user_id", "user_200")):
        touched = sum(r[f"min_{c}"] <= value <= r[f"max_{c}"] for r in files)
        assert touched <= len(files) / 2
    assert spark.read.parquet(dst).exceptAll(spark.read.parquet(src)).count() == 0


def test_inventory_counts_files_without_rows(spark, scratch):
    path = f"{scratch}/t"
    spark.range(10).repartition(2).write.parquet(path)
    spark.range(0).write.mode("append").parquet(path)
    inv = upkeep.file_inventory(spark, {"t": path}).first()
    assert inv.num_files == len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 3
