"""Table upkeep as plain Spark jobs (M1-M3, K5, K6).

* ``column_stats``   one-pass per-column profile (rows, NULLs, min, max, NDV)
* ``compact``        rewrite a table into fewer, sorted files (range layout
                     or z-order); sorted files make parquet row-group min/max
                     statistics selective, which is what data skipping uses
* ``write_clustered``the clustered write used for gold (K5), optionally
                     partitioned by date with dynamic partition overwrite (K6)
* ``file_inventory`` files, bytes and a needs-compaction flag per table,
                     from the file listing alone (no file is opened)
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL_FILE_LIMIT = 1000  # fixed value: file count above which a table needs compaction


def column_stats(df: DataFrame, columns: list[str] | None = None, approx: bool = True) -> DataFrame:
    """One row per column: row_count, null_count, min/max (as text), approx NDV.

    A single global aggregate computes every statistic of every column in
    one scan; ``stack`` then turns the wide row into rows.
    """
    cols = columns or df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"_n{i}"),
            F.min(c).cast("string").alias(f"_lo{i}"),
            F.max(c).cast("string").alias(f"_hi{i}"),
        ]
        if approx:
            aggs.append(F.approx_count_distinct(c).alias(f"_d{i}"))
    wide = df.agg(*aggs)
    d = lambda i: f"_d{i}" if approx else "CAST(NULL AS BIGINT)"
    parts = ", ".join(f"'{c}', _n{i}, _lo{i}, _hi{i}, {d(i)}" for i, c in enumerate(cols))
    out = wide.selectExpr(
        "_rows AS row_count",
        f"stack({len(cols)}, {parts}) AS (column_name, null_count, min_value, max_value, approx_distinct)",
    )
    cols_out = ["column_name", "row_count", "null_count", "min_value", "max_value"]
    return out.select(*cols_out, "approx_distinct") if approx else out.select(*cols_out)


def _layout(df: DataFrame, cluster_by: list[str], num_files: int, zorder: bool, bits: int) -> DataFrame:
    if zorder and len(cluster_by) > 1:
        return (with_z_value(df, cluster_by, bits, "_z")
                .repartitionByRange(num_files, "_z").sortWithinPartitions("_z").drop("_z"))
    return df.repartitionByRange(num_files, *cluster_by).sortWithinPartitions(*cluster_by)


def _as_number(df: DataFrame, col: str) -> Column:
    """An order-preserving double for dates, timestamps and numbers; for strings
    the rank among sampled values."""
    from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

    t = df.schema[col].dataType
    c = F.col(col)
    if isinstance(t, TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(t, TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(t, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(t, NumericType):
        return c.cast("double")
    return _string_rank(df, col)(c.cast("string"))


# Values sampled per string column for its range bounds.
SAMPLED_VALUES = 20_000


def _string_rank(df: DataFrame, col: str):
    """A function to the position of a string among sampled values of its column (bounded sample, sorted)."""
    c = F.col(col).cast("string")
    rows = df.count()
    share = min(1.0, SAMPLED_VALUES / rows) if rows else 1.0
    picked = df.select(c.alias("v")).where("v is not null").sample(share, seed=7).distinct()
    values = np.array(sorted(r.v for r in picked.collect()), dtype=object)  # about SAMPLED_VALUES at most

    @F.pandas_udf("double")
    def rank(text: pd.Series) -> pd.Series:
        known = text.notna().to_numpy()
        out = np.zeros(len(text))
        if len(values):
            out[known] = np.searchsorted(values, text[known].to_numpy(dtype=object))
        return pd.Series(out)

    return rank


def with_z_value(df: DataFrame, cols: list[str], bits: int = 10, out: str = "_z") -> DataFrame:
    """Add the Morton code of the columns' quantile ranks as ``out``.

    Each column is mapped to a bucket in [0, 2^bits) by its approximate
    quantiles (one mergeable sketch per column; at most 2^bits bounds per
    column reach the driver), bucketed with a JVM-side binary search
    (``Bucketizer``), then the bucket bits are interleaved with column
    expressions.
    """
    from pyspark.ml.feature import Bucketizer

    levels = 1 << bits
    probs = [i / levels for i in range(1, levels)]
    tmp_in = [f"_zin{j}" for j in range(len(cols))]
    tmp_out = [f"_zb{j}" for j in range(len(cols))]
    base = df.select("*", *[_as_number(df, c).alias(t) for c, t in zip(cols, tmp_in)])
    bounds = base.agg(*[
        F.percentile_approx(t, probs, 10000).alias(t) for t in tmp_in
    ]).first()
    splits = []
    for t in tmp_in:
        qs = sorted(set(q for q in (bounds[t] or []) if q is not None)) or [0.0]  # empty input
        splits.append([float("-inf")] + qs + [float("inf")])
    bucketed = Bucketizer(splitsArray=splits, inputCols=tmp_in, outputCols=tmp_out,
                          handleInvalid="keep").transform(base.na.fill(0.0, subset=tmp_in))
    z = F.lit(0).cast("long")
    for j, b_col in enumerate(tmp_out):
        rank = F.least(F.col(b_col).cast("long"), F.lit(levels - 1).cast("long"))
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, b * len(cols) + j))
    return bucketed.withColumn(out, z).drop(*tmp_in, *tmp_out)


def compact(spark: SparkSession, src: str, dst: str, cluster_by: list[str],
            target_file_mb: int = 128, zorder: bool = False, bits: int = 10) -> DataFrame:
    """M1: rewrite ``src`` into ``dst`` as sorted files of about ``target_file_mb``.

    The file count comes from the input's on-disk size (file listing), so the
    rewrite needs no counting pass.  ``dst`` must differ from ``src``; swap
    the folders after the job (a reader of ``src`` is never disturbed).
    Returns the inventory of the written table.
    """
    if src.rstrip("/") == dst.rstrip("/"):
        raise ValueError("compact writes a new folder; dst must differ from src")
    df = spark.read.parquet(src)
    size = _input_bytes(df)
    num_files = max(1, -(-size // (target_file_mb * 1024 * 1024)))
    _layout(df, cluster_by, num_files, zorder, bits).write.mode("overwrite").parquet(dst)
    return file_inventory(spark, {"compacted": dst})


def optimize_table(spark: SparkSession, path: str, cluster_by: list[str],
                   partition_by: list[str] | None = None, target_file_mb: int = 128,
                   zorder: bool = False, bits: int = 10) -> None:
    """M1 in place: rewrite a table clustered into files of about ``target_file_mb``.

    The new layout is written beside the table and swapped in by rename
    (``session.publish``), so readers see the old or the new table, never a
    half-written one.  Partition folders (``partition_by``) are kept.
    """
    from threadlens.session import publish

    df = spark.read.parquet(path)
    num_files = max(1, -(-_input_bytes(df) // (target_file_mb * 1024 * 1024)))
    keys = list(partition_by or [])
    laid = _layout(df, keys + [c for c in cluster_by if c not in keys], num_files, zorder, bits)
    parent, name = path.rstrip("/").rsplit("/", 1)
    staged = f"{parent}/_optimizing_{name}"
    writer = laid.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(staged)
    publish(spark, staged, path)


# Layout of the tables written by ``plans.refresh``: (cluster columns, partition columns).
# The streaming tables keep their per-batch folders and are not rewritten.
REFRESH_LAYOUT = {
    "silver_checkpoints": (["thread_id"], ["checkpoint_date"]),
    "gold_user_team_metrics": (["team", "user_id"], ["checkpoint_date"]),
    "gold_team_summary": (["team"], ["checkpoint_date"]),
}


def optimize_tables(spark: SparkSession, out_dir: str, names: list[str] | None = None,
                    target_file_mb: int = 128, dry_run: bool = False) -> DataFrame:
    """M1 for the named tables of a refresh output (default: all with a layout).

    The loop runs over the handful of table names; every rewrite is a Spark
    job.  Returns the inventory after the rewrites; with ``dry_run`` nothing
    is rewritten.  Which tables need it says ``file_inventory``.
    """
    paths = {n: f"{out_dir.rstrip('/')}/{n}" for n in names or REFRESH_LAYOUT}
    for name, path in paths.items():
        cluster_by, partition_by = REFRESH_LAYOUT[name]
        if not dry_run:
            optimize_table(spark, path, cluster_by, partition_by, target_file_mb)
    return file_inventory(spark, paths)


def analyze_tables(spark: SparkSession, out_dir: str, approx: bool = True) -> DataFrame:
    """M2 for all tables of a refresh output: ``column_stats`` per table.

    One aggregate per table (every column at once), tagged with the table name.
    """
    out = None
    for name in REFRESH_LAYOUT:
        stats = column_stats(spark.read.parquet(f"{out_dir.rstrip('/')}/{name}"), approx=approx)
        part = stats.select(F.lit(name).alias("table_name"), *stats.columns)
        out = part if out is None else out.unionByName(part)
    return out


def write_clustered(df: DataFrame, path: str, cluster_by: list[str], partition_by: list[str] | None = None,
                    num_partitions: int | None = None, after_layout=None) -> None:
    """K5/K6: clustered write; with ``partition_by`` only touched partitions are replaced.

    ``after_layout(df)`` runs on the range-partitioned rows, above the
    exchange: observed metrics placed there are not also collected by the
    range partitioner's sampling job.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = (partition_by or []) + [c for c in cluster_by if c not in (partition_by or [])]
    out = df.repartitionByRange(n, *keys)
    if after_layout is not None:
        out = after_layout(out)
    out = out.sortWithinPartitions(*keys)
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def _input_bytes(df: DataFrame) -> int:
    jfiles = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(jfiles))


def file_inventory(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """M3: per table: files, MB, average file MB, newest write, compaction flag."""
    out = None
    for name, path in tables.items():
        # the listing only: no content column is selected, so no file is opened
        files = (
            spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(path)
            .select(F.col("length").alias("file_size"), F.col("modificationTime").alias("mtime"))
        )
        arm = files.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("num_files"),
            F.round(F.sum("file_size") / (1024 * 1024), 2).alias("size_mb"),
            F.round(F.avg("file_size") / (1024 * 1024), 2).alias("avg_file_mb"),
            F.max("mtime").alias("last_modified"),
        ).withColumn("needs_compaction", F.col("num_files") > SMALL_FILE_LIMIT)
        out = arm if out is None else out.unionByName(arm)
    return out
