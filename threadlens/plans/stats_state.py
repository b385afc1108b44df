"""Column statistics of a batched table from stored, mergeable partials (M2).

Every batch folder of the table leaves one row: the number of its rows and, per
column, its NULLs, least and greatest value (in the column's own type) and an
HLL sketch of its values.  Rows and NULLs add up, extremes combine, sketches
unite, so ``refresh_stats`` reads the batches without a partial and
``column_stats`` one row a batch.

Rows, NULLs and extremes equal a full pass.  The number of distinct values has
a relative standard error of about 0.8 % (``LG_K`` = 14); ``NDV_ERROR`` is the
promised bound.  NULLs are not values; a column that is NULL throughout has 0.
A batch that is delivered again replaces its partial if it is folded again
(``refresh_stats(..., again=[ids])``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.plans.batch_state import BATCH_COL, missing_batches, read_batches, write_batch

LG_K = 14
NDV_ERROR = 0.04


def partial(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the partial statistics of ``columns`` over ``rows``."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}"), F.min(c).alias(f"lo_{i}"), F.max(c).alias(f"hi_{i}"),
                 F.hll_sketch_agg(F.col(c).cast("string"), LG_K).alias(f"ndv_{i}")]
    return rows.agg(*aggs)


def _schema(rows: DataFrame, columns: list[str]) -> str:
    types = [rows.schema[c].dataType.simpleString() for c in columns]
    return "n long, " + ", ".join(f"nulls_{i} long, lo_{i} {t}, hi_{i} {t}, ndv_{i} binary" for i, t in enumerate(types))


def refresh_stats(spark: SparkSession, table_dir: str, state_dir: str, columns: list[str], again: list[int] = ()) -> list[int]:
    """Fold the batches of ``table_dir`` that have no partial yet (and those of ``again``); returns their ids."""
    todo = sorted({*missing_batches(spark, table_dir, state_dir), *again})
    for batch in todo:
        rows = spark.read.parquet(f"{table_dir.rstrip('/')}/{BATCH_COL}={batch}")
        write_batch(partial(rows, columns), state_dir, batch)
    return todo


def column_stats(spark: SparkSession, state_dir: str, table: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column from the partials; ``table`` gives the types and is not read."""
    aggs = [F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")]
    for i in range(len(columns)):
        aggs += [F.coalesce(F.sum(f"nulls_{i}"), F.lit(0)).alias(f"nulls_{i}"),
                 F.min(f"lo_{i}").cast("string").alias(f"lo_{i}"), F.max(f"hi_{i}").cast("string").alias(f"hi_{i}"),
                 F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"ndv_{i}")), F.lit(0)).alias(f"ndv_{i}")]
    wide = read_batches(spark, state_dir, _schema(table, columns)).agg(*aggs)
    parts = ", ".join(f"'{c}', nulls_{i}, lo_{i}, hi_{i}, ndv_{i}" for i, c in enumerate(columns))
    return wide.selectExpr(
        "row_count", f"stack({len(columns)}, {parts}) AS (column_name, null_count, min_value, max_value, approx_distinct)",
    ).select("column_name", "row_count", "null_count", "min_value", "max_value", "approx_distinct")


def with_exact_distinct(stats: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """``stats`` beside the exact number of distinct values, and whether the estimate keeps its bound.

    (column, value) pairs are made distinct in one shuffle; a hot column is spread over its values.
    """
    pairs = table.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("p")).select("p.*")
    exact = pairs.filter("v IS NOT NULL").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))
    out = stats.join(exact, "column_name", "left").withColumn("distinct_count", F.coalesce("distinct_count", F.lit(0)))
    within = F.abs(F.col("approx_distinct") - F.col("distinct_count")) <= F.lit(NDV_ERROR) * F.col("distinct_count")
    return out.withColumn("within", within).drop("approx_distinct")
