"""Places of rows within groups by a distributed sort, however large a group is."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.shared import ship, written


def ranked(rows: DataFrame, group: str, order: list, name: str, out: str = "pos") -> DataFrame:
    """``rows``, written to the shared folder, with their place from 0 in the ``order`` within their ``group``.

    ``group`` is a string column without nulls.  Rows are range-sorted by
    group and order (and a salt, so that equal rows are spread as well); a
    row's place is its place in its sorted partition plus the group's rows in
    the partitions before.  Only groups that begin a partition go on from one
    before: their counts, at most two rows a partition, are broadcast.
    """
    ship(rows.sparkSession)
    keys = [F.col(group), *order, F.col("_salt")]
    ranged = rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_salt")
    ranged = ranged.withColumn("_part", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("_at", T.LongType()), T.StructField("_head", T.BooleanType())])
    at = ranged.columns.index(group)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ran, head = None, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            key = batch.column(at)
            new = np.ones(n, bool)
            new[1:] = np.asarray(pc.not_equal(key.slice(1), key.slice(0, n - 1)))
            new[0] = key[0].as_py() != last
            index = np.arange(n)
            start = np.maximum.accumulate(np.where(new, index, -1))
            place = np.where(start < 0, index + ran, index - start)
            last, ran = key[n - 1].as_py(), int(place[-1]) + 1
            first = np.zeros(n, bool)
            first[0], head = head, False
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64()), pa.array(first)], names=schema.names)

    placed = written(ranged.mapInArrow(place, schema), name)
    heads = placed.where("_head").select(F.col(group).alias("_key")).distinct()
    counts = placed.select(F.col(group).alias("_key"), "_part", "_at").join(F.broadcast(heads), "_key").groupBy("_key", "_part").agg((F.max("_at") + 1).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("_key", "_part", F.sum("_n").over(before).alias("_base")).where("_base IS NOT NULL").withColumnRenamed("_part", "_of")
    joined = placed.join(F.broadcast(base), (F.col(group) == F.col("_key")) & (F.col("_part") == F.col("_of")), "left")
    return joined.select(*rows.columns, (F.col("_at") + F.coalesce("_base", F.lit(0))).alias(out))
