"""SCD2 history maintained by a stream on plain parquet.

There is no MERGE on plain parquet, so the history is kept as deltas.  Each
micro-batch (``foreachBatch``):

1. appends its cleaned change rows to a change log, partitioned by
   ``bucket = pmod(xxhash64(keys), buckets)``, at ``log/_batch=<id>``;
2. finds what its keys' versions become.  A key whose rows all come after its
   last known one needs only its open version, which is closed or confirmed.
   A key with a late row is recomputed from its log with the batch operator
   ``scd2_history``, so late and out-of-order rows land in the right place;
   the log is read only if there are such keys, and only their buckets;
3. writes the versions that are new or changed, and tombstones of those that
   are gone, to ``history/_batch=<id>/bucket=<b>``: as much as the batch
   changes, however long the history is.

A version's identity is its key, sequence, tiebreak and place among equal
ones; the current table is the newest row of every identity, without the
tombstones (``read_history``).  Open versions carry the order of the key's last
row (``_last``), which tells late rows.  Every write replaces only its own
``_batch=<id>`` folder and is computed from the batches before it, so a retried
micro-batch is idempotent; every folder is written under a staging name and
published by one rename, so a reader never lists half of a batch.
``compact_history`` folds all deltas into one snapshot folder and drops them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadlens.functions.schemas import END_AT, START_AT
from threadlens.operators.scd2 import scd2_history
from threadlens.session import batch_ids, path_exists, publish, remove, work_dir

BATCH_COL = "_batch"
BUCKET_COL = "bucket"
#: Columns of the deltas that are no part of the history.
ID, LAST, GONE, NEW = "_id", "_last", "_gone", "_new"


def with_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET_COL, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def apply_changes(changes: DataFrame, batch_id: int, log_dir: str, history_dir: str, *,
                  keys: list[str], sequence_by: str, tiebreak: list[str] | tuple = (),
                  track_columns: list[str] | None = None, buckets: int = 64) -> None:
    """Fold one micro-batch of change rows into the history (steps 1-3)."""
    spark = changes.sparkSession
    order = [sequence_by, *tiebreak]
    batch = with_bucket(changes, keys, buckets)
    _write_batch(batch, log_dir, batch_id)
    # at most `buckets` values reach the driver: they become a partition filter
    touched = batch_ids(spark, f"{log_dir}/{BATCH_COL}={batch_id}", BUCKET_COL)
    if not touched:
        return
    rows = spark.read.parquet(f"{log_dir}/{BATCH_COL}={batch_id}").filter(_complete([*keys, sequence_by]))
    touched_keys = rows.select(*keys).distinct()

    def versions(points: DataFrame) -> DataFrame:
        return scd2_history(points, keys=keys, sequence_by=sequence_by, tiebreak=tiebreak, track_columns=track_columns)

    old = _state(spark, history_dir, batch_id - 1, touched)
    if old is None:
        points = rows
    else:
        # used by several joins below, merged from the deltas once
        old = _kept(old.join(touched_keys, keys, "left_semi"))
        now_open = old.filter(F.col(END_AT).isNull())
        first = rows.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
        late = first.join(now_open.select(*keys, LAST, ID), keys).filter(
            (F.col("_first") <= F.col(LAST)) | (F.col(f"{ID}._n") > 1)).select(*keys)
        any_late = not late.isEmpty()
        points = rows
        if any_late:
            points = points.join(late, keys, "left_anti")
            now_open = now_open.join(late, keys, "left_anti")
        points = points.unionByName(now_open.select(*rows.columns))
        if any_late:
            log = spark.read.parquet(log_dir).filter((F.col(BATCH_COL) <= batch_id) & F.col(BUCKET_COL).isin(touched))
            points = points.unionByName(log.drop(BATCH_COL).join(late, keys, "left_semi"))
            old = now_open.unionByName(old.join(late, keys, "left_semi"))
        else:
            old = now_open
    last = points.filter(_complete([*keys, sequence_by])).groupBy(*keys).agg(F.max(F.struct(*order)).alias(LAST))
    equals = Window.partitionBy(*keys, *order).orderBy(F.xxhash64(*changes.columns))
    new = versions(points).withColumn("_n", F.row_number().over(equals)).join(last, keys).select(
        *rows.columns, START_AT, END_AT, F.struct(*keys, *order, F.col("_n")).alias(ID),
        F.when(F.col(END_AT).isNull(), F.col(LAST)).alias(LAST), F.lit(False).alias(GONE), F.lit(True).alias(NEW))
    if old is not None:
        # one join tells new, changed and vanished versions: the versions are worked out once
        after, before = F.struct(*new.columns).alias("_new_row"), F.struct(*new.drop(GONE, NEW).columns).alias("_old_row")
        pair = new.select(F.col(ID).alias("_new_id"), after).join(
            old.select(F.col(ID).alias("_old_id"), before), F.col("_new_id").eqNullSafe(F.col("_old_id")), "full")
        appears, vanishes = F.col("_old_row").isNull(), F.col("_new_row").isNull()
        same = F.struct(f"_new_row.{END_AT}", f"_new_row.{LAST}").eqNullSafe(F.struct(f"_old_row.{END_AT}", f"_old_row.{LAST}"))
        new = pair.filter(appears | vanishes | ~same).select(
            *[F.when(vanishes, F.col(f"_old_row.`{c}`")).otherwise(F.col(f"_new_row.`{c}`")).alias(c) for c in new.columns if c not in (GONE, NEW)],
            vanishes.alias(GONE), appears.alias(NEW))
    _write_batch(new, history_dir, batch_id)


def _kept(df: DataFrame) -> DataFrame:
    """A table that is computed once and read from the scratch folder."""
    path = work_dir(df.sparkSession, "scd2_state")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _complete(columns: list[str]) -> Column:
    rule = F.lit(True)
    for c in columns:
        rule = rule & F.col(c).isNotNull()
    return rule


def _state(spark: SparkSession, history_dir: str, until: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """The versions after batch ``until``, with their delta columns; None if nothing has been written."""
    ids = batch_ids(spark, history_dir)
    if until is not None:
        ids = [b for b in ids if b <= until]
    if not ids:
        return None
    files = spark.read.parquet(history_dir)
    if until is not None:
        files = files.filter(F.col(BATCH_COL) <= until)
    if buckets is not None:
        files = files.filter(F.col(BUCKET_COL).isin(buckets))
    row = F.struct(*[c for c in files.columns if c not in (BATCH_COL, BUCKET_COL)])
    newest = files.groupBy(BUCKET_COL, ID).agg(F.max_by(row, BATCH_COL).alias("_row"))
    return newest.filter(~F.col(f"_row.{GONE}")).select("_row.*", BUCKET_COL)


def _write_batch(df: DataFrame, table_dir: str, batch_id: int) -> None:
    """Write one batch folder, visible to readers only once complete."""
    staged = f"{table_dir}/_staging_{batch_id}"
    df.write.mode("overwrite").partitionBy(BUCKET_COL).parquet(staged)
    publish(df.sparkSession, staged, f"{table_dir}/{BATCH_COL}={batch_id}")


def read_history(spark: SparkSession, history_dir: str, schema: str | None = None,
                 keep_bucket: bool = False, until: int | None = None) -> DataFrame:
    """The newest state of every version.

    Before any batch has written history, an empty frame of ``schema``.
    ``until`` reads the state after that batch.
    """
    state = _state(spark, history_dir, until)
    if state is None:
        if schema is None:
            raise ValueError(f"no history at {history_dir}")
        return spark.createDataFrame([], schema)
    state = state.drop(ID, LAST, GONE, NEW)
    return state if keep_bucket else state.drop(BUCKET_COL)


def write_owner_changes(changes: DataFrame, batch_id: int, history_dir: str, out_dir: str, *,
                        keys: list[str], track_columns: list[str], end_col: str = END_AT) -> None:
    """Keys whose open version differs before and after a batch, at ``out_dir/_batch=<id>``.

    Both states come from the history's batch folders, so a retried batch
    writes the same rows.
    """
    spark = changes.sparkSession
    touched = changes.select(*keys).distinct()

    def open_versions(until: int, name: str) -> DataFrame:
        state = _state(spark, history_dir, until)
        if state is None:
            return touched.select(*keys, F.lit(None).cast(changes.select(F.struct(*track_columns).alias("s")).schema["s"].dataType).alias(name)).limit(0)
        state = state.filter(F.col(end_col).isNull())
        return state.join(touched, keys, "left_semi").select(*keys, F.struct(*track_columns).alias(name))

    if path_exists(spark, history_dir):
        before, after = open_versions(batch_id - 1, "_before"), open_versions(batch_id, "_after")
        moved = after.join(before, keys, "full").filter(~F.col("_before").eqNullSafe(F.col("_after"))).select(*keys)
    else:  # no valid row so far
        moved = touched.limit(0)
    staged = f"{out_dir}/_staging_{batch_id}"
    moved.write.mode("overwrite").parquet(staged)
    publish(spark, staged, f"{out_dir}/{BATCH_COL}={batch_id}")


def run_scd2_stream(spark: SparkSession, source_dir: str, log_dir: str, history_dir: str,
                    checkpoint: str, prepare=None, max_files_per_trigger: int | None = None,
                    **scd2_args) -> None:
    """Stream a parquet change table into the history until caught up.

    ``prepare(df)`` turns source rows into change rows (e.g. cleaning and
    the thread-id expectation); ``scd2_args`` go to ``apply_changes``.
    """
    schema = spark.read.parquet(source_dir).schema
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(source_dir)

    def fold(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare is not None else batch
        apply_changes(rows, batch_id, log_dir, history_dir, **scd2_args)

    q = (stream.writeStream.foreachBatch(fold)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def compact_history(spark: SparkSession, history_dir: str, snapshot_batch: int) -> None:
    """Write the current state as one new batch folder and drop the deltas before it (between updates)."""
    state = _state(spark, history_dir, snapshot_batch)
    if state is None:
        return
    _write_batch(state, history_dir, snapshot_batch)
    for batch in batch_ids(spark, history_dir):
        if batch < snapshot_batch:
            remove(spark, f"{history_dir}/{BATCH_COL}={batch}")
