"""Slowly changing dimension, type 2.

``scd2_history`` turns a change feed (one row per delivered state of a key)
into versions with ``__START_AT`` / ``__END_AT``:

* every row opens a version (``track_columns=None``, C1), or
* consecutive rows with null-safe equal tracked columns are collapsed into
  one version (``track_columns=[...]``, C2);
* ``__END_AT`` is the sequence value of the next version of the key, NULL for
  the current one.  Rows with a NULL key or NULL sequence are not versions.

Order within a key is (sequence_by, *tiebreak); give a tiebreak that makes it
total, otherwise equal sequence values are ordered arbitrarily.

Skew.  A plain ``lead() OVER (PARTITION BY key)`` sends every row of a key to
one task, so a key holding a third of the feed becomes a third of the job in
one task.  Here an exact per-key count (a partial aggregate, whatever the size of
the feed) marks keys with more than ``hot_key_rows`` rows as hot.  Their rows
are cut by range on the total order (key, sequence, tiebreak, hash of the row)
into as many partitions as their number needs, each is sorted, and every
``hot_key_rows`` consecutive rows are a chunk: neither equal sequence values nor
outliers make a large chunk, and small chunks cost no tasks or files of their
own.  Where most rows are of hot keys, the others are cut and written along,
each key of theirs one chunk.  The cut rows are written to the shared scratch
folder, so that every consumer and every retry sees the same chunks.  Windows
run per (key, chunk).  The neighbour of a chunk's first/last row lives in the
previous/next chunk of its key; it comes from a table with one row per hot
chunk, joined back on (key, chunk).  All other keys take one shuffle.

``split_hot_keys=False`` leaves out the count, for feeds whose keys are known
to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.functions.schemas import END_AT, START_AT
from threadlens.session import work_dir

_CHUNK = "_scd_chunk"
DEFAULT_HOT_KEY_ROWS = 1_000_000
#: Rows that a task cuts at least, however small the chunks.
TASK_ROWS = 250_000


def hot_keys(valid: DataFrame, keys: list[str], hot_key_rows: int) -> DataFrame:
    """Keys with more than ``hot_key_rows`` rows, with their counts ``_n``."""
    return valid.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_key_rows)


def with_chunks(valid: DataFrame, keys: list[str], order: list[str], hot_key_rows: int) -> DataFrame | None:
    """The feed with ``_scd_chunk`` (rising with the order; -1 for ordinary keys) and ``_hot``; None without hot keys."""
    hot = hot_keys(valid, keys, 0).withColumn("_hot", F.col("_n") > hot_key_rows)
    total, rows = hot.agg(F.sum("_n"), F.sum(F.when(F.col("_hot"), F.col("_n")))).first()
    if not rows:
        return None
    hot = hot.filter("_hot").select(*keys, "_hot")
    # with few ordinary rows all are cut: no further pass over the feed for them
    every = 2 * rows > total
    ranks = [*keys, *order, "_row_hash"]
    # half as many parts again as rows need: the range bounds come from a sample
    parts = -(-3 * (total if every else rows) // (2 * max(hot_key_rows, TASK_ROWS)))
    cut = (
        valid.join(hot, keys, "left" if every else "inner").select(*valid.columns, F.coalesce("_hot", F.lit(False)).alias("_hot"))
        .withColumn("_row_hash", F.xxhash64(*valid.columns))
        .repartitionByRange(parts, *ranks).sortWithinPartitions(*ranks)
        .withColumn(_CHUNK, F.expr(f"if(_hot, monotonically_increasing_id() div {hot_key_rows}, -1L)")).drop("_row_hash")
    )
    path = work_dir(valid.sparkSession, "scd2_hot")
    cut.write.parquet(path)
    cut_rows = valid.sparkSession.read.schema(cut.schema).parquet(path)
    if every:
        return cut_rows
    cold = valid.join(hot, keys, "left_anti").select(*valid.columns, F.lit(False).alias("_hot"), F.lit(-1).cast("long").alias(_CHUNK))
    return cold.unionByName(cut_rows)


def scd2_history(
    changes: DataFrame,
    keys: list[str],
    sequence_by: str,
    tiebreak: list[str] | tuple = (),
    track_columns: list[str] | None = None,
    split_hot_keys: bool = True,
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    start_col: str = START_AT,
    end_col: str = END_AT,
) -> DataFrame:
    keys = list(keys)
    order = [sequence_by, *tiebreak]
    valid_rule = F.col(sequence_by).isNotNull()
    for k in keys:
        valid_rule = valid_rule & F.col(k).isNotNull()
    valid = changes.filter(valid_rule)
    out_cols = list(changes.columns)

    chunked = with_chunks(valid, keys, order, hot_key_rows) if split_hot_keys else None
    if chunked is None:
        return _history_by_key(valid, keys, order, track_columns, out_cols, start_col, end_col)

    part = keys + [_CHUNK]
    w = Window.partitionBy(*part).orderBy(*order)
    by_chunk = Window.partitionBy(*keys).orderBy(_CHUNK)  # over one row per hot chunk

    if track_columns is None:
        versions = chunked
    else:
        tracked = F.struct(*[F.col(c) for c in track_columns])
        tails = (
            chunked.filter("_hot").groupBy(*part)
            .agg(F.max(F.struct(*[F.col(c) for c in order], tracked.alias("_t"))).alias("_last"))
            .select(*part, F.lag("_last").over(by_chunk).alias("_prev_tail"))
        )
        with_prev = chunked.withColumn("_prev", F.lag(tracked).over(w)).join(tails, part, "left")
        prev = F.coalesce(F.col("_prev"), F.col("_prev_tail._t"))
        versions = (
            with_prev.withColumn("_p", prev)
            .filter(F.col("_p").isNull() | ~tracked.eqNullSafe(F.col("_p")))
            .drop("_prev", "_prev_tail", "_p")
        )

    heads = (
        versions.filter("_hot").groupBy(*part)
        .agg(F.min(F.struct(*[F.col(c) for c in order])).alias("_first"))
        .select(*part, F.lead("_first").over(by_chunk).alias("_next_head"))
    )
    with_next = versions.withColumn("_next", F.lead(sequence_by).over(w)).join(heads, part, "left")
    end = F.coalesce(F.col("_next"), F.col(f"_next_head.{sequence_by}"))
    return with_next.select(*out_cols, F.col(sequence_by).alias(start_col), end.alias(end_col))


def _history_by_key(valid, keys, order, track_columns, out_cols, start_col, end_col):
    """One window per key: one shuffle, for feeds whose keys are known small."""
    w = Window.partitionBy(*keys).orderBy(*order)
    versions = valid
    if track_columns is not None:
        tracked = F.struct(*[F.col(c) for c in track_columns])
        prev = F.lag(tracked).over(w)
        versions = (
            valid.withColumn("_p", prev)
            .filter(F.col("_p").isNull() | ~tracked.eqNullSafe(F.col("_p")))
            .drop("_p")
        )
    return versions.select(
        *out_cols,
        F.col(order[0]).alias(start_col),
        F.lead(order[0]).over(w).alias(end_col),
    )


def current(history: DataFrame, end_col: str = END_AT) -> DataFrame:
    """The open version of every key."""
    return history.filter(F.col(end_col).isNull())


def as_of(history: DataFrame, instant, start_col: str = START_AT, end_col: str = END_AT) -> DataFrame:
    """The version valid at ``instant`` (start <= t < end, open end)."""
    t = instant if isinstance(instant, Column) else F.lit(instant)
    return history.filter(
        (F.col(start_col) <= t) & (F.col(end_col).isNull() | (t < F.col(end_col)))
    )


def asof_join(
    facts: DataFrame,
    history: DataFrame,
    keys: list[str],
    at: str,
    columns: list[str],
    hot_key_rows: int = DEFAULT_HOT_KEY_ROWS,
    split_hot_keys: bool = True,
    start_col: str = START_AT,
    end_col: str = END_AT,
) -> DataFrame:
    """J5/C5 for a table of instants: every fact with the ``columns`` of the version valid at its own time ``at``.

    Facts and versions of a key are put in one order (time, versions before
    facts), where a fact's version is the last one before it; that is one
    window, linear in the rows, however many versions a key has.  No interval
    is compared with another, and no row is emitted twice.  Keys with more
    than ``hot_key_rows`` facts and versions are cut by range, as in
    ``scd2_history``: a chunk takes the version that is open where it begins
    from a table with one row per hot chunk.  Facts and versions are worked out
    once and written to the shared scratch folder, as they are read several
    times; ``split_hot_keys=False`` leaves that out.

    Facts before the first version, after a closed last one, or with a NULL
    key or time come back with NULLs.  ``history`` is what ``scd2_history``
    gives: the versions of a key don't overlap, and those without a duration
    are never valid.
    """
    def complete(time: str) -> Column:
        rule = F.col(time).isNotNull()
        for k in keys:
            rule = rule & F.col(k).isNotNull()
        return rule

    version = F.struct(F.col(start_col).alias("start"), F.col(end_col).alias("end"), F.struct(*columns).alias("value"))
    fact = F.struct(*[F.col(c) for c in facts.columns])
    moment = facts.schema[at].dataType
    versions = history.filter(complete(start_col)).select(
        *keys, F.col(start_col).cast(moment).alias("_at"), F.lit(0).alias("_kind"), F.col(end_col).isNull().alias("_open"),
        F.col(end_col).cast(moment).alias("_until"), F.lit(None).cast(facts.select(fact.alias("f")).schema["f"].dataType).alias("_fact"), version.alias("_version"))
    kind = versions.schema["_version"].dataType
    dated = facts.select(
        *keys, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast("boolean").alias("_open"),
        F.lit(None).cast(moment).alias("_until"), fact.alias("_fact"), F.lit(None).cast(kind).alias("_version"))
    order = ["_at", "_kind", "_open", "_until"]
    every = versions.unionByName(dated)
    if split_hot_keys:
        # worked out once: the count, the cut and the join read it back
        path = work_dir(facts.sparkSession, "scd2_asof")
        every.write.parquet(path)
        every = facts.sparkSession.read.schema(every.schema).parquet(path)
    both = every.filter((F.col("_kind") == 0) | complete("_at"))
    chunked = with_chunks(both, keys, order, hot_key_rows) if split_hot_keys else None
    if chunked is None:
        so_far = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        found = both.withColumn("_found", F.last("_version", ignorenulls=True).over(so_far))
    else:
        part = [*keys, _CHUNK]
        so_far = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)  # one row per hot chunk
        ranks = F.struct(*order)
        tails = chunked.filter("_hot").groupBy(*part).agg(F.max_by("_version", F.when(F.col("_kind") == 0, ranks)).alias("_tail")).select(
            *part, F.last("_tail", ignorenulls=True).over(earlier).alias("_before"))
        found = chunked.withColumn("_own", F.last("_version", ignorenulls=True).over(so_far)).join(tails, part, "left").withColumn(
            "_found", F.coalesce("_own", "_before"))
    valid = F.col("_found.end").isNull() | (F.col("_at") < F.col("_found.end").cast(moment))
    value = F.when(valid, F.col("_found.value"))
    out = found.filter("_kind = 1").select("_fact.*", *[value[c].alias(c) for c in columns])
    rest = every.filter((F.col("_kind") == 1) & ~complete("_at")).select("_fact.*", *[F.lit(None).cast(history.schema[c].dataType).alias(c) for c in columns])
    return out.unionByName(rest)


def key_history(history: DataFrame, keys: DataFrame, start_col: str = START_AT) -> DataFrame:
    """C4: all versions of the given keys (a DataFrame of key rows), in order.

    Restricting by a DataFrame keeps this a semi-join instead of a literal list
    collected on the driver.
    """
    return history.join(keys, on=keys.columns, how="left_semi").orderBy(
        *keys.columns, start_col
    )


def duplicate_current_versions(history: DataFrame, keys: list[str], end_col: str = END_AT) -> DataFrame:
    """Keys with more than one open version (should be empty)."""
    return (
        current(history, end_col)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("open_versions"))
        .filter(F.col("open_versions") > 1)
    )
