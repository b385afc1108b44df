"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a 36-bit key from the hash of its id.  A source's budget
is a threshold on that key: documents below it are taken.  The threshold is
found from sums of words by (source, 12 key bits); only the bucket that the
budget falls into is looked at again with the next 12 bits, and once more with
the last 12.  Nothing is sorted, and a smaller budget takes a subset of what a
larger one takes.  All work is DataFrame expressions; the largest shuffle has
one row per task, source and bucket.

A budget above a source's size takes whole copies first and the threshold
decides who gets one more copy.

Defined cases: a null source is a source of its own, ordered last; a null text
or one without words has size 0 and is never taken; rows of equal doc_id
(repeated rows) are taken alike; rows with a null doc_id are told apart by
their text; an empty table gives an empty result; a source without words gets
target 0.  Columns of the input that bear an output name are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadlens.llm.shared import written

#: Key bits per round of refinement, and rounds.
BITS, ROUNDS = 12, 3
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix per word of the input, and the most copies of a source.
RATIO, MOST = 1.5, 2
#: Source tables of up to this many rows are broadcast (each row is some 60 bytes and the name).
BROADCAST_SOURCES = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mixing_key(doc_id: Column, text: Column) -> Column:
    """36 hash bits of a document."""
    own = F.when(doc_id.isNull(), F.concat(F.lit("null "), F.coalesce(F.md5(text.cast("binary")), F.lit("")))).otherwise(doc_id.cast("string"))
    return F.conv(F.substring(F.md5(own.cast("binary")), 1, BITS * ROUNDS // 4), 16, 10).cast("long")


def source_targets(masses: DataFrame, ratio: float = RATIO, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) -> with target: ``ratio`` of all words by weight, at most ``most`` times a source's size.

    Capping and resharing until none is above ends at min(cap, level * weight)
    for one level: with sources by cap / weight, the first k are capped.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last())
    upto = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    choice = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(in_order) - 1) % len(weights) + 1).cast("int"))
    ranked = masses.withColumn("w", choice)
    levels = ranked.select(
        "*",
        F.sum("source_size").over(whole).alias("all_size"),
        (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(upto), F.lit(0))).alias("open_w"),
        (F.coalesce(F.sum("source_size").over(upto), F.lit(0)) * most).alias("full"),
    ).withColumn("level", (F.lit(ratio) * F.col("all_size").cast("double") - F.col("full").cast("double")) / F.col("open_w").cast("double"))
    held = levels.withColumn("fits", F.col("level") * F.col("w") <= F.col("source_size").cast("double") * most)
    fixed = held.withColumn("level", F.min(F.when(F.col("fits"), F.struct("full", "level"))).over(whole)["level"])
    cap = F.col("source_size").cast("double") * most
    return fixed.select("source", "source_size", F.least(cap, F.coalesce(F.col("level") * F.col("w"), cap)).alias("target"))


def thresholds(mass: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, size, key) rows and targets -> targets with ``copies`` (whole ones) and ``below``: keys under it get one more."""
    ratio = F.col("target") / F.col("source_size")
    plan = targets.select(
        "*",
        F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(F.lit(0)).cast("long").alias("copies"),
        F.lit(0).cast("long").alias("cell"), F.lit(0.0).alias("base"), F.lit(0).cast("long").alias("inside"),
    ).withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    for turn in range(ROUNDS):
        shift = BITS * (ROUNDS - 1 - turn)
        rows = mass.withColumn("low", F.shiftright("key", shift))
        if turn:
            edge = plan.select(F.col("source").alias("s"), F.col("cell").alias("c"))
            rows = rows.join(F.broadcast(edge) if plan_is_small(plan) else edge,
                             F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("low", BITS) == F.col("c"))).drop("s", "c")
        sums = rows.groupBy("source", "low").agg(F.sum("size").alias("in_cell"))
        sums = sums.withColumnRenamed("source", "s").join(plan.select("source", "base", "rest"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        upto = Window.partitionBy("source").orderBy("low")
        ends = sums.withColumn("to", F.col("base") + F.sum("in_cell").over(upto))
        hit = ends.where(F.col("to") > F.col("rest")).groupBy("source").agg(F.min(F.struct("low", "to", "in_cell")).alias("x"))
        found = hit.select(F.col("source").alias("s"), F.col("x.low").alias("cell"), (F.col("x.to") - F.col("x.in_cell")).alias("base"), F.col("x.in_cell").alias("inside"))
        plan = plan.drop("cell", "base", "inside").join(found, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        plan = written(plan.fillna({"cell": 0, "base": 0.0, "inside": 0}), "mix-plan")
    nearer = F.col("base") + F.col("inside") - F.col("rest") < F.col("rest") - F.col("base")
    return plan.select("source", "source_size", "target", "copies", (F.col("cell") + nearer.cast("long")).alias("below"))


def plan_is_small(plan: DataFrame) -> bool:
    """Whether the table of sources has at most BROADCAST_SOURCES rows."""
    return plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES


def mix(docs: DataFrame, masses: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of every row."""
    added = ["size", "source_size", "target", "copies", "taken"]
    sized = docs.drop(*added).select("*", word_count(F.col("text")).alias("size"), mixing_key(F.col("doc_id"), F.col("text")).alias("_key"))
    mass = masses if masses is not None else written(sized.select("source", "size", F.col("_key").alias("key")), "mix-mass")
    sources = mass.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = thresholds(mass, source_targets(sources)).withColumnRenamed("source", "_s")
    plan = F.broadcast(plan) if plan_is_small(plan) else plan
    out = sized.join(plan, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    out = out.withColumn("copies", F.when(F.col("size") > 0, F.col("copies") + (F.col("_key") < F.col("below")).cast("long")).otherwise(F.lit(0)).cast("long"))
    return out.withColumn("taken", F.col("size") * F.col("copies")).drop("_key", "below")


def repeat_taken(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    columns = docs.columns
    mixed = mix(docs.select("*", F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row")))
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")


def op5_source_mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    narrow = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mixing_key(F.col("doc_id"), F.col("text")).alias("key")), "mix-mass")
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = thresholds(narrow, source_targets(sources)).withColumnRenamed("source", "s")
    plan = F.broadcast(plan) if plan_is_small(plan) else plan
    copies = F.col("copies") + (F.col("key") < F.col("below")).cast("long")
    return narrow.join(plan, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(CASE WHEN doc_id IS NULL THEN 'null ' || coalesce(md5(text), '') ELSE doc_id::VARCHAR END), 1, 9))::BIGINT AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
l AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
        - (2 * coalesce(sum(source_size) OVER f, 0))::DOUBLE) / (sum(w) OVER () - coalesce(sum(w) OVER f, 0))::DOUBLE AS level,
        coalesce(sum(source_size) OVER f, 0) AS full_
      FROM w WINDOW f AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
x AS (SELECT arg_min(level, full_) AS level FROM l WHERE level * w <= 2 * source_size::DOUBLE),
t AS (SELECT source, source_size, least(2 * source_size::DOUBLE, coalesce(x.level * w, 2 * source_size::DOUBLE)) AS target FROM l, x),
c AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies,
        target - (CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END) * source_size AS rest FROM t),
k AS (SELECT source, k, sum(size)::DOUBLE AS inside FROM d GROUP BY source, k),
r AS (SELECT *, sum(inside) OVER (PARTITION BY source ORDER BY k) AS upto FROM k),
p AS (SELECT r.source, r.k, r.upto <= c.rest OR (r.upto - r.inside <= c.rest AND r.upto - c.rest < c.rest - (r.upto - r.inside)) AS more
      FROM r JOIN c ON r.source IS NOT DISTINCT FROM c.source)
SELECT d.doc_id, d.size, c.source_size, c.target, d.size * (c.copies + p.more::BIGINT) AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.k = p.k
"""
