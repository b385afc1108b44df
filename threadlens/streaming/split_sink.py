"""Kept and quarantined rows of a batch from one pass, published together (Q6).

Rows are judged once and staged in one write, partitioned by verdict.  The
violations are observed during that write; with the action ``fail`` a
violation drops the staged folder and raises, so nothing of the batch becomes
visible.  Otherwise both parts are published under the batch's id: first the
quarantined rows, then the kept ones, so that a batch that can be read has its
quarantine beside it.  A repeated batch replaces both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlens.operators.expectations import ExpectationFailed, Rule, observe_rules
from threadlens.session import path_exists, publish, remove

VERDICT, BROKEN, BATCH_COL = "_verdict", "_broken", "_batch"
ACTIONS = ("drop", "quarantine", "fail")


def judged(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``df`` with the names of the rules a row breaks (NULL counts as broken) and its verdict, kept or quarantined."""
    names = F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]).cast("array<string>")
    out = df.withColumn(BROKEN, F.filter(names, lambda n: n.isNotNull()))
    return out.withColumn(VERDICT, F.when(F.size(BROKEN) == 0, F.lit("kept")).otherwise(F.lit("quarantined")))


def write_split(df: DataFrame, rules: list[Rule], batch_id: int, kept_dir: str, quarantine_dir: str, *,
                action: str = "quarantine", partition_by: str | None = None) -> dict:
    """Write one batch to ``kept_dir/_batch=<id>`` and ``quarantine_dir/_batch=<id>``; returns the observed counts.

    With ``drop`` the violating rows are not written.  A batch without kept
    rows still has its folder in ``kept_dir``.
    """
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}; expected one of {ACTIONS}")
    spark = df.sparkSession
    observed, seen = observe_rules(df, rules, f"split_{batch_id}")
    rows = judged(observed, rules)
    if action == "drop":
        rows = rows.filter(F.col(VERDICT) == "kept")
    staged = f"{kept_dir.rstrip('/')}/_staging_split_{batch_id}"
    parts = [partition_by] if partition_by else []
    rows.write.mode("overwrite").partitionBy(VERDICT, *parts).parquet(staged)
    counts = seen.get
    bad = {r.name: counts[r.name] for r in rules if counts.get(r.name)}
    if action == "fail" and bad:
        remove(spark, staged)
        raise ExpectationFailed(f"expectations violated in batch {batch_id}: {bad}")
    kept = f"{staged}/{VERDICT}=kept"
    if not path_exists(spark, kept):
        rows.drop(VERDICT).limit(0).write.partitionBy(*parts).parquet(kept)
    for part, target in ((f"{staged}/{VERDICT}=quarantined", quarantine_dir), (kept, kept_dir)):
        final = f"{target.rstrip('/')}/{BATCH_COL}={batch_id}"
        if path_exists(spark, part):
            publish(spark, part, final)
        elif path_exists(spark, final):
            remove(spark, final)  # a repeated batch that has no such rows any more
    remove(spark, staged)
    return counts
