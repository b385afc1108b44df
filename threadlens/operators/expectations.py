"""Row-level expectations (Q1-Q7).

A rule is a SQL boolean expression.  A rule that evaluates to NULL counts as
violated, so ``kept + quarantined == input`` always holds.  Actions:

* ``warn``       keep every row; violations are counted (``observe``)
* ``drop``       keep passing rows
* ``quarantine`` keep only the violating rows (to write them aside)
* ``fail``       raise before anything is written if any row violates

Counting is one global aggregate with one ``count_if`` per rule (a single
pass, map-side partial aggregation); nothing is collected but one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "quarantine", "fail")


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


class ExpectationFailed(Exception):
    pass


def all_pass(rules: list[Rule]) -> Column:
    cond = F.lit(True)
    for r in rules:
        cond = cond & r.passes()
    return cond


def apply_rules(df: DataFrame, rules: list[Rule], action: str = "drop",
                observation: Observation | None = None) -> DataFrame:
    """``df`` under one of ACTIONS; with ``warn``, ``observation.get`` has the counts once ``df`` was executed."""
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}; expected one of {ACTIONS}")
    if not rules:
        return df if action != "quarantine" else df.limit(0)
    if action == "drop":
        return df.filter(all_pass(rules))
    if action == "quarantine":
        return df.filter(~all_pass(rules))
    if action == "fail":
        failed = violation_counts(df, rules).first()
        bad = {r.name: failed[r.name] for r in rules if failed[r.name]}
        if bad:
            raise ExpectationFailed(f"expectations violated: {bad}")
        return df
    return observe_rules(df, rules, observation=observation)[0]


def observe_rules(df: DataFrame, rules: list[Rule], name: str = "expectations", observation: Observation | None = None):
    """Attach violation counters that fill in when ``df`` is executed.

    Works for batch and for streaming DataFrames (there the counters are
    reported per micro-batch in the query progress).
    """
    obs = observation or Observation(name)
    metrics = [F.count(F.lit(1)).alias("total")] + [
        F.count_if(~r.passes()).alias(r.name) for r in rules
    ]
    return df.observe(obs, *metrics), obs


def violation_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row: total rows and the violation count of every rule."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(~r.passes()).alias(r.name) for r in rules],
    )


def expectation_report(df: DataFrame, rules: list[Rule], dataset: str) -> DataFrame:
    """One row per rule: dataset, rule, condition, total, failed, passed, failed_pct."""
    wide = violation_counts(df, rules)
    stack_args = ", ".join(
        f"'{r.name}', '{_sql_text(r.condition)}', `{r.name}`" for r in rules
    )
    long = wide.selectExpr(
        "total",
        f"stack({len(rules)}, {stack_args}) AS (rule, condition, failed)",
    )
    return long.select(
        F.lit(dataset).alias("dataset"),
        "rule",
        "condition",
        F.col("total").cast("bigint").alias("total"),
        F.col("failed").cast("bigint").alias("failed"),
        (F.col("total") - F.col("failed")).cast("bigint").alias("passed"),
        F.when(F.col("total") > 0,
               F.round(F.col("failed") * 100.0 / F.col("total"), 2))
        .cast("double").alias("failed_pct"),
    )


def rescued_rows(bronze: DataFrame, rescue_col: str = "_rescued_data") -> DataFrame:
    """Q7: number of rows whose unknown or mismatched cells were rescued."""
    return bronze.agg(F.count_if(F.col(rescue_col).isNotNull()).alias("rescued_row_count"))


def _sql_text(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")
