"""The medallion layers as lazily built DataFrames.

``Layers`` wires the operators the way the pipeline does: bronze feeds ->
SCD2 ownership history -> enriched silver (current owner) -> gold.  Built
from the driver's test tables through the adapters, or from given bronze and
cleaned lookup DataFrames.  Every attribute is a logical plan that Catalyst
optimises together with the consumer's query; the only job run while
building is the SCD2 hot-key count (see ``scd2.with_chunks``).
"""

from __future__ import annotations

import weakref
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.operators import metrics, scd2
from threadlens.operators.enrich import enrich_checkpoints, parse_checkpoints
from threadlens.operators.expectations import Rule, apply_rules
from threadlens.session import ensure_defaults
from threadlens.sources import adapters

LOOKUP_RULES = [Rule("thread_id_not_null", "thread_id IS NOT NULL")]
SILVER_RULES = [Rule("checkpoint_ts_not_null", "checkpoint_ts IS NOT NULL")]
TRACKED = ["user_id", "team"]
_SHARED: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str | None = None, *,
                 bronze: DataFrame | None = None, lookup: DataFrame | None = None,
                 split_hot_keys: bool = True, hot_key_rows: int | None = None):
        ensure_defaults(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self._bronze = bronze
        self._lookup = lookup
        self.split_hot_keys = split_hot_keys
        self.hot_key_rows = hot_key_rows
        self._tables: dict[str, DataFrame] = {}

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Layers":
        """One Layers per (session, folder): queries reuse the logical plans
        (like temp views defined once).  Nothing is cached but plans; every
        execution reads the files again."""
        reg = _SHARED.setdefault(spark, {})
        if sf_dir not in reg:
            reg[sf_dir] = cls(spark, sf_dir)
        return reg[sf_dir]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = adapters.table(self.spark, self.sf_dir, name)
        return self._tables[name]

    @cached_property
    def bronze(self) -> DataFrame:
        """bronze_checkpoints"""
        if self._bronze is not None:
            return self._bronze
        return adapters.checkpoint_feed(self.table("events"))

    @cached_property
    def lookup_feed(self) -> DataFrame:
        """thread_lookup_cleaned after its expectation (Q1)."""
        feed = self._lookup if self._lookup is not None else adapters.lookup_feed(self.table("events"))
        return apply_rules(feed, LOOKUP_RULES, "drop")

    @property
    def lookup_tiebreak(self) -> list[str]:
        return ["event_id"] if "event_id" in self.lookup_feed.columns else []

    def _history(self, track):
        return scd2.scd2_history(
            self.lookup_feed, keys=["thread_id"], sequence_by="updated_at",
            tiebreak=self.lookup_tiebreak, track_columns=track,
            split_hot_keys=self.split_hot_keys,
            **({"hot_key_rows": self.hot_key_rows} if self.hot_key_rows else {}),
        )

    @cached_property
    def history_all(self) -> DataFrame:
        """Every delivery opens a version."""
        return self._history(None)

    @cached_property
    def history(self) -> DataFrame:
        """silver_thread_lookup_history: C2, unchanged re-deliveries collapsed."""
        return self._history(TRACKED)

    @cached_property
    def current_owner(self) -> DataFrame:
        return scd2.current(self.history).select("thread_id", "user_id", "team")

    @cached_property
    def silver_unchecked(self) -> DataFrame:
        return enrich_checkpoints(self.bronze, self.current_owner)

    @cached_property
    def silver(self) -> DataFrame:
        """silver_checkpoints (Q2 applied)."""
        return apply_rules(self.silver_unchecked, SILVER_RULES, "drop")

    @cached_property
    def gold_user(self) -> DataFrame:
        return metrics.gold_user_team_metrics(self.silver)

    @cached_property
    def gold_team(self) -> DataFrame:
        return metrics.gold_team_summary(self.silver)

    def newest_date(self) -> "F.Column":
        """Newest checkpoint date, as a scalar subquery (no driver round trip).

        Silver keeps every parsed bronze row with a timestamp (the owner join
        is a left join), so the newest date needs only the parse, not the
        history or the join.
        """
        return parse_checkpoints(self.bronze).agg(F.max("checkpoint_date")).scalar()
