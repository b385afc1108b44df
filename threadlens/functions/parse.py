"""Column expressions for the checkpoint payloads.

All conversions are the ``try_`` variants: under ANSI mode a plain cast of a
bad value fails the whole job, while the pipeline's contract is that such a
row is dropped by the ``checkpoint_ts IS NOT NULL`` expectation (SURVEY D2).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.schemas import CHECKPOINT_JSON, METADATA_JSON


def parse_checkpoint(col: str | Column = "checkpoint") -> Column:
    """checkpoint JSON text -> struct<ts, v, id, channel_versions>."""
    return F.from_json(_c(col), CHECKPOINT_JSON)


def parse_metadata(col: str | Column = "metadata") -> Column:
    """metadata JSON text -> struct<step, source>."""
    return F.from_json(_c(col), METADATA_JSON)


def to_ts(col: str | Column) -> Column:
    """Text -> timestamp; unparsable text gives NULL instead of an error."""
    return F.try_to_timestamp(_c(col))


def to_int(col: str | Column) -> Column:
    """Text -> int; non-numeric text gives NULL."""
    return _c(col).try_cast("int")


def map_value(col: str | Column, key: str) -> Column:
    """Map lookup; an absent key gives NULL."""
    return F.try_element_at(_c(col), F.lit(key))


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col
