"""Fixed schemas of the checkpoint feed.

Fixed values (must equal the reference's data model for the same results):
the checkpoint JSON carries ``ts``, ``v``, ``id`` (strings) and
``channel_versions`` (map string -> string); the metadata JSON carries
``step`` and ``source`` (strings).  Unknown JSON fields are ignored.
"""

from pyspark.sql.types import MapType, StringType, StructField, StructType

CHECKPOINT_JSON = StructType([
    StructField("ts", StringType(), True),
    StructField("v", StringType(), True),
    StructField("id", StringType(), True),
    StructField("channel_versions", MapType(StringType(), StringType()), True),
])

METADATA_JSON = StructType([
    StructField("step", StringType(), True),
    StructField("source", StringType(), True),
])

# CSV feeds: every cell is read as text and bound by header name.
CHECKPOINT_FEED_COLUMNS = [
    "thread_id", "checkpoint_ns", "checkpoint_id", "parent_checkpoint_id",
    "type", "checkpoint", "metadata",
]
LOOKUP_FEED_COLUMNS = ["thread_id", "user_id", "team"]

RESCUE_COLUMN = "_rescued_data"
INGESTED_AT = "ingested_at"

# SCD2 bookkeeping columns of the history table.
START_AT = "__START_AT"
END_AT = "__END_AT"
