"""The data contract: collections, table columns and thresholds."""

from pyspark.sql import types as T

# Record collections carried by the event stream
POST = "app.bsky.feed.post"
LIKE = "app.bsky.feed.like"
REPOST = "app.bsky.feed.repost"
FOLLOW = "app.bsky.graph.follow"
COLLECTIONS = (POST, LIKE, REPOST, FOLLOW)

# Rich-text feature kinds, and embed kinds counted as quotes
FACET_TAG = "app.bsky.richtext.facet#tag"
FACET_MENTION = "app.bsky.richtext.facet#mention"
QUOTE_EMBEDS = ("app.bsky.embed.record", "app.bsky.embed.recordWithMedia")

# Fixed value: an AT URI naming one record
AT_URI_PATTERN = "^at://did:[a-z]+:[^/]+/[^/]+/[^/]+$"

TYPES = {
    "binary": T.BinaryType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
}


def schema(**columns: str) -> T.StructType:
    """A schema from column names and type names, without needing a session."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in columns.items()])


BRONZE_SCHEMA = schema(
    seq="bigint",
    did="string",
    collection="string",
    operation="string",
    rkey="string",
    rev="string",
    cid="string",
    event_time="timestamp",
    record="string",
    kafka_partition="int",
    kafka_offset="bigint",
    processed_at="timestamp",
)
# The columns a message states in its payload under their own names
PAYLOAD_COLUMNS = ("seq", "did", "collection", "operation", "rkey", "rev", "cid")
BRONZE_COLUMNS = tuple(BRONZE_SCHEMA.fieldNames())
# A message without one of these is dropped
BRONZE_REQUIRED = ("seq", "did", "collection", "operation", "rkey", "event_time")

# Columns that differ between two runs of the same pipeline by nature
LINEAGE_COLUMNS = ("bronze_snapshot_id", "silver_snapshot_id", "processed_at")
# List columns whose order is not part of the contract
UNORDERED_LISTS = ("hashtags", "mention_dids")
# Retention is measured on the first of these that a table has
TIME_COLUMNS = ("event_time", "minute", "hour")

# Hashtags kept an hour, and the thresholds of benchmark windows
TOP_HASHTAGS = 50
WINDOW_SECONDS = 300
MAX_SAMPLE_GAP_SECONDS = 30
MIN_COVERAGE = 0.9
# Messages a second below each bound; the last bucket has none
RATE_BUCKETS = ((200, "0-200"), (500, "200-500"), (None, "500+"))
HOST_STEAL_PCT_MAX = 5.0
NEIGHBOUR_CORES_MAX = 0.5
# Catalog database -> the branch it serves
CATALOG_BRANCHES = {"ducklake_catalog": "duckdb", "iceberg_catalog": "spark"}

# Alternation of the two branches
ROTATION = ("duckdb", "spark")
DAY_TIME_ZONE = "Europe/Paris"
DAY_CLOSE_HOUR = 19
