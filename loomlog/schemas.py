"""Schemas of the data the library reads and writes.

Schemas are declared, never inferred: inference costs an extra pass over
the input and, for JSON, orders columns alphabetically, which breaks any
code that reads fields by position.
"""

from pyspark.sql import types as T

# GitHub event, JSON lines: every top-level field of the feed.  ``payload``
# differs by event type, so it is kept as its JSON text.
ACTOR = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("login", T.StringType()),
    T.StructField("gravatar_id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("avatar_url", T.StringType()),
])
REPO = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("url", T.StringType()),
])
GITHUB_EVENT = T.StructType([
    T.StructField("id", T.StringType()),          # numeric text in the feed
    T.StructField("type", T.StringType()),
    T.StructField("public", T.BooleanType()),
    T.StructField("created_at", T.StringType()),  # ISO-8601, usually with Z
    T.StructField("actor", ACTOR),
    T.StructField("repo", REPO),
    T.StructField("org", ACTOR),
    T.StructField("payload", T.StringType()),
])

# Canonical event log.  ``created_at`` is the UTC wall-clock time as
# TIMESTAMP_NTZ, so nothing downstream depends on the session time zone.
EVENT_LOG = T.StructType([
    T.StructField("date_utc", T.StringType()),
    T.StructField("hour_utc", T.IntegerType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("ev_id", T.LongType()),
    T.StructField("actor", T.StringType()),
    T.StructField("ev_type", T.StringType()),
    T.StructField("repo", T.StringType()),
])
EVENT_LOG_COLUMNS = [f.name for f in EVENT_LOG.fields]

# Hourly table layout: partition and clustering keys.
HOURLY_PARTITION = ["date_utc", "hour_utc"]
HOURLY_CLUSTERING = ["created_at", "ev_id"]
# Default event table: partitioned by id block (ev_id div ID_BLOCK_SIZE).
ID_BLOCK_SIZE = 10_000_000
# Fixed value: name suffix of the hourly table next to the default table.
HOURLY_SUFFIX = "_hourly_by_ts_id"
# Fixed value: pattern for the event type in a raw JSON line (group 1).
TYPE_FIELD_REGEX = r'"type":"(\w*)"'


# Fixed value: printed for a line without a type.
NO_TYPE = "{NONE}"

# Literal defaults for absent JSON fields (lenient reader).
DEFAULT_ID = "0"
DEFAULT_TYPE = "NONE"
DEFAULT_CREATED_AT = "1970-01-01T00:00:00Z"
DEFAULT_LOGIN = "NONE"
DEFAULT_REPO = "NONE"

# Case/vote text format.
ATTRIBUTE = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
])
# Fixed value: column layout of an ``A`` line, used with from_csv.
ATTRIBUTE_LINE_DDL = "kind STRING, id INT, ignored INT, title STRING, url STRING"
# Fixed value: a header line of the format (record letters A, N, T, I, C).
CASE_VOTE_HEADER_REGEX = r"^[ANTIC],.*"
