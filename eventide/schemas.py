"""Event topic schemas (flat JSON wire form and nested record form).

Fixed values: the topic names, field names, field order and field types
below are the wire contract of the four event topics and must stay as they
are for decoded rows to line up with produced ones.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: topic names -------------------------------------------
PAGE_VIEW = "page_view_events"
LISTEN = "listen_events"
STATUS_CHANGE = "status_change_events"
AUTH = "auth_events"
TOPICS = [PAGE_VIEW, LISTEN, STATUS_CHANGE, AUTH]

# --- fixed values: field blocks (name, Spark type), in wire order ---------
USER_BLOCK = [
    ("city", "string"), ("zip", "string"), ("state", "string"),
    ("userAgent", "string"), ("lon", "double"), ("lat", "double"),
    ("userId", "bigint"), ("lastName", "string"), ("firstName", "string"),
    ("gender", "string"), ("registration", "bigint"),
]
SONG_BLOCK = [("artist", "string"), ("song", "string"), ("duration", "double")]

_FIELDS = {
    PAGE_VIEW: [("ts", "bigint"), ("sessionId", "bigint"), ("page", "string"),
                ("auth", "string"), ("method", "string"), ("status", "int"),
                ("level", "string"), ("itemInSession", "int")]
    + USER_BLOCK + SONG_BLOCK,
    STATUS_CHANGE: [("ts", "bigint"), ("sessionId", "bigint"), ("auth", "string"),
                    ("level", "string"), ("itemInSession", "int")] + USER_BLOCK,
    LISTEN: SONG_BLOCK + [("ts", "bigint"), ("sessionId", "bigint"),
                          ("auth", "string"), ("level", "string"),
                          ("itemInSession", "int")] + USER_BLOCK,
    AUTH: [("ts", "bigint"), ("sessionId", "bigint"), ("level", "string"),
           ("itemInSession", "int")] + USER_BLOCK + [("success", "boolean")],
}

_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(),
    "bigint": T.LongType(), "boolean": T.BooleanType(),
}


def _struct(fields, with_tag: bool) -> T.StructType:
    out = [T.StructField(n, _TYPES[t], True) for n, t in fields]
    if with_tag:
        out.append(T.StructField("tag", T.StringType(), True))
    return T.StructType(out)


def get_schema(topic: str, with_tag: bool = False) -> T.StructType:
    """Flat schema of one topic; ``with_tag`` adds the optional A/B tag."""
    if topic not in _FIELDS:
        raise KeyError(f"unknown event schema: {topic!r}; known: {TOPICS}")
    return _struct(_FIELDS[topic], with_tag)


def field_names(topic: str) -> list[str]:
    return [n for n, _ in _FIELDS[topic]]


def table_ddl_columns(topic: str) -> list[tuple[str, str]]:
    """Catalog column list of a decoded topic table: lower-case names,
    ``ts_timestamp`` first and the source ``offset`` last."""
    cols = [(n.lower(), t) for n, t in _FIELDS[topic]]
    return [("ts", "bigint"), ("ts_timestamp", "timestamp"), ("offset", "bigint")] + \
        [c for c in cols if c[0] != "ts"]


# --- nested (record) form ---------------------------------------------------
# Map values are a union of string / long / double, which Spark represents as
# a struct with one member per branch.
UNION_VALUE = T.StructType([
    T.StructField("member0", T.StringType(), True),
    T.StructField("member1", T.LongType(), True),
    T.StructField("member2", T.DoubleType(), True),
])
DETAIL_MAP = T.MapType(T.StringType(), UNION_VALUE, True)
SONG_PROPERTIES = T.StructType([
    T.StructField("artist", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("duration", T.DoubleType(), True),
])

# keys of the user detail map, in the flat field order
USER_DETAIL_KEYS = ["city", "zip", "state", "lastName", "firstName", "gender",
                    "registration", "lon", "lat"]
DEVICE_DETAIL_KEYS = ["userAgent"]


def nested_schema(topic: str) -> T.StructType:
    base = [
        T.StructField("ts", T.LongType(), False),
        T.StructField("userId", T.LongType(), True),
        T.StructField("sessionId", T.LongType(), False),
        T.StructField("level", T.StringType(), False),
        T.StructField("itemInSession", T.IntegerType(), False),
        T.StructField("userDetails", DETAIL_MAP, True),
        T.StructField("deviceDetails", DETAIL_MAP, True),
        T.StructField("tag", T.StringType(), True),
    ]
    extra = {
        AUTH: [T.StructField("success", T.BooleanType(), True)],
        LISTEN: [T.StructField("auth", T.StringType(), True),
                 T.StructField("songProperties", SONG_PROPERTIES, False)],
        PAGE_VIEW: [T.StructField("page", T.StringType(), True),
                    T.StructField("auth", T.StringType(), True),
                    T.StructField("method", T.StringType(), True),
                    T.StructField("status", T.IntegerType(), True),
                    T.StructField("songProperties", SONG_PROPERTIES, True)],
        STATUS_CHANGE: [T.StructField("auth", T.StringType(), True)],
    }[topic]
    return T.StructType(base + extra)


# Kafka source row layout (what readStream.format("kafka") yields)
KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])

# Driver events table (the generic stream used for the registered queries)
EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])
