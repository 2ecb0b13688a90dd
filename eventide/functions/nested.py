"""Nested (record) <-> flat event shape.

The nested form keeps user and device details in maps whose values are a
string / long / double union (a struct with one member per branch) and the
song in a ``songProperties`` struct; the flat form has one column per field
and ``song`` for the title.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

_MEMBER = {"string": "member0", "bigint": "member1", "int": "member1", "double": "member2"}
_FLAT_TYPES = dict((n.lower(), t) for n, t in S.USER_BLOCK)


def _union(c: Column, kind: str) -> Column:
    m = _MEMBER[kind]
    return F.struct(*[(c.cast({"member0": "string", "member1": "bigint",
                               "member2": "double"}[x]) if x == m else
                       F.lit(None).cast({"member0": "string", "member1": "bigint",
                                         "member2": "double"}[x])).alias(x)
                      for x in ("member0", "member1", "member2")])


def detail_map(df: DataFrame, keys: list[str]) -> Column:
    """Map of the present detail columns (case-insensitive); absent or null
    values are left out of the map."""
    cols = {c.lower(): c for c in df.columns}
    entries = []
    for k in keys:
        c = cols.get(k.lower())
        if c is None:
            continue
        entries.append(F.when(F.col(c).isNotNull(),
                              F.struct(F.lit(k).alias("k"),
                                       _union(F.col(c), _FLAT_TYPES[k.lower()]).alias("v"))))
    if not entries:
        return F.lit(None).cast(S.DETAIL_MAP)
    arr = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return F.map_from_entries(arr)


def to_nested(df: DataFrame) -> DataFrame:
    """Flat (lower-case) page-view columns -> nested record shape."""
    cols = {c.lower(): c for c in df.columns}
    song = F.when(F.col(cols["song"]).isNotNull() if "song" in cols else F.lit(False),
                  F.struct(F.col(cols.get("artist", "artist")).alias("artist"),
                           F.col(cols.get("song", "song")).alias("title"),
                           F.col(cols.get("duration", "duration")).cast("double").alias("duration"))) \
        if "song" in cols else F.lit(None).cast(S.SONG_PROPERTIES)
    names = {"ts": "ts", "sessionid": "sessionId", "level": "level",
             "iteminsession": "itemInSession", "page": "page", "auth": "auth",
             "method": "method", "status": "status", "tag": "tag"}
    base = [c for c in names if c in cols]
    return df.select(
        *[F.col(cols[c]).alias(names[c]) for c in base],
        F.col(cols["userid"]).cast("long").alias("userId") if "userid" in cols
        else F.lit(None).cast("long").alias("userId"),
        detail_map(df, S.USER_DETAIL_KEYS).alias("userDetails"),
        detail_map(df, S.DEVICE_DETAIL_KEYS).alias("deviceDetails"),
        song.alias("songProperties"))


def from_nested(df: DataFrame) -> DataFrame:
    """Nested record shape -> flat lower-case columns."""
    out = [F.col(c).alias(c.lower()) for c in df.columns
           if c not in ("userDetails", "deviceDetails", "songProperties")]
    for k in S.USER_DETAIL_KEYS:
        kind = _FLAT_TYPES[k.lower()]
        out.append(F.element_at(F.col("userDetails"), F.lit(k))[_MEMBER[kind]]
                   .cast(kind).alias(k.lower()))
    out.append(F.element_at(F.col("deviceDetails"), F.lit("userAgent"))["member0"]
               .alias("useragent"))
    out += [F.col("songProperties.artist").alias("artist"),
            F.col("songProperties.title").alias("song"),
            F.col("songProperties.duration").alias("duration")]
    return df.select(*out)


def from_avro_payload(col: str, json_schema: str) -> Column:
    """Decode an Avro payload. Needs the spark-avro package on the
    class path (``spark.jars.packages``); raises a clear error otherwise."""
    try:
        from pyspark.sql.avro.functions import from_avro
    except ImportError as e:  # pragma: no cover
        raise RuntimeError("spark-avro is not available") from e
    return from_avro(F.col(col), json_schema)


NESTED_TYPES = {t: S.nested_schema(t) for t in S.TOPICS}
__all__ = ["to_nested", "from_nested", "detail_map", "from_avro_payload", "NESTED_TYPES"]
