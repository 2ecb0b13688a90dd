"""Decode of Kafka-shaped rows (FIXTURES.md §1)."""

import json

from pyspark.sql import functions as F

from eventide import schemas as S
from eventide.functions.decode import decode_topic, lower_names

import pytest


def test_decode_edge_cases(spark):
    good = json.dumps({"ts": 1704067200123, "sessionId": 5, "page": "Home", "status": 200,
                       "userId": 9, "tag": "control", "extra": 1})
    rows = [
        (good, 0, 1), ("{not json", 0, 2), ("", 0, 3), (None, 0, 4),
        (json.dumps({"ts": 1, "sessionId": 3000000000}), 1, 1),
        (json.dumps({"ts": "7", "sessionId": 1}), 1, 2),
    ]
    df = spark.createDataFrame(rows, "v string, partition int, offset long") \
        .select(F.col("v").cast("binary").alias("value"), F.lit("page_view_events").alias("topic"),
                "partition", "offset")
    out = decode_topic(df, S.get_schema(S.PAGE_VIEW, with_tag=True))
    assert out.columns[0] == "ts_timestamp" and out.columns[-1] == "offset"
    assert all(c == c.lower() for c in out.columns)
    got = {(r.partition, r.offset): r for r in out.collect()}
    r = got[(0, 1)]
    assert (r.sessionid, r.page, r.userid, r.tag) == (5, "Home", 9, "control")
    assert r.ts_timestamp.isoformat().startswith("2024-01-01T00:00:00.123")
    assert got[(0, 2)].ts is None and got[(0, 2)].page is None      # malformed -> nulls
    assert got[(0, 3)].ts is None and got[(0, 4)].ts is None         # empty / null
    assert got[(1, 1)].sessionid == 3000000000 and got[(1, 1)].ts == 1    # 64-bit ids
    assert got[(1, 2)].ts is None                                   # string for long


def test_lower_names_collision(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").toDF("userId", "userid")
    with pytest.raises(ValueError):
        lower_names(df)


def test_schema_lookup():
    assert len(S.get_schema(S.PAGE_VIEW)) == 22
    assert len(S.get_schema(S.STATUS_CHANGE)) == 16
    assert len(S.get_schema(S.LISTEN)) == 19
    assert len(S.get_schema(S.AUTH)) == 16
    with pytest.raises(KeyError):
        S.get_schema("nope")
