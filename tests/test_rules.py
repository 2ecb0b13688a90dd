"""Single-rule tests on the small frames of FIXTURES.md §6."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from eventide.operators import routing, sessions
from eventide.sources.files import capitalise
from eventide.streaming.stateful import previous_pages

T0 = dt.datetime(2024, 1, 1)


def _pv(spark, rows):
    return spark.createDataFrame(
        [(s, i, T0 + dt.timedelta(seconds=10 * i + 100 * s), p, st, u)
         for s, i, p, st, u in rows],
        "sessionid long, iteminsession int, ts timestamp, page string, status int, user long")


REDIRECT_ROWS = [
    (1, 0, "Home", 200, 7), (1, 1, "Login", 200, 7), (1, 2, "Login", 307, 7),
    (1, 3, "Home", 200, 7), (2, 0, "Login", 307, 8), (2, 1, "Home", 200, 8),
]
EXPECTED_PREV = {(1, 0): None, (1, 1): "Home", (1, 2): "Home", (1, 3): "Login",
                 (2, 0): None, (2, 1): "Login"}


def test_previous_page_batch_by_session(spark):
    df = sessions.previous_page(_pv(spark, REDIRECT_ROWS), session_col="sessionid",
                                ts_col="ts", order=["ts", "iteminsession"])
    got = {(r.sessionid, r.iteminsession): r.previous_page for r in df.collect()}
    assert got == EXPECTED_PREV


def test_previous_page_batch_by_user_tiny_buckets(spark):
    # keyed by user, buckets of 1 second: every row is its own bucket, so the
    # whole answer comes from the carried values
    df = sessions.previous_page(_pv(spark, REDIRECT_ROWS), session_col="sessionid",
                                ts_col="ts", order=["ts", "iteminsession"], user_col="user",
                                bucket_seconds=1)
    got = {(r.sessionid, r.iteminsession): r.previous_page for r in df.collect()}
    assert got == EXPECTED_PREV


def test_previous_page_state_rule():
    for sid in (1, 2):
        rows = [r for r in REDIRECT_ROWS if r[0] == sid]
        pdf = pd.DataFrame({"page": [r[2] for r in rows], "status": [r[3] for r in rows]})
        got = list(previous_pages(pdf, "page", "status", None, None))
        assert got == [EXPECTED_PREV[(sid, r[1])] for r in rows]
    # split across two batches: the state carries on
    pdf1 = pd.DataFrame({"page": ["Home", "Login"], "status": [200, 200]})
    pdf2 = pd.DataFrame({"page": ["Login", "Home"], "status": [307, 200]})
    p1 = list(previous_pages(pdf1, "page", "status", None, None))
    p2 = list(previous_pages(pdf2, "page", "status", "Login", p1[-1]))
    assert p1 + p2 == [None, "Home", "Home", "Login"]


def test_session_boundary_exact_gap_joins(spark):
    times = ["00:00:00", "00:30:00", "00:59:59"]
    df = spark.createDataFrame([(1, i, dt.datetime.fromisoformat(f"2024-01-01T{t}"))
                                for i, t in enumerate(times)],
                               "user_id long, event_id long, ts timestamp")
    s = sessions.sessionize(df)
    assert s.select("session_id").distinct().count() == 1
    df2 = df.union(spark.createDataFrame([(1, 3, dt.datetime(2024, 1, 1, 1, 30))],
                                         df.schema))
    s2 = sessions.sessionize(df2)
    assert s2.select("session_id").distinct().count() == 2
    assert [r.item_in_session for r in s2.orderBy("ts").collect()] == [0, 1, 2, 0]
    # same split as Spark's session_window
    sw = df2.groupBy(F.session_window("ts", "30 minutes")).count()
    assert sw.count() == 2


def test_masking(spark):
    df = spark.createDataFrame([("Logged In", 1, "a"), ("Guest", 2, "b"), ("Weird", 3, "c")],
                               "auth string, userid long, tag string")
    got = {r.auth: (r.userid, r.tag) for r in routing.mask_users(df).collect()}
    assert got == {"Logged In": (1, "a"), "Guest": (None, None), "Weird": (None, None)}


def test_capitalise(spark):
    df = spark.createDataFrame([("MARY",), ("VAN DYKE",), ("x",), (None,)], "n string")
    got = [r[0] for r in df.select(capitalise(F.col("n"))).collect()]
    assert got == ["Mary", "Van dyke", "X", None]


def test_routing_shapes(spark):
    df = spark.createDataFrame(
        [(1, "NextSong", "GET", 200, "Logged In", "a", "s", 1.0),
         (2, "Submit Upgrade", "PUT", 200, "Logged In", None, None, None),
         (3, "Home", "GET", 200, "Logged Out", None, None, None)],
        "ts long, page string, method string, status int, auth string, artist string, "
        "song string, duration double")
    li = routing.listens(df)
    assert li.count() == 1 and "page" not in li.columns and "artist" in li.columns
    sc = routing.status_changes(df)
    assert sc.count() == 1 and "song" not in sc.columns
    pv = df.withColumn("previous_page", F.when(F.col("ts") == 3, "Login"))
    au = routing.auth_attempts(pv).collect()
    assert len(au) == 1 and au[0].success is False and "auth" not in au[0].asDict()
