"""Window aggregates: pane-based sliding counts equal Spark's sliding window,
with and without keys; distinct counts per window; formatting."""

import datetime as dt
import random

from pyspark.sql import functions as F

from eventide.operators import windows


def _events(spark, n=3000, seed=4):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(microseconds=rnd.randint(0, 3_600_000_000)),
             rnd.choice(["a", "b", "c"]), rnd.randint(0, 40)) for _ in range(n)]
    return spark.createDataFrame(rows, "ts timestamp, k string, u long")


def test_pane_sliding_equals_window(spark):
    df = _events(spark)
    for length, slide, keys in [("60 seconds", "10 seconds", None),
                                ("5 minutes", "1 minute", ["k"]),
                                ("30 seconds", "30 seconds", ["k"])]:
        a = windows.sliding_count(df, "ts", length, slide, keys=keys, panes=True)
        b = windows.sliding_count(df, "ts", length, slide, keys=keys, panes=False)
        cols = ["window", *(keys or []), "count"]
        assert sorted(map(tuple, a.select(*cols).collect())) == \
            sorted(map(tuple, b.select(*cols).collect())), (length, slide, keys)


def test_distinct_per_window_and_format(spark):
    df = _events(spark)
    d = windows.distinct_per_window(df, "ts", "u", "10 minutes", out="users")
    exp = {}
    for r in df.collect():
        start = r.ts.replace(minute=r.ts.minute // 10 * 10, second=0, microsecond=0)
        exp.setdefault(start, set()).add(r.u)
    got = {r.window.start: r.users for r in d.collect()}
    assert got == {k: len(v) for k, v in exp.items()}
    f = windows.format_windows(d, ["users"]).collect()
    r = min(f, key=lambda x: x.unix_timestamp)
    assert r.timestamp_minute == "2024-01-01 00:00:00" and r.unix_timestamp == 1704067200
    approx = windows.distinct_per_window(df, "ts", "u", "10 minutes", approx=True, out="users")
    assert approx.count() == d.count()


def test_sketch_is_near_the_exact_count(spark):
    import os

    from eventide.plans import queries

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    near = {r.unix_timestamp: r.users for r in queries.approx_users_sketch(spark, sf).collect()}
    exact = {r.unix_timestamp: r.users for r in queries.distinct_users_window(spark, sf).collect()}
    assert near.keys() == exact.keys()
    assert all(abs(near[k] - n) <= max(3, 0.05 * n) for k, n in exact.items())


def test_tumbling_windows_in_order(spark):
    df = spark.createDataFrame([(i * 700,) for i in range(50)], "s long").select(F.timestamp_seconds("s").alias("ts"))
    got = [r.window.start for r in windows.order_windows(windows.tumbling_count(df, "ts", "1 hour"), False).collect()]
    assert got == sorted(got, reverse=True) and len(got) == 10
