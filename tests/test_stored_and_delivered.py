"""Hourly stream state, redelivery, versioned tables, sketches, bitmaps, rejects, telescoped gaps."""

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators import sessions, sketches
from eventide.session import hint_if_small, materialize
from eventide.sinks import versions, writers
from eventide.sources import rejects
from eventide.streaming import hourly
from eventide.streaming.deliveries import drop_redelivered
from eventide.streaming.jobs import run_until_done, state_partitions
from eventide.streaming.progress import progress_table, totals

T0 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
HOUR_US = 3_600_000_000


# J6 by hours: the two pure steps against following a user's rows in one go

def follow_all(rows, gap_us):
    """(id, session, item) of login attempts, by the definition."""
    out, session, item, prev, page_before, us_before = [], None, 0, None, None, None
    for us, rid, page, redirect, auth, _ in rows:
        if us_before is None or us - us_before > gap_us:
            session, item, prev = rid, 0, None
        else:
            item += 1
            prev = prev if redirect else page_before
        if prev == "Login":
            out.append((rid, session, item, auth == "Logged In"))
        page_before, us_before = page, us
    return out


def follow_by_hours(rows, gap_us):
    import json
    out, carry = [], None
    for hour in sorted({r[0] // HOUR_US for r in rows}):
        s = hourly.follow_hour([r for r in rows if r[0] // HOUR_US == hour], gap_us)
        carry, (session, items, prev) = hourly.join_hour(carry, s, gap_us)
        for a in json.loads(s["attempts"]):
            if (a["prev"] if a["known"] else prev) == "Login":
                head = a["session"] is None
                out.append((a["event_id"], session if head else a["session"], a["item"] + (items if head else 0), a["success"]))
    return out


@pytest.mark.parametrize("gap_minutes", [5, 30, 150, 1500])
def test_hours_with_a_carry_equal_one_pass(gap_minutes):
    rnd = random.Random(gap_minutes)
    for _ in range(60):
        us, rows = 10**15, []
        for i in range(rnd.randint(1, 60)):
            us += rnd.choice([0, 60, 600, 1799, 1800, 1801, 4000, 9000]) * 10**6
            rows.append((us, str(i), rnd.choice(["Login", "Home", None]), rnd.random() < 0.4, rnd.choice(["Logged In", "x", None]), ()))
        assert follow_by_hours(rows, gap_minutes * 60 * 10**6) == follow_all(rows, gap_minutes * 60 * 10**6)


def test_stream_by_hours_with_late_and_null_rows(spark, tmp_path):
    """Hot and null user, ids past 2^53, rows late within the delay, several batches."""
    schema = "event_id long, ts timestamp, user_id long, page string, status int, auth string, level string"
    rnd, big = random.Random(2), 2**60
    rows = []
    for i in range(400):
        user = rnd.choice([7, 7, None, 1, 2])
        rows.append((big + i, T0 + dt.timedelta(minutes=3 * i + rnd.randint(0, 2)), user, rnd.choice(["Login", "Home"]),
                     rnd.choice([200, 307, None]), rnd.choice(["Logged In", "Out"]), "paid"))
    late = list(rows)
    for k in range(0, 390, 7):  # swapped with a row some minutes later
        late[k], late[k + 3] = late[k + 3], late[k]
    late.insert(3, (big + 999, None, 7, "Login", 200, "Out", "paid"))  # no time
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    frame = spark.createDataFrame(late, schema)
    batches = [spark.createDataFrame(late[k:k + 101], schema) for k in range(0, 401, 101)]
    for b in [*batches, hourly.heartbeat(frame, rows[-1][1], 2)]:
        b.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(frame.schema).parquet(src).withWatermark("ts", "30 minutes")
        with state_partitions(spark, 2, rocksdb=True):
            run_until_done(writers.write_stream(hourly.hourly_auth_attempts_stream(stream, ["level"], gap_seconds=5400),
                                                out, ck, trigger="availableNow"))
    got = sorted((r.event_id, r.session_id, r.item_in_session, r.success, r.user_id) for r in spark.read.parquet(out).collect())
    want = []
    for user in (7, None, 1, 2):
        mine = sorted((int((r[1] - T0).total_seconds()) * 10**6 + 1_709_251_200 * 10**6, str(r[0]), r[3],
                       r[4] is not None and 300 <= r[4] <= 398, r[5], ()) for r in rows if r[2] == user)
        want += [(int(a), int(s), n, ok, user) for a, s, n, ok in follow_all(mine, 5400 * 10**6)]
    assert got == sorted(want, key=lambda r: r[:4])


def test_redelivered_offsets_come_once(spark, tmp_path):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    schema = "topic string, partition int, offset long, ts timestamp"
    first = [("t", p, o, at(o)) for p in (0, 1) for o in range(30)]
    second = [r for r in first if r[2] > 22] + [("t", 0, 30, at(30)), ("t", 0, 3, at(3)), ("u", 0, 29, at(29))]
    src, out, ck, log = (str(tmp_path / x) for x in ("in", "out", "ck", "log"))
    with progress_table(spark, log):
        for rows in (first, second):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
            stream = spark.readStream.schema(schema).parquet(src)
            with state_partitions(spark, 2, rocksdb=True):
                run_until_done(writers.write_stream(drop_redelivered(stream), out, ck, trigger="availableNow", query_name="r"))
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("topic", "partition", "offset").collect())
    assert got == sorted({r[:3] for r in first + second})
    t = totals(spark, log).first()
    assert (t.rows_in, t.late, t.duplicates) == (len(first) + len(second), 1, 14)


# B3

def test_snapshot_is_atomic(spark, tmp_path):
    path = str(tmp_path / "s")
    write = versions.atomic_snapshot_writer(path, keep=1)
    assert versions.read_snapshot(spark, path, schema="n long").count() == 0
    write(spark.range(5), 0)
    before = versions.read_snapshot(spark, path)
    started, go = threading.Event(), threading.Event()
    slow = spark.range(9)

    class Slow:  # a write that is under way while others read
        sparkSession = spark

        @property
        def write(self):
            started.set()
            assert go.wait(30)
            return slow.write
    t = threading.Thread(target=write, args=(Slow(), 1))
    t.start()
    assert started.wait(30)
    assert versions.read_snapshot(spark, path).count() == 5
    go.set()
    t.join()
    assert versions.read_snapshot(spark, path).count() == 9 and before.count() == 5
    write(spark.range(1), 1)  # a replay changes nothing
    with pytest.raises(Exception, match="broken"):
        write(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), 2)
    assert versions.read_snapshot(spark, path).count() == 9
    write(spark.range(2), 2)
    assert versions.read_snapshot(spark, path).count() == 2
    write(spark.range(3), 3)
    with pytest.raises(Exception):  # more than ``keep`` commits behind
        before.collect()


# B10, B14

def test_keyed_table(spark, tmp_path):
    schema = "k long, s string, ts timestamp, v string"
    at = lambda d: T0 + dt.timedelta(days=d)
    table = versions.KeyedTable(str(tmp_path / "t"), ["k", "s"], "ts", buckets=4, ttl="10 days")
    assert table.read(spark, schema).count() == 0
    merge = lambda rows, n: table.merge(spark.createDataFrame(rows, schema), n)
    rows = lambda: sorted(((r.k, r.s, r.v) for r in table.read(spark).collect()), key=str)
    merge([(1, "a", at(0), "x"), (1, "a", at(2), "y"), (None, "a", at(1), "n"), (2, None, at(1), "m"), (3, "c", None, "z")], 0)
    assert rows() == sorted([(1, "a", "y"), (None, "a", "n"), (2, None, "m")], key=str)  # without a version: older than all
    merge([(1, "a", at(1), "older"), (None, "a", at(3), "n2")], 1)
    merge([(1, "a", at(9), "replayed")], 1)
    assert rows() == sorted([(1, "a", "y"), (None, "a", "n2"), (2, None, "m")], key=str)
    merge([], 2)
    merge([(7, "q", at(12), "new")], 3)  # ten days before day 12: the rows of day 1 have expired
    assert rows() == sorted([(1, "a", "y"), (None, "a", "n2"), (7, "q", "new")], key=str)
    table.expire(spark)
    now = versions.read_pointer(spark, table.path)
    stored = spark.read.schema(schema).parquet(*table._folders(now))
    assert stored.count() == 3
    merge([(2, None, at(13), "back")], 4)
    assert (2, None, "back") in rows()
    with pytest.raises(ValueError):
        versions.KeyedTable("x", ["k"], "ts", 1, ttl="10 days; drop")


def test_keyed_table_against_a_dictionary(spark, tmp_path):
    rnd, table, held = random.Random(5), versions.KeyedTable(str(tmp_path / "t"), ["k"], "ts", buckets=5), {}
    for n in range(6):
        rows = [(rnd.randint(0, 30), rnd.randint(0, 50), f"{n}-{i}") for i in range(40)]
        rows += [(1, 5, "same")] * 30  # a hot key
        table.merge(spark.createDataFrame(rows, "k long, ts long, v string").repartition(3), n)
        for k, ts, v in rows:
            held[k] = max(held.get(k, (-1, "")), (ts, v))
        assert {r.k: (r.ts, r.v) for r in table.read(spark).collect()} == held


# F3, F4

def _events(spark, n=3000):
    rnd = random.Random(1)
    rows = [(T0 + dt.timedelta(seconds=int(rnd.expovariate(0.002))), rnd.choice([rnd.randint(-70000, 70000), 5, None])) for _ in range(n)]
    rows += [(None, 3), (T0 - dt.timedelta(seconds=1), 2**40)]
    return rows, spark.createDataFrame(rows, "ts timestamp, user_id long").repartition(3)


@pytest.mark.parametrize("segment", [7, 512])
def test_bitmaps_and_sketches(spark, segment):
    rows, df = _events(spark)
    users = {}
    for ts, u in rows:
        if ts is not None:
            pane = int((ts - T0).total_seconds()) // 10
            for w in range(pane - 5, pane + 1):
                users.setdefault(T0 + dt.timedelta(seconds=10 * w), set()).add(u)
    def read(d):
        got = d.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "users").collect()
        return {dt.datetime.fromisoformat(r.start).replace(tzinfo=dt.timezone.utc): r.users for r in got}
    exact = {w: len(s - {None}) for w, s in users.items()}
    bits = materialize(sketches.bitmap_panes(df, "ts", "user_id", "10 seconds"), "bits")
    assert read(sketches.sliding_distinct(bits, "10 seconds", "60 seconds", segment=segment)) == {w: n for w, n in exact.items() if n}
    panes = materialize(sketches.sketch_panes(df, "ts", "user_id", "10 seconds"), "sketches")
    assert read(sketches.sliding_estimates(panes, "10 seconds", "60 seconds")) == exact
    days = read(sketches.rollup_estimates(panes, "10 seconds", "day"))
    assert days[T0] == len({u for ts, u in rows if ts is not None and ts >= T0} - {None})


def test_large_sketches_are_within_tolerance(spark):
    df = spark.range(200_000).select(F.lit(T0).cast("timestamp").alias("ts"), (F.col("id") % 50_000).alias("user_id"))
    got = sketches.rollup_estimates(sketches.sketch_panes(df, "ts", "user_id", "10 seconds"), "10 seconds", "day").first().users
    assert abs(got - 50_000) < 1_500
    assert sketches.sketch_panes(df.limit(0), "ts", "user_id", "10 seconds").count() == 0


# C2, D5

def test_rejects(spark, tmp_path):
    schema = T.StructType.fromDDL("ts long, page string")
    lines = ['{"ts": 1, "page": "a"}', '{"ts": 2}', '{"ts": "x"}', '{"page": "b"}', "", "  ", None, '{"ts": 3', "[1]"]
    p = rejects.write_parsed(rejects.json_rows(spark.createDataFrame([(x,) for x in lines], "value string"), schema, ["ts"]),
                             str(tmp_path / "j"))
    assert (p.n_good, p.n_rejected) == (2, 7)
    assert sorted((r.ts, r.page) for r in p.good.collect()) == [(1, "a"), (2, None)]
    got = {r.line: r.reason for r in p.rejects.collect()}
    assert got == {'{"ts": "x"}': "malformed", '{"page": "b"}': "no ts", "": "blank", "  ": "blank", None: "blank",
                   '{"ts": 3': "malformed", "[1]": got["[1]"]}
    q = rejects.write_parsed(rejects.separated_rows(spark.createDataFrame([("a<SEP>b",), ("a",), ("a<SEP>b<SEP>c",), ("x.y",)], "value string"),
                                                    "<SEP>", ["one", "two"]), str(tmp_path / "s"))
    assert (q.n_good, q.n_rejected) == (2, 2) and sorted(map(tuple, q.good.collect())) == [("a", "b")] * 2
    none = rejects.write_parsed(rejects.json_rows(spark.createDataFrame([], "value string"), schema, []), str(tmp_path / "e"))
    assert (none.n_good, none.n_rejected, none.good.count()) == (0, 0, 0)


# F11, F12

def test_gaps_add_up(spark):
    rnd = random.Random(9)
    rows, want = [], {}
    for user in (1, 2, None):
        t, ends = 0, []
        for s in range(rnd.randint(1, 6)):
            times = [t]
            for _ in range(rnd.randint(0, 4)):
                times.append(times[-1] + rnd.randint(0, 100))
            rows.append((user, T0 + dt.timedelta(seconds=times[0]), T0 + dt.timedelta(seconds=times[-1]), len(times)))
            ends.append(times)
            t = times[-1] + rnd.randint(1000, 2000)
        inner = [b - a for x in ends for a, b in zip(x, x[1:])]
        outer = [y[0] - x[-1] for x, y in zip(ends, ends[1:])]
        mean = lambda v: sum(v) / len(v) if v else None
        want[user] = (mean(inner), len(inner), mean(outer), len(outer))
    rows.append((4, T0, T0, 1))
    want[4] = (None, 0, None, 0)
    got = sessions.user_gaps(spark.createDataFrame(rows, "user_id long, session_start timestamp, session_end timestamp, n_events long"))
    for r in got.collect():
        assert tuple(r)[1:] == pytest.approx(want[r.user_id])


def test_size_bound_of_hints(spark):
    t = materialize(spark.range(100), "ids")
    plan = lambda x: x._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(hint_if_small(t)) and "broadcast" not in plan(hint_if_small(t, 100))
