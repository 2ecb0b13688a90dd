"""What queries carry per key and per file, on rows of the tests' own."""

import datetime as dt
import re

from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 1)


def _events(spark, folder, rows):
    """An events table with (event_id, seconds, user, type, k)."""
    data = [(i, None if s is None else T0 + dt.timedelta(seconds=s), u, t, 1.0, f'{{"k": {k}}}') for i, s, u, t, k in rows]
    spark.createDataFrame(data, "event_id long, ts timestamp, user_id long, event_type string, value double, props string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_sketch_is_kept_per_window_only(spark, tmp_path):
    """Beside an exact distinct count, a sketch must not be carried per window and user."""
    from eventide.plans.queries import approx_users_window
    rows = [(i, i * 7 % 7200, None if i % 11 == 0 else i % 50, "view", 1) for i in range(500)]
    rows += [(500, 8000, None, "view", 1), (501, None, 3, "view", 1)]
    df = approx_users_window(spark, _events(spark, tmp_path, rows))
    plan = df._jdf.queryExecution().sparkPlan().toString()
    per_user = [x for x in plan.splitlines() if re.search(r"Aggregate\(keys=\[[^\]]*user_id", x)]
    assert per_user and not [x for x in per_user if "approx_count_distinct" in x]
    exp = {}
    for _, s, u, *_ in rows:
        if s is not None:
            exp.setdefault(s // 3600, set()).update([] if u is None else [u])
    start = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    got = {(r.unix_timestamp - start) // 3600: (r.users_exact, r.approx_ok) for r in df.collect()}
    assert got == {h: (len(v), True) for h, v in exp.items()} and got[2] == (0, True)


def test_hours_need_no_python_state_per_hour(spark, tmp_path, monkeypatch):
    """One Python state operator, keyed by user; many hours of a user in one batch are parked and taken out."""
    from eventide.streaming import hourly
    from eventide.streaming.jobs import state_partitions
    monkeypatch.setattr(hourly, "HOURS_AT_ONCE", 2)
    rows = [(i, T0 + dt.timedelta(minutes=25 * i), 1 if i % 4 else None, "Login" if i % 3 else "Home", 200, "Logged In", "paid")
            for i in range(60)]
    schema = "event_id long, ts timestamp, user_id long, page string, status int, auth string, level string"
    frame = spark.createDataFrame(rows, schema)
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    for b in [frame, hourly.heartbeat(frame, rows[-1][1], 2)]:
        b.coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(frame.schema).parquet(src).withWatermark("ts", "30 minutes")
        with state_partitions(spark, 2, rocksdb=True):
            q = hourly.hourly_auth_attempts_stream(stream, ["level"], gap_seconds=3600).writeStream \
                .option("checkpointLocation", ck).trigger(availableNow=True).start(out, format="parquet")
            q.awaitTermination()
    assert sorted(s.operatorName[:18] for s in q.lastProgress.stateOperators) == ["stateStoreSave", "transformWithState"]
    want = []
    for user in (None, 1):
        session, item, page, before = None, 0, None, None
        for i, ts, _, p, *_ in (r for r in rows if r[2] == user):
            if before is None or ts - before > dt.timedelta(hours=1):
                session, item, prev = i, 0, None
            else:
                item, prev = item + 1, page
            if prev == "Login":
                want.append((i, session, item))
            page, before = p, ts
    got = spark.read.parquet(out).select("event_id", "session_id", "item_in_session").collect()
    assert sorted(map(tuple, got)) == sorted(want) and want


def test_multi_line_json_is_parsed_from_memory(spark, tmp_path):
    """The same rows as Spark's multi-line reader, which goes back to the file for each number read as a string."""
    from eventide.sources import files
    docs = ['[{"track_id": "1",\n "similars": [\n ["a", 17.0],\n ["é", 3]\n]},\n{"track_id": "2", "similars": []}]\n',
            '{"track_id": "3",\n "similars": [["c", 1.10], [7, null]]}', '{"track_id": "4", "similars', "[]", "",
            '[{"track_id": 5}, {"similars": [[]]}]']
    for i, d in enumerate(docs):
        (tmp_path / f"f{i}").mkdir()
        (tmp_path / f"f{i}" / "x.json").write_text(d, encoding="utf-8")
    schema = "track_id string, similars array<array<string>>"
    got = files.read_json_tree(spark, str(tmp_path), schema)
    want = spark.read.schema(schema).options(recursiveFileLookup="true", multiLine="true").json(str(tmp_path))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    scan = got._jdf.queryExecution().analyzed().collectLeaves().head().relation().options()
    assert scan.get("multiLine").isEmpty()


def test_python_state_gets_needed_columns_only(spark, tmp_path):
    """Each column costs a conversion per user and batch. Rows without a time open a session of their user."""
    from eventide.streaming.jobs import run_until_done, state_partitions
    from eventide.streaming.stateful import sessionized_auth_attempts_stream
    at = lambda m: T0 + dt.timedelta(minutes=m)
    rows = [(1, at(0), 1, "Login", 200, "Logged In", "a"), (2, at(1), 1, "Home", 200, "Logged In", "b"),
            (3, at(2), 1, "Login", 307, None, "c"), (4, at(40), 1, "Home", 200, "Out", "d"),
            (5, None, 2, "Login", 200, "Out", "e"), (6, None, 2, "Home", None, "Out", "f"), (7, at(600), 3, "Home", 200, "Out", "g")]
    schema = "event_id long, ts timestamp, user_id long, page string, status int, auth string, level string"
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.createDataFrame(rows, schema).withColumn("unused", F.lit("x")).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(schema + ", unused string").parquet(src).withWatermark("ts", "30 minutes")
    q = sessionized_auth_attempts_stream(stream, out_cols=["event_id", "ts", "level"])
    state = q._jdf.queryExecution().analyzed().toString()
    given = next(x for x in state.splitlines()[state.splitlines().index(next(
        x for x in state.splitlines() if "WithState" in x)) + 1:] if "Project" in x)
    assert "unused" not in given and "level" in given
    with state_partitions(spark, 2, rocksdb=True):
        run_until_done(q.writeStream.option("checkpointLocation", ck).trigger(availableNow=True).start(out, format="parquet"))
    got = spark.read.parquet(out).select("event_id", F.col("ts").isNull(), "level", "session_id", "item_in_session", "success")
    assert sorted(map(tuple, got.collect())) == [(2, False, "b", 1, 1, True), (3, False, "c", 1, 2, False),
                                                 (6, True, "f", 5, 1, False)]


def _brute_next(requests, similar, every, key):
    """Python's own draw: similar holds (item, next, weight), every (next, weight)."""
    lists = {}
    for item, nxt, w in similar:
        if item is not None:
            lists.setdefault(item, []).append((nxt, w))
    out = []
    for r in requests:
        ranges = sorted(lists.get(r[-1], every))
        k = key(r) % sum(w for _, w in ranges)
        for nxt, w in ranges:
            if k < w:
                out.append((*r, nxt))
                break
            k -= w
    return sorted(out, key=str)


def _watch_lookups(monkeypatch):
    """Rows that the bucketed lookups get: [(grouped, requests, ranges)]."""
    from eventide.operators import sampling
    seen, plain = [], sampling.range_lookup

    def watched(keys, k_col, ranges, width, group=None):
        seen.append((bool(group), keys.count(), ranges.count()))
        return plain(keys, k_col, ranges, width, group)
    monkeypatch.setattr(sampling, "range_lookup", watched)
    return seen


def test_next_items_with_short_long_and_no_lists(spark, monkeypatch):
    """Only lists over the bound, and requests on them, are copied into buckets; every request gets its draw."""
    from eventide.operators import sampling
    length = {"a": 1, "b": 3, "c": 4, "d": 40, None: 2}
    similar = [(i, n * 7, (n * 5 + len(i or "")) % 4 + (n == 0)) for i, m in length.items() for n in range(m)]
    every = [(n, n % 3) for n in range(1, 60)]
    requests = [(j, "abcde"[j % 5] if j % 7 else None) for j in range(700)]
    seen = _watch_lookups(monkeypatch)
    df = sampling.next_items(
        spark.createDataFrame(requests, "id long, item string"), "item", lambda tot: F.pmod(F.col("id") * 7919, tot),
        spark.createDataFrame([(*r, r[1]) for r in similar], "item string, next long, weight long, order_key long"),
        spark.createDataFrame([(*r, r[0]) for r in every], "next long, weight long, order_key long"),
        out="next", bucket_width=16, short_list=3)
    assert df.columns == ["id", "item", "next"]
    assert sorted(map(tuple, df.collect()), key=str) == _brute_next(requests, similar, every, lambda r: r[0] * 7919)
    on = lambda items: sum(r[1] in items for r in requests)
    assert seen == [(True, on(("c", "d")), 44), (False, on(("e", None)), len(every))]


def test_next_track_draws_from_short_lists_in_one_join(spark, tmp_path, monkeypatch):
    """Lists of a few tracks are not copied into buckets, nor are the order lines that ask for them moved again."""
    from eventide.plans.queries import next_track
    lines = [(o, o * (n + 3) % 17 if (o + n) % 11 else None, n, float(1 + (o + n) % 5)) for o in range(60) for n in range(o % 5)]
    lines += lines[:8] + [(900, 19, 1, 2.0), (901, 40, 1, 2.0), (901, 3, 2, 1.0)]  # rows twice, a track without a list, an unknown part
    parts = [(p, f"part {p}", "Brand", p) for p in range(20)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    plays, heads = {}, {}
    for o, p, n, q in lines:
        heads[o] = min(heads.get(o, (n, p)), (n, p), key=lambda x: (x[0], -1 if x[1] is None else x[1]))
        if p is not None and p < 20:
            plays[p] = plays.get(p, 0) + int(q)
    pairs = {(heads[o][1], p) for o, p, n, _ in lines if n != heads[o][0] and p in plays}
    key = lambda r: r[0] * 7919 + r[1] * 31 + (r[2] or 0)
    requests = [(o, n, p) for o, p, n, _ in lines if p is not None]
    exp = _brute_next(requests, [(t, s, plays[s]) for t, s in pairs], list(plays.items()), key)
    seen = _watch_lookups(monkeypatch)
    got = next_track(spark, str(tmp_path)).collect()
    assert sorted(((r.l_orderkey, r.l_linenumber, int(r.track_id[2:]), int(r.next_track[2:])) for r in got), key=str) == exp
    tracks = {t for t, _ in pairs if t is not None}
    assert seen == [(True, 0, 0), (False, sum(r[1] not in tracks for r in lines), len(plays))]
