"""Stream panes, replays into connectors, range counts, the console sink, scratch folders."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from eventide import schemas as S
from eventide.functions.decode import to_epoch_millis
from eventide.operators import catalog, segmented, windows
from eventide.session import clear_scratch, materialize
from eventide.sinks import writers
from eventide.streaming import jobs, panes

T0 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
SCHEMA = "ts timestamp, kind string"


def at(second, kind="a"):
    return (T0 + dt.timedelta(seconds=second), kind)


def windows_by_hand(rows, length, slide):
    """{(window start second, kind): rows}, counted row by row."""
    out = {}
    for ts, kind in rows:
        s = int((ts - T0).total_seconds())
        start = s // slide * slide
        while start > s - length:
            out[(start, kind)] = out.get((start, kind), 0) + 1
            start -= slide
    return out


def counted(df):
    us0 = int(T0.timestamp())
    return {(int(r.us / 10**6) - us0, r.kind): r["count"]
            for r in df.select(F.unix_micros("window.start").alias("us"), "kind", "count").collect()}


def run_panes(spark, folder, rows, length="60 seconds", slide="10 seconds", delay="60 seconds"):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    with jobs.state_partitions(spark, 2):
        q = panes.write_panes(panes.pane_counts(stream, "ts", length, slide, delay, ["kind"]),
                              f"{folder}/out", f"{folder}/ck", trigger="availableNow")
        jobs.run_until_done(q)
    return q


def test_windows_of_panes_equal_windows_counted_by_hand(spark, tmp_path):
    rng = random.Random(5)
    rows = [at(rng.randrange(900), rng.choice(["a", "a", None])) for _ in range(400)]
    for k in range(4):  # deliveries out of order within the delay
        run_panes(spark, str(tmp_path), rows[k::4], delay="1000 seconds")
    for length, secs in (("60 seconds", 60), ("10 seconds", 10), ("5 minutes", 300)):
        got = counted(panes.read_windows(spark, f"{tmp_path}/out", length, "10 seconds", ["kind"]))
        assert got == windows_by_hand(rows, secs, 10)


def test_a_row_counts_as_long_as_a_native_window_would_take_it(spark, tmp_path):
    """Watermark of the native window: 1000 - 60 = 940. A row at 905 lies in windows that end up to 960,
    so they are open; one at 845 lies in windows that end by 900."""
    run_panes(spark, str(tmp_path), [at(1000)])
    run_panes(spark, str(tmp_path), [at(905), at(845)])
    run_panes(spark, str(tmp_path), [at(1001)])
    got = counted(panes.read_windows(spark, f"{tmp_path}/out", keys=["kind"]))
    assert got == windows_by_hand([at(1000), at(905), at(1001)], 60, 10)


def test_state_holds_a_row_per_pane(spark, tmp_path):
    rows = [at(s) for s in range(0, 600, 10)]
    q = run_panes(spark, str(tmp_path), rows, delay="1 hour")
    held = max(o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"])
    assert held == len(rows)


def test_panes_need_a_slide_that_divides_the_length(spark):
    with pytest.raises(ValueError):
        windows.windows_of_panes(spark.range(1).selectExpr("id AS _pane", "id AS _n"), "25 seconds", "10 seconds")
    with pytest.raises(ValueError):
        panes.pane_counts(spark.createDataFrame([], SCHEMA), length="25 seconds")


def test_no_panes_give_no_windows(spark):
    empty = spark.range(0).selectExpr("id AS _pane", "id AS _n")
    assert windows.windows_of_panes(empty, "60 seconds", "10 seconds").count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_a_replayed_batch_replaces_its_own_rows_only(spark, tmp_path, fmt):
    write = writers.connector_batch_writer(fmt, {"path": str(tmp_path / "t")})
    write(spark.range(0, 5), 0)
    write(spark.range(5, 9), 1)
    write(spark.range(5, 9), 1)
    got = spark.read.schema("id long").format(fmt).load(str(tmp_path / "t"))
    assert sorted((r.id, r.batch_id) for r in got.collect()) == [(i, int(i > 4)) for i in range(9)]


def test_replay_kinds(spark, tmp_path):
    write = writers.connector_batch_writer("parquet", {"path": str(tmp_path / "t")}, replay="append")
    write(spark.range(2), 0)
    write(spark.range(2), 0)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    with pytest.raises(ValueError):
        writers.connector_batch_writer("parquet", replay="twice")


def test_warehouse_job_repeats_an_uncommitted_batch_once(spark, tmp_path):
    """The commit of the last batch is lost, as when the driver dies behind the write: Spark runs the batch again."""
    value = F.to_json(F.struct((F.col("id") * 1000).alias("ts"), F.lit("Home").alias("page"), F.col("id").alias("userId")))
    records = spark.range(6).select(value.cast("binary").alias("value"), F.lit(S.PAGE_VIEW).alias("topic"),
                                    F.lit(0).alias("partition"), F.col("id").alias("offset"))
    folder, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))

    def run():
        stream = spark.readStream.schema(records.schema).parquet(folder)
        jobs.run_until_done(jobs.decode_to_warehouse_job(stream, "parquet", {"path": out}, ck, trigger="availableNow"))

    records.where("id < 3").write.parquet(folder)
    run()
    records.where("id >= 3").write.mode("append").parquet(folder)
    run()
    last = max((f for f in os.listdir(f"{ck}/commits") if f.isdigit()), key=int)
    os.remove(f"{ck}/commits/{last}")
    if os.path.exists(f"{ck}/commits/.{last}.crc"):
        os.remove(f"{ck}/commits/.{last}.crc")
    run()
    assert sorted(r.offset for r in spark.read.parquet(out).collect()) == list(range(6))


def test_ranges_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert segmented.range_count(spark.range(0)) == 1
    assert segmented.range_count(spark.range(1)) == 1
    assert segmented.range_count(spark.range(10_000)) == cores
    assert segmented.range_count(spark.range(10_000), rows_per_range=100) == max(cores, 100)
    assert segmented.add_range_bucket(spark.range(0), ["id"]).count() == 0


def test_console_sink_prints_changing_counts(spark, tmp_path, capfd):
    spark.createDataFrame([at(1), at(2), at(40)], SCHEMA).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    q = writers.console(windows.tumbling_count(stream, "ts", "30 seconds"), trigger="availableNow")
    jobs.run_until_done(q)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 3
    assert any("ConsoleTable" in p["sink"]["description"] for p in q.recentProgress)


def test_epoch_millis_and_tracks_without_duration(spark):
    df = spark.sql("SELECT timestamp_millis(1709251200123) AS t")
    assert df.select(to_epoch_millis(F.col("t"))).first()[0] == 1709251200123
    tracks = spark.createDataFrame([("T1",), ("T2",), ("T2",)], "track_id string")
    durations = spark.createDataFrame([("T1", 9.0)], "track_id string, duration double")
    assert [r.track_id for r in catalog.tracks_without_duration(tracks, durations).collect()] == ["T2", "T2"]


def test_clear_scratch_removes_this_applications_folders(spark, tmp_path):
    kept = str(tmp_path / "kept")
    spark.range(3).write.parquet(kept)
    t = materialize(spark.range(5), "scratch_test")
    folder = files_of(t)
    assert os.path.isdir(folder)
    assert clear_scratch(spark) >= 1
    assert not os.path.exists(folder)
    assert spark.read.parquet(kept).count() == 3
    assert clear_scratch(spark) == 0
    assert materialize(spark.range(5), "scratch_test").count() == 5


def files_of(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://").removeprefix("file:"))
