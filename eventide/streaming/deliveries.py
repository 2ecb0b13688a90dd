"""Registered stream queries whose input arrives in several deliveries: each delivery
is written, then a bounded run (``availableNow``) goes on from the checkpoint of the one before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows
from ..plans import adapters as A
from ..plans.oracle import pv_cte
from ..plans.queries import page_view_payload_stateless
from ..session import scratch_path
from ..sinks import committed, writers
from ..sinks.versions import KeyedTable, atomic_snapshot_writer, read_snapshot
from ..sources import lines
from . import panes
from .hourly import heartbeat, hourly_auth_attempts_stream
from .jobs import decoded_page_views, run_until_done, state_partitions
from .progress import progress_table, totals

GAP = 12 * 3600


def _cuts(df: DataFrame, n: int) -> list:
    """n - 1 times (epoch microseconds) that cut the time line evenly."""
    lo, hi = df.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    return [] if lo is None else [lo + (hi - lo) * k // n for k in range(1, n)]


def _slices(df: DataFrame, n: int) -> list[DataFrame]:
    """``df`` cut by time into n parts."""
    us, cuts = F.unix_micros("ts"), _cuts(df, n)
    if not cuts:
        return [df]
    edges = [None, *cuts, None]
    return [df.where((us >= a if a is not None else F.lit(True)) & (us < b if b is not None else F.lit(True)))
            for a, b in zip(edges, edges[1:])]


def _deliver(deliveries: list[DataFrame], folder: str, run: Callable[[DataFrame], None]) -> None:
    """Write each delivery into ``folder`` and let ``run`` read the folder as a stream."""
    for d in deliveries:
        d.write.mode("append").parquet(folder)
        run(d.sparkSession.readStream.schema(d.schema).parquet(folder))


def crowded_page_views(spark: SparkSession, sf: str) -> DataFrame:
    """Page views where user 1 and the rows without a user hold a sixth each."""
    k = F.col("event_id") % 6
    user = F.when(k == 0, F.lit(1)).when(k == 3, F.lit(None)).otherwise(F.col("user_id"))
    ev = A.events(spark, sf).withColumn("user_id", user.cast("long"))
    return A.page_view_columns(ev)


def stream_hourly_attempts(spark: SparkSession, sf: str) -> DataFrame:
    """J6 D3 G1 G2 G5 over four deliveries: login attempts with state per (user, hour)
    and a carry from hour to hour (see :mod:`eventide.streaming.hourly`). Sessions have a 12-hour gap,
    so they run across many hours. A heartbeat closes the last hours."""
    base = scratch_path(spark, "stream_hourly_attempts")
    pv = crowded_page_views(spark, sf)
    newest = pv.agg(F.max("ts")).first()[0]

    def run(stream: DataFrame) -> None:
        out = hourly_auth_attempts_stream(stream.withWatermark("ts", "30 minutes"), ["level", "tag"], gap_seconds=GAP)
        with state_partitions(spark, rocksdb=True):
            run_until_done(writers.write_stream(out, f"{base}/out", f"{base}/ck", trigger="availableNow"))

    _deliver([*_slices(pv, 4), heartbeat(pv, newest)], f"{base}/in", run)
    return spark.read.parquet(f"{base}/out")


def drop_redelivered(records: DataFrame, ts_col: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Each (topic, partition, offset) once, also when a source sends it again in a
    later batch. An offset is unique within its partition only. State holds the offsets of the
    delay; what comes back later than that is dropped as late."""
    return records.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(["topic", "partition", "offset"])


def redelivered_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """The second delivery sends the whole first one again. Returns what was
    kept, and from Spark's own counters (through the progress table) how many rows came in, were
    late, and were duplicates within the delay."""
    base = scratch_path(spark, "redelivered_offsets")
    ev = A.events(spark, sf).select(
        F.lit("page_view_events").alias("topic"), (F.col("event_id") % 5).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 5).alias("offset"), "ts")
    first = _slices(ev, 2)[0]

    def run(stream: DataFrame) -> None:
        with state_partitions(spark, rocksdb=True):
            run_until_done(writers.write_stream(drop_redelivered(stream), f"{base}/out", f"{base}/ck",
                                                trigger="availableNow", query_name="redelivered_offsets"))

    with progress_table(spark, f"{base}/progress"):
        _deliver([first, ev], f"{base}/in", run)
    kept = spark.read.parquet(f"{base}/out").groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("partition", "offset").alias("n_offsets"))
    seen = totals(spark, f"{base}/progress").select(F.lit("page_view_events").alias("topic"), "rows_in", "late", "duplicates")
    return kept.join(seen, "topic")


def keyed_upserts(spark: SparkSession, sf: str) -> DataFrame:
    """The last event per (user, type), upserted per micro-batch into a keyed
    table whose rows expire 7 days behind the newest. The last delivery sends the first one again, so
    every late older version meets a newer one or an expired key; a batch is also merged twice."""
    base = scratch_path(spark, "keyed_upserts")
    table = KeyedTable(f"{base}/table", ["user_id", "event_type"], "ts", buckets=8, ttl="7 days")
    ev = A.events(spark, sf).select("user_id", "event_type", "ts", "event_id", "value")

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, batch_id)
        table.merge(batch, batch_id)  # as after a failure

    def run(stream: DataFrame) -> None:
        run_until_done(writers.for_each_batch(stream, merge, f"{base}/ck", trigger="availableNow"))

    parts = _slices(ev, 3)
    _deliver([*parts, parts[0]], f"{base}/in", run)
    table.expire(spark)
    return table.read(spark, ev.schema).select("user_id", "event_type", F.unix_micros("ts").alias("ts_us"), "event_id", "value")


def snapshot_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Running counts per event type, each micro-batch an atomic snapshot. A
    reader that pinned the first snapshot still sees it after the second one is committed, and a
    write that fails leaves the committed one in place."""
    base = scratch_path(spark, "snapshot_versions")
    ev = A.events(spark, sf).select("event_type", "ts")
    pinned = []

    def run(stream: DataFrame) -> None:
        agg = stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        with state_partitions(spark):
            run_until_done(writers.for_each_batch(agg, atomic_snapshot_writer(f"{base}/now"), f"{base}/ck", mode="complete",
                                                  trigger="availableNow"))
        pinned.append(read_snapshot(spark, f"{base}/now", schema="event_type string, n long"))

    _deliver(_slices(ev, 2), f"{base}/in", run)
    broken = pinned[-1].withColumn("n", F.raise_error(F.lit("the write fails")).cast("long"))
    try:
        atomic_snapshot_writer(f"{base}/now")(broken, 10**6)
    except Exception as e:
        if "the write fails" not in str(e):
            raise
    now = read_snapshot(spark, f"{base}/now", schema="event_type string, n long")
    return now.join(pinned[0].withColumnRenamed("n", "n_pinned"), "event_type", "left")


def _deliver_lines(rows: DataFrame, folder: str, k: int) -> list[str]:
    """Write ``rows`` (p, value) as line files of delivery ``k``, a folder per p, under
    names that ascend with ``k``. Returns the folders."""
    rows.write.partitionBy("p").text(f"{folder}/.new-{k}")
    fs, root = lines.file_system(folder)
    out = []
    for p in (0, 1):
        fs.create_dir(f"{root}/p{p}", recursive=True)
        for name, size in lines.list_files(f"{root}/.new-{k}/p={p}"):
            fs.move(f"{root}/.new-{k}/p={p}/{name}", f"{root}/p{p}/{k:04d}-{name}")
        out.append(f"{folder}/p{p}")
    return out


def committed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Event lines of two producers, read with positions and written by
    commit, in two deliveries. The first run fails while one producer's tasks have written theirs; its
    batch is then run again. A second query starts behind the last row of the first batch.
    Returns per event how often the first query's table holds it, and the second's."""
    base = scratch_path(spark, "committed_lines")
    ev = A.events(spark, sf).select("ts", (F.col("event_id") % 2).alias("p"),
                                    F.to_json(F.struct("event_id", "event_type")).alias("value"))
    fails = F.when(F.col("folder").endswith("p1"), F.raise_error(F.lit("a task fails"))).otherwise(F.lit(True)).cast("boolean")

    def run(starting, name: str, broken: bool = False) -> None:
        stream = lines.read_event_lines(spark, folders, starting, range_bytes=16 << 20)
        run_until_done(committed.write_committed(stream.where(fails) if broken else stream, f"{base}/{name}",
                                                 f"{base}/{name}-ck", trigger="availableNow"))

    def table(name: str, **kw) -> DataFrame:
        return committed.read_committed(spark, f"{base}/{name}", lines.SCHEMA, **kw)

    for k, d in enumerate(_slices(ev, 2)):
        folders = _deliver_lines(d.select("p", "value"), f"{base}/in", k)
        if k == 0:
            try:
                run("earliest", "all", broken=True)
            except Exception as e:
                if "a task fails" not in str(e):
                    raise
        run("earliest", "all")
    run(lines.position_behind(table("all", up_to_batch=0)), "later")
    event = F.from_json(F.col("value").cast("string"), "event_id long, event_type string")
    both = table("all").select(event.alias("e"), F.lit(0).alias("k")).unionByName(
        table("later").select(event.alias("e"), F.lit(1).alias("k")))
    return both.groupBy("e.event_id", "e.event_type").agg(F.count_if(F.col("k") == 0).alias("n"), F.count_if(F.col("k") == 1).alias("n_later"))


def stream_pane_windows(spark: SparkSession, sf: str) -> DataFrame:
    """J3 J1 F2 over three deliveries: 60 s / 10 s counts per event type from panes
    (see :mod:`eventide.streaming.panes`)."""
    base = scratch_path(spark, "stream_pane_windows")
    ev = A.events(spark, sf).select("ts", "event_type")

    def run(stream: DataFrame) -> None:
        with state_partitions(spark):
            run_until_done(panes.write_panes(panes.pane_counts(stream, keys=["event_type"]), f"{base}/out", f"{base}/ck",
                                             trigger="availableNow"))

    _deliver(_slices(ev, 3), f"{base}/in", run)
    return windows.format_windows(panes.read_windows(spark, f"{base}/out", keys=["event_type"]), ["count"], ["event_type"])


def warehouse_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Decoded page views appended to a file-backed connector in two
    deliveries, every batch written twice as after a failure. Each row is there once."""
    base = scratch_path(spark, "warehouse_replay")
    ev = A.events(spark, sf)
    writer = writers.connector_batch_writer("parquet", {"path": f"{base}/out"})

    def twice(batch: DataFrame, batch_id: int) -> None:
        writer(batch, batch_id)
        writer(batch, batch_id)

    def run(stream: DataFrame) -> None:
        records = page_view_payload_stateless(A.page_view_columns(stream))
        run_until_done(writers.for_each_batch(decoded_page_views(records), twice, f"{base}/ck", trigger="availableNow"))

    _deliver(_slices(ev, 2), f"{base}/in", run)
    return spark.read.parquet(f"{base}/out").groupBy("method", "page").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("offset").alias("n_offsets"),
        F.count_distinct("batch_id").alias("n_batches"))


DELIVERY_QUERIES = {f.__name__: f for f in (
    stream_hourly_attempts, redelivered_offsets, keyed_upserts, snapshot_versions, committed_lines,
    stream_pane_windows, warehouse_replay)}

_HALF = "(SELECT epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) // 2 FROM events)"

DELIVERY_SQL = {
    "stream_hourly_attempts": f"""
WITH events AS (
  SELECT * REPLACE (CASE event_id % 6 WHEN 0 THEN 1 WHEN 3 THEN NULL ELSE user_id END AS user_id) FROM main.events),
{pv_cte(GAP, neighbours=True)}
SELECT user_id, event_id, epoch_us(ts) AS ts_us, session_id, item_in_session, auth = 'Logged In' AS success, level, tag
FROM pv WHERE previous_page = 'Login'""",
    # late: not after the watermark, ten minutes behind the first delivery
    "redelivered_offsets": f"""
WITH f AS (SELECT epoch_us(ts) AS us FROM events WHERE epoch_us(ts) < {_HALF}),
m AS (SELECT max(us) // 1000 * 1000 - 600000000 AS mark FROM f)
SELECT 'page_view_events' AS topic, (SELECT count(*) FROM events) AS n,
       (SELECT count(*) FROM (SELECT DISTINCT event_id FROM events)) AS n_offsets,
       (SELECT count(*) FROM events) + (SELECT count(*) FROM f) AS rows_in,
       (SELECT count(*) FROM f, m WHERE us <= mark) AS late, (SELECT count(*) FROM f, m WHERE us > mark) AS duplicates""",
    "keyed_upserts": """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                        ORDER BY ts DESC, event_id DESC, value DESC) AS k FROM events)
SELECT user_id, event_type, epoch_us(ts) AS ts_us, event_id, value FROM r
WHERE k = 1 AND epoch_us(ts) >= (SELECT epoch_us(max(ts)) FROM events) - 7 * 86400000000""",
    "committed_lines": f"""
SELECT event_id, event_type, count(*) AS n, count(*) FILTER (WHERE epoch_us(ts) >= {_HALF}) AS n_later
FROM events GROUP BY event_id, event_type""",
    "stream_pane_windows": """
SELECT strftime(make_timestamp(ws * 1000000), '%Y-%m-%d %H:%M:%S') AS timestamp_minute,
       CAST(ws AS BIGINT) AS unix_timestamp, event_type, count(*) AS count
FROM (SELECT event_type, unnest(range(epoch_us(ts) // 10000000 * 10 - 50, epoch_us(ts) // 10000000 * 10 + 10, 10)) AS ws
      FROM events)
GROUP BY ws, event_type""",
    "warehouse_replay": f"""
WITH {pv_cte()}
SELECT method, page, count(*) AS n, count(DISTINCT event_id) AS n_offsets,
       count(DISTINCT epoch_us(ts) < {_HALF}) AS n_batches
FROM pv GROUP BY method, page""",
    "snapshot_versions": f"""
SELECT event_type, count(*) AS n, nullif(count(*) FILTER (WHERE epoch_us(ts) < {_HALF}), 0) AS n_pinned
FROM events GROUP BY event_type""",
}
