"""Registered stream queries: each runs a real Structured Streaming query
(``availableNow``) over the driver tables into the shared checkpoint folder,
then returns the written result as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import routing, windows
from ..plans import adapters as A
from ..plans.oracle import SQL as BATCH_SQL
from ..plans.oracle import pv_cte
from ..session import scratch_path
from ..sinks import writers
from ..sources.files import read_event_files
from .jobs import events_stream, run_until_done, state_partitions


def _latest_per_key(df: DataFrame, keys: list[str], value_cols: list[str]) -> DataFrame:
    """Update mode re-emits a key per batch: keep the row of the last batch."""
    last = F.max_by(F.struct(*value_cols), F.col("batch_id"))
    return df.groupBy(*keys).agg(last.alias("_v")).select(*keys, "_v.*")


def stream_sliding_count(spark: SparkSession, sf: str) -> DataFrame:
    """The reference's flagship stream, end to end: page-view JSON records
    (produced from events on the stream) are decoded from a Kafka-shaped
    frame (C1-C7), watermarked at 60 s (J1), counted in 60 s / 10 s windows
    (J3) in update mode (B8) through an idempotent per-batch writer (B4,
    J7); the last version of each window wins."""
    from ..plans.queries import page_view_payload_stateless
    from .jobs import decoded_page_views
    base = scratch_path(spark, "stream_sliding_count")
    wire = page_view_payload_stateless(A.page_view_columns(events_stream(spark, sf)))
    decoded = decoded_page_views(wire, with_parts=True)
    ev = windows.with_watermark(decoded.select("ts_timestamp"), "ts_timestamp", "60 seconds")
    agg = windows.sliding_count(ev, "ts_timestamp", "60 seconds", "10 seconds")
    with state_partitions(spark):
        run_until_done(writers.for_each_batch(agg, writers.idempotent_batch_writer(f"{base}/out"),
                                              f"{base}/ck", mode="update",
                                              trigger="availableNow"))
    res = spark.read.parquet(f"{base}/out")
    return windows.format_windows(_latest_per_key(res, ["window"], ["count"]), ["count"])


def stream_tumbling_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly tumbling counts, watermark 10 min, append mode into a
    parquet file sink: only windows closed by the watermark are written."""
    base = scratch_path(spark, "stream_tumbling_closed")
    ev = windows.with_watermark(events_stream(spark, sf).select("ts"), "ts", "10 minutes")
    agg = windows.tumbling_count(ev, "ts", "1 hour")
    with state_partitions(spark):
        run_until_done(writers.write_stream(agg, f"{base}/out", f"{base}/ck", mode="append",
                                            trigger="availableNow"))
    return windows.format_windows(spark.read.parquet(f"{base}/out"), ["count"])


def stream_sessions_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Per-user session windows (30 min gap) on a stream, append mode."""
    base = scratch_path(spark, "stream_sessions_closed")
    ev = windows.with_watermark(events_stream(spark, sf).select("ts", "user_id"),
                                "ts", "30 minutes")
    agg = ev.groupBy(F.session_window("ts", "30 minutes").alias("s"), "user_id") \
        .agg(F.count(F.lit(1)).alias("n_events"))
    with state_partitions(spark, merge_sessions=True):
        run_until_done(writers.write_stream(agg, f"{base}/out", f"{base}/ck", mode="append",
                                            trigger="availableNow"))
    r = spark.read.parquet(f"{base}/out")
    return r.select("user_id", F.unix_micros("s.start").alias("session_start"),
                    F.unix_micros("s.end").alias("session_end"), "n_events")


def stream_distinct_users(spark: SparkSession, sf: str) -> DataFrame:
    """F4 on a stream: de-duplicate (hour window, user) under the watermark,
    then count per window (two chained stateful operators, append mode)."""
    base = scratch_path(spark, "stream_distinct_users")
    ev = windows.with_watermark(events_stream(spark, sf).select("ts", "user_id"),
                                "ts", "10 minutes")
    agg = windows.distinct_per_window(ev, "ts", "user_id", "1 hour", out="users")
    with state_partitions(spark):
        run_until_done(writers.write_stream(agg, f"{base}/out", f"{base}/ck", mode="append",
                                            trigger="availableNow"))
    return windows.format_windows(spark.read.parquet(f"{base}/out"), ["users"])


def stream_to_table(spark: SparkSession, sf: str) -> DataFrame:
    """Page-view JSON records decoded on a stream into a
    catalog table partitioned by ``method`` (created from the schema
    registry), then read back and counted per method and page."""
    from ..plans.queries import page_view_payload_stateless
    from .jobs import decoded_page_views
    base = scratch_path(spark, "stream_to_table")
    pv = A.page_view_columns(events_stream(spark, sf))
    decoded = decoded_page_views(page_view_payload_stateless(pv))
    name = writers.create_topic_table(spark, "eventide_stream",
                                      "page_views_" + base.rsplit("/", 1)[-1][:12],
                                      location=f"{base}/table")
    cols = spark.table(name).columns
    q = writers.to_table(decoded.select(*cols), name, f"{base}/ck", trigger="availableNow")
    run_until_done(q)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    t = spark.read.parquet(f"{base}/table")
    return t.groupBy("method", "page").agg(F.count(F.lit(1)).alias("n"))


def foreach_batch_append(spark: SparkSession, sf: str) -> DataFrame:
    """Events appended through the idempotent per-batch writer;
    the same batch is then replayed once (as after a failure) and the result
    still has each row once."""
    base = scratch_path(spark, "foreach_batch_append")
    writer = writers.idempotent_batch_writer(f"{base}/out")
    seen = []

    def write_twice(batch, batch_id):
        writer(batch, batch_id)
        if not seen:  # replay the first batch: overwrite, not duplicate
            seen.append(batch_id)
            writer(batch, batch_id)

    ev = events_stream(spark, sf).select("event_id", "event_type")
    run_until_done(writers.for_each_batch(ev, write_twice, f"{base}/ck", trigger="availableNow"))
    r = spark.read.parquet(f"{base}/out")
    return r.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                       F.count_distinct("event_id").alias("n_distinct"))


def stream_auth_attempts(spark: SparkSession, sf: str) -> DataFrame:
    """G5 G2 J6 D3 on a stream: the events stream, mapped to page views
    row by row, is sessionized and followed page by page in per-user state;
    login attempts come out once the watermark has passed them."""
    from .stateful import sessionized_auth_attempts_stream
    base = scratch_path(spark, "stream_auth_attempts")
    pv = A.page_view_columns(events_stream(spark, sf)).withWatermark("ts", "30 minutes")
    out = sessionized_auth_attempts_stream(
        pv, out_cols=["event_id", "ts", "user_id", "level", "tag"])
    with state_partitions(spark):
        run_until_done(writers.write_stream(out, f"{base}/out", f"{base}/ck", mode="append",
                                            trigger="availableNow"))
    r = spark.read.parquet(f"{base}/out")
    return r.select("event_id", F.unix_micros("ts").alias("ts_us"), "session_id",
                    "item_in_session", "level", "user_id", "tag", "success")


def event_files_late(spark: SparkSession, sf: str) -> DataFrame:
    """JSON event files, one folder per topic, read as a stream that
    stops and goes on. Login pages arrive in a second delivery, after the
    watermark (10 min behind the newest row) has moved on: they count where
    their hour is still open and are dropped where it is closed. Returns the
    counts per hour and how many rows came too late for it."""
    from ..plans.queries import page_view_payload_stateless
    base = scratch_path(spark, "event_files_late")
    folder = f"{base}/{S.PAGE_VIEW}"
    pv = A.page_view_columns(A.events(spark, sf))
    login = F.coalesce(F.col("page") == "Login", F.lit(False))

    def rows(stream: bool) -> DataFrame:
        return read_event_files(spark, folder, S.PAGE_VIEW, stream=stream) \
            .select(F.timestamp_millis("ts").alias("ts"))

    for delivery in (~login, login):
        page_view_payload_stateless(pv.where(delivery)).select(F.col("value").cast("string")) \
            .write.mode("append").text(folder)
        agg = windows.tumbling_count(windows.with_watermark(rows(True), "ts", "10 minutes"), "ts", "1 hour")
        with state_partitions(spark):
            run_until_done(writers.for_each_batch(agg, writers.idempotent_batch_writer(f"{base}/out"),
                                                  f"{base}/ck", mode="update", trigger="availableNow"))
    counted = _latest_per_key(spark.read.parquet(f"{base}/out"), ["window"], ["count"])
    sent = windows.tumbling_count(rows(False), "ts", "1 hour").withColumnRenamed("count", "sent")
    both = sent.join(counted, "window", "left").withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
    return windows.format_windows(both.withColumn("n_late", F.col("sent") - F.col("count")), ["count", "n_late"])


def topic_files(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records of three topics, each copied by its own query with
    its own checkpoint into its own folder; every query is drained and stopped."""
    from ..plans.queries import page_view_payload_stateless
    base = scratch_path(spark, "topic_files")
    pv = A.page_view_columns(events_stream(spark, sf))
    wire = {S.PAGE_VIEW: pv, S.LISTEN: routing.listens(pv, drop=()),
            S.STATUS_CHANGE: routing.status_changes(pv, drop=())}
    streams = {t: page_view_payload_stateless(df).withColumn("topic", F.lit(t)) for t, df in wire.items()}
    for q in writers.start_per_topic(streams, f"{base}/raw", f"{base}/ck", trigger="1 second"):
        writers.drain_and_stop(q)
    out = None
    for t in streams:
        n = spark.read.parquet(f"{base}/raw/{t}").groupBy("topic").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("offset").alias("n_offsets"))
        out = n if out is None else out.unionByName(n)
    return out


def stream_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Running counts per event type in complete mode; each micro-batch
    replaces the snapshot."""
    base = scratch_path(spark, "stream_snapshot")
    agg = events_stream(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    with state_partitions(spark):
        run_until_done(writers.for_each_batch(agg, writers.snapshot_writer(f"{base}/now"), f"{base}/ck",
                                              mode="complete", trigger="availableNow"))
    return spark.read.parquet(f"{base}/now")


def insert_by_name_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Events inserted by name into a catalog table per micro-batch; each
    batch is sent twice, as after a failure, and stays once."""
    base = scratch_path(spark, "insert_by_name_replay")
    name = "eventide_stream.events_" + base.rsplit("/", 1)[-1][:12]
    spark.sql("CREATE DATABASE IF NOT EXISTS eventide_stream")
    spark.sql(f"CREATE TABLE {name} (event_type STRING, event_id BIGINT, batch_id BIGINT) USING parquet "
              f"PARTITIONED BY (batch_id) LOCATION '{base}/table'")
    insert = writers.insert_by_name(name)

    def twice(batch, batch_id):
        insert(batch, batch_id)
        insert(batch, batch_id)

    ev = events_stream(spark, sf).select("event_id", "event_type")
    run_until_done(writers.for_each_batch(ev, twice, f"{base}/ck", trigger="availableNow"))
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    t = spark.read.parquet(f"{base}/table")
    return t.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))


STREAM_QUERIES = {
    "stream_sliding_count": stream_sliding_count,
    "stream_tumbling_closed": stream_tumbling_closed,
    "stream_sessions_closed": stream_sessions_closed,
    "stream_distinct_users": stream_distinct_users,
    "stream_to_table": stream_to_table,
    "foreach_batch_append": foreach_batch_append,
    "stream_auth_attempts": stream_auth_attempts,
    "event_files_late": event_files_late,
    "topic_files": topic_files,
    "stream_snapshot": stream_snapshot,
    "insert_by_name_replay": insert_by_name_replay,
}

_CLOSED_HOUR = """
SELECT strftime(make_timestamp(ws * 3600000000), '%Y-%m-%d %H:%M:%S') AS timestamp_minute,
       CAST(ws * 3600 AS BIGINT) AS unix_timestamp, {agg}
FROM (SELECT epoch_us(ts) // 3600000000 AS ws, user_id FROM events)
GROUP BY ws
HAVING (ws + 1) * 3600000000 <= (SELECT epoch_us(max(ts)) FROM events) - 600000000"""

STREAM_SQL = {
    "stream_sliding_count": BATCH_SQL["sliding_count"],
    "stream_tumbling_closed": _CLOSED_HOUR.format(agg="count(*) AS count"),
    "stream_distinct_users": _CLOSED_HOUR.format(agg="count(DISTINCT user_id) AS users"),
    "stream_sessions_closed": f"""
WITH {pv_cte()}
SELECT user_id, epoch_us(min(ts)) AS session_start,
       epoch_us(max(ts)) + 1800000000 AS session_end, count(*) AS n_events
FROM pv GROUP BY user_id, session_id
HAVING epoch_us(max(ts)) + 1800000000 <= (SELECT epoch_us(max(ts)) FROM events) - 1800000000""",
    "stream_to_table": f"""
WITH {pv_cte()}
SELECT method, page, count(*) AS n FROM pv GROUP BY 1, 2""",
    "foreach_batch_append": """
SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS n_distinct
FROM events GROUP BY 1""",
    # an hour is closed once the watermark of the first delivery has reached its end
    "event_files_late": f"""
WITH {pv_cte()},
m AS (SELECT max(epoch_us(ts) // 1000) * 1000 - 600000000 AS mark FROM pv WHERE page IS DISTINCT FROM 'Login'),
w AS (SELECT epoch_us(ts) // 3600000000 AS ws, page IS NOT DISTINCT FROM 'Login'
             AND (epoch_us(ts) // 3600000000 + 1) * 3600000000 <= mark AS late FROM pv, m)
SELECT strftime(make_timestamp(ws * 3600000000), '%Y-%m-%d %H:%M:%S') AS timestamp_minute,
       CAST(ws * 3600 AS BIGINT) AS unix_timestamp, count(*) FILTER (WHERE NOT late) AS count,
       count(*) FILTER (WHERE late) AS n_late
FROM w GROUP BY ws""",
    "topic_files": f"""
WITH {pv_cte()},
t AS (SELECT 'page_view_events' AS topic, event_id FROM pv
      UNION ALL SELECT 'listen_events', event_id FROM pv WHERE page = 'NextSong'
      UNION ALL SELECT 'status_change_events', event_id FROM pv
                WHERE page IN ('Submit Downgrade', 'Submit Upgrade'))
SELECT topic, count(*) AS n, count(DISTINCT event_id) AS n_offsets FROM t GROUP BY 1""",
    "stream_snapshot": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "insert_by_name_replay": """
SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1""",
    # rows are followed once the watermark has passed them
    "stream_auth_attempts": f"""
SELECT * FROM ({BATCH_SQL["auth_attempts"]}) AS a
WHERE ts_us <= ((SELECT epoch_us(max(ts)) FROM events) // 1000 - 1800000) * 1000""",
}
