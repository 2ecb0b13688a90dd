"""Stream pipelines: source -> decode -> event time -> window -> sink.

These are the reference's stream jobs as functions. Bounded runs use the
``availableNow`` trigger; long-running ones take a processing-time trigger.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.decode import decode_topic, date_parts
from ..operators import windows
from ..sinks import writers


def events_stream(spark: SparkSession, sf_dir: str, max_files: int = 1000) -> DataFrame:
    """The driver's events table read as a file stream (a glob, as a file
    stream source watches a folder), ``ts`` as TIMESTAMP. ``max_files`` bounds
    a micro-batch."""
    src = spark.readStream.schema(S.EVENTS_SCHEMA).option("maxFilesPerTrigger", str(max_files)).parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")
    return src.withColumn("ts", F.col("ts").cast("timestamp"))


def decoded_page_views(kafka_rows: DataFrame, with_parts: bool = False) -> DataFrame:
    """Kafka-shaped page-view rows -> decoded table."""
    d = decode_topic(kafka_rows, S.get_schema(S.PAGE_VIEW, with_tag=True))
    return date_parts(d) if with_parts else d


def windowed_count_job(decoded: DataFrame, length: str = "60 seconds",
                       slide: str = "10 seconds", delay: str = "60 seconds",
                       ts_col: str = "ts_timestamp") -> DataFrame:
    """The notebook query: watermark, sliding count, formatted start."""
    w = windows.with_watermark(decoded, ts_col, delay)
    return windows.format_windows(windows.sliding_count(w, ts_col, length, slide))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None, rocksdb: bool = False,
                     merge_sessions: bool = False):
    """Start a stateful stream with ``n`` state partitions (default: the
    cluster's cores). The count is fixed in the query's checkpoint at its
    first start, so the session setting is restored right after; AQE cannot
    coalesce stateful stages, so the batch default (often 200) would mean
    200 state-store tasks per operator per micro-batch. ``rocksdb`` picks that
    state store also in a session built elsewhere (list, map and timer state need it).
    ``merge_sessions`` merges session windows before their shuffle, so a hot key's rows of a task
    leave it as a few sessions."""
    n = n or spark.sparkContext.defaultParallelism
    want = {"spark.sql.shuffle.partitions": str(n)}
    if rocksdb:
        want["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
    if merge_sessions:
        want["spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"] = "true"
    old = {k: spark.conf.get(k, None) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_until_done(query) -> None:
    """Wait for a bounded (availableNow) query and surface its error."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def bronze_copy(kafka_rows: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                trigger: str | None = "1 minute"):
    """B1: raw topic rows, undecoded, appended to a lake folder."""
    return writers.write_stream(kafka_rows, path, checkpoint, fmt=fmt, mode="append",
                                trigger=trigger)


def decode_to_files_job(kafka_rows: DataFrame, path: str, checkpoint: str,
                        fmt: str = "parquet", trigger: str | None = "1 minute",
                        partition_by: list[str] | None = None):
    """Decoded page views appended to files (the file-sink stream job)."""
    return writers.write_stream(decoded_page_views(kafka_rows), path, checkpoint, fmt=fmt,
                                mode="append", trigger=trigger, partition_by=partition_by)


def decode_to_table_job(kafka_rows: DataFrame, database: str, table: str, checkpoint: str,
                        fmt: str = "parquet", trigger: str | None = "1 minute",
                        location: str | None = None):
    """Decoded page views streamed into a catalog table partitioned by
    ``method``; the table is created from the schema registry if absent and
    columns are matched by name."""
    spark = kafka_rows.sparkSession
    name = writers.create_topic_table(spark, database, table, fmt=fmt, location=location)
    cols = spark.table(name).columns
    return writers.to_table(decoded_page_views(kafka_rows).select(*cols), name, checkpoint,
                            fmt=fmt, trigger=trigger)


def decode_to_warehouse_job(kafka_rows: DataFrame, fmt: str, options: dict, checkpoint: str,
                            trigger: str | None = "30 seconds"):
    """Decoded page views appended to a warehouse connector per micro-batch,
    with the batch id in the rows for idempotent loads."""
    return writers.for_each_batch(decoded_page_views(kafka_rows),
                                  writers.connector_batch_writer(fmt, options), checkpoint,
                                  trigger=trigger)


def start_all_topics(kafka_rows: DataFrame, base_path: str, base_checkpoint: str,
                     trigger: str | None = "1 minute"):
    """One subscription, four decoded topic streams, each into its own folder
    with its own checkpoint (all started, then awaited together)."""
    from ..sources.kafka import split_topics
    streams = {t: decode_topic(df, S.get_schema(t, with_tag=True))
               for t, df in split_topics(kafka_rows).items()}
    return writers.start_per_topic(streams, base_path, base_checkpoint, trigger=trigger)
