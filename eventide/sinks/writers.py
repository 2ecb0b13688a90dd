"""Sinks, tables and stream control.

Stream writers always take an explicit path/table and checkpoint location
(one checkpoint per query). ``foreachBatch`` writers are idempotent by
batch id: a replayed batch overwrites its own output instead of appending
twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S


def _trigger(w, trigger: str | None):
    if trigger in (None, "availableNow"):
        return w.trigger(availableNow=True)
    if trigger == "once":
        return w.trigger(once=True)
    return w.trigger(processingTime=trigger)


def write_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 mode: str = "append", trigger: str | None = "1 minute",
                 partition_by: list[str] | None = None, query_name: str | None = None,
                 options: dict | None = None) -> StreamingQuery:
    """A stream into files (parquet by default; ``delta``
    when that package is present). File sinks take append mode only."""
    if not path or not checkpoint:
        raise ValueError("a stream sink needs both a path and a checkpoint location")
    w = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start(path)


def start_per_topic(streams: dict[str, DataFrame], base_path: str, base_checkpoint: str,
                    **kw) -> list[StreamingQuery]:
    """B2 (S6): one query per topic, each with its own output folder and
    checkpoint; all are started before any is awaited."""
    return [write_stream(df, f"{base_path}/{t}", f"{base_checkpoint}/{t}", **kw)
            for t, df in streams.items()]


def await_any(spark: SparkSession, timeout_s: float | None = None) -> None:
    spark.streams.awaitAnyTermination(timeout_s)


def idempotent_batch_writer(path: str, fmt: str = "parquet", options: dict | None = None,
                            partition_by: list[str] | None = None
                            ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback writing batch N to ``batch_id=N``
    with overwrite, so a batch replayed after a failure replaces its own
    output instead of duplicating it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite").format(fmt)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(f"{path}/batch_id={batch_id}")
    return write


FILE_FORMATS = {"parquet", "orc", "json", "csv", "avro"}


def connector_batch_writer(fmt: str, options: dict | None = None, mode: str = "append",
                           replay: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback for a connector addressed by options
    (a warehouse table, a key-value store table with ``keyspace``/``ttl``).
    Rows carry a ``batch_id`` column. ``replay`` says what a batch that runs again does:

    ``partition``  replaces the files of its own ``batch_id`` partition (default of file formats)
    ``where``      replaces the rows with its ``batch_id`` (default of ``delta``)
    ``append``     adds its rows again (default of the rest): key the target on
                   ``batch_id`` and the row's key if the connector upserts, or use
                   :class:`eventide.sinks.versions.KeyedTable`

    Batch ids start again with a new checkpoint, so a target belongs to one checkpoint."""
    replay = replay or ("partition" if fmt in FILE_FORMATS else "where" if fmt == "delta" else "append")
    if replay not in ("partition", "where", "append"):
        raise ValueError(f"unknown replay {replay!r}")

    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.withColumn("batch_id", F.lit(batch_id)).write.format(fmt)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        if replay == "partition":
            w = w.mode("overwrite").partitionBy("batch_id").option("partitionOverwriteMode", "dynamic")
        elif replay == "where":
            w = w.mode("overwrite").option("replaceWhere", f"batch_id = {int(batch_id)}")
        else:
            w = w.mode(mode)
        w.save()
    return write


def snapshot_writer(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Each micro-batch replaces the whole output (latest snapshot)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(path)
    return write


def insert_by_name(table: str) -> Callable[[DataFrame, int], None]:
    """B6 (S9): ``foreachBatch`` insert after selecting the table's columns by
    name (an insert itself is positional). Partitions written this way are
    registered in the catalog. If the table is partitioned by ``batch_id``, a
    replayed batch overwrites its own partition; otherwise rows are appended
    and a replay appends them again."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cols = spark.table(table).columns
        if "batch_id" in cols:
            rows = batch.select(*[c for c in cols if c != "batch_id"])
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {int(batch_id)}) "
                      "SELECT * FROM {rows}", rows=rows)
        else:
            batch.select(*cols).write.mode("append").insertInto(table)
    return write


def for_each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                   mode: str = "append", trigger: str | None = "30 seconds",
                   query_name: str | None = None) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` per micro-batch."""
    w = df.writeStream.foreachBatch(fn).outputMode(mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return _trigger(w, trigger).start()


def stop_after(n_batches: int, fn: Callable[[DataFrame, int], None] | None = None):
    """Wrap a batch callback so the query stops itself after N batches.
    Returns ``(callback, holder)``; put the started query in ``holder[0]``."""
    holder: list = [None]
    seen = {"n": 0}

    def cb(batch: DataFrame, batch_id: int) -> None:
        if fn:
            fn(batch, batch_id)
        seen["n"] += 1
        if seen["n"] >= n_batches and holder[0] is not None:
            import threading
            threading.Thread(target=holder[0].stop, daemon=True).start()
    return cb, holder


def to_table(df: DataFrame, table: str, checkpoint: str, mode: str = "append",
             fmt: str = "parquet", trigger: str | None = "1 minute") -> StreamingQuery:
    """Stream into a catalog table. Stream-written partitions are not
    added to the metastore; run :func:`repair` after, or use
    :func:`insert_by_name` in ``foreachBatch``."""
    w = df.writeStream.outputMode(mode).format(fmt).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).toTable(table)


def repair(spark: SparkSession, table: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {table}")


def drain_and_stop(query: StreamingQuery) -> None:
    """Graceful stop: finish the data already available, then stop; the
    checkpoint holds the position, so a restart continues from there
    (``spark.streaming.stopGracefullyOnShutdown`` only applies to DStreams)."""
    query.processAllAvailable()
    query.stop()


def console(df: DataFrame, mode: str = "update", trigger: str | None = "60 seconds",
            truncate: bool = False, num_rows: int = 20) -> StreamingQuery:
    """Print changing aggregates (for people; tests use :func:`memory`)."""
    w = df.writeStream.outputMode(mode).format("console") \
        .option("truncate", str(truncate).lower()).option("numRows", str(num_rows))
    return _trigger(w, trigger).start()


def memory(df: DataFrame, name: str, mode: str = "update") -> StreamingQuery:
    """In-memory table (driver side; bounded test inputs only)."""
    return df.writeStream.outputMode(mode).format("memory").queryName(name) \
        .trigger(availableNow=True).start()


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite",
              compression: str | None = None) -> None:
    """B11 (C16): tab-separated text, tabs inside values replaced by spaces;
    ``compression="gzip"`` for B12."""
    out = df.select(*[F.replace(F.col(c).cast("string"), F.lit("\t"), F.lit("     ")).alias(c)
                      for c in df.columns])
    w = out.write.mode(mode).options(sep="\t", quote="", escape="")
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_gzip_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Gzip-compressed CSV."""
    df.write.mode(mode).option("compression", "gzip").csv(path)


def to_json_lines(df: DataFrame, out: str = "value") -> DataFrame:
    """One JSON object per row; null fields are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(out))


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """Publish JSON lines to files (``write.format('kafka')`` for a broker)."""
    to_json_lines(df).write.mode(mode).text(path)


def retain(df: DataFrame, ts_col: str, keep: str) -> DataFrame:
    """Rows not older than ``keep`` (e.g. '1 day', '30 days') before the
    newest row; the newest time is a scalar subquery."""
    newest = df.agg(F.max(ts_col)).scalar()
    return df.where(F.col(ts_col) >= newest - F.expr(f"INTERVAL {keep}"))


def retain_dates(spark: SparkSession, path: str, out: str, days: int,
                 date_col: str = "date", fmt: str = "parquet") -> None:
    """Rewrite a table that is partitioned by date with its last ``days``
    dates. The limit is on the partition column, so older folders are not read."""
    df = spark.read.format(fmt).load(path)
    newest = df.agg(F.max(date_col)).scalar()
    kept = df.where(F.col(date_col) > F.date_sub(newest, days))
    kept.write.mode("overwrite").format(fmt).partitionBy(date_col).save(out)


def create_topic_table(spark: SparkSession, database: str, table: str, topic: str = S.PAGE_VIEW,
                       fmt: str = "parquet", partition_by: list[str] | None = None,
                       location: str | None = None, drop: bool = False) -> str:
    """``CREATE DATABASE/TABLE IF NOT EXISTS`` for a decoded topic,
    columns from the schema registry (A9). Returns the qualified name."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    name = f"{database}.{table}"
    if drop:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = S.table_ddl_columns(topic)
    part = partition_by or (["method"] if topic == S.PAGE_VIEW else None)
    if part:  # partition columns go last in the table schema
        cols = [c for c in cols if c[0] not in part] + [c for c in cols if c[0] in part]
    body = ",\n  ".join(f"`{n}` {t}" for n, t in cols)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} (\n  {body}\n) USING {fmt}"
    if part:
        ddl += f" PARTITIONED BY ({', '.join(part)})"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)
    return name
