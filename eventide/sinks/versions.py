"""Versioned tables: atomic snapshots (B3) and a keyed table with row expiry.

A version is a set of folders that no later write touches. What makes it visible is one
small file, the pointer, written last: under a temporary name, then renamed over the
old one in a single step of the file system. A reader takes the pointer once and reads the folders it
names, so it sees one version whole, however long it reads and whatever is written
meanwhile. A write that fails leaves the pointer, and so every reader, where it was.
The pointer goes through Hadoop's file system API, so any store that Spark can write to will do.

One writer per table is assumed, as one streaming query writes it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "_CURRENT"


def _jvm_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def read_pointer(spark: SparkSession, path: str) -> dict | None:
    """What the pointer of the table at ``path`` says; None before the first commit."""
    jvm, p, fs = _jvm_path(spark, f"{path}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit_pointer(spark: SparkSession, path: str, what: dict) -> None:
    """Write the pointer beside its place and rename it over the old one."""
    jvm, target, fs = _jvm_path(spark, f"{path}/{POINTER}")
    temp = jvm.org.apache.hadoop.fs.Path(f"{path}/.{POINTER}-{uuid.uuid4().hex}")
    stream = fs.create(temp, False)
    try:
        stream.write(bytearray(json.dumps(what).encode()))
    finally:
        stream.close()
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    files.rename(fs.makeQualified(temp), fs.makeQualified(target), overwrite)


def atomic_snapshot_writer(path: str, fmt: str = "parquet", keep: int = 3) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback; each micro-batch becomes the next snapshot. A
    replayed batch that is already committed is left alone. Snapshots that fell more than ``keep`` commits
    behind are deleted; a reader of one of the last ``keep`` is not disturbed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = read_pointer(spark, path)
        if now and now["batch_id"] >= batch_id:
            return
        folder = f"v{batch_id}-{uuid.uuid4().hex[:8]}"  # a failed try's folder is not met again
        batch.write.format(fmt).save(f"{path}/{folder}")
        past = ([now["folder"], *now["past"]] if now else [])
        commit_pointer(spark, path, {"batch_id": batch_id, "folder": folder, "past": past[:keep]})
        for old in past[keep:]:
            _, p, fs = _jvm_path(spark, f"{path}/{old}")
            fs.delete(p, True)
    return write


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """The snapshot the pointer names now; the frame stays on it. An empty table (``schema``
    is then needed) before the first commit."""
    now = read_pointer(spark, path)
    if now is None:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).load(f"{path}/{now['folder']}")


class KeyedTable:
    """One row per key: the newest version, unless it has expired.

    Rows are dealt to ``buckets`` by a hash of the key. Merging a micro-batch reads and
    rewrites only the buckets that it touches; the pointer then names, for every bucket, the
    commit whose folder holds it. So a merge costs in proportion to the touched buckets, which is
    why their number should grow with the table (about 128 MB each).

    The newest version is the greatest ``version`` column, ties by all columns, so that a late older version
    never replaces a newer one and a replayed batch changes nothing. With ``ttl``, a row
    whose ``version`` (a timestamp) lies more than that before the newest one in the table
    has expired: reads leave it out, merges drop it from the buckets they rewrite, and
    :meth:`expire` rewrites the others. An expired key may come back with a newer version.

    Null keys are keys; rows without a version are older than all others.
    """

    def __init__(self, path: str, keys: list[str], version: str, buckets: int, ttl: str | None = None,
                 fmt: str = "parquet"):
        if ttl and not re.fullmatch(r"\d+ \w+", ttl):
            raise ValueError(f"not an interval: {ttl!r}")
        self.path, self.keys, self.version, self.buckets, self.ttl, self.fmt = path, keys, version, buckets, ttl, fmt

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _newest(self, df: DataFrame) -> DataFrame:
        """One row per key, by a partial aggregate: a hot key is combined map-side."""
        rest = [c for c in df.columns if c not in self.keys]
        order = F.struct(F.col(self.version), *[F.col(c) for c in rest if c != self.version])
        keys = [F.struct(F.col(k).alias("k")).alias(k) for k in self.keys]  # null equals null
        return (df.select(*keys, F.struct(*rest).alias("_v"), order.alias("_o")).groupBy(*self.keys)
                .agg(F.max_by("_v", "_o").alias("_v"))
                .select(*[F.col(f"{k}.k").alias(k) for k in self.keys], "_v.*").select(*df.columns))

    def _alive(self, df: DataFrame, newest_us: int | None) -> DataFrame:
        if not self.ttl or newest_us is None:
            return df
        limit = F.timestamp_micros(F.lit(newest_us)) - F.expr(f"INTERVAL {self.ttl}")
        return df.where(F.col(self.version).cast("timestamp") >= limit)

    def _folders(self, now: dict | None, only: set[int] | None = None) -> list[str]:
        held = (now or {}).get("buckets", {})
        return [f"{self.path}/{folder}/_bucket={b}" for b, folder in sorted(held.items())
                if only is None or int(b) in only]

    def _load(self, spark: SparkSession, now: dict | None, columns: list[str], schema, only: set[int] | None = None) -> DataFrame:
        folders = self._folders(now, only)
        if not folders:
            return spark.createDataFrame([], schema).select(*columns)
        return spark.read.format(self.fmt).schema(schema).load(folders).select(*columns)

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` callback."""
        spark = batch.sparkSession
        now = read_pointer(spark, self.path)
        if now and now["batch_id"] >= batch_id:
            return
        columns = batch.columns
        schema = T.StructType.fromJson(now["schema"]) if now else batch.schema
        fresh = self._newest(batch)
        folder = f"c{batch_id}-{uuid.uuid4().hex[:8]}"
        # the batch's own newest rows, written once: the merge and the bucket list read them
        stage = f"{self.path}/{folder}/incoming"
        fresh.withColumn("_bucket", self._bucket()).write.format(self.fmt).save(stage)
        fresh = spark.read.format(self.fmt).load(stage)
        seen = fresh.agg(F.collect_set("_bucket").alias("b"), F.max(F.unix_micros(F.col(self.version).cast("timestamp"))).alias("t")
                         if self.ttl else F.lit(None).alias("t")).first()  # at most ``buckets`` numbers
        touched = set(seen["b"])
        newest = max((t for t in (seen["t"], (now or {}).get("newest_us")) if t is not None), default=None)
        if touched:
            both = fresh.select(*columns).unionByName(self._load(spark, now, columns, schema, touched))
            out = self._alive(self._newest(both), newest).withColumn("_bucket", self._bucket())
            (out.repartition(len(touched), "_bucket").write.format(self.fmt).partitionBy("_bucket")
             .save(f"{self.path}/{folder}/data"))
        self._commit(spark, now, batch_id, f"{folder}/data", touched, newest, schema)
        _, p, fs = _jvm_path(spark, stage)  # no version names it
        fs.delete(p, True)

    def expire(self, spark: SparkSession) -> None:
        """Rewrite all buckets without their expired rows."""
        now = read_pointer(spark, self.path)
        if now is None or not self.ttl or not now["buckets"]:
            return
        schema = T.StructType.fromJson(now["schema"])
        alive = self._alive(self._load(spark, now, schema.names, schema), now["newest_us"])
        folder = f"c{now['batch_id']}-{uuid.uuid4().hex[:8]}"
        (alive.withColumn("_bucket", self._bucket()).repartition(len(now["buckets"]), "_bucket").write.format(self.fmt)
         .partitionBy("_bucket").save(f"{self.path}/{folder}/data"))
        self._commit(spark, now, now["batch_id"], f"{folder}/data", {int(b) for b in now["buckets"]}, now["newest_us"], schema)

    def _commit(self, spark, now, batch_id, folder, touched, newest, schema) -> None:
        held = dict((now or {}).get("buckets", {}))
        for b in touched:  # a bucket whose rows have all expired has no folder
            _, p, fs = _jvm_path(spark, f"{self.path}/{folder}/_bucket={b}")
            held.pop(str(b), None)
            if fs.exists(p):
                held[str(b)] = folder
        commit_pointer(spark, self.path, {"batch_id": batch_id, "buckets": held, "newest_us": newest,
                                          "schema": schema.jsonValue()})

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        """The committed rows that have not expired, as of now."""
        now = read_pointer(spark, self.path)
        if now is None:
            return spark.createDataFrame([], schema)
        held = T.StructType.fromJson(now["schema"])
        return self._alive(self._load(spark, now, held.names, held), now["newest_us"])

