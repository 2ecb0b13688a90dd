"""Kafka topics as (streaming) DataFrames (A1-A3).

The Kafka connector jar is not bundled with PySpark; these readers build the
same options and fail with Spark's own message when it is missing. Every
downstream operator takes a Kafka-*shaped* DataFrame (see
:data:`eventide.schemas.KAFKA_SCHEMA`), so files with that layout stand in
for a broker in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S


def kafka_options(bootstrap: str, topics: list[str] | str,
                  starting_offsets: str | None = None, **extra: str) -> dict[str, str]:
    """A1/A2/A3: options for one topic or several (comma list)."""
    opts = {"kafka.bootstrap.servers": bootstrap,
            "subscribe": topics if isinstance(topics, str) else ",".join(topics)}
    if starting_offsets:
        opts["startingOffsets"] = starting_offsets
    opts.update(extra)
    return opts


def read_kafka(spark: SparkSession, bootstrap: str, topics: list[str] | str,
               starting_offsets: str | None = None, stream: bool = True,
               **extra: str) -> DataFrame:
    """A1: subscribe to one or more topics (stream by default)."""
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**kafka_options(
        bootstrap, topics, starting_offsets, **extra)).load()


def split_topics(df: DataFrame, topics: list[str] | None = None) -> dict[str, DataFrame]:
    """A3: one subscription to all topics, one DataFrame per topic (a filter
    on the ``topic`` column; no extra scan)."""
    return {t: df.where(F.col("topic") == t) for t in (topics or S.TOPICS)}


def read_kafka_shaped(spark: SparkSession, path: str, stream: bool = False,
                      fmt: str = "parquet", max_files_per_trigger: int | None = None
                      ) -> DataFrame:
    """Files with the Kafka row layout (a broker stand-in)."""
    r = (spark.readStream if stream else spark.read).format(fmt).schema(S.KAFKA_SCHEMA)
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def to_kafka_shape(df: DataFrame, topic: str, value_col: str = "value",
                   key_col: str | None = None, partitions: int = 5,
                   offset_col: str | None = None, ts_col: str | None = None) -> DataFrame:
    """Give any rows with a JSON text ``value`` the Kafka layout: binary key
    and value, topic, a partition from the key hash, an offset."""
    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    part = F.pmod(F.hash(key), F.lit(partitions)) if key_col else F.lit(0)
    off = F.col(offset_col).cast("long") if offset_col else F.monotonically_increasing_id()
    ts = F.col(ts_col).cast("timestamp") if ts_col else F.current_timestamp()
    return df.select(key.cast("binary").alias("key"), F.col(value_col).cast("binary").alias("value"),
                     F.lit(topic).alias("topic"), part.cast("int").alias("partition"),
                     off.alias("offset"), ts.alias("timestamp"),
                     F.lit(0).alias("timestampType"))
