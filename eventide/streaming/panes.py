"""Sliding counts of a stream kept as panes.

Spark's sliding window puts a row into length / slide windows, and its state, its
output and every update of it are that many times larger. Here the stream counts
slide-wide panes: one state row per pane and key. The sink holds the last version of
each pane, and windows are added up from panes when they are read, for any length
that the slide divides.

A row is late for the native window once the watermark has passed the last
window that covers it; its pane closes length - slide earlier. So the pane's watermark
waits that much longer, and no row that a native window would count is lost. A native
window counts a late row in its open windows only; panes count it in all or none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import windows
from ..sinks import writers


def pane_counts(stream: DataFrame, ts_col: str = "ts", length: str = "60 seconds", slide: str = "10 seconds",
                delay: str = "60 seconds", keys: list[str] | None = None) -> DataFrame:
    """Update-mode stream of (pane, keys, n); ``pane`` is epoch / slide."""
    L, S, D = (windows._seconds(x) for x in (length, slide, delay))
    if L % S:
        raise ValueError(f"{slide} does not divide {length}")
    marked = windows.with_watermark(stream, ts_col, f"{D + L - S} seconds")
    counts = windows.tumbling_count(marked, ts_col, slide, keys)
    pane = F.floor(F.unix_micros("window.start") / F.lit(S * 1_000_000))
    return counts.select(pane.alias("pane"), *(keys or []), F.col("count").alias("n"))


def write_panes(panes: DataFrame, path: str, checkpoint: str, trigger: str | None = "30 seconds",
                query_name: str | None = None) -> StreamingQuery:
    """Pane versions of batch N go to ``batch_id=N``; a batch that runs again replaces its own."""
    return writers.for_each_batch(panes, writers.idempotent_batch_writer(path), checkpoint, mode="update",
                                  trigger=trigger, query_name=query_name)


def read_panes(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """The last version of every pane. Counts only grow, so the largest is the last."""
    stored = spark.read.parquet(path)
    return stored.groupBy("pane", *(keys or [])).agg(F.max("n").alias("n"))


def read_windows(spark: SparkSession, path: str, length: str = "60 seconds", slide: str = "10 seconds",
                 keys: list[str] | None = None) -> DataFrame:
    """Sliding counts of any ``length`` that the panes' slide divides."""
    return windows.windows_of_panes(read_panes(spark, path, keys), length, slide, keys, "pane", "n")
