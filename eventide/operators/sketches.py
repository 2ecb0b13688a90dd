"""Distinct counts kept as stored, mergeable pieces per time pane.

A pane is the part of the time line that one slide of a window covers. What is
stored per pane is merged for any longer stretch: a sliding window, an hour, a day.

* Sketches (F3): a HyperLogLog sketch per pane, a few bytes for small sets and at most
  2^lg_k registers of 6 bits, merged by union. Estimates of small sets are exact (the sketch then
  holds the hashes themselves); larger ones have a standard error of about 0.8 / sqrt(2^lg_k).
* Bitmaps (F4): one bit per integer key, in buckets of 32,768 keys, merged by OR. Counts are exact.
  Keys outside integers need a dictionary first.

Rows without a time are in no pane; null keys are not counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .windows import _seconds

LG_K = 14


def pane_of(ts_col: str, pane: str):
    """Number of the pane since the epoch."""
    return F.floor(F.unix_micros(F.col(ts_col).cast("timestamp")) / F.lit(_seconds(pane) * 1_000_000)).cast("long")


def sketch_panes(df: DataFrame, ts_col: str, key: str, pane: str, lg_k: int = LG_K) -> DataFrame:
    """pane, sketch: to be written, and appended to as time goes on."""
    return (df.where(F.col(ts_col).isNotNull()).groupBy(pane_of(ts_col, pane).alias("pane"))
            .agg(F.hll_sketch_agg(key, lg_k).alias("sketch")))


def sliding_estimates(panes: DataFrame, pane: str, length: str, out: str = "users") -> DataFrame:
    """start (timestamp), estimate per sliding window (its slide is the pane): each
    pane's sketch joins the windows that cover it; rows are panes, not events."""
    k, width = _seconds(length) // _seconds(pane), _seconds(pane) * 1_000_000
    fan = panes.select("sketch", F.explode(F.sequence(F.col("pane") - (k - 1), F.col("pane"))).alias("w"))
    return (fan.groupBy("w").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out))
            .select(F.timestamp_micros(F.col("w") * F.lit(width)).alias("start"), out))


def rollup_estimates(panes: DataFrame, pane: str, unit: str, out: str = "users") -> DataFrame:
    """start, estimate per ``unit`` (day, hour, ...) from the stored panes."""
    at = F.date_trunc(unit, F.timestamp_micros(F.col("pane") * F.lit(_seconds(pane) * 1_000_000)))
    return (panes.groupBy(at.alias("start"))
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(out)))


def bitmap_panes(df: DataFrame, ts_col: str, key: str, pane: str) -> DataFrame:
    """pane, bucket, bits: a bitmap of 32,768 keys per pane and key range."""
    k = F.col(key).cast("long")
    return (df.where(F.col(ts_col).isNotNull() & k.isNotNull())
            .groupBy(pane_of(ts_col, pane).alias("pane"), F.bitmap_bucket_number(k).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("bits")))


def sliding_distinct(panes: DataFrame, pane: str, length: str, out: str = "users", segment: int = 512) -> DataFrame:
    """start, exact distinct keys per sliding window, from stored bitmap panes.

    The line of panes is cut into segments of ``segment`` panes; only the first panes of a segment,
    which windows of the one before also cover, are copied. In a (segment, bucket) every
    window start is one narrow row, and a range frame ORs the bitmaps of its panes, so
    neither events nor bitmaps are copied once per window. A segment's rows are bounded by its panes,
    whatever the number of events."""
    k, width = _seconds(length) // _seconds(pane), _seconds(pane) * 1_000_000
    seg = lambda c: F.floor(c / F.lit(segment)).cast("long")
    held = panes.select("pane", "bucket", "bits", F.explode(F.array_distinct(
        F.array(seg(F.col("pane")), seg(F.col("pane") - (k - 1))))).alias("seg"))
    starts = (panes.select("bucket", F.explode(F.sequence(F.col("pane") - (k - 1), F.col("pane"))).alias("pane"))
              .distinct().select("pane", "bucket", F.lit(None).cast("binary").alias("bits"), seg(F.col("pane")).alias("seg"),
                                 F.lit(True).alias("start")))
    rows = held.withColumn("start", F.lit(False)).unionByName(starts)
    frame = Window.partitionBy("seg", "bucket").orderBy("pane").rangeBetween(0, k - 1)
    empty = F.unhex(F.lit(""))
    return (rows.withColumn("n", F.bitmap_count(F.bitmap_or_agg(F.coalesce("bits", empty)).over(frame)))
            .where("start").groupBy("pane").agg(F.sum("n").alias(out))
            .select(F.timestamp_micros(F.col("pane") * F.lit(width)).alias("start"), out))
