"""Event-time window aggregates.

All functions work on batch and streaming DataFrames unless noted. For
streams call :func:`with_watermark` first so state is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import format_window_start, text_to_epoch_seconds


def _seconds(duration: str) -> int:
    """'60 seconds' / '10 minutes' / '1 hour' -> seconds."""
    n, unit = duration.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    return int(n) * mult[unit.rstrip("s")]


def with_watermark(df: DataFrame, ts_col: str, delay: str) -> DataFrame:
    """Event-time watermark (the column must be TIMESTAMP, not NTZ)."""
    return df.withWatermark(ts_col, delay)


def windowed_agg(df: DataFrame, ts_col: str, length: str, slide: str | None = None,
                 keys: list[str | Column] | None = None,
                 aggs: list[Column] | None = None) -> DataFrame:
    """Group by an event-time window (tumbling, or sliding when ``slide`` is
    given) plus optional keys. Default aggregate is ``count``."""
    w = F.window(F.col(ts_col), length, slide) if slide else F.window(F.col(ts_col), length)
    g = df.groupBy(w.alias("window"), *(keys or []))
    return g.agg(*aggs) if aggs else g.count()


def tumbling_count(df: DataFrame, ts_col: str = "ts_timestamp", length: str = "30 seconds",
                   keys: list[str | Column] | None = None) -> DataFrame:
    """Count per tumbling window (and key)."""
    return windowed_agg(df, ts_col, length, None, keys)


def sliding_count(df: DataFrame, ts_col: str = "ts_timestamp", length: str = "60 seconds",
                  slide: str = "10 seconds", keys: list[str] | None = None,
                  panes: bool | None = None) -> DataFrame:
    """Count per sliding window.

    Batch plans use panes: count per slide-wide pane first (one row in, one
    pane out, partial aggregation map-side), then add each pane into the
    length/slide windows that cover it. That replaces a length/slide-fold
    expansion of every input row with an expansion of the (far fewer) pane
    rows. Streams use Spark's windowed aggregate directly (one stateful
    operator, works in update mode).
    """
    panes = (not df.isStreaming) if panes is None else panes
    L, S = _seconds(length), _seconds(slide)
    if not panes or L % S:
        return windowed_agg(df, ts_col, length, slide, keys)
    keys = keys or []
    # pane index = floor(epoch_us / slide_us); a pane p lies in the length/slide
    # windows that start at panes up to p.
    pane = F.floor(F.unix_micros(F.col(ts_col).cast("timestamp")) / F.lit(S * 1_000_000))
    per_pane = df.groupBy(pane.alias("_pane"), *keys).agg(F.count(F.lit(1)).alias("_n"))
    return windows_of_panes(per_pane, length, slide, keys)


def windows_of_panes(per_pane: DataFrame, length: str, slide: str, keys: list[str] | None = None,
                     pane_col: str = "_pane", count_col: str = "_n") -> DataFrame:
    """Sliding counts from pane counts (``pane_col``: epoch / slide, ``slide`` divides
    ``length``): each pane is added to the length/slide windows that cover it."""
    keys = keys or []
    L, S = _seconds(length), _seconds(slide)
    if L % S:
        raise ValueError(f"{slide} does not divide {length}")
    pane = F.col(pane_col)
    fan = per_pane.select(*keys, F.col(count_col).alias("_n"),
                          F.explode(F.sequence(pane - (L // S - 1), pane)).alias("_wstart"))
    agg = fan.groupBy("_wstart", *keys).agg(F.sum("_n").alias("count"))
    start = F.timestamp_micros(F.col("_wstart") * F.lit(S * 1_000_000))
    win = F.struct(start.alias("start"),
                   (start + F.expr(f"INTERVAL {L} SECONDS")).alias("end")).alias("window")
    return agg.select(win, *keys, "count")


def distinct_per_window(df: DataFrame, ts_col: str, key: str, length: str,
                        slide: str | None = None, approx: bool = False,
                        out: str = "sessions", rsd: float = 0.05) -> DataFrame:
    """distinct keys per window.

    ``approx=True`` uses HyperLogLog++ (``approx_count_distinct``), which is
    mergeable and stream-safe. Exact on a stream: de-duplicate
    ``(window, key)`` under the watermark, then count (two stateful operators).
    """
    w = F.window(F.col(ts_col), length, slide) if slide else F.window(F.col(ts_col), length)
    if approx:
        return df.groupBy(w.alias("window")).agg(F.approx_count_distinct(key, rsd).alias(out))
    if df.isStreaming:
        return (df.select(w.alias("window"), F.col(key), F.col(ts_col))
                .dropDuplicates(["window", key])
                .groupBy("window").agg(F.count(F.lit(1)).alias(out)))
    return df.groupBy(w.alias("window")).agg(F.count_distinct(key).alias(out))


def format_windows(df: DataFrame, value_cols: list[str] | None = None,
                   keys: list[str] | None = None) -> DataFrame:
    """Window start text as ``timestamp_minute``, its epoch seconds as
    ``unix_timestamp``, then the keys and values."""
    value_cols = value_cols or ["count"]
    start_txt = format_window_start("window")
    return df.select(start_txt.alias("timestamp_minute"),
                     text_to_epoch_seconds(start_txt).alias("unix_timestamp"),
                     *(keys or []), *value_cols)


def order_windows(df: DataFrame, ascending: bool = True) -> DataFrame:
    """H1: order by window (batch, or a stream in complete mode)."""
    return df.orderBy(F.col("window").asc() if ascending else F.col("window").desc())
