"""Decode Kafka-shaped rows into typed, event-time tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_COLS = ["topic", "partition", "offset"]


def payload_text(col: str = "value") -> Column:
    """Binary payload to text."""
    return F.col(col).cast("string")


def parse_json(text: Column, schema: T.StructType) -> Column:
    """PERMISSIVE JSON parse. Malformed text gives a struct of nulls,
    null/empty text a null struct, and a value that does not fit its field
    type (int overflow, quoted number) a null field."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def decode(df: DataFrame, schema: T.StructType, value_col: str = "value",
           keep: list[str] | None = None) -> DataFrame:
    """Kafka-shaped rows -> flat typed columns + source position.

    ``keep`` are source columns carried next to the payload; by default the
    full position ``topic, partition, offset`` (offset alone is only unique
    per partition).
    """
    keep = [c for c in (keep if keep is not None else SOURCE_COLS) if c in df.columns]
    parsed = df.select(parse_json(payload_text(value_col), schema).alias("_v"), *keep)
    return parsed.select("_v.*", *keep)


def millis_to_timestamp(col: str = "ts") -> Column:
    """Epoch millis -> TIMESTAMP (UTC)."""
    return F.timestamp_millis(F.col(col))


def with_event_time(df: DataFrame, ts_col: str = "ts",
                    out: str = "ts_timestamp") -> DataFrame:
    """Add the event-time column first, keep every other column."""
    return df.select(millis_to_timestamp(ts_col).alias(out), *df.columns)


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name in one projection; a collision fails."""
    lowered = [c.lower() for c in df.columns]
    dup = {c for c in lowered if lowered.count(c) > 1}
    if dup:
        raise ValueError(f"lower-casing makes duplicate columns: {sorted(dup)}")
    return df.toDF(*lowered)


def decode_topic(df: DataFrame, schema: T.StructType, value_col: str = "value",
                 keep: list[str] | None = None) -> DataFrame:
    """C1-C6 in one plan: decode, event time first, lower-case names,
    source position last."""
    out = lower_names(with_event_time(decode(df, schema, value_col, keep)))
    return out


def date_parts(df: DataFrame, ts_col: str = "ts_timestamp") -> DataFrame:
    """Date, month, year, hour, minute, second beside all columns."""
    t = F.col(ts_col)
    return df.select(
        F.to_date(t).alias("date"), F.month(t).alias("month"), F.year(t).alias("year"),
        F.hour(t).alias("hour"), F.minute(t).alias("minute"), F.second(t).alias("second"),
        *df.columns)


def format_window_start(window_col: str = "window",
                        fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Window start as text."""
    return F.date_format(F.col(f"{window_col}.start"), fmt)


def text_to_epoch_seconds(col: Column) -> Column:
    """C9: 'yyyy-MM-dd HH:mm:ss' text -> epoch seconds (session zone)."""
    return F.unix_timestamp(col)


def to_epoch_millis(col: Column) -> Column:
    """Timestamp -> epoch millis (floors sub-millisecond parts)."""
    return F.unix_millis(col)


def as_utc_timestamp(col: str) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP in a UTC session (needed before a watermark)."""
    return F.col(col).cast("timestamp")
