"""Adapter from the generic ``events`` table to the page-view model.

The driver's ``events`` table (event_id, ts, user_id, event_type, value,
props JSON ``{"k": n}``) is mapped, row by row, to a page view with the same
expression in Spark and in the SQL oracle, then sessionized per user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sessions import ALL_NEIGHBOURS, session_pass

# fixed values: event_type -> page of the adapter
PAGE_OF_TYPE = [("view", "NextSong"), ("click", "Home"), ("error", "Login"),
                ("signup", "Submit Upgrade"), ("purchase", "Submit Downgrade")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with ``ts`` as TIMESTAMP (UTC session zone)."""
    e = table(spark, sf_dir, "events")
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def k_of(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("long")


def page_of(event_type: str = "event_type") -> Column:
    c = F.col(event_type)
    expr = None
    for t, p in PAGE_OF_TYPE:
        expr = (F.when(c == t, p) if expr is None else expr.when(c == t, p))
    return expr


def page_view_columns(ev: DataFrame) -> DataFrame:
    """Stateless part of the adapter."""
    k = k_of()
    et = F.col("event_type")
    return ev.select(
        "event_id", "ts", "user_id", "event_type",
        page_of().alias("page"),
        F.when((et == "click") & (k % 2 == 0), 307).otherwise(200).alias("status"),
        F.when(et.isin("view", "click"), "GET").otherwise("PUT").alias("method"),
        F.when(k % 3 == 0, "Logged Out").otherwise("Logged In").alias("auth"),
        F.when(k % 2 == 1, "paid").otherwise("free").alias("level"),
        F.col("value").alias("duration"),
        F.when(F.col("user_id") % 2 == 0, "control").otherwise("test").alias("tag"),
    )


def page_views(spark: SparkSession, sf_dir: str, gap_seconds: int = 1800,
               neighbours: bool | tuple[str, ...] = False,
               keep_bucket: bool = False) -> DataFrame:
    """Page views with ``session_id`` (first event id of the session) and
    ``item_in_session``; with ``neighbours`` also ``prev_ts, next_ts,
    next_page, previous_page`` inside the session."""
    want = () if not neighbours else (
        neighbours if isinstance(neighbours, tuple) else ALL_NEIGHBOURS)
    # one pass: sessions, item numbers and the requested in-session neighbours
    pv = session_pass(page_view_columns(events(spark, sf_dir)), gap_seconds=gap_seconds,
                      page_col="page", status_col="status", want=want, keep_bucket=keep_bucket)
    return pv
