"""Sessions and login attempts on a stream, with a user's state cut into hours.

:mod:`eventide.streaming.stateful` keeps all of a user's pending rows in one state
value and hands them to one Python call. Here a user with a third of all events is many
keys. Three steps, all in one streaming plan:

1. A windowed aggregate, keyed by (user, hour), holds the hour's rows and gives them out
   when the watermark has passed the hour's end. Then no row of the hour can still come, so
   it is sorted and followed once (``closed_hours``, an Arrow function over many hours at a
   time) and becomes one summary: first and last time and page, the session that is open at
   its end, and its possible login attempts. What depends on earlier hours (the rows before the
   hour's first session break; redirects at its very start) is marked as relative to them.
   There are as many hours as events where users are many, so no Python state is read or
   written per hour.
2. ``HourCarry``, keyed by user: takes one row per hour, in hour order, and passes on the
   carry: open session, its item count, last page, last "previous page", last time. It
   never sees events. If a batch closes more than ``HOURS_AT_ONCE`` hours of a user,
   they are parked in a map state and taken out hour by hour. A timer drops the carry once
   no hour that could join its session is open any more.
3. Built-in expressions unpack the attempts and add the carry.

A state TTL is not used: it counts processing time, so a paused stream would lose open
sessions; event-time timers drop the state exactly when it can no longer matter.

Rows of a user's last open hours stay in state until the watermark passes them. A bounded
run ends with :func:`heartbeat`, a row late enough to close every hour.
Null users are one key like any other. Rows without a time belong to no hour and are left out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.sessions import is_redirect
from ..session import ship_package

LOGIN = "Login"
HEARTBEAT_USER = -(2 ** 63)
# Ids travel as text and keys are never null: a column with nulls reaches pandas as floating
# point numbers, which lose ids past 2^53 and never equal themselves as keys.
KEY = "no_user boolean, user_id bigint"
SUMMARY = ("first_us bigint, last_us bigint, first_id string, first_redirect boolean, open_session string, open_item int, "
           "last_page string, last_prev string, last_prev_known boolean, attempts string")
CARRY = "session string, item int, last_page string, last_prev string, last_us bigint"
OUT = (f"{KEY}, hour_us bigint, head_session string, head_items int, head_prev string, attempts string, hours int")
HOURS_AT_ONCE = 1000


def follow_hour(rows: list[tuple], gap_us: int) -> dict:
    """Summary of one hour of one user. ``rows``: (us, id, page, redirect, auth, extras),
    sorted. ``prev`` of a row is (known, page): not known where it is that of the hour's
    first row, which the carry decides."""
    session, item, before, page_before, us_before = None, -1, (False, None), None, None
    attempts = []
    for k, (us, rid, page, redirect, auth, extras) in enumerate(rows):
        if k and us - us_before > gap_us:
            session, item, prev = rid, 0, (True, None)
        else:
            item += 1
            prev = (False, None) if k == 0 else (before if redirect else (True, page_before))
        if not prev[0] or prev[1] == LOGIN:
            attempts.append({"event_id": rid, "ts_us": us, "session": session, "item": item, "known": prev[0],
                             "prev": prev[1], "success": auth == "Logged In", "extras": list(extras)})
        before, page_before, us_before = prev, page, us
    first = rows[0]
    return {"first_us": first[0], "last_us": us_before, "first_id": first[1],
            "first_redirect": first[3],
            "open_session": session, "open_item": item, "last_page": page_before, "last_prev": before[1],
            "last_prev_known": before[0], "attempts": json.dumps(attempts)}


def join_hour(carry: tuple | None, hour: dict, gap_us: int) -> tuple[tuple, tuple]:
    """(new carry, (session, items before, previous page) of the hour's head)."""
    joins = carry is not None and hour["first_us"] - carry[4] <= gap_us
    if joins:
        session, items = carry[0], carry[1] + 1
        prev = carry[3] if hour["first_redirect"] else carry[2]
    else:
        session, items, prev = hour["first_id"], 0, None
    head_open = hour["open_session"] is None
    new = (session if head_open else hour["open_session"], hour["open_item"] + (items if head_open else 0),
           hour["last_page"], hour["last_prev"] if hour["last_prev_known"] else prev, hour["last_us"])
    return new, (session, items, prev)


def closed_hours(extras: int, gap_us: int):
    """Arrow function: lists of an hour's rows -> SUMMARY of each."""
    kind = to_arrow_type(T.StructType.fromDDL(SUMMARY))

    def follow(hours: pa.Array) -> pa.Array:
        out = []
        for rows in hours:
            got = [(r["us"], r["id"], r["page"], r["redirect"], r["auth"], [r[f"x{i}"] for i in range(extras)])
                   for r in rows.as_py()]
            # ties by id; rows without an id come first
            got.sort(key=lambda r: (r[0], r[1] is not None, int(r[1] or 0)))
            out.append(follow_hour(got, gap_us))
        return pa.array(out, kind)

    return F.arrow_udf(follow, T.StructType.fromDDL(SUMMARY))


class HourCarry(StatefulProcessor):
    """Passes a user's open session from hour to hour."""

    FIELDS = [f.split()[0] for f in SUMMARY.split(", ")]

    def __init__(self, hour_us: int, gap_us: int):
        self.hour_us, self.gap_us, self.at_once = hour_us, gap_us, HOURS_AT_ONCE

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.carry = handle.getValueState("carry", CARRY)
        self.parked = handle.getMapState("parked", "hour_us bigint", SUMMARY)

    def _hours(self, rows: Iterator[Row]) -> Iterator[tuple[int, dict]]:
        """The hours in order; they are parked in the state if they are many."""
        first = list(islice(rows, self.at_once))
        after = next(rows, None)
        if after is None:
            yield from sorted(((r["hour_us"], r["summary"]) for r in first), key=lambda h: h[0])
            return
        for r in chain(first, [after], rows):
            self.parked.updateValue((r["hour_us"],), tuple(r["summary"][c] for c in self.FIELDS))
        for hour in sorted(int(k[0]) for k in self.parked.keys()):
            summary = dict(zip(self.FIELDS, self.parked.getValue((hour,))))
            self.parked.removeKey((hour,))
            yield hour, summary

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        carry = self.carry.get()
        seen = 0
        for hour_us, hour in self._hours(rows):
            carry, (session, items, prev) = join_hour(carry, hour, self.gap_us)
            seen += 1
            if hour["attempts"] != "[]":
                yield Row(no_user=key[0], user_id=key[1], hour_us=hour_us, head_session=session, head_items=items,
                          head_prev=prev, attempts=hour["attempts"], hours=seen)
        self.carry.update(carry)
        last_open = (carry[4] + self.gap_us) // self.hour_us + 1  # the last hour that may join ends here
        self.handle.registerTimer(last_open * self.hour_us // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        carry = self.carry.get()
        if carry is not None and ((carry[4] + self.gap_us) // self.hour_us + 1) * self.hour_us <= \
                expiredTimerInfo.getExpiryTimeInMs() * 1000:
            self.carry.clear()
        return iter(())

    def close(self) -> None:
        pass


def hourly_auth_attempts_stream(page_views: DataFrame, extras: list[str], user_col: str = "user_id", ts_col: str = "ts",
                                id_col: str = "event_id", page_col: str = "page", status_col: str = "status",
                                auth_col: str = "auth", gap_seconds: int = 1800, hour_seconds: int = 3600) -> DataFrame:
    """Login attempts of a page-view stream with a watermark on ``ts_col`` and no
    session ids: id, time (``ts_us``), session, item number, success and the ``extras``
    (string columns), once the watermark has passed the hour. The session builder's
    RocksDB state store is needed."""
    spark = page_views.sparkSession
    ship_package(spark)
    hour_us, gap_us = hour_seconds * 1_000_000, gap_seconds * 1_000_000
    us = F.unix_micros(ts_col)
    rows = page_views.where(F.col(ts_col).isNotNull()).select(
        F.col(user_col).isNull().alias("no_user"), F.coalesce(F.col(user_col).cast("long"), F.lit(0)).alias("user_id"),
        F.window(ts_col, f"{hour_seconds} seconds").alias("hour"),
        us.alias("us"), F.col(id_col).cast("string").alias("id"), F.col(page_col).alias("page"),
        F.coalesce(is_redirect(status_col), F.lit(False)).alias("redirect"), F.col(auth_col).alias("auth"),
        *[F.col(c).cast("string").alias(f"x{i}") for i, c in enumerate(extras)])
    names = ["us", "id", "page", "redirect", "auth", *[f"x{i}" for i in range(len(extras))]]
    hours = rows.groupBy("hour", "no_user", "user_id").agg(F.collect_list(F.struct(*names)).alias("rows"))
    followed = hours.select("no_user", "user_id", F.window_time("hour").alias("ts"), F.unix_micros("hour.end").alias("hour_us"),
                            closed_hours(len(extras), gap_us)("rows").alias("summary"))
    carried = followed.groupBy("no_user", "user_id").transformWithState(
        HourCarry(hour_us, gap_us), OUT, "Append", "EventTime")
    kind = T.ArrayType(T.StructType.fromDDL("event_id string, ts_us bigint, session string, item int, known boolean, prev string, "
                                            "success boolean, extras array<string>"))
    a = F.col("a")
    return (carried.select("*", F.explode(F.from_json("attempts", kind)).alias("a"))
            .where(F.when(a["known"], a["prev"]).otherwise(F.col("head_prev")) == LOGIN)
            .select(F.when(~F.col("no_user"), F.col("user_id")).alias("user_id"), a["event_id"].cast("long").alias("event_id"), a["ts_us"].alias("ts_us"),
                    F.coalesce(a["session"], F.col("head_session")).cast("long").alias("session_id"),
                    (a["item"] + F.when(a["session"].isNull(), F.col("head_items")).otherwise(0)).alias("item_in_session"),
                    a["success"].alias("success"), *[a["extras"][i].alias(c) for i, c in enumerate(extras)]))


def heartbeat(page_views: DataFrame, newest, days: int = 1) -> DataFrame:
    """One row, typed like ``page_views``, ``days`` after the newest time: it moves the
    watermark past every hour that holds rows, so a bounded run leaves none in state.
    It belongs to a user of its own and is no attempt."""
    spark = page_views.sparkSession
    values = {"ts": F.lit(newest) + F.expr(f"INTERVAL {days} DAYS"), "user_id": F.lit(HEARTBEAT_USER)}
    return spark.range(1).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in page_views.schema])
