"""Previous page / login attempts on a stream.

``lag`` is not allowed on streams, so the redirect-aware previous page is
kept in state with ``applyInPandasWithState``, per user (a user's sessions
follow each other in time).

Rows may come in any order the watermark accepts. A row is held in the user's
state until the watermark has passed it, because only then no earlier row can
still arrive; the rows due are then followed in event-time order (ties by
session and item, or by id). No accepted row is dropped. An event-time timeout
fires when the next held row is due, or, with nothing held, one session gap
after the last row, when the state goes. So the state holds the rows of the
watermark delay and one small tuple per active user; rows of one user in one
batch are bounded by the trigger size (``maxFilesPerTrigger``).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.sessions import is_redirect
from ..session import ship_package

LOGIN = "Login"
STATE_SCHEMA = "session long, last_page string, last_prev string, last_us long, held binary"


def previous_pages(pdf: pd.DataFrame, page_col: str, status_col: str,
                   last_page: str | None, last_prev: str | None,
                   session_col: str | None = None, state_session=None) -> pd.Series:
    """Vectorised rule for ordered rows, continuing from the state.

    In a session, a non-redirect row's previous page is the page before it;
    a redirect (300..398) keeps the previous page of the row before it; the
    first row of a session has none.
    """
    n = len(pdf)
    pages = pdf[page_col].astype(object).reset_index(drop=True)
    redirect = pdf[status_col].reset_index(drop=True).between(300, 398) \
        .fillna(False).to_numpy(dtype=bool)
    if session_col is not None:
        sess = pdf[session_col].to_numpy()
        new_sess = np.r_[state_session is None or sess[0] != state_session, sess[1:] != sess[:-1]]
    else:
        new_sess = np.zeros(n, dtype=bool)
        new_sess[0] = last_page is None and last_prev is None
    before = pages.shift(1).astype(object)
    before[new_sess] = None
    if not new_sess[0]:
        before.iloc[0] = last_page
    # anchors: non-redirect rows and session starts; a redirect takes the
    # value of the anchor before it
    anchor = ~redirect | new_sess
    anchor[0] = True
    value = before.where(~redirect, None)
    if redirect[0] and not new_sess[0]:
        value.iloc[0] = last_prev
    grp = np.cumsum(anchor) - 1
    vals = value[anchor].to_numpy(dtype=object)
    return pd.Series(vals[grp], dtype=object)


US, REDIRECT, SUCCESS = "_us", "_redirect", "_success"
NO_TIME = -(2 ** 63)  # rows without a time are due at once, and come last among those due


def _followed(page_views: DataFrame, ts_col: str, status_col: str, auth_col: str, cols: list[str]) -> DataFrame:
    """``cols`` once each, the time (kept for the watermark) and the three derived columns."""
    return page_views.select(*dict.fromkeys([ts_col, *cols]), F.coalesce(F.unix_micros(ts_col), F.lit(NO_TIME)).alias(US),
                             F.coalesce(is_redirect(status_col), F.lit(False)).alias(REDIRECT),
                             F.coalesce(F.col(auth_col) == "Logged In", F.lit(False)).alias(SUCCESS))


def _tuples(pdf: pd.DataFrame, cols: list[str]) -> list[tuple]:
    """Rows as plain Python values, missing as None."""
    lists = [pdf[c].tolist() for c in cols]
    return list(zip(*[[None if v != v else v for v in x] if pdf[c].dtype.kind == "f" else x for c, x in zip(cols, lists)]))


def _place(row: tuple, n: int) -> list[tuple]:
    """Sort key of the first n fields; missing values come last."""
    return [(True, 0) if v is None or v == NO_TIME else (False, v) for v in row[:n]]


def follow_due_rows(pdfs: Iterator[pd.DataFrame], state: GroupState, blank: tuple, cols: list[str], n_order: int,
                    gap_us: int, follow: Callable) -> Iterator[pd.DataFrame]:
    """Hold new rows (tuples of ``cols``, the first of which is the time in microseconds) in the
    state and hand those that the watermark has passed, ordered by the first ``n_order`` columns,
    to ``follow(rows, carry) -> (carry, result or None)``.

    The state tuple is (*carry, held rows); the last carry field is the time of
    the last followed row in microseconds."""
    *carry, held = state.get if state.exists else (*blank, None)
    rows = pickle.loads(held) if held else []
    if not state.hasTimedOut:
        for pdf in pdfs:
            rows += _tuples(pdf, cols)
    if not rows:  # the gap after the last row has passed
        state.remove()
        return
    watermark = state.getCurrentWatermarkMs()
    ready = [r for r in rows if r[0] <= watermark * 1000]
    rest = [r for r in rows if r[0] > watermark * 1000] if ready else rows
    if ready:
        ready.sort(key=lambda r: _place(r, n_order))
        carry, result = follow(ready, tuple(carry))
        if result is not None and len(result):
            yield result
    state.update((*carry, pickle.dumps(rest) if rest else None))
    if rest:
        wake = -(-min(r[0] for r in rest) // 1000) - 1
    else:
        wake = (carry[-1] + gap_us) // 1000 + 1
    state.setTimeoutTimestamp(max(wake, watermark + 1))


def _with_time(out: DataFrame, ts_col: str, out_cols: list[str], more: list[str]) -> DataFrame:
    """The output columns; the time left the state as microseconds."""
    return out.select(*[F.when(F.col(c) != NO_TIME, F.timestamp_micros(c)).alias(c) if c == ts_col else F.col(c) for c in out_cols], *more)


def auth_attempts_stream(page_views: DataFrame, session_col: str = "session_id",
                         ts_col: str = "ts", item_col: str = "item_in_session",
                         page_col: str = "page", status_col: str = "status",
                         auth_col: str = "auth", user_col: str = "user_id",
                         gap: str = "30 minutes",
                         out_cols: list[str] | None = None) -> DataFrame:
    """J6 + D3: login attempts from a page-view stream.

    ``page_views`` must carry a watermark on ``ts_col``. Output: the
    requested columns plus ``success``.
    """
    out_cols = out_cols or [c for c in page_views.columns
                            if c not in (page_col, status_col, auth_col, "method", "artist",
                                         "song", "duration")]
    types = {**dict(page_views.dtypes), ts_col: "bigint"}
    out_schema = ", ".join([f"`{c}` {types[c]}" for c in out_cols] + ["success boolean"])
    gap_us = _gap_ms(gap) * 1000
    cols = list(dict.fromkeys([US, session_col, item_col, page_col, REDIRECT, SUCCESS, *(c for c in out_cols if c != ts_col)]))
    out_at = [cols.index(US if c == ts_col else c) for c in out_cols]

    def follow(rows, carry):
        sess, page_before, prev, us = carry
        out = []
        for r in rows:
            us, s, _, page, redirect, ok = r[:6]
            if s is None or s != sess:
                prev = None
            elif not redirect:
                prev = page_before
            if prev == LOGIN:
                out.append((*[r[i] for i in out_at], ok))
            sess, page_before = s, page
        return (None if sess is None else int(sess), page_before, prev, us), pd.DataFrame(out, columns=[*out_cols, "success"])

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        yield from follow_due_rows(pdfs, state, (None, None, None, None), cols, 3, gap_us, follow)

    ship_package(page_views.sparkSession)
    need = [c for c in cols if c not in (US, REDIRECT, SUCCESS)]
    out = _followed(page_views, ts_col, status_col, auth_col, [user_col, *need]).groupBy(user_col).applyInPandasWithState(
        step, out_schema, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
    return _with_time(out, ts_col, out_cols, ["success"])


def _gap_ms(gap: str) -> int:
    n, unit = gap.split()
    return int(n) * {"second": 1000, "minute": 60_000, "hour": 3_600_000}[unit.rstrip("s")]


SESSION_STATE_SCHEMA = "session long, item long, last_page string, last_prev string, last_us long, held binary"


def sessionized_auth_attempts_stream(page_views: DataFrame, user_col: str = "user_id",
                                     ts_col: str = "ts", id_col: str = "event_id",
                                     page_col: str = "page", status_col: str = "status",
                                     auth_col: str = "auth", gap_seconds: int = 1800,
                                     out_cols: list[str] | None = None) -> DataFrame:
    """G5 + G2 + J6 + D3 on a stream of page views without session ids.

    Per user the state holds the open session (id = its first event id), its
    item count, the last pages, the last event time and the rows that the
    watermark has not passed. Rows are followed in ``(ts, id)`` order; a gap of
    more than ``gap_seconds`` starts a session. Output: ``out_cols`` +
    ``session_id``, ``item_in_session`` and ``success`` for rows whose previous
    page is the login page, once the watermark has passed them.
    """
    out_cols = out_cols or [c for c in page_views.columns
                            if c not in (page_col, status_col, auth_col)]
    types = {**dict(page_views.dtypes), ts_col: "bigint"}
    out_schema = ", ".join([f"`{c}` {types[c]}" for c in out_cols] +
                           ["session_id bigint", "item_in_session int", "success boolean"])
    gap_us = int(gap_seconds) * 1_000_000
    cols = list(dict.fromkeys([US, id_col, page_col, REDIRECT, SUCCESS, *(c for c in out_cols if c != ts_col)]))
    out_at = [cols.index(US if c == ts_col else c) for c in out_cols]

    def follow(rows, carry):
        sess, item, page_before, prev, us_before = carry
        out = []
        for r in rows:
            us, rid, page, redirect, ok = r[:5]
            # rows without a time open a session; the rows that come after it join it
            if us_before is None or (us_before != NO_TIME and (us == NO_TIME or us - us_before > gap_us)):
                sess, item, prev = rid, 0, None
            else:
                item += 1
                prev = prev if redirect else page_before
            if prev == LOGIN:
                out.append((*[r[i] for i in out_at], sess, item, ok))
            page_before, us_before = page, us
        return (sess, item, page_before, prev, us_before), pd.DataFrame(
            out, columns=[*out_cols, "session_id", "item_in_session", "success"])

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        yield from follow_due_rows(pdfs, state, (None, None, None, None, None), cols, 2, gap_us, follow)

    ship_package(page_views.sparkSession)
    need = [c for c in cols if c not in (US, REDIRECT, SUCCESS)]
    out = _followed(page_views, ts_col, status_col, auth_col, [user_col, *need]).groupBy(user_col).applyInPandasWithState(
        step, out_schema, SESSION_STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
    return _with_time(out, ts_col, out_cols, ["session_id", "item_in_session", "success"])
