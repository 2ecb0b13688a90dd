"""Sessions and in-session order.

No per-user or per-session window: rows are split by ``(user, time
bucket)`` and values that cross a bucket border are carried through one
summary row per bucket (see :mod:`eventide.operators.segmented`), so a hot
user or an endless session is spread over many tasks. In-session values are
carried with their session id; a value from another session is discarded.
:func:`session_pass` does sessions, item numbers and all neighbours in one
pass; :func:`in_session_neighbours` is the generic form for tables that
already carry a session id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import hint_if_small, materialize
from .segmented import BUCKET, Scan, add_time_bucket, ordered_scan

DAY = 86400
# One fixed width for every key: a user with a third of all events is cut into
# hours like anyone else, and rows and summaries can never disagree.
HOUR = 3600
END = "(end)"


def _us(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def _same_session(carried: str, session_col: str, field: str) -> Column:
    """Field of a carried struct, kept only if it came from the same session."""
    return F.when(F.col(f"{carried}.s") == F.col(session_col), F.col(f"{carried}.{field}"))


def _bucket(df: DataFrame, user_col: str, ts_col: str, bucket_seconds) -> DataFrame:
    if BUCKET in df.columns:
        return df
    if bucket_seconds == "auto":
        bucket_seconds = HOUR
    return add_time_bucket(df, ts_col, bucket_seconds)


def sessionize(df: DataFrame, user_col: str = "user_id", ts_col: str = "ts",
               id_col: str = "event_id", gap_seconds: int = 1800,
               bucket_seconds: int | str = "auto", session_col: str = "session_id",
               item_col: str = "item_in_session", keep_bucket: bool = False) -> DataFrame:
    """G5 + G2: split each user's events into sessions (a gap of more than
    ``gap_seconds`` starts a new one; an exact gap joins, as
    ``session_window`` does) and number events in a session from 0.

    The session id is the ``id_col`` of its first event, so it is unique and
    stable. Order is ``(ts, id)``. Buckets are an hour wide for every user
    (``bucket_seconds="auto"``) or of the width given.
    """
    return session_pass(df, user_col, ts_col, id_col, gap_seconds,
                        bucket_seconds=bucket_seconds, session_col=session_col,
                        item_col=item_col, keep_bucket=keep_bucket)


def is_redirect(status_col: str = "status") -> Column:
    """A redirect is a status in 300..398 (399 is not one)."""
    return F.col(status_col).between(300, 398)


ALL_NEIGHBOURS = ("prev_ts", "next_ts", "next_page", "previous_page")


def in_session_neighbours(df: DataFrame, user_col: str, session_col: str,
                          order: list[str], ts_col: str, page_col: str | None = None,
                          status_col: str | None = None, bucket_seconds: int | str = "auto",
                          keep_bucket: bool = False,
                          want: tuple[str, ...] = ALL_NEIGHBOURS) -> DataFrame:
    """Add, inside the session (only the columns named in ``want``):

    * ``prev_ts`` / ``next_ts`` - event time of the neighbouring events;
    * ``next_page`` - page of the next event (null for the last);
    * ``previous_page`` (G1) - the page before this one, where a redirect
      does not move the "previous" pointer: a non-redirect event's previous
      page is the page of the event before it; a redirect keeps the previous
      page of the event before it.
    """
    d = _bucket(df, user_col, ts_col, bucket_seconds)
    s = F.col(session_col)
    scans = []
    if "prev_ts" in want:
        scans.append(Scan("lag", F.struct(s.alias("s"), F.col(ts_col).alias("v")), "_p_ts"))
    if "next_ts" in want:
        scans.append(Scan("lead", F.struct(s.alias("s"), F.col(ts_col).alias("v")), "_n_ts"))
    if "next_page" in want and page_col:
        scans.append(Scan("lead", F.struct(s.alias("s"), F.col(page_col).alias("v")), "_n_pg"))
    if scans:
        d = ordered_scan(d, [user_col], order, scans)
        adds = {"_p_ts": "prev_ts", "_n_ts": "next_ts", "_n_pg": "next_page"}
        d = d.select(*[c for c in d.columns if c not in adds],
                     *[_same_session(c, session_col, "v").alias(o)
                       for c, o in adds.items() if c in d.columns])
    if "previous_page" in want and page_col:
        d = _previous_page_pass(d, user_col, session_col, order, page_col, status_col)
    return d if keep_bucket else d.drop(BUCKET)


def _previous_page_pass(d: DataFrame, user_col: str, session_col: str, order: list[str],
                        page_col: str, status_col: str | None) -> DataFrame:
    """G1 in one pass over rows partitioned by (user, bucket).

    Every non-redirect row is an anchor holding the page before it (when that
    row is in the same session); a row's previous page is the last anchor at
    or before it. Inside a bucket that is a running last-non-null; the first
    row of a bucket takes the previous bucket's last page from the summary,
    and buckets without an anchor take the last anchor of earlier buckets (a
    window over one summary row per bucket). Values carry their session id,
    so nothing leaks across sessions.
    """
    part = [user_col, BUCKET]
    w = Window.partitionBy(*part).orderBy(*order)
    sw = Window.partitionBy(user_col).orderBy(BUCKET)
    up = Window.unboundedPreceding
    s = F.col(session_col)
    red = F.coalesce(is_redirect(status_col), F.lit(False)) if status_col else F.lit(False)
    sp = F.struct(s.alias("s"), F.col(page_col).alias("v"))
    loc = d.select("*", F.row_number().over(w).alias("_rn"), F.lag(sp).over(w).alias("_lp"),
                   red.alias("_red"))
    c = F.when(~F.col("_red") & (F.col("_lp.s") == s),
               F.struct(s.alias("s"), F.col("_lp.v").alias("v")))
    loc = loc.select("*", c.alias("_c"))
    loc = loc.select("*", F.last("_c", ignorenulls=True).over(w.rowsBetween(up, 0)).alias("_lc"))

    summ = loc.groupBy(*part).agg(
        F.max_by(sp, F.col("_rn")).alias("_last"),
        F.min_by(F.struct(s.alias("s"), F.col("_red").alias("red")), F.col("_rn")).alias("_first"),
        F.max_by(F.col("_c"), F.when(F.col("_c").isNotNull(), F.col("_rn"))).alias("_lastc"))
    summ = summ.withColumn("_prev_last", F.lag("_last").over(sw))
    c_first = F.when(~F.col("_first.red") & (F.col("_prev_last.s") == F.col("_first.s")),
                     F.struct(F.col("_first.s").alias("s"), F.col("_prev_last.v").alias("v")))
    summ = summ.select(*part, c_first.alias("_cf"),
                       F.coalesce(F.col("_lastc"), c_first).alias("_bl"))
    summ = summ.select(*[F.col(k).alias(f"_k_{k}") for k in part], "_cf",
                       F.last("_bl", ignorenulls=True).over(sw.rowsBetween(up, -1)).alias("_carry"))
    j = loc.join(summ, [loc[k] == summ[f"_k_{k}"] for k in part], "left")
    anchor = F.coalesce(F.col("_lc"), F.col("_cf"), F.col("_carry"))
    prev = F.when(anchor["s"] == s, anchor["v"]).alias("previous_page")
    return j.select(*[F.col(c) for c in d.columns], prev)


def previous_page(df: DataFrame, session_col: str = "sessionid",
                  order: list[str] | None = None, ts_col: str = "ts_timestamp",
                  page_col: str = "page", status_col: str = "status",
                  user_col: str | None = None, bucket_seconds: int | str = "auto") -> DataFrame:
    """G1 on a decoded page-view table (keyed by session, or by user when
    given so the scan shares the user's partitioning)."""
    order = order or [ts_col, "iteminsession"]
    return in_session_neighbours(df, user_col or session_col, session_col, order, ts_col,
                                 page_col, status_col, bucket_seconds,
                                 want=("previous_page",))


def session_summary(df: DataFrame, session_col: str = "session_id", ts_col: str = "ts",
                    order: list[str] | None = None, page_col: str = "page",
                    level_col: str = "level", user_col: str | None = "user_id") -> DataFrame:
    """start, end, number of events, last page, last level, duration (s).

    ``max_by`` is a partial aggregate, so a huge session is combined map-side.
    """
    order = order or [ts_col]
    last = F.struct(*[F.col(c) for c in order])
    keys = [session_col] + ([user_col] if user_col else [])
    return df.groupBy(*keys).agg(
        F.min(ts_col).alias("session_start"),
        F.max(ts_col).alias("session_end"),
        F.count(F.lit(1)).alias("n_events"),
        F.max_by(F.col(page_col), last).alias("last_page"),
        F.max_by(F.col(level_col), last).alias("last_level"),
    ).withColumn("duration_s",
                 (_us("session_end") - _us("session_start")) / F.lit(1_000_000.0))


def transition_matrix(df: DataFrame, page_col: str = "page",
                      next_col: str = "next_page", closed_only: bool = False,
                      session_col: str = "session_id", ts_col: str = "ts",
                      gap_seconds: int = 1800) -> DataFrame:
    """counts and shares of page -> next page, session end as ``(end)``.

    Input rows carry ``next_page`` (see :func:`session_pass`). The share is
    over the source page; the window runs on the aggregated edge table
    (pages x pages), not on events. A session whose last event lies within
    the gap of the newest event may still continue, so its "end" is not yet
    known: ``closed_only`` leaves such sessions out. Only the ids of those open
    sessions are joined (written first, so their size is known): they are those of the
    last gap, however long the history, and a hot closed session is never gathered.
    """
    if closed_only:
        newest = df.agg(F.max(ts_col)).scalar()
        ends = df.groupBy(session_col).agg(F.max(ts_col).alias("_end"))
        still_open = ends.where(_us("_end") + F.lit(int(gap_seconds) * 1_000_000)
                                > F.unix_micros(newest)).select(session_col)
        df = df.join(hint_if_small(materialize(still_open, "open_sessions")), session_col, "left_anti")
    edges = df.select(F.col(page_col).alias("source"),
                      F.coalesce(F.col(next_col), F.lit(END)).alias("dest")) \
        .groupBy("source", "dest").agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy("source"))
    return edges.withColumn("p", F.col("n") / tot)


def event_gaps(df: DataFrame, user_col: str = "user_id", ts_col: str = "ts",
               prev_col: str = "prev_ts") -> DataFrame:
    """F12 alpha: mean gap in seconds between consecutive events of a session,
    per user (rows carry ``prev_ts`` in session)."""
    gap = (_us(ts_col) - _us(prev_col)) / F.lit(1_000_000.0)
    return df.where(F.col(prev_col).isNotNull()).groupBy(user_col).agg(
        F.avg(gap).alias("mean_event_gap_s"), F.count(F.lit(1)).alias("n_gaps"))


def user_gaps(sessions: DataFrame, user_col: str = "user_id", start_col: str = "session_start",
              end_col: str = "session_end", events_col: str = "n_events") -> DataFrame:
    """F12, both gaps per user, from one row per session and without any order.

    A user's n sessions do not overlap, so the gaps between them add up to
    (last end - first start) - sum of durations, over n - 1; the gaps inside them add up to
    the sum of durations, over events - n. Minimum, maximum and sums are partial
    aggregates, so a user with any number of sessions is combined map-side. Means are null where there is no gap."""
    start, end = _us(start_col), _us(end_col)
    g = sessions.groupBy(user_col).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(events_col).alias("_events"), F.sum(end - start).alias("_inside"),
        (F.max(end) - F.min(start)).alias("_span"))

    def mean(total: Column, n: Column) -> Column:
        return F.when(n > 0, total / n / F.lit(1_000_000.0))
    inner, outer = F.col("_events") - F.col("_n"), F.col("_n") - 1
    return g.select(user_col, mean(F.col("_inside"), inner).alias("mean_event_gap_s"), inner.alias("n_event_gaps"),
                    mean(F.col("_span") - F.col("_inside"), outer).alias("mean_session_gap_s"),
                    outer.alias("n_session_gaps"))


def session_gaps(sessions: DataFrame, user_col: str = "user_id", start_col: str = "session_start",
                 end_col: str = "session_end", events_col: str = "n_events") -> DataFrame:
    """F12 beta: mean time from a session's end to the user's next session
    start, for users with two sessions or more (see :func:`user_gaps`)."""
    g = user_gaps(sessions, user_col, start_col, end_col, events_col)
    return g.where("n_session_gaps > 0").select(user_col, "mean_session_gap_s", F.col("n_session_gaps").alias("n_gaps"))


def play_through(df: DataFrame, ts_col: str = "ts", duration_col: str = "duration",
                 next_col: str = "next_ts", page_col: str = "page",
                 song_page: str = "NextSong") -> DataFrame:
    """A song plays through when the next event of the session comes at
    or after the song's end (start + whole seconds of duration); null when
    it is the session's last event."""
    end = F.timestamp_micros(
        _us(ts_col) + F.floor(F.col(duration_col)).cast("long") * F.lit(1_000_000))
    flag = F.when(F.col(next_col).isNull(), F.lit(None).cast("boolean")) \
        .otherwise(_us(next_col) >= F.unix_micros(end))
    return df.where(F.col(page_col) == song_page).withColumn("played_through", flag)


def session_pass(df: DataFrame, user_col: str = "user_id", ts_col: str = "ts",
                 id_col: str = "event_id", gap_seconds: int = 1800,
                 page_col: str | None = None, status_col: str | None = None,
                 want: tuple[str, ...] = (), bucket_seconds: int | str = "auto",
                 session_col: str = "session_id", item_col: str = "item_in_session",
                 keep_bucket: bool = False) -> DataFrame:
    """Sessionize and add in-session neighbours in ONE pass over the rows.

    Adds ``session_id`` and ``item_in_session`` (as :func:`sessionize`) and
    any of ``prev_ts, next_ts, next_page, previous_page`` named in ``want``
    (as :func:`in_session_neighbours`). All values that cross a bucket border
    come from one summary row per (user, bucket): last/first time and page,
    the last session start, and the last "previous page" anchor. A
    previous-page anchor is a non-redirect row (its value is the page before
    it in the session) or a session start (value null); a row's previous
    page is the value of the last anchor at or before it.
    """
    order = [ts_col, id_col]
    rows = _bucket(df, user_col, ts_col, bucket_seconds)
    # a struct equals itself also where the user is null (logged-out rows)
    d = rows.withColumn("_key", F.struct(F.col(user_col).alias("k")))
    part = ["_key", BUCKET]
    w = Window.partitionBy(*part).orderBy(*order)
    w_all = Window.partitionBy(*part)
    sw = Window.partitionBy("_key").orderBy(BUCKET)
    up = Window.unboundedPreceding
    gap_us = F.lit(int(gap_seconds) * 1_000_000)
    ts, rid = F.col(ts_col), F.col(id_col)
    want_prev_page = "previous_page" in want and page_col is not None
    want_next = "next_ts" in want or ("next_page" in want and page_col is not None)
    pg = F.col(page_col) if page_col else None
    red = F.coalesce(is_redirect(status_col), F.lit(False)) if status_col else F.lit(False)

    # stage 1: positions and in-bucket neighbours
    sel = [F.row_number().over(w).alias("_rn"), F.lag(ts).over(w).alias("_lts"),
           red.alias("_red")]
    if want_next:
        sel += [F.count(F.lit(1)).over(w_all).alias("_nb"), F.lead(ts).over(w).alias("_nts")]
        if page_col:
            sel.append(F.lead(pg).over(w).alias("_npg"))
    if want_prev_page:
        sel.append(F.lag(pg).over(w).alias("_lpg"))
    loc = d.select("*", *sel)
    nl = (F.col("_rn") > 1) & ((_us(ts) - _us("_lts")) > gap_us)
    loc = loc.select("*", nl.alias("_nl"))
    # stage 2: running "last" values inside the bucket
    run = w.rowsBetween(up, 0)
    sel2 = [F.last(F.when(F.col("_nl"), rid), ignorenulls=True).over(run).alias("_sid_l"),
            F.last(F.when(F.col("_nl"), F.col("_rn")), ignorenulls=True).over(run).alias("_srn_l")]
    if want_prev_page:
        anchor = (F.col("_rn") > 1) & (~F.col("_red") | F.col("_nl"))
        aval = F.struct(F.when(~F.col("_red") & ~F.col("_nl"), F.col("_lpg")).alias("v"))
        loc = loc.select("*", anchor.alias("_anc"), aval.alias("_aval"))
        sel2.append(F.last(F.when(F.col("_anc"), F.col("_aval")), ignorenulls=True)
                    .over(run).alias("_pa_l"))
    loc = loc.select("*", *sel2)

    # one summary row per (user, bucket)
    aggs = [F.min(ts).alias("_fts"), F.max(ts).alias("_lts_b"),
            F.min_by(rid, F.col("_rn")).alias("_fid"), F.count(F.lit(1)).alias("_cnt"),
            F.max_by(rid, F.when(F.col("_nl"), F.col("_rn"))).alias("_lsid"),
            F.max(F.when(F.col("_nl"), F.col("_rn"))).alias("_lsrn")]
    if want_prev_page:
        aggs += [F.max_by(pg, F.col("_rn")).alias("_lpage"),
                 F.min_by(F.col("_red"), F.col("_rn")).alias("_fred"),
                 F.max_by(F.col("_aval"), F.when(F.col("_anc"), F.col("_rn"))).alias("_lanc")]
    if want_next and page_col:
        aggs.append(F.min_by(pg, F.col("_rn")).alias("_fpage"))
    summ = loc.groupBy(*part).agg(*aggs)
    s1 = [F.lag("_lts_b").over(sw).alias("_plts"),
          F.coalesce(F.sum("_cnt").over(sw.rowsBetween(up, -1)), F.lit(0)).alias("_before")]
    if want_prev_page:
        s1.append(F.lag("_lpage").over(sw).alias("_plpage"))
    if want_next:
        s1.append(F.lead("_fts").over(sw).alias("_nfts"))
        if page_col:
            s1.append(F.lead("_fpage").over(sw).alias("_nfpage"))
    summ = summ.select("*", *s1)
    first_new = F.col("_plts").isNull() | ((_us("_fts") - _us("_plts")) > gap_us)
    s2 = [*part, "_fid", "_before", first_new.alias("_fnew"),
          F.coalesce(F.col("_lsid"), F.when(first_new, F.col("_fid"))).alias("_xid"),
          F.coalesce(F.col("_lsrn") - 1 + F.col("_before"),
                     F.when(first_new, F.col("_before"))).alias("_xidx"),
          F.when(~first_new, F.col("_plts")).alias("_r1_pts")]
    if want_prev_page:
        r1 = F.when(~F.col("_fred") | first_new,
                    F.struct(F.when(~F.col("_fred") & ~first_new, F.col("_plpage")).alias("v")))
        s2 += [r1.alias("_r1anc"), F.coalesce(F.col("_lanc"), r1).alias("_xanc")]
    if want_next:
        cont = F.col("_nfts").isNotNull() & ((_us("_nfts") - _us("_lts_b")) <= gap_us)
        s2.append(F.when(cont, F.col("_nfts")).alias("_x_nts"))
        if page_col:
            s2.append(F.when(cont, F.col("_nfpage")).alias("_x_npg"))
    summ = summ.select(*s2)
    carry = sw.rowsBetween(up, -1)
    s3 = [*[F.col(k).alias(f"_k_{k}") for k in part], "_before", "_r1_pts",
          F.when(F.col("_fnew"), F.col("_fid"))
          .otherwise(F.last("_xid", ignorenulls=True).over(carry)).alias("_eid"),
          F.when(F.col("_fnew"), F.col("_before"))
          .otherwise(F.last("_xidx", ignorenulls=True).over(carry)).alias("_eidx")]
    if want_prev_page:
        s3 += ["_r1anc", F.last("_xanc", ignorenulls=True).over(carry).alias("_canc")]
    if want_next:
        s3.append("_x_nts")
        if page_col:
            s3.append("_x_npg")
    summ = summ.select(*s3)

    j = loc.join(summ, [loc[k] == summ[f"_k_{k}"] for k in part], "left")
    uidx = F.col("_rn") - 1 + F.col("_before")
    start = F.coalesce(F.col("_srn_l") - 1 + F.col("_before"), F.col("_eidx"))
    outs = [F.coalesce(F.col("_sid_l"), F.col("_eid")).alias(session_col),
            (uidx - start).cast("int").alias(item_col)]
    if "prev_ts" in want:
        outs.append(F.when(F.col("_rn") == 1, F.col("_r1_pts"))
                    .otherwise(F.when(~F.col("_nl"), F.col("_lts"))).alias("prev_ts"))
    if want_next:
        last_row = F.col("_rn") == F.col("_nb")
        same = (_us("_nts") - _us(ts)) <= gap_us
        if "next_ts" in want:
            outs.append(F.when(last_row, F.col("_x_nts"))
                        .otherwise(F.when(same, F.col("_nts"))).alias("next_ts"))
        if "next_page" in want and page_col:
            outs.append(F.when(last_row, F.col("_x_npg"))
                        .otherwise(F.when(same, F.col("_npg"))).alias("next_page"))
    if want_prev_page:
        outs.append(F.coalesce(F.col("_pa_l"), F.col("_r1anc"), F.col("_canc"))["v"]
                    .alias("previous_page"))
    keep = [c for c in rows.columns if keep_bucket or c != BUCKET]
    return j.select(*keep, *outs)
