"""Registered batch queries over the driver tables.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables; the
SQL twin of each lives in :mod:`eventide.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.decode import date_parts, decode_topic
from ..operators import catalog, growth, routing, sessions, windows
from ..operators.sampling import prefix_ranges, range_lookup, total_weight
from ..operators.sampling import weighted_pick as pick_by_weight
from ..operators.segmented import BUCKET, Scan, ordered_scan
from ..session import materialize
from ..sinks import writers
from ..sources import files
from . import adapters as A

HOUR = 3600


def us(c: str) -> Column:
    return F.unix_micros(F.col(c))


def _fmt(df: DataFrame, values: list[str], keys: list[str] | None = None) -> DataFrame:
    return windows.format_windows(df, values, keys)


# --- windows ---------------------------------------------------------------

def sliding_count(spark: SparkSession, sf: str) -> DataFrame:
    """F2 flagship: 60-second windows every 10 seconds."""
    ev = A.events(spark, sf).select("ts")
    return _fmt(windows.sliding_count(ev, "ts", "60 seconds", "10 seconds"), ["count"])


def tumbling_count(spark, sf):
    ev = A.events(spark, sf).select("ts")
    return _fmt(windows.tumbling_count(ev, "ts", "30 seconds"), ["count"])


def window_by_key(spark, sf):
    ev = A.events(spark, sf).select("ts", "event_type")
    return _fmt(windows.tumbling_count(ev, "ts", "1 minute", ["event_type"]), ["count"],
                ["event_type"])


def distinct_users_window(spark, sf):
    ev = A.events(spark, sf).select("ts", "user_id")
    return _fmt(windows.distinct_per_window(ev, "ts", "user_id", "1 hour", out="users"),
                ["users"])


def approx_users_window(spark, sf):
    """HLL++ estimate per hour, reported with the exact count and a
    tolerance flag (estimates differ by engine)."""
    ev = A.events(spark, sf).select("ts", "user_id")
    # each (window, user) once before the sketch: beside count_distinct, Spark's rewrite
    # would carry one sketch (13 KB) per window and user through the shuffle
    users = ev.select(F.window("ts", "1 hour").alias("window"), "user_id").distinct()
    agg = users.groupBy("window").agg(
        F.approx_count_distinct("user_id", 0.01).alias("approx"),
        F.count("user_id").alias("users_exact"))
    ok = F.abs(F.col("approx") - F.col("users_exact")) <= \
        F.greatest(F.lit(3.0), F.col("users_exact") * 0.05)
    return _fmt(agg.withColumn("approx_ok", ok), ["users_exact", "approx_ok"])


def approx_users_sketch(spark, sf):
    """the HLL++ estimate per hour alone, one pass without an exact count.
    No SQL twin (estimates differ by engine); a test holds it to a tolerance."""
    ev = A.events(spark, sf).select("ts", "user_id")
    agg = ev.groupBy(F.window("ts", "1 hour").alias("window")).agg(
        F.approx_count_distinct("user_id", 0.01).alias("users"))
    return _fmt(agg, ["users"])


def ordered_windows(spark, sf):
    """H1: hourly counts in window order."""
    ev = A.events(spark, sf).select("ts")
    return _fmt(windows.order_windows(windows.tumbling_count(ev, "ts", "1 hour")), ["count"])


# --- decode / projections ----------------------------------------------------

def date_parts_q(spark, sf):
    ev = A.events(spark, sf).select("event_id", "ts")
    d = date_parts(ev, "ts")
    return d.select("event_id", F.date_format("date", "yyyy-MM-dd").alias("date"),
                    *[F.col(c).cast("long").alias(c)
                      for c in ["month", "year", "hour", "minute", "second"]])


def page_view_payload(pv: DataFrame) -> DataFrame:
    """B13 + A4: page views as Kafka-shaped JSON records (nulls omitted)."""
    payload = F.to_json(F.struct(
        F.unix_millis("ts").alias("ts"), F.col("session_id").alias("sessionId"),
        "page", "auth", "method", "status", "level",
        F.col("item_in_session").alias("itemInSession"),
        F.col("user_id").alias("userId"), "duration", "tag"))
    return pv.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        payload.cast("binary").alias("value"),
        F.lit(S.PAGE_VIEW).alias("topic"),
        (F.col("user_id") % 5).cast("int").alias("partition"),
        F.col("event_id").alias("offset"))


def page_view_payload_stateless(pv: DataFrame) -> DataFrame:
    """Page-view JSON records from the stateless adapter (stream-safe)."""
    payload = F.to_json(F.struct(
        F.unix_millis("ts").alias("ts"), "page", "auth", "method", "status", "level",
        F.col("user_id").alias("userId"), "duration", "tag"))
    return pv.select(payload.cast("binary").alias("value"), F.lit(S.PAGE_VIEW).alias("topic"),
                     (F.col("user_id") % 5).cast("int").alias("partition"),
                     F.col("event_id").alias("offset"))


def decode_events(spark, sf):
    """Produce page-view JSON records, then decode them."""
    kafka = page_view_payload(A.page_views(spark, sf))
    d = decode_topic(kafka, S.get_schema(S.PAGE_VIEW, with_tag=True))
    return d.select(
        F.date_format("ts_timestamp", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts_timestamp"),
        "ts", "sessionid", "page", "auth", "method", "status", "level", "iteminsession",
        "city", "userid", "duration", "tag", "topic", "partition", "offset")


def decode_all_topics(spark, sf):
    """The page-view model produces all four topics
    into one Kafka-shaped frame (one subscription), which is split by topic
    and decoded with each topic's own schema."""
    from ..sources.kafka import split_topics
    # the sessionized page views feed four producers: build them once
    pv = materialize(A.page_views(spark, sf, neighbours=("previous_page",)), "page_views")
    common = [F.unix_millis("ts").alias("ts"), F.col("session_id").alias("sessionId"),
              "level", F.col("item_in_session").alias("itemInSession"),
              F.col("user_id").alias("userId")]
    payloads = {
        S.PAGE_VIEW: pv.select(*common, "page", "auth", "method", "status", "duration",
                               "event_id"),
        S.LISTEN: routing.listens(pv).select(*common, "auth", "duration", "event_id"),
        S.STATUS_CHANGE: routing.status_changes(pv).select(*common, "auth", "event_id"),
        S.AUTH: routing.auth_attempts(pv).select(*common, "success", "event_id"),
    }
    frames = [df.select(F.to_json(F.struct(*[c for c in df.columns if c != "event_id"]))
                        .cast("binary").alias("value"), F.lit(t).alias("topic"),
                        (F.col("userId") % 5).cast("int").alias("partition"),
                        F.col("event_id").alias("offset"))
              for t, df in payloads.items()]
    wire = frames[0]
    for f in frames[1:]:
        wire = wire.unionByName(f)
    out = None
    for topic, rows in split_topics(wire).items():
        d = decode_topic(rows, S.get_schema(topic))
        agg = d.groupBy("topic").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("sessionid").alias("n_sessions"),
            F.max("iteminsession").cast("long").alias("max_item"),
            F.count("userid").alias("n_with_user"))
        out = agg if out is None else out.unionByName(agg)
    return out


# --- routing ------------------------------------------------------------------

def listens(spark, sf):
    pv = routing.listens(A.page_views(spark, sf))
    return pv.select("event_id", us("ts").alias("ts_us"), "session_id", "item_in_session",
                     "auth", "level", "user_id", "duration", "tag")


def status_changes(spark, sf):
    pv = routing.status_changes(A.page_views(spark, sf))
    return pv.select("event_id", us("ts").alias("ts_us"), "session_id", "item_in_session",
                     "auth", "level", "user_id", "tag")


def auth_attempts(spark, sf):
    pv = A.page_views(spark, sf, neighbours=("previous_page",))
    a = routing.auth_attempts(pv)
    return a.select("event_id", us("ts").alias("ts_us"), "session_id", "item_in_session",
                    "level", "user_id", "tag", "success")


def mask_users(spark, sf):
    pv = A.page_views(spark, sf)
    m = routing.mask_users(pv, fields=["user_id", "tag"])
    return m.select("event_id", "auth", "user_id", "tag")


def tagged_users(spark, sf):
    """An A/B tag per user, hidden for logged-out rows."""
    pv = A.page_view_columns(A.events(spark, sf)).select("event_id", "user_id", "auth")
    tag = F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd")
    return routing.add_tag(pv, tag, F.col("auth") == "Logged In").select("event_id", "tag")


def clean_fields(spark, sf):
    """Quoted fields with tabs, unquoted and with spaces for tabs."""
    raw = F.concat(F.lit('"'), F.col("p_brand"), F.lit("\t"), F.col("p_name"), F.lit('"'))
    part = A.table(spark, sf, "part").select("p_partkey", raw.alias("raw"))
    return part.select("p_partkey", files.remove_tabs(files.unquote(F.col("raw"))).alias("name"))


def time_range(spark, sf):
    ev = A.events(spark, sf)
    r = routing.time_range(ev, "ts", "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    return r.select("event_id", us("ts").alias("ts_us"), "event_type")


def retain_days(spark, sf, days: int = 7):
    """Keep the last ``days`` of data relative to the newest event."""
    ev = A.events(spark, sf).select("event_id", "ts")
    return writers.retain(ev, "ts", f"{days} days").select("event_id", us("ts").alias("ts_us"))


def ordered_events(spark, sf):
    """H2: all events in (ts, event_id) order with their global position,
    computed by a two-level scan over sampled range partitions (no
    single-partition window; a hot hour is split like any other range)."""
    from ..operators.segmented import add_range_bucket
    ev = add_range_bucket(A.events(spark, sf).select("event_id", "ts"), ["ts", "event_id"])
    o = ordered_scan(ev, [], ["ts", "event_id"], [Scan("index", None, "pos")]).drop(BUCKET)
    return o.select("event_id", us("ts").alias("ts_us"), F.col("pos").cast("long"))


# --- sessions -----------------------------------------------------------------

def previous_page(spark, sf):
    pv = A.page_views(spark, sf, gap_seconds=12 * HOUR, neighbours=("previous_page",))
    return pv.select("event_id", "session_id", "page", "status", "previous_page")


def item_numbers(spark, sf):
    pv = A.page_views(spark, sf, gap_seconds=12 * HOUR)
    return pv.select("event_id", "session_id", "item_in_session")


def sessionize(spark, sf):
    pv = A.page_views(spark, sf)
    return pv.select("event_id", "user_id", "session_id", "item_in_session")


def session_summary(spark, sf):
    pv = A.page_views(spark, sf, gap_seconds=12 * HOUR)
    s = sessions.session_summary(pv, order=["ts", "event_id"])
    return s.select("session_id", "user_id", us("session_start").alias("session_start"),
                    us("session_end").alias("session_end"), "n_events", "last_page",
                    "last_level", F.round("duration_s", 6).alias("duration_s"))


def transition_matrix(spark, sf):
    pv = A.page_views(spark, sf, gap_seconds=12 * HOUR, neighbours=("next_page",))
    t = sessions.transition_matrix(pv)
    return t.select("source", "dest", "n", F.round("p", 9).alias("p"))


def transition_matrix_closed(spark, sf):
    """F11 on closed sessions only: sessions that may still continue past the
    end of the data (last event within the gap of the newest) are left out."""
    gap = 12 * HOUR
    pv = A.page_views(spark, sf, gap_seconds=gap, neighbours=("next_page",))
    t = sessions.transition_matrix(pv, closed_only=True, gap_seconds=gap)
    return t.select("source", "dest", "n", F.round("p", 9).alias("p"))


def event_gaps(spark, sf):
    """F12 alpha, from the session summary: no event meets its neighbour."""
    pv = A.page_views(spark, sf, gap_seconds=12 * HOUR)
    g = sessions.user_gaps(sessions.session_summary(pv, order=["ts", "event_id"]))
    return g.where("n_event_gaps > 0").select("user_id", F.round("mean_event_gap_s", 3).alias("mean_event_gap_s"),
                                              F.col("n_event_gaps").alias("n_gaps"))


def session_gaps(spark, sf):
    """F12 beta, from the session summary."""
    s = sessions.session_summary(A.page_views(spark, sf), order=["ts", "event_id"])
    return sessions.session_gaps(s).select(
        "user_id", F.round("mean_session_gap_s", 3).alias("mean_session_gap_s"), "n_gaps")


def play_through(spark, sf):
    pv = A.page_views(spark, sf, gap_seconds=12 * HOUR, neighbours=("next_ts",))
    return sessions.play_through(pv).select("event_id", "session_id", "played_through")


# --- growth -------------------------------------------------------------------

def hourly_profile(spark, sf):
    return growth.hourly_profile(A.events(spark, sf).select("ts"))


def weekday_class(spark, sf):
    w = growth.weekday_profile(A.events(spark, sf).select("ts"))
    return w.select("day_class", "n_events", "n_days",
                    F.round("events_per_day", 6).alias("events_per_day"))


def user_growth(spark, sf):
    g = growth.user_growth(A.events(spark, sf).select("user_id", "ts"))
    return g.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "new_users",
                    F.col("total_users").cast("long"))


def churned_users(spark, sf):
    pv = A.page_views(spark, sf)
    return growth.churned_users(pv, "Logged Out", order=["ts", "event_id"])


def tag_comparison(spark, sf):
    t = growth.tag_comparison(A.page_views(spark, sf))
    return t.select("tag", "users", "events", "sessions",
                    F.round("events_per_user", 6).alias("events_per_user"))


def level_changes(spark, sf):
    lc = growth.level_changes(A.page_views(spark, sf))
    return lc.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "upgrades", "downgrades")


# --- catalog jobs ---------------------------------------------------------------

def _tracks(spark, sf):
    part = A.table(spark, sf, "part")
    tracks = part.select(F.concat(F.lit("TR"), F.col("p_partkey").cast("string")).alias("track_id"),
                         F.concat(F.lit("SO"), F.col("p_partkey").cast("string")).alias("song_id"),
                         F.col("p_brand").alias("artist"), F.col("p_name").alias("title"))
    durations = part.select(
        F.concat(F.lit("TR"), F.col("p_partkey").cast("string")).alias("track_id"),
        (F.col("p_size") * 10.0).alias("duration"))
    plays = A.table(spark, sf, "lineitem").select(
        F.concat(F.lit("SO"), F.col("l_partkey").cast("string")).alias("song_id"),
        F.col("l_quantity").alias("count"))
    return tracks, plays, durations


def listen_counts(spark, sf):
    """E1 E2 F6 D4 over part (tracks) and lineitem (plays)."""
    return catalog.track_listen_counts(*_tracks(spark, sf))


def _similar_keys(spark, sf) -> DataFrame:
    """(src_part, l_partkey, l_quantity) rows from orders: the first line's part of
    each order is the track, each later line one similar pair."""
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                               "l_quantity")
    # one narrow row per order from a partial aggregate, written: a hot order's
    # lines meet it in a join that can split them, not in one window task
    heads = materialize(li.groupBy("l_orderkey").agg(
        F.min(F.struct("l_linenumber", "l_partkey")).alias("_first")), "order_heads")
    j = li.join(heads, "l_orderkey").where(F.col("l_linenumber") != F.col("_first.l_linenumber"))
    return j.select(F.col("_first.l_partkey").alias("src_part"), "l_partkey", "l_quantity")


def _similar_rows(spark, sf) -> DataFrame:
    """:func:`_similar_keys` as (track, similar, score) rows."""
    j = _similar_keys(spark, sf)
    return j.select(F.concat(F.lit("TR"), F.col("src_part").cast("string")).alias("track_id"),
                    F.concat(F.lit("TR"), F.col("l_partkey").cast("string")).alias("similar_id"),
                    F.col("l_quantity").alias("score"))


def _similar_docs(spark, sf) -> DataFrame:
    """Similar-track documents derived from orders (see :func:`_similar_rows`),
    written as the JSON documents the similar-track loader reads."""
    r = _similar_rows(spark, sf)
    doc = F.to_json(F.struct(
        "track_id",
        F.array(F.array("similar_id", F.col("score").cast("string"))).alias("similars")))
    return r.select(doc.alias("value"))


SIMILAR_SCHEMA = "track_id string, similars array<array<string>>"


def similar_pairs(spark, sf):
    """Parse similar-track documents and explode their pair arrays."""
    docs = _similar_docs(spark, sf).select(F.from_json("value", SIMILAR_SCHEMA).alias("d")) \
        .select("d.*")
    return catalog.explode_similars(docs)


def similar_weights(spark, sf):
    """Pairs whose target has a play count, weighted by it (the
    pairs straight from the order lines; the JSON document form is parsed by
    ``similar_pairs`` / ``json_tree``)."""
    pairs = _similar_rows(spark, sf)
    counts = listen_counts(spark, sf)
    return catalog.similar_weights(pairs, counts).select(
        "track_id", "similar_id", "score", "weight", "total_weight")


def geo_dimension(spark, sf):
    """Zip population (from customers) joined to place names; the
    postal list carries a duplicate line per zip and the later one wins."""
    cust = A.table(spark, sf, "customer")
    gaz = cust.groupBy(F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip")).agg(
        F.count(F.lit(1)).alias("population"), F.round(F.avg("c_acctbal"), 6).alias("lat"))
    nat = A.table(spark, sf, "nation").join(
        A.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    zip_ = F.lpad(F.col("n_nationkey").cast("string"), 5, "0")
    postal = nat.select(zip_.alias("zip"), F.col("n_name").alias("city"),
                        F.col("r_name").alias("state"),
                        (F.col("n_nationkey") * 2).cast("long").alias("line_no")) \
        .unionByName(nat.select(zip_.alias("zip"), F.lower("n_name").alias("city"),
                                F.col("r_name").alias("state"),
                                (F.col("n_nationkey") * 2 + 1).cast("long").alias("line_no")))
    return catalog.locations(gaz, postal).select("zip", "population", "lat", "city", "state")


# --- sampling -------------------------------------------------------------------

def prefix_weights(spark, sf):
    part = A.table(spark, sf, "part").select("p_partkey", "p_size")
    r = prefix_ranges(part, "p_size", "p_partkey")
    return r.select("p_partkey", "lo", "hi")


def weighted_pick(spark, sf):
    """Each customer draws a part with probability by size; the
    key is ``(c_custkey * 7919) mod total`` so SQL can repeat it."""
    part = A.table(spark, sf, "part").select("p_partkey", "p_size")
    keys = A.table(spark, sf, "customer").select(
        "c_custkey", F.pmod(F.col("c_custkey") * 7919, total_weight(part, "p_size")).alias("k"))
    return pick_by_weight(keys, "k", part, "p_partkey", "p_size").select("c_custkey", "p_partkey")


def weighted_pick_seeded(spark, sf, seed: int = 42):
    """H4 as the generator does it: a seeded, deterministic draw per key
    (``pmod(xxhash64(key, seed), total)``; no ``rand()``, so a retried task
    draws the same). No SQL twin (DuckDB has no xxhash64); the tests check it
    against a brute-force recomputation."""
    from ..operators.sampling import seeded_key
    part = A.table(spark, sf, "part").select("p_partkey", "p_size")
    total = total_weight(part, "p_size")
    n = part.agg(F.count(F.lit(1))).scalar()
    ranges = prefix_ranges(part, "p_size", "p_partkey")
    keys = A.table(spark, sf, "customer").select(
        "c_custkey", seeded_key(F.col("c_custkey"), total, seed).alias("k"))
    width = F.greatest(F.lit(1).cast("long"), F.ceil(total / n).cast("long"))
    return range_lookup(keys, "k", ranges, width).select("c_custkey", "p_partkey")


def next_track(spark, sf):
    """H5 F8: each order line asks for the track after its part's track:
    drawn from that track's similar list (weighted by plays), or from all
    played tracks when it has none. Draw key: (orderkey*7919 + line*31 +
    partkey) mod total, so SQL can repeat it."""
    from ..operators.sampling import next_items
    # a track is moved and sorted by the number in its id, which is its part's key
    track = lambda c: F.concat(F.lit("TR"), F.col(c).cast("string"))
    # the two reference tables are built once and read back (they are used
    # by several branches of the plan)
    counts = materialize(listen_counts(spark, sf).select(
        F.substring("track_id", 3, 20).cast("long").alias("next_part"), F.col("count").alias("weight")), "listen_counts")
    pairs = _similar_keys(spark, sf).select("src_part", F.col("l_partkey").alias("next_part")).distinct()
    similar = pairs.join(counts, "next_part").select(F.col("src_part").alias("l_partkey"), "next_part", "weight")
    similar = materialize(similar, "similar_lists")
    req = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    key = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 31 + F.col("l_partkey"))
    out = next_items(req, "l_partkey", lambda tot: F.pmod(key, tot), similar, counts,
                     order_col="next_part", out="next_part", bucket_width=256)
    return out.select("l_orderkey", "l_linenumber", track("l_partkey").alias("track_id"),
                      track("next_part").alias("next_track"))


QUERIES = {
    "sliding_count": sliding_count,
    "tumbling_count": tumbling_count,
    "window_by_key": window_by_key,
    "distinct_users_window": distinct_users_window,
    "approx_users_window": approx_users_window,
    "approx_users_sketch": approx_users_sketch,
    "ordered_windows": ordered_windows,
    "date_parts": date_parts_q,
    "decode_events": decode_events,
    "decode_all_topics": decode_all_topics,
    "listens": listens,
    "status_changes": status_changes,
    "auth_attempts": auth_attempts,
    "previous_page": previous_page,
    "item_numbers": item_numbers,
    "sessionize": sessionize,
    "session_summary": session_summary,
    "transition_matrix": transition_matrix,
    "transition_matrix_closed": transition_matrix_closed,
    "event_gaps": event_gaps,
    "session_gaps": session_gaps,
    "play_through": play_through,
    "hourly_profile": hourly_profile,
    "weekday_class": weekday_class,
    "user_growth": user_growth,
    "churned_users": churned_users,
    "tag_comparison": tag_comparison,
    "level_changes": level_changes,
    "mask_users": mask_users,
    "tagged_users": tagged_users,
    "clean_fields": clean_fields,
    "time_range": time_range,
    "retain_days": retain_days,
    "ordered_events": ordered_events,
    "listen_counts": listen_counts,
    "similar_pairs": similar_pairs,
    "similar_weights": similar_weights,
    "geo_dimension": geo_dimension,
    "prefix_weights": prefix_weights,
    "weighted_pick": weighted_pick,
    "weighted_pick_seeded": weighted_pick_seeded,
    "next_track": next_track,
}
