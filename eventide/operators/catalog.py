"""Reference-table batch jobs: listen counts, similar tracks, locations
(E1-E4, F6-F9, D4, D5, I1, I2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def sum_plays(plays: DataFrame, song_col: str = "song_id",
              count_col: str = "count") -> DataFrame:
    """total plays per song, as long (partial aggregate map-side)."""
    return plays.groupBy(song_col).agg(F.sum(F.col(count_col).cast("long")).alias("plays"))


def last_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """keep the last row per key (later line wins), as the hash-map
    overwrite does. ``max_by`` is a partial aggregate; no window sort."""
    cols = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(order_col))
    return df.groupBy(key).agg(last.alias("_r")).select(key, "_r.*")


def track_listen_counts(tracks: DataFrame, plays: DataFrame, durations: DataFrame,
                        keep_unplayed: bool = False) -> DataFrame:
    """E1 + E2 + F6 + D4: per track its artist, title, duration and total
    plays.

    ``tracks``: track_id, song_id, artist, title. ``plays``: song_id, count.
    ``durations``: track_id, duration. Plays are summed before the join so
    the join sees one row per song; tracks without a duration are dropped
    (inner join; list them with :func:`tracks_without_duration`).
    """
    counts = sum_plays(plays)
    j = tracks.join(counts, "song_id", "left") \
        .withColumn("plays", F.coalesce(F.col("plays"), F.lit(0).cast("long")))
    j = j.join(durations, "track_id", "inner")
    if not keep_unplayed:
        j = j.where(F.col("plays") > 0)
    return j.select("track_id", "artist", "title", "duration", F.col("plays").alias("count"))


def tracks_without_duration(tracks: DataFrame, durations: DataFrame) -> DataFrame:
    """E2 misses: tracks whose id has no duration row."""
    return tracks.join(durations, "track_id", "left_anti")


def explode_similars(df: DataFrame, id_col: str = "track_id",
                     arr_col: str = "similars") -> DataFrame:
    """An array of ``[similar_id, score]`` pairs -> one row per pair.
    Fields are taken inside ``transform`` first, then exploded (a generator
    cannot sit inside an expression)."""
    pairs = F.transform(F.col(arr_col), lambda a: F.struct(
        a[0].alias("similar_id"), a[1].cast("double").alias("score")))
    return df.select(F.col(id_col), F.explode(pairs).alias("_p")) \
        .select(id_col, "_p.similar_id", "_p.score")


def similar_weights(pairs: DataFrame, track_counts: DataFrame,
                    id_col: str = "track_id") -> DataFrame:
    """E4 + F8: keep pairs whose target is a known track and weight each by
    the target's play count. Stays one row per pair; ``total_weight`` (F7)
    per track is a partial aggregate joined back (a per-track window would
    put a hot track's pairs in one task). Counts, weighted pairs and totals are
    written, so both joins read plain tables: AQE then splits a hot track,
    and the pairs are computed once."""
    known = materialize(track_counts.select(F.col(id_col).alias("similar_id"),
                                            F.col("count").alias("weight")), "known_tracks")
    j = materialize(pairs.join(known, "similar_id", "inner"), "weighted_pairs")
    totals = materialize(j.groupBy(id_col).agg(F.sum("weight").alias("total_weight")), "pair_totals")
    return j.join(totals, id_col)


def locations(gazetteer: DataFrame, postal: DataFrame) -> DataFrame:
    """Zip population and position joined to its place name; a zip that
    appears twice in the postal file keeps its last line (F9)."""
    names = last_per_key(postal, "zip", "line_no").drop("line_no")
    return gazetteer.join(names, "zip", "inner")
