"""Registered queries for the reference-file loaders (A10-A20, B11, B12,
C11, C14-C17, D5, I1).

Each writes files that Spark derives from the driver tables into the shared
checkpoint folder (so their size grows with the tables), then reads them
back with the loaders and runs the batch job on top.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import from_nested, to_nested
from ..operators import catalog
from ..session import materialize, scratch_path
from ..sinks import writers
from ..sources import files
from . import adapters as A
from .queries import SIMILAR_SCHEMA, _similar_docs, _similar_rows


def _s(c):
    return F.col(c).cast("string")


def _write_track_files(spark: SparkSession, sf: str, base: str) -> None:
    part = A.table(spark, sf, "part")
    tid = F.concat(F.lit("TR"), _s("p_partkey"))
    sid = F.concat(F.lit("SO"), _s("p_partkey"))
    # unique tracks, '<SEP>'-separated
    line = F.concat_ws("<SEP>", tid, sid, "p_brand", "p_name")
    part.select(line.alias("value")).write.text(f"{base}/unique_tracks")
    # analysis lines: 31 whitespace-separated fields, duration at 3, id at 30
    fields = [F.lit("x")] * 3 + [(F.col("p_size") * 10.0).cast("string")] + \
        [F.lit("0")] * 26 + [tid]
    part.select(F.concat_ws("  ", *fields).alias("value")).write.text(f"{base}/analysis")
    # play triplets: user, song id, count
    li = A.table(spark, sf, "lineitem")
    li.select(_s("l_orderkey"), F.concat(F.lit("SO"), _s("l_partkey")),
              F.col("l_quantity").cast("long").cast("string")) \
        .write.option("sep", "\t").csv(f"{base}/triplets")


def _track_counts_from_files(spark: SparkSession, base: str) -> DataFrame:
    tracks = files.read_unique_tracks(spark, f"{base}/unique_tracks")
    durations = files.read_song_analysis(spark, f"{base}/analysis")
    plays = files.read_triplets(spark, f"{base}/triplets")
    return catalog.track_listen_counts(tracks, plays, durations)


def track_file_job(spark: SparkSession, sf: str) -> DataFrame:
    """A10 A11 A12 D5 + E1 E2 F6 D4: the listen-count job over text files."""
    base = scratch_path(spark, "track_file_job")
    _write_track_files(spark, sf, base)
    return _track_counts_from_files(spark, base)


def listen_count_file(spark: SparkSession, sf: str) -> DataFrame:
    """Write the listen counts as gzip TSV (an empty
    duration on every third size), read them back; empty -> 180."""
    base = scratch_path(spark, "listen_count_file")
    _write_track_files(spark, sf, base)
    counts = _track_counts_from_files(spark, base)
    size = F.regexp_extract("track_id", r"TR(\d+)", 1).cast("long")
    part = A.table(spark, sf, "part").select(F.col("p_partkey").alias("_k"), "p_size")
    out = counts.join(part, size == F.col("_k")).select(
        "track_id", "artist", "title",
        F.when(F.col("p_size") % 3 != 0, F.col("duration")).alias("duration"), "count")
    writers.write_tsv(out, f"{base}/listen_counts", compression="gzip")
    return files.read_listen_counts(spark, f"{base}/listen_counts")


def name_files(spark: SparkSession, sf: str) -> DataFrame:
    """First names (no header) and surnames (header)."""
    base = scratch_path(spark, "name_files")
    nat = A.table(spark, sf, "nation")
    nat.select(F.upper("n_name"), F.when(F.col("n_nationkey") % 2 == 0, "M").otherwise("F"),
               (F.col("n_nationkey") + 1).cast("string")).write.csv(f"{base}/first")
    cust = A.table(spark, sf, "customer")
    cust.select(F.upper(F.concat_ws(" ", "c_mktsegment", "c_name")).alias("name"),
                F.lit("1").alias("rank"), _s("c_custkey").alias("weight")) \
        .write.option("header", "true").csv(f"{base}/last")
    first = files.read_first_names(spark, f"{base}/first") \
        .select(F.lit("first").alias("kind"), "name", "weight")
    last = files.read_surnames(spark, f"{base}/last") \
        .select(F.lit("last").alias("kind"), "name", "weight")
    generic = files.load_weighted(spark, f"{base}/first", sep=",", thing_col=1, weight_col=2) \
        .groupBy(F.col("thing").alias("name")).agg(F.sum("weight").alias("weight")) \
        .select(F.lit("gender").alias("kind"), "name", "weight")
    return first.unionByName(last).unionByName(generic)


def user_agent_file(spark: SparkSession, sf: str) -> DataFrame:
    """A UTF-16 TSV with header, read with ``multiLine``."""
    base = scratch_path(spark, "user_agent_file")
    nat = A.table(spark, sf, "nation")
    nat.select(_s("n_name").alias("name"), (F.col("n_nationkey") + 1).cast("string").alias("w"),
               F.concat(F.lit("Mozilla/"), _s("n_nationkey")).alias("agent"),
               F.lit("Windows").alias("os"), F.lit("Chrome").alias("browser")) \
        .write.options(sep="\t", header="true", encoding="UTF-16").csv(f"{base}/ua")
    return files.read_user_agents(spark, f"{base}/ua").toDF("weight", "agent", "os", "browser")


def json_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Similar-track documents in two folder trees (by order key
    parity), read recursively as one scan and exploded."""
    base = scratch_path(spark, "json_tree")
    li_docs = _similar_docs(spark, sf)
    li_docs.where(F.length("value") % 2 == 0).write.text(f"{base}/train/A/B")
    li_docs.where(F.length("value") % 2 == 1).write.text(f"{base}/test/C")
    docs = files.read_json_tree(spark, [f"{base}/train", f"{base}/test"], SIMILAR_SCHEMA,
                                multiline=False)
    return catalog.explode_similars(docs)


def json_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-line JSON files, each an array of similar-track documents: a document
    lists at most four line numbers of an order. Documents are dealt to files of about a thousand."""
    base = scratch_path(spark, "json_documents")
    li = A.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    pair = F.concat(F.lit('    ["'), _s("l_partkey"), F.lit('", '), _s("l_quantity"), F.lit("]"))
    # spread before collecting: a list does not shrink in a partial aggregate, which would only
    # keep the few tasks that read the file busy
    li = li.withColumn("b", F.floor((F.col("l_linenumber") - 1) / 4)).repartition("l_orderkey", "b")
    lists = li.groupBy("l_orderkey", "b").agg(
        F.array_join(F.sort_array(F.collect_list(pair)), ",\n").alias("l"))
    doc = F.concat(F.lit('{"track_id": "'), _s("l_orderkey"), F.lit('",\n  "similars": [\n'), F.col("l"), F.lit("\n]}"))
    docs = materialize(lists.select(F.xxhash64("l_orderkey", "b").alias("h"), doc.alias("doc")), "json_documents")
    n_files = docs.count() // 1000 + 1
    text = F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("doc")), ",\n"), F.lit("]"))
    # one row is one file, in one flat folder: a folder per file costs the driver a few
    # file system calls each, at commit and again at listing
    (docs.groupBy(F.pmod("h", F.lit(n_files)).alias("file")).agg(text.alias("value")).select("value")
     .write.option("maxRecordsPerFile", 1).text(f"{base}/docs"))
    return catalog.explode_similars(files.read_json_tree(spark, f"{base}/docs", SIMILAR_SCHEMA))


def location_files(spark: SparkSession, sf: str) -> DataFrame:
    """A gazetteer and two postal files (tab-separated); a zip
    that is in both postal files keeps its line of the later one."""
    base = scratch_path(spark, "location_files")
    zip_ = lambda c: F.lpad(_s(c), 5, "0")
    dot = F.lit(".")
    cust = A.table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    cust.select(zip_("c_nationkey").alias("zip"), F.col("n").alias("population"),
                *[dot.alias(f"x{i}") for i in range(5)], (F.col("c_nationkey") / 2.0).alias("lat"),
                F.lit(-1.5).alias("lon")) \
        .write.options(sep="\t", header="true").csv(f"{base}/gazetteer")
    nat = A.table(spark, sf, "nation").join(
        A.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    for i, city in enumerate([F.col("n_name"), F.lower("n_name")]):
        nat.select(F.lit("US"), zip_("n_nationkey"), city, dot, "r_name") \
            .write.option("sep", "\t").csv(f"{base}/postal/{i}")
    postal = files.read_postal(spark, [f"{base}/postal/0", f"{base}/postal/1"])
    gaz = files.read_gazetteer(spark, f"{base}/gazetteer")
    return catalog.locations(gaz, postal).select("zip", "population", "lat", "lon", "city", "state")


def similar_csv(spark: SparkSession, sf: str) -> DataFrame:
    """(track, similar) pairs as gzip CSV, read back."""
    base = scratch_path(spark, "similar_csv")
    writers.write_gzip_csv(_similar_rows(spark, sf).select("track_id", "similar_id"), f"{base}/similar")
    return files.read_similar_csv(spark, f"{base}/similar")


def retain_by_date(spark: SparkSession, sf: str) -> DataFrame:
    """Events partitioned by date, rewritten with the last seven dates."""
    base = scratch_path(spark, "retain_by_date")
    ev = A.events(spark, sf).select("event_id", F.to_date("ts").alias("date"))
    ev.repartition("date", F.pmod(F.xxhash64("event_id"), F.lit(8))) \
        .write.partitionBy("date").parquet(f"{base}/all")
    writers.retain_dates(spark, f"{base}/all", f"{base}/kept", 7)
    kept = spark.read.parquet(f"{base}/kept")
    return kept.select("event_id", F.date_format("date", "yyyy-MM-dd").alias("date"))


def nested_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Page views -> nested record shape (detail maps of union
    values, song struct) -> JSON -> parsed back -> flat columns."""
    pv = A.page_views(spark, sf)
    u = F.col("user_id")
    flat = pv.select(
        F.unix_millis("ts").alias("ts"), F.col("session_id").alias("sessionid"), "level",
        F.col("item_in_session").alias("iteminsession"), "page", "auth", "method", "status",
        "tag", u.alias("userid"),
        F.concat(F.lit("city_"), (u % 10).cast("string")).alias("city"),
        F.lpad(u.cast("string"), 5, "0").alias("zip"),
        (u * 1000).alias("registration"), (u / 10.0).alias("lat"),
        F.when(F.col("page") == "NextSong", F.concat(F.lit("artist_"), (u % 7).cast("string")))
        .alias("artist"),
        F.when(F.col("page") == "NextSong", F.concat(F.lit("song_"), F.col("event_id").cast("string")))
        .alias("song"),
        "duration", "event_id")
    nested = to_nested(flat)
    from .. import schemas as S
    text = writers.to_json_lines(nested)
    back = text.select(F.from_json("value", S.nested_schema(S.PAGE_VIEW)).alias("r")).select("r.*")
    out = from_nested(back)
    return out.select("ts", "sessionid", "userid", "page", "city", "zip", "registration",
                      "lat", "artist", "song", "duration")


FILE_QUERIES = {
    "track_file_job": track_file_job,
    "listen_count_file": listen_count_file,
    "name_files": name_files,
    "user_agent_file": user_agent_file,
    "json_tree": json_tree,
    "json_documents": json_documents,
    "location_files": location_files,
    "similar_csv": similar_csv,
    "retain_by_date": retain_by_date,
    "nested_round_trip": nested_round_trip,
}


def _file_sql() -> dict[str, str]:
    from .oracle import SQL, pv_cte
    lc = SQL["listen_counts"]
    return {
        "track_file_job": lc,
        "listen_count_file": lc.replace(
            "CAST(p_size AS DOUBLE) * 10.0 AS duration",
            "CASE WHEN p_size % 3 = 0 THEN 180.0 ELSE CAST(p_size AS DOUBLE) * 10.0 END"
            " AS duration"),
        "name_files": """
SELECT 'first' AS kind, upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS name,
       CAST(n_nationkey + 1 AS BIGINT) AS weight FROM nation
UNION ALL
SELECT 'last', upper(substr(s, 1, 1)) || lower(substr(s, 2)), c_custkey
FROM (SELECT upper(c_mktsegment || ' ' || c_name) AS s, c_custkey FROM customer)
UNION ALL
SELECT 'gender', CASE WHEN n_nationkey % 2 = 0 THEN 'M' ELSE 'F' END,
       CAST(sum(n_nationkey + 1) AS BIGINT)
FROM nation GROUP BY 2""",
        "user_agent_file": """
SELECT CAST(n_nationkey + 1 AS BIGINT) AS weight, 'Mozilla/' || n_nationkey AS agent,
       'Windows' AS os, 'Chrome' AS browser FROM nation""",
        "json_tree": SQL["similar_pairs"],
        "json_documents": """
SELECT CAST(l_orderkey AS VARCHAR) AS track_id, CAST(l_partkey AS VARCHAR) AS similar_id,
       CAST(l_quantity AS DOUBLE) AS score FROM lineitem""",
        "location_files": """
WITH g AS (SELECT c_nationkey AS k, count(*) AS population FROM customer GROUP BY 1)
SELECT lpad(CAST(k AS VARCHAR), 5, '0') AS zip, population, k / 2.0 AS lat,
       CAST(-1.5 AS DOUBLE) AS lon, lower(n_name) AS city, r_name AS state
FROM g JOIN nation ON n_nationkey = k JOIN region ON n_regionkey = r_regionkey""",
        "similar_csv": f"SELECT track_id, similar_id FROM ({SQL['similar_pairs']}) AS s",
        "retain_by_date": """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events
WHERE CAST(ts AS DATE) > (SELECT CAST(max(ts) AS DATE) - 7 FROM events)""",
        "nested_round_trip": f"""
WITH {pv_cte()}
SELECT epoch_us(ts) // 1000 AS ts, session_id AS sessionid, user_id AS userid, page,
       'city_' || (user_id % 10) AS city, lpad(CAST(user_id AS VARCHAR), 5, '0') AS zip,
       user_id * 1000 AS registration, CAST(user_id AS DOUBLE) / 10.0 AS lat,
       CASE WHEN page = 'NextSong' THEN 'artist_' || (user_id % 7) END AS artist,
       CASE WHEN page = 'NextSong' THEN 'song_' || event_id END AS song,
       CASE WHEN page = 'NextSong' THEN duration END AS duration
FROM pv""",
    }


FILE_SQL = _file_sql()
