"""Event files and reference-table files.

All readers are plain ``spark.read`` calls with explicit schemas (no
inference pass over the data), so they split and prune like any scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S

LATIN1 = "ISO-8859-1"
WHOLE_FILE = "\x01\x02\x01\x02"


def read_event_files(spark: SparkSession, path: str | list[str], topic: str,
                     stream: bool = False, with_tag: bool = True,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A4: one JSON object per line, one folder per topic (batch or stream)."""
    r = (spark.readStream if stream else spark.read).schema(S.get_schema(topic, with_tag))
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(path)


def capitalise(c: Column) -> Column:
    """First letter upper, the rest lower ('VAN DYKE' -> 'Van dyke');
    unlike ``initcap`` it does not capitalise later words."""
    return F.concat(F.upper(c.substr(F.lit(1), F.lit(1))), F.lower(c.substr(F.lit(2), F.length(c))))


def remove_tabs(c: Column) -> Column:
    """A tab becomes five spaces."""
    return F.replace(c, F.lit("\t"), F.lit("     "))


def unquote(c: Column) -> Column:
    """Strip one pair of surrounding double quotes."""
    return F.regexp_replace(c, r'^"(.*)"$', "$1")


def default_duration(c: Column, default: float = 180.0) -> Column:
    """C14: an empty duration defaults to 180 seconds."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")).cast("double"), F.lit(default))


def field(parts: Column, n: int) -> Column:
    """C17: field ``n`` (0-based) of a split, null when too short."""
    return F.get(parts, n)


def read_song_analysis(spark: SparkSession, path: str | list[str],
                       id_field: int = 30, duration_field: int = 3) -> DataFrame:
    """A10: whitespace-separated analysis lines (Latin-1): track id and
    duration fields."""
    parts = F.split(F.col("value"), r"\s+")
    return _latin1_text(spark, path).select(
            field(parts, id_field).alias("track_id"),
            field(parts, duration_field).cast("double").alias("duration"))


def _latin1_text(spark: SparkSession, path) -> DataFrame:
    # the text source is UTF-8 only; csv with an unused separator reads
    # whole lines in any charset
    return spark.read.schema("value string").options(
        sep="\u0001", encoding=LATIN1, quote="", escape="").csv(path)


def read_triplets(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tab-separated (user, song id, count), Latin-1."""
    return spark.read.schema("user string, song_id string, count long").options(
        sep="\t", encoding=LATIN1).csv(path)


def read_unique_tracks(spark: SparkSession, path: str | list[str],
                       with_rejects: bool = False):
    """A12 + D5: ``<SEP>``-separated track id, song id, artist, title;
    rows with fewer than four fields are dropped (and returned apart when
    ``with_rejects``)."""
    raw = spark.read.schema("track_id string, song_id string, artist string, title string") \
        .options(sep="<SEP>", encoding=LATIN1, quote="").csv(path)
    ok = raw.where(F.col("title").isNotNull())
    if with_rejects:
        return ok, raw.where(F.col("title").isNull())
    return ok


def read_json_tree(spark: SparkSession, paths: str | list[str], schema: str | T.StructType,
                   multiline: bool = True) -> DataFrame:
    """A13 + I1: every JSON document under one or more folders (recursive);
    several roots are one scan (a union of paths). A multi-line file is one document or
    an array of them.

    A multi-line file is read as one record that no separator ends (JSON holds no raw control
    characters), so it is parsed from memory: Spark's ``multiLine`` reader goes back to the
    file for each number that the schema takes as a string."""
    options = {"lineSep": WHOLE_FILE} if multiline else {}
    return spark.read.schema(schema).options(recursiveFileLookup="true", **options).json(paths)


def read_listen_counts(spark: SparkSession, path: str | list[str],
                       partitions: int | None = None) -> DataFrame:
    """A14 + C14: gzip TSV (track id, artist, title, duration, count),
    Latin-1; an empty duration is 180. Gzip is not splittable, so the rows
    are spread over ``partitions`` after the read when given."""
    df = spark.read.schema("track_id string, artist string, title string, duration string, "
                           "count long").options(sep="\t", encoding=LATIN1, quote="").csv(path)
    df = df.withColumn("duration", default_duration(F.col("duration")))
    return df.repartition(partitions) if partitions else df


def read_similar_csv(spark: SparkSession, path: str) -> DataFrame:
    """Gzip CSV of (track id, similar id); a missing file gives an
    empty table instead of an error."""
    schema = "track_id string, similar_id string"
    try:
        return spark.read.schema(schema).csv(path)
    except Exception as e:  # noqa: BLE001 - only a missing path is tolerated
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def _columns(n: int) -> str:
    """A schema of the first ``n`` string columns; further ones are not read."""
    return ", ".join(f"c{i} string" for i in range(n))


def read_gazetteer(spark: SparkSession, path) -> DataFrame:
    """A16 + D7: TSV with header; zip (0), population (1), lat (7), lon (8)."""
    df = spark.read.schema(_columns(9)).options(sep="\t", header="true", encoding=LATIN1).csv(path)
    return df.select(F.col("c0").alias("zip"), F.col("c1").cast("long").alias("population"),
                     F.col("c7").cast("double").alias("lat"), F.col("c8").cast("double").alias("lon"))


def read_postal(spark: SparkSession, path) -> DataFrame:
    """Postal TSV; zip (1), city (2), state (4), with its line order
    (``line_no``) so a repeated zip can keep its last line. The order is by
    file name, then by place in the file (a large file is read in splits)."""
    df = spark.read.schema(_columns(5)).options(sep="\t", encoding=LATIN1).csv(path)
    line = F.struct("_metadata.file_path", "_metadata.file_block_start",
                    F.monotonically_increasing_id().alias("row"))
    return df.select(F.col("c1").alias("zip"), F.col("c2").alias("city"), F.col("c4").alias("state"),
                     line.alias("line_no"))


def read_first_names(spark: SparkSession, path) -> DataFrame:
    """A17 + C15: CSV without header: name, gender, weight."""
    df = spark.read.schema("name string, gender string, weight long").csv(path)
    return df.withColumn("name", capitalise(F.col("name")))


def read_surnames(spark: SparkSession, path) -> DataFrame:
    """A18 + C15 + D7: CSV with header; name (0) and weight (2)."""
    df = spark.read.schema(_columns(3)).options(header="true").csv(path)
    return df.select(capitalise(F.col("c0")).alias("name"), F.col("c2").cast("long").alias("weight"))


def read_user_agents(spark: SparkSession, path) -> DataFrame:
    """UTF-16 TSV with header; weight (1), values (2-4). UTF-16 needs
    ``multiLine`` or the decoder garbles line ends."""
    df = spark.read.schema("name string, weight long, agent string, os string, browser string") \
        .options(sep="\t", header="true", encoding="UTF-16", multiLine="true").csv(path)
    return df.select("weight", "agent", "os", "browser")


def load_weighted(spark: SparkSession, path, sep: str = ",", thing_col: int = 0,
                  weight_col: int = 1, header: bool = False) -> DataFrame:
    """A generic weighted list file -> (thing, weight)."""
    df = spark.read.schema(_columns(max(thing_col, weight_col) + 1)) \
        .options(sep=sep, header=str(header).lower()).csv(path)
    return df.select(F.col(f"c{thing_col}").alias("thing"),
                     F.col(f"c{weight_col}").cast("long").alias("weight"))
