"""Helpers shared by the corpus operators.

Row identity: ``doc_id`` may be null or repeated, so rows are tied together by
two independent 64-bit hashes of (id, text). Rows with equal keys are equal
rows and get the same answer.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

# Strip set / word separators of every contract: space and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"
WORD_REGEX = r"[^\x20\x09-\x0D]+"
BLANK_REGEX = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_keys(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Two independent hashes that stand for a row's (id, text)."""
    return F.xxhash64(doc_id, text), F.xxhash64(F.lit(7), text, doc_id)


def keyed_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_row (all columns, so that none clashes), _k1, _k2."""
    k1, k2 = row_keys(F.col(id_col), F.col(text_col))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), k1.alias("_k1"), k2.alias("_k2"))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does that for pure ASCII and is much
    faster than ``translate``, which the rest takes."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.when(F.octet_length(c) == F.char_length(c), F.lower(c))
            .otherwise(F.translate(c, upper, upper.lower())))


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only for a table counted at ``max_rows`` narrow rows or
    fewer; otherwise the plain (shuffled, skew-split) join is left to Spark.
    ``df`` should be a written table: the count is then read from footers."""
    return F.broadcast(df) if df.count() <= max_rows else df


CHUNK = 4096


def repeated(df: DataFrame, times: Column, name: str) -> DataFrame:
    """Every row ``times`` times, numbered by a long column ``name`` from 0 (rows with
    0 or null go). A row that is wanted very often becomes chunks first, which are
    dealt out again, so neither one task nor one array holds a hot row's copies."""
    d = df.withColumn("_times", times.cast("long")).filter(F.col("_times") > 0)
    few = d.filter(F.col("_times") <= CHUNK).withColumn("_chunk", F.lit(0).cast("long"))
    many = (d.filter(F.col("_times") > CHUNK)
            .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_times") - 1) / CHUNK)))))
    many = many.repartition(F.xxhash64(*[c for c in df.columns if not isinstance(df.schema[c].dataType, MapType)], "_chunk"))
    low = F.col("_chunk") * CHUNK
    both = few.unionByName(many)
    return (both.withColumn(name, F.explode(F.sequence(low, F.least(low + CHUNK, F.col("_times")) - 1)))
            .drop("_times", "_chunk"))


def text_chunks(texts, max_bytes: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """(start, end) slices of a batch of strings holding about ``max_bytes``
    characters each (a single longer text is a slice of its own)."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > max_bytes:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
