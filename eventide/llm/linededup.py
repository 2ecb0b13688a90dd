"""Line dedup with levelled sorted runs of line hashes (native).

Lines are hashed once (two 64-bit hashes of the stripped, A-Z lower-cased
line). The documents arrive in batches. A batch counts the documents of
each line hash, merge-anti-joins the hashes that the runs already know to be
frequent (their fate is settled) and adds the rest as a new sorted run on level
0. When a level holds ``fanout`` runs they are compacted: merged by hash, counts
added, hashes that reach the limit moved to the sorted run of frequent ones, the
others written as one run of the next level. At the end one last compaction
over all levels leaves the frequent lines; all their occurrences go.

A frequent line is found by hash, so a hot line is a counter that is summed
map-side. Dropped line numbers are gathered per document (bounded by the
document), and texts without a dropped line are not joined line by line.

Rules: null or empty text is one empty line; an empty key is never dropped;
several occurrences in one document count once; equal rows (same id and text)
count as separate documents and get the same answer; lines with equal keys are ties
and go or stay together; a very long text is one row, read whole; other columns are not
read, so their names are free; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import BLANKS, ascii_lower, broadcast_within, row_keys, table
from eventide.session import materialize, scratch_path

BATCHES = 4
FANOUT = 2
MAX_BROADCAST = 500_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def _hashed(k: Column) -> Column:
    return F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(7), k).alias("h2"))


def hash_lines(docs: DataFrame, batches: int, id_col: str, text_col: str) -> DataFrame:
    """Written once: k1, k2, batch, lines (hash pairs), uniq (distinct ones)."""
    k1, k2 = row_keys(F.col(id_col), F.col(text_col))
    spark = docs.sparkSession
    path = scratch_path(spark, "tables", "line_hashes")
    keyed = docs.select(k1.alias("k1"), k2.alias("k2"),
                        F.transform(lines_of(F.col(text_col)), line_key).alias("keys"))
    (keyed.select("k1", "k2", F.transform("keys", _hashed).alias("lines"),
                  F.transform(F.filter(F.array_distinct("keys"), lambda k: k != ""), _hashed).alias("uniq"),
                  F.pmod("k1", F.lit(batches)).cast("int").alias("batch"))
     .write.partitionBy("batch").parquet(path))
    return spark.read.schema("k1 long, k2 long, lines array<struct<h1 long, h2 long>>, "
                             "uniq array<struct<h1 long, h2 long>>, batch int").parquet(path)


class LineRuns:
    """Sorted runs of (h1, h2, n) in levels, and one run of frequent hashes."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = [[]]
        self.frequent = spark.range(0).select(F.col("id").alias("h1"), F.col("id").alias("h2"))

    def _run(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df.sortWithinPartitions("h1", "h2"), name)

    def _fresh(self, counts: DataFrame) -> DataFrame:
        """``counts`` without the frequent hashes. The condition on n holds for every row; with it
        the join stays above the count, as on the keys alone the optimizer would put it below, and
        then every occurrence of a hot line, not its partial counts, is sent to one task."""
        c, f = counts.hint("merge").alias("c"), self.frequent.hint("merge").alias("f")
        known = (F.col("c.h1") == F.col("f.h1")) & (F.col("c.h2") == F.col("f.h2")) & (F.col("c.n") > 0)
        return c.join(f, known, "left_anti")

    def add_batch(self, hashes: DataFrame) -> None:
        """``hashes``: (h1, h2), one row per document and distinct line."""
        counts = hashes.groupBy("h1", "h2").agg(F.count("*").alias("n"))
        fresh = self._fresh(counts)
        self.levels[0].append(self._run(fresh, "line_run"))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._compact(self.levels[level]))
            self.levels[level] = []
            level += 1

    def _compact(self, runs: list[DataFrame]) -> DataFrame:
        both = runs[0]
        for r in runs[1:]:
            both = both.unionByName(r)
        merged = self._run(both.groupBy("h1", "h2").agg(F.sum("n").alias("n")), "line_merge")
        found = merged.filter(F.col("n") >= self.min_docs).select("h1", "h2")
        self.frequent = self._run(self.frequent.unionByName(found).distinct(), "line_frequent")
        return merged.filter(F.col("n") < self.min_docs)

    def finish(self) -> DataFrame:
        """(h1, h2) of all lines found in at least ``min_docs`` documents."""
        runs = [r for level in self.levels for r in level]
        if runs:
            self.levels = [[], [self._compact(runs)]]
        return self.frequent


def dropped_lines(docs: DataFrame, min_docs: int = 10, batches: int = BATCHES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k1, k2, drop (array of line numbers) of documents that lose lines."""
    hashed = hash_lines(docs, batches, id_col, text_col)
    runs = LineRuns(docs.sparkSession, min_docs)
    for b in range(batches):
        runs.add_batch(hashed.filter(F.col("batch") == b).select(F.explode("uniq").alias("h")).select("h.*"))
    frequent = runs.finish()
    lines = (hashed.select("k1", "k2", F.posexplode("lines").alias("line", "h"))
             .select("k1", "k2", "line", F.col("h")["h1"].alias("h1"), F.col("h")["h2"].alias("h2")))
    hit = lines.join(broadcast_within(frequent, MAX_BROADCAST), ["h1", "h2"], "left_semi")
    return materialize(hit.groupBy("k1", "k2").agg(F.collect_set("line").alias("drop")), "dropped_lines")


def _without(parts: Column, gone: Column) -> Column:
    """``parts`` without the places in the sorted array ``gone``: the stretches
    between them, so the work is linear in the document."""
    last = F.lit(-1)

    def stretch(k: Column) -> Column:
        before = F.coalesce(F.get(gone, k - 1), last)
        return F.slice(parts, before + 2, F.coalesce(F.get(gone, k), F.size(parts)) - before - 1)
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), stretch))


def drop_lines(docs: DataFrame, min_docs: int = 10, batches: int = BATCHES,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` columns id, text and n_lines, n_dropped, kept (the text left)."""
    drop = dropped_lines(docs, min_docs, batches, id_col, text_col)
    k1, k2 = row_keys(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), k1.alias("k1"), k2.alias("k2"))
    # line numbers have no bound in bytes, so this table is never broadcast
    out = rows.join(drop, ["k1", "k2"], "left")
    parts = lines_of(F.col("text"))
    kept = F.when(F.col("drop").isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(
        F.array_join(_without(parts, F.sort_array("drop")), "\n"))
    return out.select("doc_id", "text", F.size(parts).cast("long").alias("n_lines"),
                      F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("kept"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in 10 or more documents dropped from all documents."""
    out = drop_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
