"""SimHash near-dedup with sharded BK-trees.

A fingerprint bit is 1 if more than half of the XXH64 hashes of a text's
word shingles have it set. Two fingerprints link if at most ``radius`` bits
differ. With ``radius`` + 1 blocks of bits, linked fingerprints agree in a whole
block, so a fingerprint belongs to one shard per block and meets all its
neighbours there. In a shard the fingerprints form a BK-tree: a child hangs
under its parent's edge of their Hamming distance d, and a search with distance
d to a node follows only the edges d - radius .. d + radius. The trees of many
shards are built and searched together, level by level, as arrays.

A shard with more than ``SHARD_ROWS`` fingerprints is cut again by blocks of the
bits its members need not share, which loses no link, until 12 bits are free at
most: so few bits make no more than 4,096 fingerprints. From the third cut on a shard
that needs only as many salts as a cut makes copies (``radius`` + 1) is salted
instead: its tree goes to every salt, and each salt searches its share of the
queries. Trees are sent to the queries of their own shard only; all trees
together grow with the data and are never broadcast to everyone. A shard emits no pairs but a star per local
component; stars are joined by connected components.

Rules: texts without words have fingerprint 0 and link like any other; equal
texts share a fingerprint, which enters a tree once; a component of null ids
only has a null id; of ties (one id with several rows) any row may stay, as they link alike; very
long texts are hashed whole; ``keep_one`` packs the columns of the input, so names cannot
clash; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import broadcast_within, keyed_rows, row_keys, table
from eventide.llm.components import connected_components
from eventide.session import materialize, ship_package

SHINGLE = 3
RADIUS = 3
SEED = 42
SHARD_ROWS = 4096
LEVELS = 3
FREE_BITS = 12
FOREST_ROWS = 200_000
FRONTIER = 1 << 20


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """The SimHash of a text as a signed 64-bit number."""
    from xxhash import xxh64_intdigest as h

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII rules
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        hashes = [h(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.r_[0, ends[:-k]].tolist()
        hashes = [h(joined[a:b], SEED) for a, b in zip(starts, (ends[k - 1:] - 1).tolist())]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE, text_col: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with a long column ``name``."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, k) for t in texts], dtype="int64")

    return docs.withColumn(name, simhash(F.col(text_col)))


class Forest:
    """BK-trees of several shards. ``keys`` are sorted shard numbers of ``fps``."""

    def __init__(self, keys: np.ndarray, fps: np.ndarray):
        self.fps = fps.view(np.uint64)
        n = len(fps)
        rows, group = np.arange(n), keys
        above = np.full(n, -1)  # the parent a row waits under
        dist = np.zeros(n, np.int64)
        parents, edges, kids = [], [], []
        self.roots = None
        while len(rows):
            first = np.r_[True, group[1:] != group[:-1]]
            head = rows[first]  # the first row of a group is its node
            if self.roots is None:
                self.roots = head[np.cumsum(first) - 1]
            else:
                parents.append(above[first])
                edges.append(dist[first])
                kids.append(head)
            node = head[np.cumsum(first) - 1][~first]
            rows = rows[~first]
            dist = np.bitwise_count(self.fps[rows] ^ self.fps[node]).astype(np.int64)
            order = np.argsort(node * 65 + dist, kind="stable")
            rows, above, dist = rows[order], node[order], dist[order]
            group = above * 65 + dist
        parents, edges, kids = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (parents, edges, kids))
        edge = parents * 65 + edges
        order = np.argsort(edge)
        self.edge, self.kid = edge[order], kids[order]

    def components(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """Smallest row linked with each row, through the rows of ``queries``."""
        label = np.arange(len(self.fps))
        todo = [(queries[i:i + FRONTIER], self.roots[queries[i:i + FRONTIER]])
                for i in range(0, len(queries), FRONTIER)]
        while todo:
            q, node = todo.pop()
            d = np.bitwise_count(self.fps[q] ^ self.fps[node]).astype(np.int64)
            near = (d <= radius) & (q != node)
            self._join(label, q[near], node[near])
            lo = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), "right")
            n = hi - lo
            # as many (query, child) rows as fit at once; the rest waits
            cuts = np.searchsorted(np.cumsum(n), np.arange(FRONTIER, n.sum(), FRONTIER)).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(n)]):
                c = n[a:b]
                if c.sum():
                    at = np.repeat(lo[a:b] - (np.cumsum(c) - c), c) + np.arange(c.sum())
                    todo.append((np.repeat(q[a:b], c), self.kid[at]))
        return label

    @staticmethod
    def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = label[a], label[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            m = np.minimum(x, y)
            np.minimum.at(label, x, m)
            np.minimum.at(label, y, m)
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def _cut_by_blocks(rows: DataFrame, width: int, blocks: int) -> DataFrame:
    """(fp, key, rest) -> one row per block of the ``width`` low bits of rest: the
    key also names the block's value, and rest holds the bits left over."""
    edges = [width * i // blocks for i in range(blocks + 1)]
    low = lambda a: F.lit((1 << a) - 1).cast("long")
    cut = F.array(*[F.struct(
        F.xxhash64("key", F.lit(i), F.shiftrightunsigned("rest", a).bitwiseAND(low(b - a))).alias("key"),
        (F.lit(0).cast("long") if b == 64 else F.shiftleft(F.shiftrightunsigned("rest", b), a))
        .bitwiseOR(F.col("rest").bitwiseAND(low(a))).alias("rest"))
        for i, (a, b) in enumerate(zip(edges, edges[1:]))])
    return rows.select("fp", F.explode(cut).alias("p")).select("fp", "p.key", "p.rest")


def _shards(fps: DataFrame, radius: int) -> DataFrame:
    """(key, salt, fp, query): the shards of every distinct fingerprint.

    The members of a shard of over ``SHARD_ROWS`` agree in a block, so linked
    ones agree in a block of their other bits too: the shard is cut again by
    those, until at most ``FREE_BITS`` are left (or no block would have a bit).
    After ``LEVELS`` cuts, a shard of a few times ``SHARD_ROWS`` is salted where
    that makes no more rows than another cut. So no tree has more than
    ``SHARD_ROWS`` * (radius + 1) rows."""
    blocks, width = radius + 1, 64
    rows = fps.select("fp", F.lit(0).cast("long").alias("key"), F.col("fp").alias("rest"))
    done = None
    for level in count(1):
        rows = _cut_by_blocks(rows, width, blocks)
        width -= width // blocks
        large = (rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > SHARD_ROWS)
                 .select("key", F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("salts")))
        large = materialize(large, "simhash_large")
        marked = (rows.join(broadcast_within(large, 100_000), "key", "left")
                  .withColumn("salts", F.coalesce("salts", F.lit(1))))
        again = F.col("salts") > (1 if level < LEVELS else blocks)
        last = width <= max(FREE_BITS, blocks) or large.filter(again).isEmpty()
        part = (marked if last else marked.filter(~again)).select("key", "fp", "salts")
        done = part if done is None else done.unionByName(part)
        if last:
            break
        rows = materialize(marked.filter(again).select("fp", "key", "rest"), "simhash_again")
    own = F.pmod(F.xxhash64("fp"), F.col("salts"))
    return (done.select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
            .select("key", "salt", "fp", (F.col("own") == F.col("salt")).alias("query")))


def _search(radius: int):
    def stars(group: tuple) -> pa.RecordBatch:
        shard, fps, query = group
        forest = Forest(shard, fps)
        label = forest.components(np.flatnonzero(query), radius)
        linked = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(fps[linked]), pa.array(fps[label[linked]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        for batch in batches:
            key = batch.column("key").to_numpy() * 1_000_003 + batch.column("salt").to_numpy()
            held.append((key, batch.column("fp").to_numpy(), batch.column("query").to_numpy(zero_copy_only=False)))
            count += len(key)
            if count >= FOREST_ROWS and held[0][0][0] != key[-1]:
                key, fps, query = (np.concatenate(x) for x in zip(*held))
                cut = int(np.flatnonzero(key != key[-1])[-1]) + 1  # the last shard may go on
                yield stars((key[:cut], fps[:cut], query[:cut]))
                held, count = [(key[cut:], fps[cut:], query[cut:])], len(key) - cut
        if count:
            yield stars(tuple(np.concatenate(x) for x in zip(*held)))
    return run


def link_fingerprints(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, label): for every distinct fingerprint with a neighbour, the
    smallest fingerprint of its component."""
    ship_package(fps.sparkSession)
    shards = _shards(fps, radius)
    dealt = shards.repartition("key", "salt").sortWithinPartitions("key", "salt")
    links = materialize(dealt.mapInArrow(_search(radius), "a long, b long"), "simhash_links")
    return connected_components(links).withColumnRenamed("node", "fp")


def with_components(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``rows`` (a written table with doc_id and fp) with component_id and label."""
    uniq = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash_uniq")
    lab = link_fingerprints(uniq.select("fp"), radius)
    named = uniq.join(lab, "fp", "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    least = materialize(named.groupBy("label").agg(F.min("first").alias("component_id")), "simhash_least")
    named = materialize(materialize(named, "simhash_named").join(least, "label").select("fp", "label", "component_id"), "simhash_named")
    return rows.join(named, "fp")


def keep_one(docs: DataFrame, k: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked fingerprints: the smallest
    id (nulls last; equal ids by row hash; of equal rows, one)."""
    k1, k2 = row_keys(F.col(id_col), F.col(text_col))
    rows = fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"),
                                    k1.alias("k1"), k2.alias("k2")), k, "_text")
    rows = materialize(rows.select("doc_id", "fp", "k1", "k2"), "simhash_rows")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    best = (with_components(rows, radius).groupBy("label").agg(F.min(order).alias("o"))
            .select(F.col("o")["k1"].alias("_k1"), F.col("o")["k2"].alias("_k2")))
    best = materialize(best, "simhash_best")
    again = materialize(rows.groupBy(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).count().filter("count > 1")
                        .select("_k1", "_k2"), "simhash_equal_rows")
    keyed = keyed_rows(docs, id_col, text_col)
    single = keyed.join(best.join(again, ["_k1", "_k2"], "left_anti"), ["_k1", "_k2"], "left_semi")
    if again.isEmpty():
        return single.select("_row.*")
    double = (keyed.join(best.join(again, ["_k1", "_k2"], "left_semi"), ["_k1", "_k2"], "left_semi")
              .dropDuplicates(["_k1", "_k2"]))
    return single.unionByName(double).select("_row.*")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = materialize(fingerprints(docs).select("doc_id", "fp"), "simhash_rows")
    return with_components(rows).select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
