"""Sharding by minimax contiguous partition (native).

Rows with equal texts form an atomic group. Groups are ordered by the hash of
their text and packed into at most 2**14 ordered units (the top bits of the
hash), so the search works on one bounded array whatever the table holds, and a
group is never cut. The smallest feasible shard capacity is found by binary
search over that array, from the largest unit upwards, as no shard is smaller than
what it cannot cut; a candidate is checked greedily (fill a shard until the next unit
would pass the capacity). The shards are then cut by a greedy pass that stays within the
capacity and closes a shard at its even part of what is left, so a huge group sets the
capacity but not the size of the other shards.

Rules: null and empty texts are one group of size 1 a row; a very long text counts with all
its bytes; equal texts and repeated rows share a shard and get slots of their own; ties of
the order are equal texts; an empty table gives an empty result; an input column named
like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import broadcast_within, repeated, table
from eventide.session import materialize

UNIT_BITS = 14
SLOT_KEYS = 1024  # at least, and one for every ROWS_PER_KEY rows
ROWS_PER_KEY = 4096
MAX_KEYS = 500_000


def text_size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + F.lit(1)).cast("long")


def text_unit(text: Column, bits: int = UNIT_BITS) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - bits).cast("int")


def _greedy(units: Column, cap: Column, total: Column | None = None, shards: int = 1) -> Column:
    """struct(cur, used, left, cuts): units put in order into shards of at most
    ``cap``. With ``total`` a shard is also closed once it holds its even part
    of what was left, so that the last shards are not short."""
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("cur"), F.lit(1).alias("used"),
                     (zero if total is None else total).alias("left"),
                     F.array().cast("array<int>").alias("cuts"))

    def step(acc, u):
        close = acc["cur"] + u["size"] > cap
        if total is not None:
            even = acc["left"] / F.greatest(F.lit(1), F.lit(shards + 1) - acc["used"])
            close = close | (acc["cur"] + u["size"] / 2 > even)
        close = close & (acc["cur"] > 0)
        return F.struct(
            F.when(close, u["size"]).otherwise(acc["cur"] + u["size"]).alias("cur"),
            F.when(close, acc["used"] + 1).otherwise(acc["used"]).alias("used"),
            F.when(close, acc["left"] - acc["cur"]).otherwise(acc["left"]).alias("left"),
            F.when(close, F.concat(acc["cuts"], F.array(u["unit"]))).otherwise(acc["cuts"]).alias("cuts"))
    return F.aggregate(units, start, step)


def shard_cuts(sizes: DataFrame, shards: int = 16) -> DataFrame:
    """One row (capacity, cuts): first unit of every shard after the first.

    ``sizes`` has (unit int, size long), one row per row of data."""
    units = sizes.groupBy("unit").agg(F.sum("size").alias("size"))
    one = units.agg(F.sort_array(F.collect_list(F.struct("unit", "size"))).alias("units"),
                    F.sum("size").alias("total"))
    u, total = F.col("units"), F.col("total")
    # lo fails (a unit is not cut), hi works
    span = F.struct((F.array_max(F.transform(u, lambda x: x["size"])) - F.lit(1)).cast("long").alias("lo"), total.alias("hi"))

    def halve(acc, _):
        # ``(hi - lo) div 2`` without an expression string: no bound names here
        mid = acc["lo"] + F.shiftright(acc["hi"] - acc["lo"], 1)
        done = acc["hi"] - acc["lo"] <= 1
        works = _greedy(u, mid)["used"] <= shards
        return (F.when(done, acc)
                .when(works, F.struct(acc["lo"].alias("lo"), mid.alias("hi")))
                .otherwise(F.struct(mid.alias("lo"), acc["hi"].alias("hi"))))
    cap = F.aggregate(F.sequence(F.lit(1), F.lit(63)), span, halve)["hi"]
    found = one.filter(total.isNotNull()).select("units", "total", cap.alias("capacity"))
    found = found.select("capacity", _greedy(u, F.col("capacity")).alias("full"),
                         _greedy(u, F.col("capacity"), total, shards).alias("even"))
    even = F.col("even")["used"] <= shards
    return found.select("capacity", F.when(even, F.col("even")["cuts"]).otherwise(F.col("full")["cuts"]).alias("cuts"))


def shard_of(cuts: DataFrame, unit: Column) -> Column:
    """Shard of a unit. The cuts are one number per shard, read once."""
    row = cuts.first()
    at = F.array(*[F.lit(c) for c in (row["cuts"] if row else [])]).cast("array<int>")
    return F.size(F.filter(at, lambda c: c <= unit))


def assign_shards(docs: DataFrame, shards: int = 16, text_col: str = "text") -> DataFrame:
    """``docs`` with an int column ``shard``; no row moves."""
    sized = docs.select(text_unit(F.col(text_col)).alias("unit"), text_size(F.col(text_col)).alias("size"))
    cuts = shard_cuts(sized, shards)
    return docs.withColumn("shard", shard_of(cuts, text_unit(F.col(text_col))))


def shard_slots(docs: DataFrame, shards: int = 16, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``slot`` numbers a shard's rows from 0 without gaps. It is counted in two
    levels (rows per (shard, key of the row), then a running count inside that key), so no
    shard is ever sorted in one task. Equal rows are counted first and numbered last, so they
    are one row in between; the number of keys grows with the rows."""
    text = F.col(text_col)
    row = F.xxhash64(F.col(id_col), text)
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), text_size(text).alias("size"), text_unit(text).alias("unit"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"), row.alias("h"))
    narrow = materialize(narrow.groupBy(*narrow.columns).agg(F.count("*").alias("n")), "shard_rows")
    keys = max(SLOT_KEYS, narrow.count() // ROWS_PER_KEY)
    cuts = shard_cuts(narrow.select("unit", (F.col("size") * F.col("n")).alias("size")), shards)
    placed = (narrow.withColumn("shard", shard_of(cuts, F.col("unit")))
              .withColumn("k", F.pmod(F.xxhash64("h"), F.lit(keys)).cast("int")))
    counts = materialize(placed.groupBy("shard", "k").agg(F.sum("n").alias("n")), "shard_keys")
    before = Window.partitionBy("shard").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    # one row per ROWS_PER_KEY rows or so
    first = materialize(counts.select("shard", "k", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "shard_first")
    inside = Window.partitionBy("shard", "k").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    at = (placed.withColumn("i", F.coalesce(F.sum("n").over(inside), F.lit(0)))
          .join(broadcast_within(first, MAX_KEYS), ["shard", "k"]))
    return repeated(at, F.col("n"), "copy").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("i") + F.col("copy")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes, equal texts together."""
    return shard_slots(table(spark, sf_dir, "documents"))
