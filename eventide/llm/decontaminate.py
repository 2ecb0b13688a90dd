"""Benchmark decontamination by SimHashes of item-sized windows (native).

A text matches a benchmark item if one of its windows of the item's size (in
word shingles) has a weighted-shingle (multiset) Jaccard similarity of
``similarity`` or more with it.

1. Windows. A window of similarity J with an item of n shingles holds at least
   J / (1 + J) * (n + window) shingles of it, and the best window can be moved right
   until it starts at such a shingle (or ends with the text) without losing any. Shared shingles
   are counted by a running sum per (text, item), and only windows that reach the
   bound are kept, as narrow rows. This is exact and loses nothing.
2. Fingerprints. A window's SimHash comes from 64 running bit sums over the text: the
   sums at its end less those before its start. No window is ever written out, so the work is linear in the text.
3. Hamming blocks. How far two fingerprints may lie apart depends on the angle between the
   two count vectors, whose cosine is at least L / (|item| |window|) for a pair of similarity J;
   L, |item| and a bound of |window| follow from the item's counts and from the number
   of repeats in the window. Bits differ by that angle / 180 each, which gives the pair's
   radius (missed with a probability under one in a million). The 64 bits are cut into MAX_RADIUS + 1
   blocks; fingerprints within MAX_RADIUS agree in one of them at least, so windows meet their item
   on (item, block, value), and the pair goes on if its distance is within its radius.
   Where repeated shingles push the radius over MAX_RADIUS the blocks can guarantee nothing, and
   the pair goes on without them.
4. Exact check. The j-th shingle of a kind counts only while fewer than the item's number of them
   stand before it in the window. So a shared shingle adds one to a stretch of window starts,
   and running sums over the ends of these stretches give the multiset overlap of every candidate.

Words are runs of letters and digits, lower case. Shingles have five words;
an item of fewer words is one shingle of all its words. A text shorter than the
item is one window.

Rules: null or empty texts and items match nothing; an item without an id
still matches; equal rows give one result row, and of equally similar windows the first
is named; very long texts and items are compared whole; other columns are not read, so
their names are free; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import broadcast_within, keyed_rows, row_keys, table
from eventide.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
MAX_BROADCAST = 200_000
MAX_TEXTS = 100_000
BITS = 64
MAX_RADIUS = 28
SPREADS = 4.75  # standard deviations: one in a million


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(words: Column, k: int) -> Column:
    """Hashes of the k-word shingles of a word array, in order."""
    n = F.size(words) - (k - 1)
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))


def held(c: Column) -> Column:
    """The same value behind a generator. Filters that Spark infers for a later
    explode are not pushed below it, where they would compute ``c`` again for
    every element."""
    return F.explode(F.array(c))


def _bit(h: Column, b: int) -> Column:
    return F.shiftrightunsigned(h, b).bitwiseAND(F.lit(1))


def _majority(n: Column, sums: list[Column]) -> Column:
    fp = F.lit(0).cast("long")
    for b, c in enumerate(sums):
        bit = F.when(2 * c > n, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
        fp = fp.bitwiseOR(F.shiftleft(bit, b))
    return fp


def item_prints(item_rows: DataFrame) -> DataFrame:
    """item, ifp, sq (sum of squared counts), top (largest count)."""
    fp = item_rows.groupBy("item").agg(F.count("*").alias("_n"), *[F.sum(_bit(F.col("h"), b)).alias(f"_b{b}") for b in range(BITS)])
    fp = fp.select("item", _majority(F.col("_n"), [F.col(f"_b{b}") for b in range(BITS)]).alias("ifp"))
    norm = (item_rows.groupBy("item", "h").agg(F.count("*").alias("c")).groupBy("item")
            .agg(F.sum(F.col("c") * F.col("c")).alias("sq"), F.max("c").alias("top")))
    return fp.join(norm, "item")


def blocks(fp: Column) -> Column:
    """The fingerprint cut into MAX_RADIUS + 1 numbered blocks of two or three bits."""
    cuts = [BITS * i // (MAX_RADIUS + 1) for i in range(MAX_RADIUS + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
                     for i, (a, b) in enumerate(zip(cuts, cuts[1:]))])


def radius(n: Column, size: Column, sq: Column, top: Column, repeats: Column, similarity: float) -> Column:
    """Bits by which the SimHashes of an item and of a window that reach the
    similarity differ at most, but for one case in a million."""
    overlap = F.ceil(similarity / (1 + similarity) * (n + size) - 1e-6)
    shared = F.greatest(overlap, sq - (n - overlap) * (2 * top - 1))  # of the squares
    window = size - repeats - 1 + (repeats + 1) * (repeats + 1)  # all repeats of one shingle
    cosine = F.least(F.lit(1.0), shared / F.sqrt((sq * window).cast("double")))
    p = F.acos(cosine) / F.lit(3.141592653589793)
    return F.ceil(BITS * p + SPREADS * F.sqrt(BITS * p * (1 - p)))


def benchmark_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item (number), item_id, k, n, shingles; written once."""
    w = items.select(F.col(id_col).alias("item_id"), held(words_of(F.col(text_col))).alias("words"))
    w = w.filter(F.size("words") > 0).distinct()
    w = w.select("item_id", "words", F.least(F.size("words"), F.lit(SHINGLE)).alias("k"))
    h = F.lit(None).cast("array<bigint>")
    for k in range(1, SHINGLE + 1):
        h = F.when(F.col("k") == k, shingles(F.col("words"), k)).otherwise(h)
    w = w.select(F.xxhash64("item_id", "words").alias("item"), "item_id", "k", h.alias("shingles"))
    return materialize(w.withColumn("n", F.size("shingles")), "bench_items")


def _hits(rows: DataFrame, item_rows: DataFrame, k: int) -> DataFrame:
    """(k1, k2, len, k, pos, h, item, n, ic): shingles of texts that an item has, ic times."""
    known = materialize(item_rows.filter(F.col("k") == k).groupBy("h", "item", "n").agg(F.count("*").alias("ic")), "bench_shingles")
    w = rows.select("k1", "k2", held(words_of(F.col("text"))).alias("words"))
    s = w.select("k1", "k2", held(shingles(F.col("words"), k)).alias("s"))
    s = s.select("k1", "k2", F.size("s").alias("len"), "s")  # before the explode: no row carries the array
    s = s.select("k1", "k2", "len", F.posexplode("s").alias("pos", "h"))
    return s.join(broadcast_within(known, MAX_BROADCAST), "h").select(
        "k1", "k2", "len", F.lit(k).alias("k"), "pos", "h", "item", "n", "ic")


def _windows(hits: DataFrame, similarity: float) -> DataFrame:
    """(k1, k2, item, n, size, s): windows that can reach the similarity with the item."""
    size = F.least("n", "len")
    keep = ["k1", "k2", "k", "item", "n", "len"]
    begin = hits.select(*keep, "pos", F.lit(0).alias("end"), F.col("pos").alias("s"))
    end = hits.select(*keep, (F.least(F.col("pos"), F.col("len") - size) + size - 1).alias("pos"), F.lit(1).alias("end"),
                      F.least(F.col("pos"), F.col("len") - size).alias("s"))
    # a window's hits = hits up to its end - hits before its start
    lead = hits.select(*keep, F.least(F.col("pos"), F.col("len") - size).alias("pos"), F.lit(-1).alias("end"),
                       F.least(F.col("pos"), F.col("len") - size).alias("s"))
    run = Window.partitionBy("k1", "k2", "k", "item").orderBy("pos", "end").rowsBetween(Window.unboundedPreceding, 0)
    both = begin.unionByName(end).unionByName(lead).withColumn("seen", F.sum((F.col("end") == 0).cast("int")).over(run))
    per = (both.filter("end <> 0").groupBy(*keep, "s")
           .agg(F.max(F.when(F.col("end") == 1, F.col("seen"))).alias("upto"),
                F.max(F.when(F.col("end") == -1, F.col("seen"))).alias("before")))
    need = F.ceil(similarity / (1 + similarity) * (F.col("n") + size) - 1e-6)
    return per.filter(F.col("upto") - F.col("before") >= need).select("k1", "k2", "item", "n", "len", size.alias("size"), "s")


def find_leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
               text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """k1, k2, doc_id, item_id, similarity, distance, start, size: the best window
    of every text and item that match (start in shingles, size in shingles)."""
    bench = benchmark_items(items, item_id, item_text)
    item_rows = bench.select("item", "k", "n", F.explode("shingles").alias("h"))
    ks = sorted(r["k"] for r in bench.select("k").distinct().limit(SHINGLE).collect())
    k1, k2 = row_keys(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), k1.alias("k1"), k2.alias("k2"))
    found = None
    for k in ks:
        part = _leaks(rows, item_rows, k, similarity)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.range(0).select(
            *[F.col("id").alias(c) for c in ("k1", "k2", "item")], F.col("id").cast("double").alias("similarity"),
            *[F.col("id").cast("int").alias(c) for c in ("distance", "start", "size")])
    found = materialize(found, "bench_found")
    asked = broadcast_within(found.select("k1", "k2").distinct(), MAX_TEXTS)
    ids = rows.select("doc_id", "k1", "k2").join(asked, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    named = found.join(bench.select("item", "item_id"), "item").join(ids, ["k1", "k2"])
    return materialize(named.select("k1", "k2", "doc_id", "item_id", "similarity", "distance", "start", "size"), "bench_leaks")


def _shingle_places(rows: DataFrame, windows: DataFrame, k: int) -> DataFrame:
    """(k1, k2, pos, h) of the texts that have windows, from their first to their last window."""
    span = materialize(windows.groupBy("k1", "k2").agg(F.min("s").alias("lo"), F.max(F.col("s") + F.col("size")).alias("hi")),
                       "bench_spans")
    asked = broadcast_within(span.select("k1", "k2"), MAX_TEXTS)
    few = rows.join(asked, ["k1", "k2"], "left_semi").select("k1", "k2", "text").dropDuplicates(["k1", "k2"])
    texts = few.join(span, ["k1", "k2"]).select("k1", "k2", "lo", "hi", held(words_of(F.col("text"))).alias("words"))
    texts = texts.select("k1", "k2", "lo", "hi", held(shingles(F.col("words"), k)).alias("sh"))
    part = F.slice("sh", F.col("lo") + 1, F.col("hi") - F.col("lo"))
    texts = texts.select("k1", "k2", "lo", F.posexplode(part).alias("i", "h"))
    return materialize(texts.select("k1", "k2", (F.col("lo") + F.col("i")).alias("pos"), "h"), "bench_places")


def window_prints(places: DataFrame, windows: DataFrame) -> DataFrame:
    """(k1, k2, s, size, fp) of the windows, by running bit sums over each text."""
    key = ["k1", "k2", "s", "size"]
    none = F.lit(None).cast("long")
    rows = places.select("k1", "k2", "pos", F.lit(0).alias("at"), "h", none.cast("int").alias("s"), none.cast("int").alias("size"))
    probes = windows.select(*key).distinct()
    begin = probes.select("k1", "k2", F.col("s").alias("pos"), F.lit(-1).alias("at"), none.alias("h"), "s", "size")
    end = probes.select("k1", "k2", (F.col("s") + F.col("size") - 1).alias("pos"), F.lit(1).alias("at"), none.alias("h"), "s", "size")
    run = Window.partitionBy("k1", "k2").orderBy("pos", "at").rowsBetween(Window.unboundedPreceding, 0)
    h = F.col("h")
    sums = rows.unionByName(begin).unionByName(end).select(
        *key, "at", *[F.coalesce(F.sum(_bit(h, b)).over(run), F.lit(0)).alias(f"_b{b}") for b in range(BITS)])
    both = sums.filter("at <> 0").groupBy(*key).agg(*[F.sum(F.col(f"_b{b}") * F.col("at")).alias(f"_b{b}") for b in range(BITS)])
    return both.select(*key, _majority(F.col("size"), [F.col(f"_b{b}") for b in range(BITS)]).alias("fp"))


def _stabbed(stretches: DataFrame, probes: DataFrame, keys: list[str], out: str) -> DataFrame:
    """``probes`` (keys, s, ...) with the number of ``stretches`` (keys, lo, hi) that hold s."""
    cols = [c for c in probes.columns if c not in (*keys, "s")]
    blank = [F.lit(None).cast(probes.schema[c].dataType).alias(c) for c in cols]
    ok = stretches.filter(F.col("lo") <= F.col("hi"))
    up = ok.select(*keys, F.col("lo").alias("s"), F.lit(0).alias("_q"), F.lit(1).alias("_d"), *blank)
    down = ok.select(*keys, (F.col("hi") + 1).alias("s"), F.lit(0).alias("_q"), F.lit(-1).alias("_d"), *blank)
    ask = probes.select(*keys, "s", F.lit(1).alias("_q"), F.lit(0).alias("_d"), *cols)
    run = Window.partitionBy(*keys).orderBy("s", "_q").rowsBetween(Window.unboundedPreceding, 0)
    return (up.unionByName(down).unionByName(ask).withColumn(out, F.sum("_d").over(run))
            .filter("_q = 1").drop("_q", "_d"))


def _repeats(places: DataFrame, windows: DataFrame) -> DataFrame:
    """(k1, k2, size, s, repeats): shingles of a window that stood in it before."""
    before = F.lag("pos").over(Window.partitionBy("k1", "k2", "h").orderBy("pos"))
    twice = places.withColumn("before", before).filter("before IS NOT NULL")
    probes = windows.select("k1", "k2", "size", "s").distinct()
    near = (twice.join(probes.select("k1", "k2", "size").distinct(), ["k1", "k2"])
            .filter(F.col("pos") - F.col("before") < F.col("size"))
            .select("k1", "k2", "size", (F.col("pos") - F.col("size") + 1).alias("lo"), F.col("before").alias("hi")))
    return _stabbed(near, probes, ["k1", "k2", "size"], "repeats")


def candidates(places: DataFrame, windows: DataFrame, prints: DataFrame, similarity: float) -> DataFrame:
    """The windows with fp distance and radius, as far as the Hamming blocks or, beyond
    MAX_RADIUS, nothing can rule them out. ``prints``: item_prints."""
    met = windows.join(window_prints(places, windows), ["k1", "k2", "s", "size"])
    met = met.join(_repeats(places, windows), ["k1", "k2", "size", "s"])
    met = met.join(broadcast_within(prints, MAX_BROADCAST), "item").withColumn(
        "radius", radius(F.col("n"), F.col("size"), F.col("sq"), F.col("top"), F.col("repeats"), similarity).cast("int"))
    met = met.withColumn("distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))).cast("int"))
    met = materialize(met.select("k1", "k2", "item", "n", "len", "size", "s", "fp", "distance", "radius"), "bench_prints")
    key = ["k1", "k2", "item", "n", "len", "size", "s", "distance", "radius"]
    index = prints.select("item", F.explode(blocks(F.col("ifp"))).alias("b")).select("item", "b.*")
    asked = met.filter(F.col("radius") <= MAX_RADIUS).select(*key, F.explode(blocks(F.col("fp"))).alias("b")).select(*key, "b.*")
    close = asked.join(broadcast_within(materialize(index, "bench_blocks"), MAX_BROADCAST), ["item", "block", "value"], "left_semi")
    close = close.filter("distance <= radius").select(*key).distinct()
    return close.unionByName(met.filter(F.col("radius") > MAX_RADIUS).select(*key))


def overlaps(hits: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked`` windows with o, their exact multiset overlap with the item."""
    same = Window.partitionBy("k1", "k2", "item", "h").orderBy("pos")
    keep = ["k1", "k2", "item", "pos", "size", "len"]
    ranked = hits.withColumn("size", F.least("n", "len")).select(
        *keep, "h", "ic", F.row_number().over(same).alias("rn"), F.lag("pos").over(same).alias("one"))
    # the place whose loss makes room for this one: ic places of the same shingle before it
    once = ranked.filter("ic = 1").select(*keep, F.col("one").alias("out"))
    more = ranked.filter("ic > 1")
    earlier = more.select("k1", "k2", "item", "h", (F.col("rn") + F.col("ic")).alias("rn"), F.col("pos").alias("out"))
    more = more.select(*keep, "h", F.col("rn").cast("long").alias("rn")).join(earlier, ["k1", "k2", "item", "h", "rn"], "left")
    places = once.unionByName(more.select(*keep, "out"))
    first = F.greatest(F.coalesce(F.col("out") + 1, F.lit(0)), F.col("pos") - F.col("size") + 1, F.lit(0))
    stretches = places.select("k1", "k2", "item", first.alias("lo"), F.least(F.col("pos"), F.col("len") - F.col("size")).alias("hi"))
    return _stabbed(stretches, asked, ["k1", "k2", "item"], "o")


def _leaks(rows: DataFrame, item_rows: DataFrame, k: int, similarity: float) -> DataFrame:
    # equal rows have equal hits
    hits = materialize(_hits(rows, item_rows, k).distinct(), "bench_hits")
    windows = materialize(_windows(hits, similarity), "bench_windows")
    places = _shingle_places(rows, windows, k)
    prints = materialize(item_prints(item_rows.filter(F.col("k") == k)), "bench_item_prints")
    asked = materialize(candidates(places, windows, prints, similarity), "bench_candidates")
    few = broadcast_within(asked.select("k1", "k2", "item").distinct(), MAX_TEXTS)
    checked = overlaps(hits.join(few, ["k1", "k2", "item"], "left_semi"), asked)
    value = F.col("o") / (F.col("n") + F.col("size") - F.col("o"))
    good = checked.withColumn("similarity", value).filter(F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("s")).alias("neg"), "size", "distance")).alias("b")
    best = good.groupBy("k1", "k2", "item").agg(best)
    return best.select("k1", "k2", "item", F.col("b.similarity").alias("similarity"), F.col("b.distance").alias("distance"),
                       (-F.col("b.neg")).cast("int").alias("start"), F.col("b.size").cast("int").alias("size"))


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that match no benchmark item."""
    bad = materialize(find_leaks(docs, items, id_col=id_col, text_col=text_col, **how)
                      .select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct(), "bench_bad")
    return (keyed_rows(docs, id_col, text_col)
            .join(broadcast_within(bad, MAX_BROADCAST), ["_k1", "_k2"], "left_anti").select("_row.*"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it contains."""
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "distance", "start", "size")
