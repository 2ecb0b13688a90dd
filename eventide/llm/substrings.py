"""Exact removal of repeated byte strings, by interval expansion on a BWT.

A byte is removed if a ``length``-byte string that covers it also starts anywhere
else. The work is dealt out so that equal strings meet without moving the
corpus:

1. Every text is cut into segments: maximal runs of ``length``-byte windows whose
   least ``Q``-gram hash (their minimizer) is the same. Equal windows have equal
   minimizers, wherever they stand. A segment is (row, place, minimizer m, content
   hash c); a segment spans about 90 windows.
2. Segments are counted per m. An m met once, at one place of its segment, holds
   no repeat. Where all segments of an m have one content, all their windows
   repeat. Both need no text.
3. Only m with different contents, or met twice in one, are looked at: one copy of each content is
   fetched, and whole m groups are packed into shards of about ``SHARD_BYTES``.
   In a shard the contents' suffixes are sorted and the Burrows-Wheeler
   transform is taken; intervals of suffixes are extended backwards by one symbol
   at a time, all intervals of a depth at once. That yields the places where
   neighbouring suffixes part by increasing length of their common prefix, and
   stops at ``length``: suffixes still together repeat.
4. A minimizer with more than ``HOT_BYTES`` of different contents does not fit a
   shard. Its contents are cut again, by the minimizers of longer grams (``FURTHER_Q``), and what
   differs under those goes through the transform as in 2 and 3. Only what is still too large under
   the longest (texts of a short period, whose grams are all alike) has its windows dealt one by one by a
   128-bit hash and counted.
5. Spans go back to their rows and are cut out of the texts.

Rules: null is an empty text; texts shorter than ``length`` lose nothing; equal
rows count as separate texts; matches never cross texts; of tied occurrences all go; very long
texts are taken whole, in segments; other columns are not read, so their names are free; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import broadcast_within, row_keys, table, text_chunks
from eventide.session import materialize, ship_package

LENGTH = 200
Q = 24
CHUNK = 1 << 20
SHARD_BYTES = 1 << 18
HOT_BYTES = 1 << 20
FURTHER_Q = (96, 160)
MAX_BROADCAST = 300_000

_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        return np.cumprod(p)


def gram_hashes(data: np.ndarray, q: int) -> np.ndarray:
    """A mixed 64-bit hash of every q-gram, from prefix sums modulo 2**64."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, n), out=sums[1:])
    h = (sums[q:] - sums[:-q]) * _powers(_ODD_INVERSE, n - q + 1)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:len(x) - (width - span)], x[width - span:])


def segments(texts: list[bytes], length: int, q: int = Q):
    """(text number, start, bytes, m, c, own) arrays of all segments of the texts;
    own: the minimizer stands there twice, so windows may repeat inside."""
    from xxhash import xxh3_64_intdigest

    joined = b"".join(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    if len(joined) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    grams, width = gram_hashes(np.frombuffer(joined, np.uint8), q), length - q + 1
    least = sliding_min(grams, width)
    long_ = sizes >= length
    edge = np.zeros(len(least) + 1, np.int64)  # +1 where windows of a text begin, -1 after the last
    np.add.at(edge, begins[long_], 1)
    np.add.at(edge, (begins + sizes - length + 1)[long_], -1)
    at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    if not len(at):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    new = np.ones(len(at), bool)
    new[1:] = least[at[1:]] != least[at[:-1]]
    new |= np.isin(at, begins[long_])
    first = np.flatnonzero(new)
    start = at[first]
    size = np.diff(np.r_[first, len(at)]) + length - 1
    text = np.searchsorted(begins, start, "right") - 1
    while (sizes[text] == 0).any():  # empty texts share a begin with the next
        text[sizes[text] == 0] -= 1
    view = memoryview(joined)
    c = np.array([xxh3_64_intdigest(view[a:b]) for a, b in zip(start.tolist(), (start + size).tolist())], np.uint64)
    # places of minimizers: q-grams that are the least of a window they stand in
    pad = np.full(width - 1, ~np.uint64(0))
    top = ~sliding_min(np.concatenate([pad, ~least, pad]), width)
    place = np.flatnonzero(top == grams)
    lo, hi = np.searchsorted(place, start), np.searchsorted(place, start + size - q, "right")
    n = hi - lo
    owner = np.repeat(np.arange(len(n)), n)
    same = grams[place[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]] == least[start][owner]
    own = np.bincount(owner[same], minlength=len(n)) > 1
    return text, start - begins[text], size, least[start].view(np.int64), c.view(np.int64), own


def _binary(column: pa.Array) -> list[bytes]:
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _binary(batch.column("text"))
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            for a, b in text_chunks(texts, CHUNK):
                text, start, size, m, c, own = segments(texts[a:b], length)
                if len(text):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (k1[a:b][text], k2[a:b][text], start << 32 | size, m, c, own)],
                        names=["k1", "k2", "at", "m", "c", "own"])
    return run


def suffix_order(s: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``s`` (symbols 0..256) in the order of their first ``depth``
    symbols or more."""
    n = len(s)
    key = np.zeros(n, np.int64)
    for i in range(min(7, n)):  # seven symbols fit one number
        key[:n - i] |= s[i:].astype(np.int64) << (9 * (6 - i))
    done = 7
    while True:
        order = np.argsort(key)
        if done >= depth:
            return order
        sorted_ = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[True, sorted_[1:] != sorted_[:-1]])
        tail = np.zeros(n, np.int64)
        tail[:max(0, n - done)] = rank[done:]
        key = rank * (n + 1) + tail
        done *= 2


def repeated_starts(texts: list[bytes], length: int) -> np.ndarray:
    """Flags over the joined texts (one separator after each): the ``length``
    symbols from here also start elsewhere."""
    s = np.zeros(sum(map(len, texts)) + len(texts), np.int16)
    ends = np.cumsum([len(t) + 1 for t in texts])
    for t, e in zip(texts, ends.tolist()):
        s[e - 1 - len(t):e - 1] = np.frombuffer(t, np.uint8)
    inside = np.ones(len(s), bool)
    inside[ends - 1] = False
    s[inside] += 1
    order = suffix_order(s, length)
    place = np.empty(len(s), np.int32)
    place[order] = np.arange(len(s), dtype=np.int32)
    bwt = s[order - 1]  # the symbol before each suffix
    # backward extension by a symbol takes suffix i to step[i]: first all that
    # follow a smaller symbol, then those of the same symbol in their order
    step = place[order - 1]
    before = np.empty(len(s), np.int32)
    before[step] = np.arange(len(s), dtype=np.int32)  # the suffix that was extended to here
    head = np.empty(len(s), np.int16)
    head[step] = bwt
    parted = np.ones(len(s), bool)  # common prefix with the one above < depth
    parted[1:] = head[1:] != head[:-1]
    # two suffixes part at a depth if a parting of the depth before lies between those
    # they were extended from. Where these are neighbours, the parting itself leads on to them;
    # the others are looked up
    here = np.flatnonzero(~parted).astype(np.int32)
    above, at = before[here - 1], before[here]
    apart = at != above + 1
    wide, low, high = here[apart], np.minimum(above, at)[apart], np.maximum(above, at)[apart]
    is_wide = np.zeros(len(s), bool)
    is_wide[wide] = True
    fresh = np.flatnonzero(parted).astype(np.int32)  # what parted last
    for _ in range(1, length):  # depth 1 -> length
        part = step[fresh]
        part = part[~parted[part] & ~is_wide[part]]
        if len(wide):
            if 2 * len(fresh) < len(wide):
                fresh.sort()
                hit = np.searchsorted(fresh, low, "right") != np.searchsorted(fresh, high, "right")
            else:
                upto = np.cumsum(parted, dtype=np.int32)
                hit = upto[high] != upto[low]
            part = np.concatenate([part, wide[hit]])
            wide, low, high = wide[~hit], low[~hit], high[~hit]
        if not len(part):
            break
        parted[part] = True
        fresh = part
    together = ~parted
    together[:-1] |= ~parted[1:]
    out = np.zeros(len(s), bool)
    out[order] = together
    for t, e in zip(texts, ends.tolist()):  # strings that would run over the end
        out[max(e - 1 - len(t), e - length):e] = False
    return out


def _expand(length: int):
    def run(shard: pa.Table) -> pa.Table:
        texts = shard.column("text").to_pylist()
        flags = repeated_starts(texts, length)
        m, c = shard.column("m").to_numpy(), shard.column("c").to_numpy()
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        flank = np.diff(np.r_[False, flags, False].astype(np.int8))
        up, down = np.flatnonzero(flank == 1), np.flatnonzero(flank == -1)
        text = np.searchsorted(begins, up, "right") - 1
        return pa.table({"m": m[text], "c": c[text], "off": up - begins[text], "n": down - up})
    return run


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        m, c, out = [], [], []
        for text, wants in zip(_binary(batch.column("text")), batch.column("wants").to_pylist()):
            for w in wants:
                at = w["at"] >> 32
                m.append(w["m"])
                c.append(w["c"])
                out.append(text[at:at + (w["at"] & 0xFFFFFFFF)])
        yield pa.RecordBatch.from_arrays([pa.array(m, pa.int64()), pa.array(c, pa.int64()), pa.array(out, pa.binary())],
                                         names=["m", "c", "text"])


def _cut_contents(length: int, q: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            m, c = batch.column("m").to_numpy(), batch.column("c").to_numpy()
            for a, b in text_chunks(texts, CHUNK):
                text, start, size, least, inner, own = segments(texts[a:b], length, q)
                if len(text):
                    parts = [texts[a + t][s:s + n] for t, s, n in zip(text.tolist(), start.tolist(), size.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (m[a:b][text], c[a:b][text], start, least, inner, own)] + [pa.array(parts, pa.binary())],
                        names=["m", "c", "off", "g", "c2", "own", "text"])
    return run


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for m, c, text in zip(*(batch.column(x).to_pylist() for x in ("m", "c", "text"))):
                view = memoryview(text)
                for a in range(0, len(text) - length + 1, 1 << 16):
                    offs = range(a, min(a + (1 << 16), len(text) - length + 1))
                    h = np.frombuffer(b"".join(xxh3_128_digest(view[i:i + length]) for i in offs), "<i8").reshape(-1, 2)
                    n = len(offs)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, m)), pa.array(np.full(n, c)), pa.array(np.arange(a, a + n)),
                         pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], names=["m", "c", "off", "h1", "h2"])
    return run


RUNS = "m long, c long, off long, n long"


def _apart(texts: DataFrame, sizes: DataFrame, length: int, shard_bytes: int, hot_bytes: int,
           further: tuple[int, ...]) -> DataFrame:
    """m, c, off, n: the n windows from off on of content c that also stand elsewhere in the
    contents of m. ``texts`` (m, c, text) has each content once, ``sizes`` (m, bytes) a row for each."""
    weight = materialize(sizes.groupBy("m").agg(F.sum("bytes").alias("bytes")), "sub_weight")
    hot = materialize(weight.filter(F.col("bytes") > hot_bytes).select("m"), "sub_hot")
    total = weight.agg(F.sum("bytes")).first()[0] or 0
    shard = F.pmod(F.xxhash64("m"), F.lit(max(1, -(-total // shard_bytes))))
    marked = texts.join(broadcast_within(hot.withColumn("hot", F.lit(True)), MAX_BROADCAST), "m", "left")
    cold = (marked.filter("hot is null").select(shard.alias("shard"), "m", "c", "text").groupBy("shard")
            .applyInArrow(_expand(length), RUNS))
    if hot.isEmpty():
        return cold
    rest = marked.filter("hot").select("m", "c", "text")
    if not further:
        return cold.unionByName(_apart_by_hash(rest, length))
    return cold.unionByName(_apart_by_longer_grams(rest, length, shard_bytes, hot_bytes, further))


def _apart_by_longer_grams(texts: DataFrame, length: int, shard_bytes: int, hot_bytes: int,
                           further: tuple[int, ...]) -> DataFrame:
    """As :func:`_apart`, with the contents cut into segments of their own. Equal windows have equal
    minimizers under any gram, so they meet again."""
    cut = texts.mapInArrow(_cut_contents(length, further[0]),
                           "m long, c long, off long, g long, c2 long, own boolean, text binary")
    cut = materialize(cut.withColumn("m2", F.xxhash64("m", "g")).drop("g"), "sub_cut_again")
    kinds = materialize(cut.groupBy("m2", "c2").agg(F.count("*").alias("n"), F.max("own").alias("own"), F.first("text").alias("text")),
                        "sub_kinds")
    mixed = kinds.groupBy("m2").agg(((F.min("c2") != F.max("c2")) | F.max("own")).alias("mixed"))
    mixed = materialize(mixed.filter("mixed").select("m2"), "sub_mixed")
    parts = materialize(kinds.join(broadcast_within(mixed, MAX_BROADCAST), "m2")
                        .select(F.col("m2").alias("m"), F.col("c2").alias("c"), "text"), "sub_parts")
    windows = (F.octet_length("text") - (length - 1)).cast("long")
    copied = kinds.filter("n > 1").select(F.col("m2").alias("m"), F.col("c2").alias("c"), F.lit(0).cast("long").alias("off"), windows.alias("n"))
    inner = _apart(parts, parts.select("m", F.octet_length("text").cast("long").alias("bytes")), length, shard_bytes, hot_bytes, further[1:])
    runs = materialize(copied.unionByName(inner), "sub_inner").toDF("m2", "c2", "at", "n")
    return cut.select("m", "c", "off", "m2", "c2").join(runs, ["m2", "c2"]).select("m", "c", (F.col("off") + F.col("at")).alias("off"), "n")


def _apart_by_hash(texts: DataFrame, length: int) -> DataFrame:
    """As :func:`_apart`, window by window."""
    windows = materialize(texts.mapInArrow(_windows(length), "m long, c long, off long, h1 long, h2 long"), "sub_windows")
    twice = materialize(windows.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2"), "sub_twice")
    warm = windows.join(twice, ["h1", "h2"])
    # neighbouring windows become one run; a window's partition is one content
    in_content = Window.partitionBy("m", "c").orderBy("off")
    return (warm.withColumn("run", F.col("off") - F.row_number().over(in_content)).groupBy("m", "c", "run")
            .agg(F.min("off").alias("off"), F.count("*").alias("n")).select("m", "c", "off", "n"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   shard_bytes: int = SHARD_BYTES, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """k1, k2, spans: per row with repeats, the (start, end) byte spans (they
    may overlap) that are covered by repeated strings."""
    ship_package(docs.sparkSession)
    k1, k2 = row_keys(F.col(id_col), F.col(text_col))
    rows = docs.select(k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    seg = materialize(rows.mapInArrow(_cut(length), "k1 long, k2 long, at long, m long, c long, own boolean"), "sub_segments")
    met = seg.groupBy("m").agg(F.count("*").alias("n"),
                               ((F.min("c") != F.max("c")) | F.max("own")).alias("mixed"))
    met = materialize(met.filter("n > 1 or mixed").select("m", "mixed"), "sub_met")
    seg = materialize(seg.join(broadcast_within(met, 2 * MAX_BROADCAST), "m"), "sub_again")
    size = F.col("at").bitwiseAND(F.lit(0xFFFFFFFF))
    start = F.shiftright("at", 32)
    whole = seg.filter("not mixed").select("k1", "k2", start.alias("start"), (start + size).alias("end"))
    mixed = seg.filter("mixed")

    contents = materialize(mixed.groupBy("m", "c").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "at")).alias("one"))
                           .select("m", "c", "n", "one.*"), "sub_contents")
    wants = contents.groupBy("k1", "k2").agg(F.collect_list(F.struct("m", "c", "at")).alias("wants"))
    wants = materialize(wants, "sub_wants")
    asked = wants.select("k1", "k2")
    few = rows.join(broadcast_within(asked, MAX_BROADCAST), ["k1", "k2"], "left_semi")
    texts = few.join(wants.hint("shuffle_hash"), ["k1", "k2"]).select("text", "wants")
    texts = materialize(texts.mapInArrow(_fetch, "m long, c long, text binary"), "sub_texts")
    apart = _apart(texts, contents.select("m", size.alias("bytes")), length, shard_bytes, hot_bytes,
                   tuple(q for q in FURTHER_Q if q < length))
    copied = contents.filter("n > 1").select("m", "c", F.lit(0).cast("long").alias("off"),
                                             (size - (length - 1)).alias("n"))
    found = materialize(copied.unionByName(apart)
                        .groupBy("m", "c").agg(F.collect_list(F.struct("off", "n")).alias("runs")), "sub_found")
    part = (mixed.join(found, ["m", "c"]).select("k1", "k2", start.alias("start"), F.explode("runs").alias("r"))
            .select("k1", "k2", (F.col("start") + F.col("r")["off"]).alias("start"),
                    (F.col("start") + F.col("r")["off"] + F.col("r")["n"] + (length - 1)).alias("end")))
    spans = whole.unionByName(part).groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return materialize(spans, "sub_spans")


def cut_spans(text: bytes, spans) -> tuple[bytes, int]:
    """The text without its spans, and the number of maximal removed runs."""
    kept, at, runs, end = [], 0, 0, -1
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if a > end:
            kept.append(text[at:a])
            runs += 1
            end = b
        else:
            end = max(end, b)
        at = end
    kept.append(text[at:])
    return b"".join(kept), runs


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   **sizes) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary: what is left)."""
    return _removed(docs, length, id_col, text_col, True, sizes)


def _removed(docs: DataFrame, length: int, id_col: str, text_col: str, give_text: bool, sizes: dict) -> DataFrame:
    spans = repeated_spans(docs, length, id_col, text_col, **sizes)
    k1, k2 = row_keys(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), k1.alias("k1"), k2.alias("k2"))
    rows = rows.join(spans.hint("shuffle_hash"), ["k1", "k2"], "left")
    result = "n_bytes long, n_removed long, n_spans long, kept " + ("binary" if give_text else "string")

    @F.pandas_udf(result)
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, all_spans in batches:
            out = []
            for t, s in zip(texts, all_spans):
                raw = (t or "").encode("utf-8", "surrogatepass")
                kept, runs = cut_spans(raw, s) if s is not None else (raw, 0)
                out.append((len(raw), len(raw) - len(kept), runs,
                            kept if give_text else hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])

    return rows.select("doc_id", cut("text", "spans").alias("r")).select("doc_id", "r.*")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every byte covered by a repeated 200-byte string removed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _removed(docs, LENGTH, "doc_id", "text", False, {}).withColumnRenamed("kept", "kept_sha256")
