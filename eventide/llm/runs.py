"""Periodic runs of words: maximal stretches that repeat with a smallest period.

The words of a text are numbered and the text is cut into pieces: a run of
exponent e or more holds each of its words e times or more (rounded down), so a word that is rarer
within its piece ends the piece. That cut is repeated until nothing changes and loses
no run. Each piece then goes through

1. Baier's grouping, phase one: suffixes start in one group per word; groups are taken
   from the highest down, and for every suffix of the group the nearest suffix before it
   that is still in a lower group moves to a new group right above its own, its context
   lengthened by the group's context once for each member that points to it. A suffix's
   context, when its group is taken, is its longest Lyndon prefix, so the Lyndon array
   comes out directly, without sorting suffixes. This is done under the order of the word
   numbers and under its reverse.
2. Lyndon roots: in a run of period p and exponent 4 or more the root is the longest
   Lyndon prefix at three consecutive places p apart (under one of the two orders), so
   only places where two consecutive Lyndon prefixes have equal length p are tried, one
   in each stretch of that period.
3. Extension by longest common extensions to the left and right; the stretch is a run
   if it is long enough for its period.

A piece costs linear time and memory, but for the extensions, whose total is bounded by the
lengths of the repetitions in it.

Rules: null, empty and blank texts have no words and no run. Words are what stands
between ``[\\x20\\x09-\\x0D]``, compared byte by byte. Very long texts are taken whole, in
one row. Of runs with the greatest exponent the one with the smallest start, then the
smallest period, is named. Rows that repeat get equal answers; an empty table gives no
rows; all columns of the input are kept inside one struct, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import BLANK_REGEX, table
from eventide.session import ship_package

MIN_LENGTH = 6
MIN_EXPONENT = 4

RESULT = "n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed string"


def lyndon_array(word: list[int]) -> list[int]:
    """Length of the longest Lyndon prefix of every suffix, by phase one of
    Baier's suffix grouping. ``word`` holds numbers 0..k-1, each used."""
    n = len(word)
    k = max(word) + 1
    members: list[list[int]] = [[] for _ in range(k)]
    for i, c in enumerate(word):
        members[c].append(i)
    size = [1] * k                       # context length of a group
    below = list(range(-1, k - 1))       # the next lower and the next higher group
    above = list(range(1, k + 1))
    group = list(word)
    left = list(range(-1, n))            # nearest place before with a lower group;
    right = list(range(1, n + 2))        # places taken are unlinked (n: the end)
    out = [0] * n
    g = k - 1
    while g >= 0:
        length = size[g]
        count: dict[int, int] = {}
        for i in members[g]:
            if group[i] != g:            # has moved to a higher group since
                continue
            out[i] = length
            p, q = left[i], right[i]
            left[q] = p
            if p >= 0:
                right[p] = q
                count[p] = count.get(p, 0) + 1
        # members are in ascending order, so no place counted belongs to g itself
        if count:
            moved: dict[tuple[int, int], list[int]] = {}
            for p, times in count.items():
                moved.setdefault((times, group[p]), []).append(p)
            # the more copies of the context follow, the higher the suffix; what is
            # inserted later stands closer to the old group
            for times, h in sorted(moved, reverse=True):
                new = len(size)
                size.append(size[h] + times * length)
                places = moved[times, h]
                members.append(places)
                for p in places:
                    group[p] = new
                x = above[h]
                above.append(x)
                below.append(h)
                above[h] = below[x] = new
        members[g] = ()
        g = below[g]
    return out


def common_extension(a: np.ndarray, i: int, j: int, step: int) -> int:
    """How many items from i and j on (step 1) or backwards (step -1) agree,
    i < j; blocks of doubling length are compared."""
    room = len(a) - j if step > 0 else i + 1
    done, block = 0, 16
    while done < room:
        m = min(block, room - done)
        if step > 0:
            x, y = a[i + done:i + done + m], a[j + done:j + done + m]
        else:
            x, y = a[i - done - m + 1:i - done + 1][::-1], a[j - done - m + 1:j - done + 1][::-1]
        differ = np.flatnonzero(x != y)
        if len(differ):
            return done + int(differ[0])
        done += m
        block *= 2
    return done


def piece_runs(ids: np.ndarray, min_length: int, min_exponent: int) -> set[tuple[int, int, int]]:
    """(start, length, period) of the runs of one piece."""
    _, dense = np.unique(ids, return_inverse=True)
    dense = dense.reshape(-1)
    n, top = len(dense), int(dense.max())
    found = set()
    for order in (dense, top - dense):
        lyndon = np.array(lyndon_array(order.tolist()), np.int64)
        at = np.arange(n)
        nxt = at + lyndon
        far = np.minimum(nxt, n - 1)
        chain = (nxt < n) & (lyndon[far] == lyndon) & (dense[far] == dense)
        seen: dict[int, int] = {}  # period -> end of the last stretch tried
        for i in np.flatnonzero(chain).tolist():
            p = int(lyndon[i])
            if i + 2 * p <= seen.get(p, 0):
                continue
            back = common_extension(dense, i - 1, i + p - 1, -1) if i else 0
            length = back + p + common_extension(dense, i, i + p, 1)
            seen[p] = i - back + length
            if length >= max(min_length, min_exponent * p):
                found.add((i - back, length, p))
    return found


def pieces(ids: np.ndarray, min_length: int, min_exponent: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches in which every word occurs ``min_exponent``
    times or more and which are ``min_length`` words or longer. A stretch cut 24
    times over is given as it is: cutting only saves time."""
    todo = [(0, len(ids), 0)]
    while todo:
        a, b, depth = todo.pop()
        if b - a < min_length:
            continue
        _, where, count = np.unique(ids[a:b], return_inverse=True, return_counts=True)
        rare = np.flatnonzero(count[where.reshape(-1)] < min_exponent)
        if not len(rare) or depth == 24:
            yield a, b
            continue
        cuts = np.concatenate([[-1], rare, [b - a]])
        wide = np.flatnonzero(np.diff(cuts) > min_length)
        todo.extend((a + int(cuts[k]) + 1, a + int(cuts[k + 1]), depth + 1) for k in wide)


def word_runs(words: list, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """All runs of at least ``min_exponent`` periods (4 or more) and ``min_length``
    words, as (start, length, period) in that order."""
    if min_exponent < 4:
        raise ValueError("roots are sought in runs of four periods or more")
    if len(words) < min_length:
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    found = set()
    for a, b in pieces(ids, min_length, min_exponent):
        found |= {(a + s, n, p) for s, n, p in piece_runs(ids[a:b], min_length, min_exponent)}
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words left when every run keeps its first period only."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for s, n, p in runs:
        edge[s + p] += 1
        edge[s + n] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]


def find_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """_row (all columns), n_words, runs array<struct<start, length, period>> in order
    of start and period, collapsed (the text without the repeats, words joined by a space)."""
    ship_package(docs.sparkSession)

    @F.pandas_udf(RESULT)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for t in texts:
                words = (t or "").encode("utf-8", "surrogatepass").split()
                runs = word_runs(words, min_length, min_exponent)
                kept = b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass")
                s, n, p = ([list(x) for x in zip(*runs)] if runs else ([], [], []))
                out.append((len(words), s, n, p, kept))
            yield pd.DataFrame(out, columns=["n_words", "starts", "lengths", "periods", "collapsed"])

    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        search(F.col(f"`{text}`")).alias("_f"))
    return found.select("_row", F.col("_f.n_words").alias("n_words"),
                        F.arrays_zip(F.col("_f.starts").alias("start"), F.col("_f.lengths").alias("length"),
                                     F.col("_f.periods").alias("period")).alias("runs"),
                        F.col("_f.collapsed").alias("collapsed"))


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly by cross products;
    ties go to the smallest start, then period. Null without runs."""
    def better(a: Column, b: Column) -> Column:
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    return F.aggregate(runs, F.lit(None).cast(kind), lambda a, b: better(a, b.cast(kind)))


def planted_text(doc_id: Column, text: Column) -> Column:
    """The contract's input: a tenth of the texts (by CRC-32 of the id) has its
    words from place a on replaced by repeats of its words a to a + p - 1."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_REGEX, -1), "")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    return F.when((h % 10 == 0), F.struct(words.alias("w"), g.alias("g")))


def with_planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (id and text) with the periodic tails of the contract. A null id plants nothing."""
    d = docs.select(F.col(id_col), F.col(text_col), planted_text(F.col(id_col), F.col(text_col)).alias("_w"))
    n = F.size("_w.w")
    a = F.when(n > 0, (F.col("_w.g") % n).cast("int"))
    p = F.when(n > 0, (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("_w.g") % 8))).cast("int"))
    d = d.withColumn("_a", a).withColumn("_p", p)
    tail = F.transform(F.sequence(F.lit(0), F.size("_w.w") - 1), lambda i: F.get(
        F.col("_w.w"), F.when(i >= F.col("_a"), F.col("_a") + (i - F.col("_a")) % F.col("_p")).otherwise(i)))
    return d.select(F.col(id_col), F.when(F.size("_w.w") > 0, F.array_join(tail, " "))
                    .otherwise(F.col(text_col)).alias(text_col))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole document, the strongest one, and what is left without repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(with_planted(docs)).withColumn("best", strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listing = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listing.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")
