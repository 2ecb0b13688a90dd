"""Quality rules: base statistics of a text and a learned decision list.

``text_stats`` counts, per whole text, what the base rules and the learned
rules look at. ``learn_rules`` runs sequential covering on labelled
statistics: a rule is a conjunction of thresholds, grown one condition at a
time by information gain on two thirds of the labelled rows, pruned from its
end on the remaining third, and kept while it is precise there; the rows it
covers are then set aside and the next rule is learned. ``decision`` turns the
ordered list into one Spark conditional expression, so applying it is a plain
column.

The rules are learned from at most ``max_rows`` labelled rows (a documented
bound, drawn by the hash of the id); every other number covers all rows. The list has at
most ``max_rules`` rules (12) of at most ``max_conditions`` conditions (4): both bound the
size of the Spark expression and are parameters; covering mostly stops before, when no
further rule is precise.

Rules: null and empty texts have no words, fail the base rules and are not
kept; with no labels, or labels of one class, the list is empty and the
base rules alone decide; repeated rows get equal answers; labelled ids that are
null or absent are ignored; an id with labels that differ counts once for each; equal gains go
to the first feature; very long texts are counted whole; an empty table gives an empty
result; ``keep_quality`` packs the columns of the input, so names cannot clash there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import table
from eventide.session import ship_package

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

STATS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "n_lines long, n_upper long, n_digits long, n_punct long, n_unique long, n_short long, n_letters long")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a run of ``window`` words that occurs twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(window):  # a polynomial of the word hashes, mixed
        key = key * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + n]
        key ^= key >> np.uint64(29)
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.searchsorted(twice, key)
    hit = twice[np.minimum(at, len(twice) - 1)] == key
    cover = np.zeros(len(words) + 1, np.int64)
    cover[:n][hit] += 1
    cover[window:window + n][hit] -= 1
    return int((np.cumsum(cover)[:-1] > 0).sum())


_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = b"0123456789"
_PUNCT = b".,;:!?\"'()[]{}-_/\\=+@~^`"


def one_text(text: str | None) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    lines = text.split("\n")
    dup = 0
    if len(lines) > 1:
        seen = set()
        for line in lines:
            if line in seen:
                dup += bool(line.strip(" \t\x0b\x0c\r"))
            else:
                seen.add(line)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    at = lambda chars: int(count[list(chars)].sum())
    sizes = np.fromiter(map(len, words), np.int64, n)
    blanks = at(b" \t\n\x0b\x0c\r")
    return (n, len(text) - blanks, at(SYMBOLS.encode()), dup, repeated_words(words), len(lines),
            at(_UPPER), at(_DIGIT), at(_PUNCT), len(set(words)), int((sizes < 3).sum()),
            len(raw) - blanks - at(_DIGIT) - at(_PUNCT) - at(SYMBOLS.encode()))


def text_stats(docs: DataFrame, text: str = "text", name: str = "stats") -> DataFrame:
    """``docs`` with a struct column ``name`` of the counts of every whole text."""
    ship_package(docs.sparkSession)
    fields = [f.split()[0] for f in STATS.split(", ")]

    @F.pandas_udf(STATS)
    def stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([one_text(t) for t in texts], columns=fields)

    return docs.withColumn(name, stats(F.col(text)))


def features(s: Column) -> dict[str, Column]:
    """What the learned rules may compare with thresholds."""
    words = F.greatest(s["n_words"], F.lit(1)).cast("double")
    chars = F.greatest(s["word_chars"], F.lit(1)).cast("double")
    return {
        "words": s["n_words"].cast("double"),
        "mean_word": s["word_chars"] / words,
        "symbols_per_word": s["n_symbols"] / words,
        "dup_line_share": s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)).cast("double"),
        "repeat_share": s["n_repeat_words"] / words,
        "words_per_line": words / F.greatest(s["n_lines"], F.lit(1)).cast("double"),
        "upper_share": s["n_upper"] / chars,
        "digit_share": s["n_digits"] / chars,
        "punct_share": s["n_punct"] / chars,
        "unique_share": s["n_unique"] / words,
        "short_share": s["n_short"] / words,
        "letter_share": s["n_letters"] / chars,
    }


def _gain(p: np.ndarray, n: np.ndarray, p0: float, n0: float) -> np.ndarray:
    """FOIL information gain of a condition covering (p, n) of (p0, n0)."""
    with np.errstate(divide="ignore", invalid="ignore"):
        g = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
    return np.where(p > 0, g, -np.inf)


def _best_condition(x: np.ndarray, y: np.ndarray):
    """(gain, feature, op, threshold) of the best single condition."""
    p0, n0 = y.sum(), (~y).sum()
    best = (0.0, None, "", 0.0)
    for j in range(x.shape[1]):
        order = np.argsort(x[:, j], kind="stable")
        v, t = x[order, j], y[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        p, n = np.cumsum(t), np.cumsum(~t)
        for op, cp, cn in (("<=", p[cut], n[cut]), (">", p0 - p[cut], n0 - n[cut])):
            g = _gain(cp.astype(float), cn.astype(float), p0, n0)
            k = int(np.argmax(g))
            if g[k] > best[0] + 1e-9:
                best = (float(g[k]), j, op, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return best


def _covers(rule, x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for j, op, t in rule:
        hit &= x[:, j] <= t if op == "<=" else x[:, j] > t
    return hit


def cover_sequentially(x: np.ndarray, y: np.ndarray, max_rules: int = 12, max_conditions: int = 4,
                       precision: float = 0.9, min_cover: int = 5) -> list[list[tuple[int, str, float]]]:
    """Ordered rules for the class ``y``; the default is the other class.

    A rule is cut back to the prefix that is best on the rows held back for
    pruning. It is kept if it covers ``min_cover`` rows or more and at least
    ``precision`` of them are of the class, on all rows and (with one error
    granted, as few rows are held back) on those held back."""
    held = np.arange(len(y)) % 3 == 2
    left = np.ones(len(y), bool)
    rules = []
    for _ in range(max_rules):
        grow, prune = left & ~held, left & held
        gx, gy = x[grow], y[grow]
        if gy.sum() < min_cover // 2 or not (~gy).any():
            break
        rule, inside = [], np.ones(len(gy), bool)
        while len(rule) < max_conditions and (~gy[inside]).any():
            _, j, op, t = _best_condition(gx[inside], gy[inside])
            if j is None:
                break
            rule.append((j, op, t))
            inside = _covers(rule, gx)
        px, py = x[prune], y[prune]

        def worth(r):
            hit = _covers(r, px)
            p, n = (py & hit).sum(), (~py & hit).sum()
            return (p + 1) / (p + n + 2), p
        options = [rule[:k] for k in range(1, len(rule) + 1)]
        if not options:
            break
        rule = max(options, key=worth)
        hit = _covers(rule, x) & left
        wrong, wrong_held = (hit & ~y).sum(), (hit & ~y & held).sum()
        if (hit.sum() < min_cover or wrong > (1 - precision) * hit.sum()
                or wrong_held > max(1, (1 - precision) * (hit & held).sum())):
            break
        rules.append(rule)
        left &= ~hit
        if not y[left].any():
            break
    return rules


def learn_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", bad: int = 0,
                max_rows: int = 20_000, id_col: str = "doc_id", text_col: str = "text", **how) -> list:
    """The decision list for rows labelled ``bad`` that pass the base rules, as (feature, op, threshold)
    conjunctions. At most ``max_rows`` labelled rows reach the driver, as a
    few numbers each."""
    ids = (labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
           .select(F.col(id_col).alias("_id"), (F.col(label) == bad).alias("_bad"))
           .orderBy(F.xxhash64("_id"), "_id", "_bad").limit(max_rows))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(ids), "_id")
    st = text_stats(rows, "_text", "_s")
    cols = features(F.col("_s"))
    got = (st.select("_bad", "_id", base_failed(F.col("_s")).alias("_failed"), *[c.alias(k) for k, c in cols.items()])
           .orderBy(F.xxhash64("_id"), "_id", "_bad", "words", "mean_word").limit(max_rows).toPandas())
    # filtered here: a filter on the counts would be pushed below the join, to all texts
    got = got[~got["_failed"].astype(bool)]
    if got.empty:
        return []
    names = list(cols)
    found = cover_sequentially(got[names].to_numpy(float), got["_bad"].to_numpy(bool), **how)
    return [[(names[j], op, t) for j, op, t in r] for r in found]


def decision(rules: list, s: Column) -> Column:
    """Number of the first rule that fires (1, 2, ...), 0 if none does."""
    cols = features(s)
    out = None
    for i, rule in enumerate(rules, 1):
        hit = F.lit(True)
        for name, op, t in rule:
            hit = hit & (cols[name] <= t if op == "<=" else cols[name] > t)
        out = F.when(hit, F.lit(i)) if out is None else out.when(hit, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def judge(docs: DataFrame, rules: list, text_col: str = "text") -> DataFrame:
    """``docs`` with columns stats, base_failed, rule, kept."""
    out = text_stats(docs, text_col, "stats")
    s = F.col("stats")
    return (out.withColumn("base_failed", base_failed(s)).withColumn("rule", decision(rules, s))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass the base rules and the learned list."""
    rules = learn_rules(docs, labels, id_col=id_col, text_col=text_col)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                         F.col(text_col).alias("_text"))
    return judge(packed, rules, "_text").filter("kept").select("_row.*")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn_rules(docs, table(spark, sf_dir, "labels"))
    return judge(docs, rules).select("doc_id", *[F.col("stats")[c].alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept", "rule")
