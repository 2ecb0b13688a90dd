"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad. A line is described by counts over its
bytes and words, each put into one of a few buckets; its score is the sum of learned
weights of its own buckets and of those of the line before and the line after, and
a 2 x 2 table of weights ties neighbouring labels together. Forward-backward gives each
line's probability of being good, and a text's score is the mean of them, weighted by
line length (code points + 1).

Forward and backward messages of all texts of a batch come from one prefix scan over
2 x 2 matrices: the matrix of a text's first line forgets what came before, so texts
need no loop of their own and a text of a million lines takes about twenty array
passes, not a million steps.

Training: each line takes its text's label. The model is fitted on the driver on a bounded
sample: at most ``max_docs`` labelled texts, drawn by the hash of their id, of at most
``max_lines`` lines each (longer ones are not learned from, but scored like all
others). A line is 14 bytes there. Scoring covers every line of every text.

Rules: a null, empty or blank text is one or more empty lines and is scored as such.
With no labelled text in the sample, or labels of one class only, every score is 0.5. Null labels and ids
are not learned from; an id with labels that differ is learned once with each; repeated
rows get equal scores. Ties at the threshold count as good. Very long texts are scored whole, an
empty table gives no rows, and all columns of the input are kept inside one struct, so names
cannot clash. Only the text is an input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import table, text_chunks
from eventide.session import ship_package

MAX_DOCS = 4_000
MAX_LINES = 500
THRESHOLD = 0.3

_CLASSES = {
    "blank": b" \t\x0b\x0c\r\n",
    "upper": bytes(range(65, 91)),
    "digit": b"0123456789",
    "symbol": b"#*$%&|<>",
    "stop": b".,;:",
    "bang": b"!?",
}
_CODE = np.zeros(256, np.uint8)
for _k, _chars in enumerate(_CLASSES.values(), 1):
    _CODE[list(_chars)] = _k

# What describes a line, with the upper ends of its buckets (the last one is open).
CUTS = {
    "words": (0, 1, 3, 8, 20, 60),
    "mean_word": (0, 2.5, 3.5, 4.5, 5.5, 7.0),
    "symbols_per_word": (0, 0.05, 0.2, 0.45, 0.7),
    "upper_share": (0, 0.02, 0.05, 0.15, 0.5),
    "bangs_per_word": (0, 0.05, 0.3, 0.7),
    "digit_share": (0, 0.05, 0.2, 0.5),
    "stops_per_word": (0, 0.05, 0.15, 0.3),
    "distinct_share": (0.1, 0.3, 0.5, 0.7, 0.85, 0.97),
    "twin_share": (0, 0.03, 0.1, 0.4),
    "short_share": (0, 0.1, 0.25, 0.5),
    "ends_sentence": (0,),
    "copy_of_line": (0,),
    "edge": (0, 1, 2),
    "longest_word": (4, 9, 14, 20, 40),
}
OFFSETS = np.concatenate([[0], np.cumsum([len(c) + 1 for c in CUTS.values()])])
N_BUCKETS = int(OFFSETS[-1])
NONE = N_BUCKETS  # stands for the line before the first and after the last one


def _per_line(values: np.ndarray, line: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(line, weights=values, minlength=n) if len(line) else np.zeros(n)


def line_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets [lines, stats] uint8, lines per text, weight per line)."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(buf == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(ends)
    lines = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), lines)
    code = _CODE[buf]

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[ends] - total[starts]
    count = {name: per_line(code == k) for k, name in enumerate(_CLASSES, 1)}
    chars = per_line((buf & 0xC0) != 0x80)
    inside = code != 1
    head = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
    tail = np.flatnonzero(inside & np.concatenate([~inside[1:], [True]])) + 1
    size = tail - head
    line = np.searchsorted(ends, head)
    # a hash of every word: its bytes times powers of an odd number, summed
    at = np.arange(len(buf), dtype=np.int64) - np.repeat(np.concatenate([[0], head]), np.diff(
        np.concatenate([[0], head, [len(buf)]])))
    with np.errstate(over="ignore"):
        power = np.multiply.accumulate(np.full(int(size.max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))
        value = np.where(inside, buf, 0).astype(np.uint64) * power[np.minimum(at, len(power) - 1)]
        h = np.add.reduceat(value, head) if len(head) else np.zeros(0, np.uint64)
        h ^= h >> np.uint64(29)
        mixed = (h * np.uint64(0xBF58476D1CE4E5B9)) ^ (line.astype(np.uint64) * np.uint64(0x94D049BB133111EB))
        order = np.argsort(mixed, kind="stable")
        fresh = np.ones(len(order), bool)
        fresh[1:] = mixed[order][1:] != mixed[order][:-1]
        distinct = _per_line(fresh, line[order], n)
        place = np.arange(len(head)) - np.repeat(np.searchsorted(line, np.arange(n)), np.bincount(line, minlength=n))
        text_hash = np.zeros(n, np.uint64)
        np.add.at(text_hash, line, h * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)))
        key = text_hash ^ (doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    twin = np.zeros(len(h), bool)
    twin[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    words = _per_line(np.ones(len(head)), line, n)
    some = np.maximum(words, 1)
    solid = np.maximum((ends - starts) - (count["blank"]), 1)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, line, size)
    last = np.zeros(n, np.uint8)
    last[line] = buf[np.maximum(tail - 1, 0)] if len(tail) else 0  # the last word of a line stays
    _, back, copies = np.unique(key, return_inverse=True, return_counts=True)
    first_line = np.concatenate([[True], doc[1:] != doc[:-1]])
    last_line = np.concatenate([doc[1:] != doc[:-1], [True]])
    stats = {
        "words": words,
        "mean_word": _per_line(size, line, n) / some,
        "symbols_per_word": count["symbol"] / some,
        "upper_share": count["upper"] / solid,
        "bangs_per_word": count["bang"] / some,
        "digit_share": count["digit"] / solid,
        "stops_per_word": count["stop"] / some,
        "distinct_share": distinct / some,
        "twin_share": _per_line(twin, line, n) / some,
        "short_share": _per_line(size < 3, line, n) / some,
        "ends_sentence": np.isin(last, np.frombuffer(b".!?", np.uint8)),
        "copy_of_line": (copies[back.reshape(-1)] > 1) & (words > 0),
        "edge": first_line + 2 * last_line,
        "longest_word": longest,
    }
    out = np.empty((n, len(CUTS)), np.uint8)
    for j, (name, cuts) in enumerate(CUTS.items()):
        out[:, j] = np.searchsorted(np.asarray(cuts, float), np.asarray(stats[name], float)) + OFFSETS[j]
    return out, lines, chars + 1.0


def scan(score: np.ndarray, tie: np.ndarray, first: np.ndarray, longest: int) -> np.ndarray:
    """Forward messages [lines, 2], each scaled to sum 1, where state 1 has log
    potential ``score`` and state 0 has 0; ``tie`` holds the transition factors."""
    node = np.stack([np.ones_like(score), np.exp(np.clip(score, -30, 30))], 1)
    node /= node.max(1, keepdims=True)
    m = np.where(first[:, None, None], 1.0, tie[None]) * node[:, None, :]
    step = 1
    while step < longest:
        a, b = m[:-step], m[step:]
        nxt = a[:, :, 0, None] * b[:, None, 0, :] + a[:, :, 1, None] * b[:, None, 1, :]
        nxt /= nxt.max((1, 2), keepdims=True)
        m = np.concatenate([m[:step], nxt])
        step *= 2
    # every product now starts in or before the text's first line, whose rows are equal
    return m[:, 0] / m[:, 0].sum(1, keepdims=True)


@dataclass
class LineModel:
    """Weights [3, buckets + 1] for the line itself, the one before and the one after
    (the last bucket: no such line), and 2 x 2 transition log factors."""
    weights: np.ndarray
    ties: np.ndarray

    def scores(self, codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        own = self.weights[0][codes].sum(1)
        before, after = self.weights[1][codes].sum(1), self.weights[2][codes].sum(1)
        own[1:] += np.where(first[1:], self.weights[1][NONE], before[:-1])
        own[:-1] += np.where(last[:-1], self.weights[2][NONE], after[1:])
        own[0] += self.weights[1][NONE]
        own[-1] += self.weights[2][NONE]
        return own

    def messages(self, codes, first, last, longest):
        u = self.scores(codes, first, last)
        t = np.exp(self.ties)
        ahead = scan(u, t, first, longest)
        behind = scan(u[::-1], t.T, last[::-1], longest)[::-1]
        return u, t, ahead, behind

    def good(self, codes: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Probability that each line is good."""
        first, last = edges(lines)
        u, _, ahead, behind = self.messages(codes, first, last, int(lines.max()))
        p = ahead * behind
        p[:, 1] /= np.exp(np.clip(u, -30, 30))
        return p[:, 1] / p.sum(1)


def edges(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.zeros(int(lines.sum()), bool)
    end = np.cumsum(lines)
    first[end - lines] = True
    last = np.zeros(len(first), bool)
    last[end - 1] = True
    return first, last


def fit(codes: np.ndarray, lines: np.ndarray, good: np.ndarray, rounds: int = 120, rate: float = 0.1,
        ridge: float = 1e-3) -> LineModel:
    """Maximum conditional likelihood (every text counts alike, however many lines it
    has) by Adam on the exact gradient: observed less expected counts."""
    first, last = edges(lines)
    longest = int(lines.max())
    doc = np.repeat(np.arange(len(lines)), lines)
    y = good[doc].astype(np.int64)
    share = (1 / lines / len(lines))[doc]
    model = LineModel(np.zeros((3, N_BUCKETS + 1)), np.zeros((2, 2)))
    moment = [[np.zeros_like(x), np.zeros_like(x)] for x in (model.weights, model.ties)]
    flat = codes.astype(np.int64).reshape(-1)
    stats = codes.shape[1]
    inner = ~first[1:]
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][inner], y[1:][inner]), share[1:][inner])
    for k in range(1, rounds + 1):
        u, t, ahead, behind = model.messages(codes, first, last, longest)
        p = ahead * behind
        p[:, 1] /= np.exp(np.clip(u, -30, 30))
        p = p[:, 1] / p.sum(1)
        miss = (y - p) * share
        grad = np.empty_like(model.weights)
        for side, (value, no) in enumerate((
                (miss, 0.0),
                (np.append(np.where(last[:-1], 0.0, miss[1:]), 0.0), miss[first].sum()),
                (np.append(0.0, np.where(first[1:], 0.0, miss[:-1])), miss[last].sum()))):
            grad[side] = np.bincount(flat, weights=np.repeat(value, stats), minlength=N_BUCKETS + 1)
            grad[side][NONE] = no
        pair = ahead[:-1, :, None] * t[None] * behind[1:, None, :]
        pair /= pair.sum((1, 2), keepdims=True)
        expected = (pair * (share[1:] * inner)[:, None, None]).sum(0)
        for x, g, mo in ((model.weights, grad, moment[0]), (model.ties, seen - expected, moment[1])):
            g = g - ridge * x / 10
            mo[0] = 0.9 * mo[0] + 0.1 * g
            mo[1] = 0.999 * mo[1] + 0.001 * g * g
            x += rate * (mo[0] / (1 - 0.9 ** k)) / (np.sqrt(mo[1] / (1 - 0.999 ** k)) + 1e-9)
        np.clip(model.ties, -4, 4, out=model.ties)
    return model


def _texts(batch: pd.Series) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in batch]


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", good: int = 1, max_docs: int = MAX_DOCS,
          max_lines: int = MAX_LINES, id_col: str = "doc_id", text_col: str = "text") -> LineModel | None:
    """The model for ``label`` = ``good``, or None if there is nothing to learn from."""
    ship_package(docs.sparkSession)
    ids = (labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
           .select(F.col(id_col).alias("_id"), (F.col(label) == good).alias("_good")).distinct()
           .orderBy(F.xxhash64("_id"), "_id", "_good").limit(max_docs))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(ids), "_id")

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = _texts(b["_text"])
            keep = np.array([t.count(b"\n") < max_lines for t in texts], bool)
            b, texts = b[keep], [t for t, k in zip(texts, keep) if k]
            if texts:
                codes, lines, _ = line_codes(texts)
                parts = np.split(codes, np.cumsum(lines)[:-1])
                yield pd.DataFrame({"_id": b["_id"].to_numpy(), "_good": b["_good"].to_numpy(),
                                    "codes": [c.tobytes() for c in parts]})

    got = (rows.mapInPandas(describe, rows.select("_id", "_good").schema.add("codes", "binary"))
           .orderBy(F.xxhash64("_id"), "_id", "_good", F.xxhash64("codes")).limit(max_docs).toPandas())
    y = got["_good"].to_numpy(bool)
    if y.all() or not y.any():
        return None
    parts = [np.frombuffer(c, np.uint8).reshape(-1, len(CUTS)) for c in got["codes"]]
    return fit(np.concatenate(parts), np.array([len(c) for c in parts], np.int64), y)


def score_lines(docs: DataFrame, model: LineModel | None, text: str = "text") -> DataFrame:
    """_row (all columns), score, n_lines, and good: each line's probability of being good."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("score double, n_lines long, good array<float>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, out = _texts(batch), []
            for a, b in text_chunks(texts):
                codes, lines, weight = line_codes(texts[a:b])
                p = np.full(len(codes), 0.5) if model is None else model.good(codes, lines)
                ends = np.cumsum(lines)
                begins = ends - lines
                mean = np.add.reduceat(p * weight, begins) / np.add.reduceat(weight, begins)
                out += [(float(min(max(m, 0.0), 1.0)), int(n), p[s:e].astype(np.float32))
                        for m, n, s, e in zip(mean, lines, begins, ends)]
            yield pd.DataFrame(out, columns=["score", "n_lines", "good"])

    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), score(F.col(f"`{text}`")).alias("_s"))
    return found.select("_row", "_s.*")


def held_out(doc_id: Column) -> Column:
    """Whether the contract keeps this id from training (a null id is not kept)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))))
    out = score_lines(docs, model)
    return out.select(F.col("_row.doc_id").alias("doc_id"), held_out(F.col("_row.doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_lines",
                      F.size(F.filter("good", lambda p: p < 0.5)).cast("long").alias("bad_lines"))
