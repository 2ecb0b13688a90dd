"""Token counts by rank-synchronous merging of ragged arrays.

A batch of texts is cut into pre-tokens; the distinct ones not counted before
become one flat array of byte symbols with sequence bounds. In every round
each sequence finds the lowest rank among its adjacent pairs and all its
non-overlapping occurrences of that pair are merged at once; a sequence
without a mergeable pair is finished and leaves the arrays. A pre-token's count
is the number of symbols that survive.

The vocabulary file is read once per worker (its path is a parameter); a file that asks
for other pre-tokens or merges is refused. The counts of short pre-tokens are remembered in
a table bounded in entries and so in bytes. A pre-token costs at most a round per
merge of the vocabulary, each linear in its length. Special strings are
tokens of their own wherever they occur, as the tokenizer file declares.

Rules: null and empty texts have 0 tokens; texts of any length are counted
whole; repeated rows get equal counts; merges of equal rank are ties that are applied from the
left; a column of the input named like the result is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import table, text_chunks
from eventide.session import ship_package

# Fixed value: the pre-token pattern of this family of byte-level vocabularies.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_RANK = np.int32(2**31 - 1)
REMEMBER = 400_000  # pre-tokens of at most LONG characters
LONG = 64
LIMIT = 512


def _byte_symbols() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b if b in shown else next(spare)) for b in range(256)}


def refuse_unlike(file: dict) -> None:
    """Raise ValueError unless a tokenizer file asks for just what is done here: byte-level
    pre-tokens by ``PRETOKEN``, plain merges by rank, special strings taken as they stand."""
    model, cut = file["model"], file.get("pre_tokenizer") or {}
    wrong = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
    if model.get("type") != "BPE":
        wrong.append("type")
    if file.get("normalizer"):
        wrong.append("normalizer")
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        wrong.append("pre_tokenizer")
    wrong += [k for k in ("single_word", "lstrip", "rstrip") if any(t.get(k) for t in file.get("added_tokens") or [])]
    if wrong:
        raise ValueError(f"the vocabulary file needs another tokenizer: {', '.join(wrong)}")


class MergeCounter:
    """Counts the symbols left of byte sequences after all merges."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        refuse_unlike(model)
        vocab = model["model"]["vocab"]
        self.symbol = np.array([vocab[s] for _, s in sorted(_byte_symbols().items())], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.width = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)  # by rank
        special = sorted((t["content"] for t in model.get("added_tokens") or []), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.words = regex.compile(PRETOKEN).findall
        self.known: dict[str, int] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def merge(self, seqs: list[bytes]) -> np.ndarray:
        """Symbols left of each (non-empty) byte sequence."""
        lens = np.fromiter(map(len, seqs), np.int64, len(seqs))
        left = lens.copy()
        sym = self.symbol[np.frombuffer(b"".join(seqs), np.uint8)]
        who = np.arange(len(seqs))
        rank = np.full(len(sym), NO_RANK, np.int32)  # of the pair (i, i + 1)
        if len(sym) > 1:
            rank[:-1] = self._rank(sym[:-1], sym[1:])
        rank[np.cumsum(lens) - 1] = NO_RANK  # no pair across two sequences
        while len(lens):
            start = np.cumsum(lens) - lens
            low = np.minimum.reduceat(rank, start)
            live = low != NO_RANK
            if not live.all():  # finished sequences leave
                left[who[~live]] = lens[~live]
                keep = np.repeat(live, lens)
                sym, rank, who, lens, low = sym[keep], rank[keep], who[live], lens[live], low[live]
                if not len(lens):
                    break
            seq = np.repeat(np.arange(len(lens)), lens)
            hit = np.flatnonzero(rank == low[seq])
            # a run of touching hits is one symbol repeated: take every other
            first = np.r_[True, hit[1:] != hit[:-1] + 1]
            at = np.arange(len(hit))
            hit = hit[(at - np.maximum.accumulate(np.where(first, at, 0))) % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            rank[hit] = rank[hit + 1]  # whether a pair follows; its rank is set below
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            lens = lens - np.bincount(seq[hit], minlength=len(lens))
            end = np.zeros(len(sym), bool)
            end[np.flatnonzero(seq[1:] != seq[:-1])] = True
            end[-1] = True
            end[hit] |= end[hit + 1]
            new = (np.cumsum(keep) - 1)[hit]
            sym, rank, end = sym[keep], rank[keep], end[keep]
            for i in (new, new[new > 0] - 1):  # pairs that begin or end in a merged symbol
                rank[i] = NO_RANK
                i = i[~end[i]]
                rank[i] = self._rank(sym[i], sym[i + 1])
        return left

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        cut, extra = [], []
        for t in texts:
            t = t or ""
            found = self.special.findall(t) if self.special else ()
            extra.append(len(found))
            if found:
                cut.append([w for part in self.special.split(t) for w in self.words(part)])
            else:
                cut.append(self.words(t))
        known = self.known
        new = list({w for ws in cut for w in ws if w not in known})
        if new:
            got = self.merge([w.encode("utf-8", "surrogatepass") for w in new])
            known.update(zip(new, got.tolist()))
        out = [sum(map(known.__getitem__, ws)) + e for ws, e in zip(cut, extra)]
        for w in new:
            if len(w) > LONG:
                del known[w]
        if len(known) > REMEMBER:
            known.clear()
        return out


_COUNTERS: dict[str, MergeCounter] = {}


def counter(path: str) -> MergeCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = MergeCounter(path)
    return _COUNTERS[path]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, path: str, text_col: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` with a long column ``name``."""
    ship_package(docs.sparkSession)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(path)
        for texts in batches:
            texts = texts.tolist()
            yield pd.Series([n for a, b in text_chunks(texts, 2 << 20) for n in c.count(texts[a:b])], dtype="int64")

    return docs.withColumn(name, tokens(F.col(text_col)))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = token_counts(docs, vocabulary_path())
    return out.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                      "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
