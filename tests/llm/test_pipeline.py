"""Stages keep the columns, decide as their operators do, and chain."""

import itertools
import random
import re
import string
from collections import Counter

import xxhash
from test_operators import plain_stats

import corpus_pipeline
from eventide.llm import quality, simhash
from eventide.session import materialize


def test_stages(spark, docs, rows, tmp_path):
    d = str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(9, 30)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    item = " ".join(rows[10][1].split()[:20])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    out = corpus_pipeline.run(spark, d)
    assert out.columns == docs.columns  # the clashing input column shard is replaced
    got = out.collect()
    assert got and all(0 <= r.shard < 16 for r in got)
    texts = {r.text for r in got}
    assert item not in " ".join(texts)
    for t in texts:
        s = quality.one_text(t)
        assert s[0] >= 20 and 100 * s[4] <= 30 * s[0]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mixture", "shards"]


# The five stages in plain Python, each on what Spark's stage before it kept

def hash64(*values):
    """Spark's xxhash64: a chain of XXH64, each seeded with the one before; nulls are passed over."""
    h = 42
    for kind, v in values:
        if v is not None:
            data = v.encode() if kind == "s" else v.to_bytes(4 if kind == "i" else 8, "little", signed=True)
            h = xxhash.xxh64_intdigest(data, h)
    return h - 2**64 if h >= 2**63 else h


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_features(text):
    t, w = text or "", words(text)
    n, chars, symbols, dup, repeat = plain_stats(t)
    blanks = sum(t.count(c) for c in " \t\n\x0b\x0c\r")
    raw, lines = t.encode(), t.count("\n") + 1
    upper, digits = (sum(map(raw.count, set)) for set in ([bytes([c]) for c in range(65, 91)], [b"%d" % d for d in range(10)]))
    punct = sum(t.count(c) for c in string.punctuation if c not in quality.SYMBOLS)
    one, c = max(n, 1), max(chars, 1)
    return {"words": n, "mean_word": chars / one, "symbols_per_word": symbols / one, "dup_line_share": dup / lines,
            "repeat_share": repeat / one, "words_per_line": one / lines, "upper_share": upper / c, "digit_share": digits / c,
            "punct_share": punct / c, "unique_share": len(set(w)) / one, "short_share": sum(len(x.encode()) < 3 for x in w) / one,
            "letter_share": (len(raw) - blanks - digits - punct - symbols) / c}


def plain_quality(rows, rules):
    def passes(t):
        n, _, _, _, repeat = plain_stats(t)
        f = plain_features(t)
        return n >= 20 and 100 * repeat <= 30 * n and not any(
            all(f[name] <= x if op == "<=" else f[name] > x for name, op, x in rule) for rule in rules)
    return [r for r in rows if passes(r.text)]


def plain_near_dedup(rows):
    fps, label = [simhash.fingerprint(r.text) for r in rows], list(range(len(rows)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i, j in itertools.combinations(range(len(rows)), 2):
        if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 3:
            label[find(j)] = find(i)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r)
    # equal ids with unlike texts do not occur here, so any row of the least id will do
    return [min(g, key=lambda r: (r.doc_id is None, r.doc_id or 0)) for g in groups.values()]


def plain_decontaminate(rows, items):
    norm = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]

    def holds(text, item):
        d, it = norm(text), norm(item)
        k = min(5, len(it))
        a = Counter(tuple(it[j:j + k]) for j in range(len(it) - k + 1)) if it else Counter()
        s = [tuple(d[j:j + k]) for j in range(len(d) - k + 1)] if it else []
        n = sum(a.values())
        for j in range(max(1, len(s) - n + 1)) if s else ():
            b = Counter(s[j:j + n])
            o = sum((a & b).values())
            if o >= 0.8 * (n + sum(b.values()) - o):
                return True
        return False
    return [r for r in rows if not any(holds(r.text, i) for i in items)]


def plain_mix(rows, seed=11):
    size, by = Counter(), {}
    for r in rows:
        size[r.source] += len(words(r.text))
        by.setdefault(r.source, []).append(r)
    names = sorted(n for n in size if n is not None) + [None] * (None in size)
    weight, target, free, left = {n: 1 + i % 3 for i, n in enumerate(names)}, {}, set(names), sum(size.values())
    while free:
        unit = left / sum(weight[n] for n in free)
        over = {n for n in free if unit * weight[n] > 3 * size[n]}
        for n in over or free:
            target[n] = 3 * size[n] if over else unit * weight[n]
        left -= sum(target[n] for n in over)
        free = free - over if over else set()
    out = []
    for n in names:
        whole = int(target[n] / size[n] + 1e-12) if size[n] else 0
        rest, seen, docs = max(0.0, target[n] - whole * size[n]), Counter(), []
        for r in by[n]:
            key = (("l", r.doc_id), ("s", r.text))
            g1, g2 = hash64(("i", seed), *key), hash64(("i", seed + 1), ("s", n), *key[::-1])
            i = seen[g1, g2]
            seen[g1, g2] += 1
            docs.append((r, len(words(r.text)), hash64(("l", g1), ("l", g2), ("l", i)) if i else g1))
        sizes, theta, above = sorted((s for _, s, _ in docs if s), reverse=True), None, 0
        for k in range(len(sizes)):  # the largest k are certain
            if rest > above:
                th = (rest - above) / sum(s * s for s in sizes[k:])
                if th * sizes[k] <= 1:
                    theta = th
                    break
            above += sizes[k]
        ranked = []
        for r, s, h in docs:
            u, p = (((h % 2**64) >> 12) + 0.5) / 2**52, theta * s if theta is not None else 1
            out += [r] * whole
            if s:
                ranked.append((0.0 if p >= 1 else u / (1 - u) * (1 - p) / p, h, s, r))
        sofar = 0
        for q, h, s, r in sorted(ranked, key=lambda x: x[:2]):
            if rest > 0 and sofar + s / 2 <= rest:
                out.append(r)
                sofar += s
            else:
                break
    return out


def least_capacity(units, shards):
    """The least greatest sum of a cut into so many stretches, by trying every last cut."""
    at = list(itertools.accumulate(units, initial=0))
    best = at[:]
    for _ in range(shards - 1):
        best = [0] + [min(max(best[i], at[j] - at[i]) for i in range(j)) for j in range(1, len(at))]
    return best[-1]


def test_stages_by_plain_python(spark, docs, rows, tmp_path):
    rnd = random.Random(8)
    bad = [" ".join(rnd.choice(["#", "x", "77", "&", "the"]) + str(rnd.randint(0, 99)) for _ in range(rnd.randint(30, 60))) for _ in range(60)]
    made = [r for r in rows if r[0] is None or r[0] != rows[12][0]] + [rows[12]] * 3  # an id with three equal rows
    made += [(1000 + i, t, "en", "s9", len(t), 0, "y", "z") for i, t in enumerate(bad)]
    d = str(tmp_path)
    spark.createDataFrame(made, docs.schema).repartition(3).write.parquet(f"{d}/documents.parquet")
    marks = [(i, 1, 0) for i in range(9, 80)] + [(1000 + i, 0, 0) for i in range(40)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    items = [" ".join(rows[k][1].split()[:22]) for k in (10, 20, 33)] + ["nothing of this kind stands in any document"]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    rules = quality.learn_rules(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))
    assert rules
    plain = {"quality": lambda x: plain_quality(x, rules), "near_dedup": plain_near_dedup,
             "decontaminate": lambda x: plain_decontaminate(x, items), "mixture": plain_mix}
    docs = spark.read.parquet(f"{d}/documents.parquet")
    key = lambda r: tuple((v is not None, v) for v in r)
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        given = docs.collect()
        docs = materialize(stage(spark, docs, d), f"plain_{name}")
        got = docs.collect()
        sizes.append(len(got))
        if name in plain:
            assert sorted(map(key, got)) == sorted(map(key, plain[name](given))), name
            assert name == "mixture" or len(got) < len(given)
    unit = lambda t: (hash64(("s", t or "")) % 2**64) >> 50
    size = lambda t: len((t or "").encode()) + 1
    assert sorted(key(r[:5]) for r in got) == sorted(key(r[:5]) for r in given)
    where, units, held = {}, Counter(), Counter()
    for r in got:
        assert where.setdefault(unit(r.text), r.shard) == r.shard
        units[unit(r.text)] += size(r.text)
        held[r.shard] += size(r.text)
    assert [where[u] for u in sorted(where)] == sorted(where.values())  # contiguous
    assert max(held.values()) == least_capacity([units[u] for u in sorted(units)], 16)
    assert not any(r.doc_id is not None and r.doc_id >= 1040 for r in got)  # bad ones without a label
    run = corpus_pipeline.run(spark, d).collect()
    assert sorted(map(key, run)) == sorted(map(key, got)) and sizes[0] < len(made)
