"""Line CRF, periodic runs and filter audit against brute force, on edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from fractions import Fraction
from math import factorial

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventide.llm import filteraudit, linecrf, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(r):
    return tuple((x is None, x) for x in r)


def same(df, expected):
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(expected, key=key)


# op11

def auc(score, good):
    order = score.argsort(kind="stable").argsort()
    return (order[good].mean() - (good.sum() - 1) / 2) / (~good).sum()


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    codes, lines, _ = linecrf.line_codes([b"Hello there.\nab ab ab\n\nX!! Y!!\nab ab ab", b"", b"one\ntwo"])
    m = linecrf.LineModel(rng.normal(size=(3, linecrf.N_BUCKETS + 1)), rng.normal(size=(2, 2)))
    got = m.good(codes, lines)
    u = m.scores(codes, *linecrf.edges(lines))
    at = 0
    for n in lines:
        total, norm = np.zeros(n), 0.0
        for ys in itertools.product([0, 1], repeat=int(n)):
            w = np.exp(sum(u[at + i] * y for i, y in enumerate(ys)) + sum(m.ties[a, b] for a, b in zip(ys, ys[1:])))
            norm, total = norm + w, total + w * np.array(ys)
        assert np.allclose(total / norm, got[at:at + n])
        at += n


def test_gradient_raises_likelihood():
    texts = [b"good words here.\nmore of them.", b"XX!! YY!!\nZZ!!", b"good again.", b"QQ!!\nfine words.\nRR!!"] * 5
    codes, lines, _ = linecrf.line_codes(texts)
    y = np.array([True, False, True, False] * 5)

    def loss(m):
        p = m.good(codes, lines)
        t = y[np.repeat(np.arange(len(lines)), lines)]
        return -np.log(np.where(t, p, 1 - p)).mean()
    assert loss(linecrf.fit(codes, lines, y, rounds=60)) < 0.1 < loss(linecrf.fit(codes, lines, y, rounds=1))


def test_line_statistics():
    codes, lines, weight = linecrf.line_codes(["ab ab  É% Q9!\n\n ab ab  É% Q9! ".encode(), b""])
    names = list(linecrf.CUTS)
    bucket = lambda l, name: int(codes[l, names.index(name)] - linecrf.OFFSETS[names.index(name)])
    cut = lambda name, x: int(np.searchsorted(np.asarray(linecrf.CUTS[name], float), x))
    assert list(lines) == [3, 1] and list(weight) == [14, 1, 16, 1]
    for line in (0, 2):
        for name, x in {"words": 4, "symbols_per_word": 1 / 4, "bangs_per_word": 1 / 4, "distinct_share": 3 / 4,
                        "twin_share": 1 / 4, "short_share": 2 / 4, "ends_sentence": 1, "copy_of_line": 1,
                        "edge": 1 if line == 0 else 2, "mean_word": 10 / 4, "longest_word": 3}.items():
            assert bucket(line, name) == cut(name, x), (line, name)
    assert bucket(1, "words") == 0 and bucket(3, "edge") == 3


def test_classifier_is_right_on_held_out_rows(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice(["an", "the", "or", "er", "ín"]) for _ in range(rnd.randint(1, 3)))
    line = lambda n: " ".join(word() for _ in range(n)) + "."
    rows, marks = [], []
    for i in range(300):
        lines = [line(rnd.randint(6, 20)) for _ in range(rnd.randint(1, 6))]
        if i % 3 == 0:
            lines = [lines[0]] + [" ".join(w.upper() + "!!" for w in x.split()) for x in lines]
        rows.append((i, "\n".join(lines), 0, "x"))
        marks.append((i, int(i % 3 != 0), 0))
    rows += [(None, None, 1, "y"), (7, "", 1, "y"), (8, "\n" * 3000, 2, "z"), rows[4]]
    marks += [(None, 1, 0), (5, None, 1), (999, 1, 1), marks[4]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, good string").repartition(3)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = linecrf.learn(docs, labels.filter(~linecrf.held_out(linecrf.F.col("doc_id"))))
    got = linecrf.score_lines(docs, model).select("_row.doc_id", "_row.text", "score", "n_lines", "good").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.n_lines == len(r.good) for r in got)
    assert {r.n_lines for r in got if r.text and not r.text.strip()} == {3001}
    test = [r for r in got if r.text and r.text.strip() and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(test) > 40
    assert auc(np.array([r.score for r in test]), np.array([r.doc_id % 3 != 0 for r in test])) > 0.99
    assert len({(r.score, r.text) for r in got if r.doc_id == 4}) == 1  # repeated rows


def test_no_labels_or_one_class(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert linecrf.learn(docs, none) is None
    assert linecrf.learn(docs, spark.createDataFrame([(i, 1, 0) for i in range(9)], none.schema)) is None
    assert {r.score for r in linecrf.score_lines(docs, None).collect()} == {0.5}
    assert linecrf.score_lines(empty, None).count() == 0


def test_registered_classifier(spark, tmp_path, docs, rows):
    d = str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(9, 60)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    got = linecrf.op11_quality_classifier(spark, d).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3)


# op12

def lyndon_by_definition(w):
    out = []
    for i in range(len(w)):
        prefixes = (w[i:j] for j in range(len(w), i, -1))
        out.append(next(len(u) for u in prefixes if all(u < u[k:] for k in range(1, len(u)))))
    return out


def runs_by_definition(w):
    found = {}
    for p in range(1, len(w) // 4 + 1):
        t = 0
        while t + p < len(w):
            s = t
            while t + p < len(w) and w[t] == w[t + p]:
                t += 1
            n = t - s + p
            if t > s and n >= max(6, 4 * p):
                found.setdefault((s, n), p)  # periods ascend: the smallest stays
            t += t == s
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=14))
def test_lyndon_array(w):
    rank = {c: i for i, c in enumerate(sorted(set(w)))}
    w = [rank[c] for c in w]
    assert runs.lyndon_array(w) == lyndon_by_definition(w)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 7), st.integers(0, 4)), max_size=6))
def test_runs(parts):
    w = []
    for unit, times, more in parts:
        w += unit * times + unit[:more]
    assert runs.word_runs(w) == runs_by_definition(w)


def test_long_runs_and_depth():
    w = [i % 7 for i in range(3000)] + [9] + [i % 501 for i in range(4000)]
    assert runs.word_runs(w) == runs_by_definition(w) != []
    w = list(itertools.chain.from_iterable([i] * 3 + [0] * 6 for i in range(1, 60)))
    assert runs.word_runs(w) == runs_by_definition(w)


def periodic_by_definition(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = runs_by_definition(words)
    best = min(found, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2],
            digest("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            digest(" ".join(w for i, w in enumerate(words) if i not in gone)), n)


def test_registered_runs(spark, tmp_path, rows):
    rnd = random.Random(8)
    more = [(i, " ".join(rnd.choice("ab") for _ in range(rnd.randint(1, 300))), "en", "s", 0, 0, "", "") for i in range(500, 620)]
    more += [(700 + i, "\t".join(["x y z"] * i + ["x"]), "en", "s", 0, 0, "", "") for i in range(9)]
    cols = "doc_id long, text string, lang string, source string, n_runs long, start int, runs string, _row string"
    spark.createDataFrame(rows + more, cols).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    same(runs.op12_periodic_runs(spark, str(tmp_path)), [periodic_by_definition(r[0], r[1]) for r in rows + more])


def test_find_runs_keeps_all_columns(spark, docs, empty):
    out = runs.find_runs(docs)
    assert out.select("_row.*").columns == docs.columns and out.count() == docs.count()
    assert runs.find_runs(empty).count() == 0
    with pytest.raises(ValueError):
        runs.word_runs(["a"] * 9, min_exponent=2)


# op13

def test_shapley_weights_are_the_permutation_average():
    for n in range(1, 6):
        w = filteraudit.shapley_weights(n)
        for i in range(n):
            for s in range(1 << n):
                k = (s & ~(1 << i)).bit_count()
                c = Fraction(factorial(k) * factorial(n - k - 1), factorial(n))
                assert w[i][s] == (c if s >> i & 1 else -c)


def audit_by_definition(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    docs = []
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > least[t]}
        docs.append((s or "", {x for x in fails if fails[x]}, i in good, i in toxic))
    out = []
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley, lines = {x: 0 for x in "ABCDE"}, []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for k, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                shapley[x] += len(gone)
                failing = sum(x in d[1] for d in mine)
                lines.append((part, "".join(order), k, len(left), len(gone), failing - len(gone),
                              sum(d[1] == {x} for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone), x))
        out += [(*line[:-1], shapley[line[-1]]) for line in lines]
    return out


def test_audit(spark, rows):
    rnd = random.Random(4)
    long = " ".join(f"w{rnd.randrange(900)}" for _ in range(260))
    some = [(r[0], r[1], r[3]) for r in rows]
    some += [(800, long, "s1"), (801, long, "s2"), (801, long, "s2"), (800, long, None), (802, long + " #", "s1"),
             (803, long.upper(), "s1"), (None, long, "s1"), (804, "a b " * 150, "s3"), (805, "É" * 20 + "AB", "")]
    marks = [(i, rnd.randint(0, 1), rnd.randint(0, 1)) for i in range(0, 60)] + [(800, 1, 0), (800, 0, 1), (801, 1, None), (None, 1, 1), (5, None, None)]
    docs = spark.createDataFrame(some, "doc_id long, text string, source string").withColumn("part", filteraudit.F.lit(1)).repartition(4)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    same(filteraudit.audit(filteraudit.document_cells(docs, labels)), audit_by_definition(some, marks))


def test_audit_of_nothing(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(filteraudit.document_cells(empty, labels)).count() == 0
    out = filteraudit.audit(filteraudit.document_cells(docs, labels)).collect()
    assert len(out) % 600 == 0 and not any(r.good_lost or r.toxic_lost for r in out)
