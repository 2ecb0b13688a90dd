"""Filter interaction audit: what each filter removes, in every order.

Filters are boolean "fails" columns. Spark counts the documents of each part by
the set of filters they fail; from these counts it tabulates, for every coalition
of filters (32 for five), how many documents the coalition removes. Everything
else follows from that table:

* a step of an order removes v(before + filter) - v(before), a coalition difference;
* a filter's Shapley value is the solution of the constrained least squares problem
  min sum_S k(S) (v(S) - sum_{i in S} phi_i)^2 with sum phi = v(all), where
  k(S) = (n - 1) / (C(n,|S|) |S| (n - |S|)). Its normal equations are solved once, in
  rationals, for all unit games; as the solution is linear in v, the solved weights times
  n! are exact integers that Spark applies to the tables of all parts.

Rules: null text is the empty text, a null source the part ''. A row with a null id
counts, but neither fails "equal to a smaller id's text" nor makes another row fail it.
Rows that repeat count each; rows of one id and text are ties and do not fail each
other. Several labels of one id count once, if any of them is set. Documents without a
label count as neither good nor toxic. Texts are read whole and compared by two 64-bit
hashes and their length. Only the named columns are read, so others may have any name.
An empty table gives no part and so no row.
"""

from __future__ import annotations

import json
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import BLANK_REGEX, table

LETTERS = "ABCDE"
STEP = "array<struct<filter_order string, step int, f int, own int, before int, after int>>"


def shapley_weights(n: int) -> list[list[Fraction]]:
    """w[i][S]: phi_i = sum_S w[i][S] v(S), by the normal equations of the
    kernel-weighted, efficiency-constrained least squares problem, in rationals."""
    full = (1 << n) - 1
    if n == 1:
        return [[Fraction(-1), Fraction(1)]]
    kernel = {}
    for s in range(1, full):
        k = s.bit_count()
        kernel[s] = Fraction(n - 1, comb(n, k) * k * (n - k))
    # rows: A phi + mu 1 = b(v) and 1' phi = v(all) - v(none); b is linear in v
    size = n + 1
    rows = [[Fraction(0)] * size + [Fraction(0)] * (full + 1) for _ in range(size)]
    for i in range(n):
        for s, k in kernel.items():
            if s >> i & 1:
                for j in range(n):
                    rows[i][j] += k * (s >> j & 1)
                rows[i][size + s] += k
                rows[i][size] -= k  # v is taken relative to v(none)
        rows[i][n] = rows[n][i] = Fraction(1)
    rows[n][size + full], rows[n][size] = Fraction(1), Fraction(-1)
    for c in range(size):  # Gauss-Jordan elimination
        p = next(r for r in range(c, size) if rows[r][c])
        rows[c], rows[p] = rows[p], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(size):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c])]
    return [rows[i][size:] for i in range(n)]


def coalition_table(cells: DataFrame, n: int, measures: list[str]) -> DataFrame:
    """One row per part: for every measure an array with, per coalition S, how much
    S removes (rows failing any filter in S), and the part's totals.

    ``cells`` has part, mask (bit i: fails filter i) and the measures, already
    summed; each cell meets the 2^n coalitions as literals, not by a join."""
    sums = []
    for m in measures:
        removed = ", ".join(f"sum(if((mask & {s}) != 0, `{m}`, 0L))" for s in range(1 << n))
        sums.append(F.expr(f"array({removed})").alias(f"v_{m}"))
        sums.append(F.sum(m).alias(f"all_{m}"))
    return cells.groupBy("part").agg(*sums)


def audit(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """part, filter_order, step and the counts of every step of every order.

    ``cells``: part, mask, docs, good, toxic (long), at most 2^n rows a part and label."""
    n = len(letters)
    full, orders = (1 << n) - 1, factorial(n)
    weights = [[w * orders for w in row] for row in shapley_weights(n)]
    assert all(w.denominator == 1 for row in weights for w in row)
    v = coalition_table(cells, n, ["docs", "good", "toxic"])
    steps = []
    for order in permutations(range(n)):
        before = 0
        for k, f in enumerate(order):
            steps.append({"filter_order": "".join(letters[i] for i in order), "step": k + 1,
                          "f": f, "own": 1 << f, "before": before, "after": before | 1 << f})
            before |= 1 << f
    shapley = F.array(*[sum((F.col("v_docs")[s] * F.lit(int(w)) for s, w in enumerate(row) if w),
                            F.lit(0).cast("long")) for row in weights])
    rows = (v.withColumn("shapleys", shapley)
            .select("*", F.explode(F.from_json(F.lit(json.dumps(steps)), STEP)).alias("s")))

    def gained(m: str) -> Column:
        return F.get(F.col(f"v_{m}"), F.col("s.after")) - F.get(F.col(f"v_{m}"), F.col("s.before"))

    fails = F.get(F.col("v_docs"), F.col("s.own"))
    others = F.lit(full) - F.col("s.own")
    return rows.select(
        "part", "s.filter_order", "s.step",
        (F.col("all_docs") - F.get("v_docs", F.col("s.after"))).alias("kept"),
        gained("docs").alias("removed"),
        (fails - gained("docs")).alias("redundant"),
        (F.col("v_docs")[full] - F.get("v_docs", others)).alias("unique_fails"),
        gained("good").alias("good_lost"),
        gained("toxic").alias("toxic_lost"),
        F.get("shapleys", F.col("s.f")).alias("shapley"))


def text_filters(text: Column) -> list[Column]:
    """The failure conditions that a text alone decides (A to D)."""
    t = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(t, BLANK_REGEX, -1), "")
    n = F.size(words)
    return [n < 200,
            F.lit(100) * F.size(F.array_distinct(words)) < F.lit(50) * n,
            F.lit(100) * F.regexp_count(t, F.lit("[A-Z]")) > F.lit(2) * F.char_length(t),
            F.regexp_like(t, F.lit("[#$%&*|]"))]


def document_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "source") -> DataFrame:
    """part, mask, docs, good, toxic for filters A to E.

    Equal rows are counted together first, so a hot id or a hot text is a few
    narrow rows per task before any shuffle on it. A document fails E unless it has
    the least id of its text, so a text needs only its least id, and per part and
    label the number of rows that have it: sums, no list of a text's documents."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_filters(F.col(text_col)))), F.lit(0))
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                        mask.alias("mask"), F.xxhash64(text).alias("h1"),
                        F.xxhash64(F.lit(3), text, F.char_length(text)).alias("h2"))
            .groupBy("id", "part", "mask", "h1", "h2").agg(F.count("*").alias("n")))
    marks = (labels.select(F.col(id_col).alias("id"), (F.col("quality") == 1).alias("good"),
                           (F.col("toxic") == 1).alias("toxic"))
             .filter("id IS NOT NULL").groupBy("id")
             .agg(F.max(F.coalesce("good", F.lit(False))).alias("good"),
                  F.max(F.coalesce("toxic", F.lit(False))).alias("toxic")))
    rows = (rows.join(marks, "id", "left")
            .withColumn("good", F.coalesce("good", F.lit(False)))
            .withColumn("toxic", F.coalesce("toxic", F.lit(False))))
    by_text = rows.groupBy("h1", "h2", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0)).alias("n_id"),
        F.min("id").alias("lo"), F.min_by("n", "id").alias("at_lo"))
    # at most (parts x 4) rows a text from here on
    least = F.min("lo").over(Window.partitionBy("h1", "h2"))
    copies = F.col("n_id") - F.when(F.col("lo") == F.col("least"), F.col("at_lo")).otherwise(0)
    split = (by_text.withColumn("least", least).withColumn("copies", copies)
             .select("part", "good", "toxic", F.explode(F.array(
                 F.struct(F.col("mask"), (F.col("n") - F.col("copies")).alias("docs")),
                 F.struct(F.col("mask").bitwiseOR(16).alias("mask"), F.col("copies").alias("docs")))).alias("c"))
             .select("part", "c.mask", "c.docs", F.when(F.col("good"), F.col("c.docs")).otherwise(0).alias("good"),
                     F.when(F.col("toxic"), F.col("c.docs")).otherwise(0).alias("toxic")))
    return split.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("docs", "good", "toxic")])


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all 120 orders of the five filters, per source."""
    return audit(document_cells(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
