"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words (weighted water-filling, at most ``max_repeat``
times its own words). With f = target / own words, each document is taken
floor(f) times for certain. The remaining words R of the source are drawn as
an unequal-probability sample without replacement: a document of size s has
the inclusion probability p = min(1, theta * s) with theta solving
sum(p * s) = R, and its rank is Q = (u / (1 - u)) / (p / (1 - p)) for a uniform
u hashed from the row (Rosen's Pareto order sampling). Documents enter in rank
order until the drawn words are nearest to R, so the sample has a fixed size in
words and a source misses its target by at most half a document. Documents
with p = 1 are certain whole copies and enter first.

Nothing is sorted per source: ranks are counted in (source, rank bin) sums, a
window over those finds the bin where R is reached, and only the rows of that
one bin are ordered. Rows of one source never meet in one task.

Equal rows (same id, text and source) are counted first and then numbered, and the
number is hashed too, so each has a draw of its own; which of them are taken does not
matter, as they are equal.

Rules: null text has size 0, null source is a source of its own (last); rows of
size 0 are kept floor(f) times; equal ranks are ordered by the hash of the row and its
number; very long texts are counted whole, and one may be most of a source, which then misses
its target by up to half of it; an empty table gives an empty result; reruns agree (no random
numbers). Columns of the input are packed in a struct, so none clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import WORD_REGEX, broadcast_within, repeated, table
from eventide.session import materialize

RANK_BINS = 4096  # at least; one more for every ROWS_PER_BIN rows
ROWS_PER_BIN = 1024
MAX_SOURCES_BROADCAST = 100_000


def word_count(text: Column) -> Column:
    """Words of a text: starts of runs of non-blank characters."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_REGEX)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3),
                   max_repeat: int = 3) -> DataFrame:
    """source, source_size, target. ``sizes`` has (source, size).

    Targets share the total of all sizes by weight; a source stops at
    ``max_repeat`` times its size and the excess is shared among the others
    again. That fixed point is water-filling: in order of size / weight the
    sources that stop are a prefix."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights)) + 1)
    per = per.withColumn("w", w).withColumn("most", F.col("source_size") * F.lit(float(max_repeat)))
    by_level = Window.orderBy((F.col("most") / F.col("w")), F.col("source").asc_nulls_last())
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding,
                                                          Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
             / F.sum("w").over(rest))
    lev = per.withColumn("level", level)
    free = F.col("level") <= F.col("most") / F.col("w")
    # the first source that does not stop fixes the level of all later ones
    lev = lev.withColumn("t", F.first(F.when(free, F.col("level")), ignorenulls=True)
                         .over(by_level.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.when(F.col("t").isNull(), F.col("most")).otherwise(F.least(F.col("most"), F.col("t") * F.col("w")))
    return lev.select("source", "source_size", target.alias("target"))


def _uniform(h: Column) -> Column:
    """A number strictly between 0 and 1 from 52 bits of a hash."""
    return (F.shiftrightunsigned(h, 12).cast("double") + 0.5) / F.lit(float(1 << 52))


def sampling_plan(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per source: source, source_size, target, whole, theta, q_max, h_max.

    A row is drawn once more if (q, h) <= (q_max, h_max) in that order."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = (targets.withColumn("whole", F.floor(ratio + 1e-12).cast("int"))
            .withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))))
    # theta from the distinct sizes of a source, largest first
    hist = rows.groupBy("source", "size").agg(F.count("*").alias("c"))
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    s = F.col("size").cast("double")
    hist = hist.select(
        "source", "size",
        F.coalesce(F.sum(s * F.col("c")).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("above"),
        F.sum(s * s * F.col("c")).over(down.rowsBetween(0, Window.unboundedFollowing)).alias("sq"))
    th = (hist.join(plan.select(F.col("source").alias("s2"), "rest"), F.col("source").eqNullSafe(F.col("s2")))
          .filter((F.col("size") > 0) & (F.col("rest") > F.col("above")))
          .withColumn("th", (F.col("rest") - F.col("above")) / F.col("sq"))
          .filter(F.col("th") * F.col("size") <= 1)
          .groupBy("source").agg(F.max_by("th", "size").alias("th")))
    plan = (plan.join(th.select(F.col("source").alias("s3"), "th"), F.col("source").eqNullSafe(F.col("s3")), "left")
            .select("source", "source_size", "target", "whole", "rest", F.col("th").alias("theta")))
    plan = materialize(plan, "mix_theta")
    ranked = with_rank(rows, plan, max(RANK_BINS, rows.count() // ROWS_PER_BIN)).filter(F.col("rest") > 0)
    bins = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"))
    up = Window.partitionBy("source").orderBy("bin")
    bins = bins.withColumn("upto", F.sum("words").over(up))
    rest = plan.select(F.col("source").alias("s4"), F.col("rest").alias("r4"))
    crossing = (bins.join(rest, F.col("source").eqNullSafe(F.col("s4")))
                .filter((F.col("upto") >= F.col("r4")) & (F.col("upto") - F.col("words") < F.col("r4")))
                .select("s4", F.col("bin").alias("b4"), (F.col("upto") - F.col("words")).alias("under"), "r4"))
    crossing = materialize(crossing, "mix_bins")
    close = ranked.join(broadcast_within(crossing, MAX_SOURCES_BROADCAST),
                        F.col("source").eqNullSafe(F.col("s4")) & (F.col("bin") == F.col("b4")))
    tied = close.groupBy("source", "q", "h").agg(F.sum("size").alias("words"), F.first("under").alias("under"),
                                                 F.first("r4").alias("r4"))
    run = Window.partitionBy("source").orderBy("q", "h")
    tied = tied.withColumn("upto", F.col("under") + F.sum("words").over(run))
    # in as long as half of it still fits: the nearest sum to the rest
    drawn = tied.filter(F.col("upto") - F.col("words") / 2 <= F.col("r4"))
    last = drawn.groupBy("source").agg(F.max(F.struct("q", "h")).alias("last"))
    first = close.groupBy("source").agg(F.min(F.struct("q", "h")).alias("first"))
    edge = (first.join(last.withColumnRenamed("source", "s5"), F.col("source").eqNullSafe(F.col("s5")), "left")
            .select(F.col("source").alias("s6"), F.col("last")["q"].alias("ql"), F.col("last")["h"].alias("hl"),
                    F.col("first")["q"].alias("qf"), F.col("first")["h"].alias("hf")))
    out = plan.join(edge, F.col("source").eqNullSafe(F.col("s6")), "left")
    # nothing of the crossing bin fits: stop just before its first row
    return materialize(out.select(
        "source", "source_size", "target", "whole", "rest", "theta",
        F.coalesce("ql", "qf").alias("q_max"),
        F.coalesce("hl", F.when(F.col("hf").isNotNull(), F.lit(None).cast("long"))).alias("h_max")), "mix_plan")


def with_rank(rows: DataFrame, plan: DataFrame, bins: int = RANK_BINS) -> DataFrame:
    """Join the per-source plan and add q (Pareto rank), bin of q."""
    p = plan.withColumnRenamed("source", "plan_source")
    joined = rows.join(broadcast_within(p, MAX_SOURCES_BROADCAST),
                       F.col("source").eqNullSafe(F.col("plan_source")), "left").drop("plan_source")
    odds_u = F.col("u") / (1 - F.col("u"))
    prob = F.col("theta") * F.col("size")
    # p >= 1 is certain (rank 0); no theta means that every sized row is certain
    q = (F.when(F.col("size") == 0, F.lit(float("inf")))
         .when(prob.isNull() | (prob >= 1), F.lit(0.0))
         .otherwise(odds_u * (1 - prob) / prob))
    joined = joined.withColumn("q", q)
    return joined.withColumn("bin", F.when(F.col("q") == float("inf"), F.lit(bins))
                             .otherwise(F.floor(F.col("q") / (1 + F.col("q")) * bins)).cast("int"))


def copies() -> Column:
    """Times a row of ``with_rank`` is taken."""
    q, h = F.col("q"), F.col("h")
    more = (F.col("rest") > 0) & (F.col("size") > 0) & (
        F.col("q_max").isNull() | (q < F.col("q_max")) | ((q == F.col("q_max")) & (h <= F.col("h_max"))))
    return F.col("whole") + F.when(more, F.lit(1)).otherwise(F.lit(0))


def _identity(id_col: str, text_col: str, source_col: str, seed: int) -> list[Column]:
    """source, size and two hashes that stand for a row."""
    key = [F.col(id_col), F.col(text_col), F.col(source_col)]
    return [F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
            F.xxhash64(F.lit(seed), *key[:2]).alias("g1"), F.xxhash64(F.lit(seed + 1), *reversed(key)).alias("g2")]


def _numbered(groups: DataFrame) -> DataFrame:
    """One row per document: equal ones numbered, each with a hash and a draw of its own."""
    rows = repeated(groups, F.col("n"), "i")
    rows = rows.withColumn("h", F.when(F.col("i") == 0, F.col("g1")).otherwise(F.xxhash64("g1", "g2", "i")))
    return materialize(rows.withColumn("u", _uniform(F.col("h"))), "mix_rows")


def mix_counts(docs: DataFrame, weights=(1, 2, 3), max_repeat: int = 3, seed: int = 11,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken (words taken, repeats counted)."""
    found = docs.select(F.col(id_col).alias("doc_id"), *_identity(id_col, text_col, source_col, seed))
    rows = _numbered(found.groupBy(*found.columns).agg(F.count("*").alias("n")))
    plan = sampling_plan(rows, source_targets(rows, weights, max_repeat))
    return with_rank(rows, plan).select("doc_id", "size", "source_size", "target",
                                        (copies() * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame, weights=(1, 2, 3), max_repeat: int = 3, seed: int = 11,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it.

    Only narrow rows are shuffled, and the texts of rows that have an equal one (of
    which one stands for all); the other texts are decided in place."""
    who = _identity(id_col, text_col, source_col, seed)
    found = docs.select(*who)
    groups = materialize(found.groupBy(*found.columns).agg(F.count("*").alias("n")), "mix_groups")
    rows = _numbered(groups)
    plan = sampling_plan(rows, source_targets(rows, weights, max_repeat))
    several = materialize(with_rank(rows.filter("n > 1"), plan).groupBy("g1", "g2").agg(
        F.sum(copies()).cast("long").alias("_mix_n")), "mix_several")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_mix_row")
    packed = docs.select(row, *who)
    alone, twins = packed, None
    if several.count():
        keys = broadcast_within(several, MAX_SOURCES_BROADCAST)
        alone = packed.join(keys.select("g1", "g2"), ["g1", "g2"], "left_anti")
        twins = (packed.join(keys.select("g1", "g2"), ["g1", "g2"], "left_semi").groupBy("g1", "g2")
                 .agg(F.first("_mix_row").alias("_mix_row")).join(keys, ["g1", "g2"]).select("_mix_row", "_mix_n"))
    alone = with_rank(alone.withColumn("h", F.col("g1")).withColumn("u", _uniform(F.col("g1"))), plan)
    out = alone.select("_mix_row", copies().cast("long").alias("_mix_n"))
    out = (out.filter(F.col("_mix_n") > 0)
           .select("_mix_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix_n"))).alias("_mix_i")).select("_mix_row"))
    if twins is not None:
        out = out.unionByName(repeated(twins, F.col("_mix_n"), "_mix_i").select("_mix_row"))
    return out.select("_mix_row.*")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 1, 2, 3, ... at 100% of all words."""
    return mix_counts(table(spark, sf_dir, "documents"))
