"""Weighted picks: prefix sums, range lookup, seeded draws.

A weighted list is a table ``(item, weight)``; its prefix sums give each item
the half-open range ``[lo, hi)`` on ``[0, total)``. A draw is a key in that
interval; the lookup is a range join done as an equi-join on a range bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import hint_if_small, materialize
from .segmented import BUCKET, Scan, add_range_bucket, add_value_bucket, ordered_scan


def prefix_ranges(items: DataFrame, weight_col: str, order_col: str,
                  keys: list[str] | None = None, bucket_width: int = 1 << 20) -> DataFrame:
    """``lo`` = exclusive running sum of weights, ``hi`` = lo + weight,
    in ``order_col`` order (per ``keys`` group when given).

    Two-level: running sums inside buckets, then bucket totals carried
    across; never one task over all rows. Without keys the buckets are
    sampled range partitions (balanced); per key they are ``order_col``
    ranges of ``bucket_width``.
    """
    if keys:
        d = add_value_bucket(items, order_col, bucket_width)
    else:
        d = add_range_bucket(items, [order_col])
    d = ordered_scan(d, keys or [], [order_col],
                     [Scan("sum_excl", F.col(weight_col).cast("long"), "lo")]).drop(BUCKET)
    return d.withColumn("hi", F.col("lo") + F.col(weight_col).cast("long"))


def total_weight(items: DataFrame, weight_col: str) -> Column:
    """the total weight as a scalar subquery (evaluated once)."""
    return items.agg(F.sum(F.col(weight_col).cast("long"))).scalar()


def seeded_key(key: Column, total: Column, seed: int = 0) -> Column:
    """H4: deterministic draw on [0, total) from a key (no ``rand()``, so a
    retried task draws the same value). Spark chains column hashes, so this
    is XXH64 of the seed value seeded with XXH64 of the key."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), total)


def range_lookup(keys: DataFrame, k_col: str, ranges: DataFrame,
                 width: Column | int | str, group: list[str] | None = None) -> DataFrame:
    """Join each key ``k`` to the range with ``lo <= k < hi``.

    Both sides get a bucket ``floor(x / width)``; a range is copied into each
    bucket it overlaps (at most ``weight / width + 2``). The join is then an
    equi-join on (group, bucket) plus the range filter. ``width`` is a
    number, a scalar column, or the name of a per-group column present on
    both sides. The copied side is never broadcast (its size after the copy
    is not known from the files): the join is hinted sort-merge, and AQE's
    skew join splits a hot bucket.
    """
    group = group or []
    if isinstance(width, int):
        w_r = w_k = F.lit(width)
    elif isinstance(width, str):
        w_r = w_k = F.col(width)
    else:
        w_r = w_k = width
    r = ranges.where(F.col("hi") > F.col("lo")).withColumn(
        "_b", F.explode(F.sequence(F.floor(F.col("lo") / w_r).cast("long"),
                                   F.floor((F.col("hi") - 1) / w_r).cast("long"))))
    k = keys.withColumn("_b", F.floor(F.col(k_col) / w_k).cast("long"))
    on = [*group, "_b"]
    if isinstance(width, str):
        r = r.drop(width)
    j = k.join(r.hint("merge"), on, "inner") \
        .where((F.col(k_col) >= F.col("lo")) & (F.col(k_col) < F.col("hi")))
    return j.drop("_b")


def weighted_pick(keys: DataFrame, k_col: str, items: DataFrame, item_col: str,
                  weight_col: str, order_col: str | None = None) -> DataFrame:
    """G3 + E6: for each key row, the item whose range holds ``k``.
    The bucket width is total / number of items, so the copied ranges stay
    within about three times the item count."""
    ranges = prefix_ranges(items, weight_col, order_col or item_col)
    n = items.agg(F.count(F.lit(1))).scalar()
    width = F.greatest(F.lit(1).cast("long"),
                       F.ceil(total_weight(items, weight_col) / n).cast("long"))
    return range_lookup(keys, k_col, ranges, width)


# a list of up to this many ranges is compared whole with each request on its item; at some
# nanoseconds a range this is cheaper than moving the request once more
SHORT_LIST = 128


def next_items(requests: DataFrame, item_col: str, k_expr, similar: DataFrame,
               all_items: DataFrame, weight_col: str = "weight",
               order_col: str = "order_key", out: str = "next_item",
               bucket_width: int = 1 << 20, short_list: int = SHORT_LIST) -> DataFrame:
    """H5: for each request on ``item_col``, draw the next item from that
    item's weighted similar list when it has one, else from all items.

    ``similar``: (item, similar item as ``out``, weight, order_key).
    ``all_items``: (``out``, weight, order_key). ``k_expr(total)`` maps a
    request row and a total weight to a draw on [0, total), without ``rand()``.

    Lists of up to ``short_list`` rows get their ranges from one window and are
    written; a request meets them in one join on the item, of two plain tables,
    so AQE can split an item that is asked for often. Longer lists are bucketed
    range joins; their ranges come from a two-level prefix sum keyed by item, so
    a hot item is split by its order buckets. So is the lookup in all items.
    """
    weight = F.col(weight_col).cast("long")
    # a bucket width per item (its total over its list length) keeps the
    # copied ranges within about three times the list length
    totals = materialize(similar.groupBy(item_col).agg(
        F.sum(weight).alias("_tot"), F.count(F.lit(1)).alias("_n")), "list_totals")
    long_lists = hint_if_small(totals.where(F.col("_n") > short_list).select(
        item_col, "_tot", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("_tot") / F.col("_n")).cast("long")).alias("_w")))

    w = Window.partitionBy(item_col).orderBy(order_col)
    up, down = Window.unboundedPreceding, Window.unboundedFollowing
    short = similar.join(long_lists, item_col, "left_anti").select(
        F.col(item_col).alias("_item"), F.col(out).alias("_out"), weight.alias("_weight"),
        F.coalesce(F.sum(weight).over(w.rowsBetween(up, -1)), F.lit(0).cast("long")).alias("_lo"),
        F.sum(weight).over(w.rowsBetween(up, down)).alias("_tot"))
    short = materialize(short.where(F.col("_weight") > 0).select(
        "_item", "_out", "_lo", (F.col("_lo") + F.col("_weight")).alias("_hi"), "_tot"), "short_lists")
    k = k_expr(F.col("_tot"))
    first = requests.join(short, (F.col(item_col) == F.col("_item")) & (k >= F.col("_lo")) & (k < F.col("_hi")), "left")
    # the ranges of an item do not overlap: one row for each request
    first = materialize(first.select(*requests.columns, F.col("_out").alias(out),
                                     F.col("_item").isNotNull().alias("_hit")), "short_picks")
    req = first.where(~F.col("_hit")).select(*requests.columns)

    sim = prefix_ranges(similar.join(long_lists.select(item_col), item_col, "left_semi"),
                        weight_col, order_col, keys=[item_col], bucket_width=bucket_width)
    sim = sim.join(long_lists.select(item_col, "_w"), item_col)
    with_sim = req.join(long_lists, item_col).where(F.col("_tot").isNotNull()).withColumn("_k", k_expr(F.col("_tot")))
    hit = range_lookup(with_sim, "_k", sim.select(item_col, out, "lo", "hi", "_w"), "_w",
                       group=[item_col])
    glob = prefix_ranges(all_items, weight_col, order_col, bucket_width=bucket_width)
    total = total_weight(all_items, weight_col)
    n = all_items.agg(F.count(F.lit(1))).scalar()
    width = F.greatest(F.lit(1).cast("long"), F.ceil(total / n).cast("long"))
    rest = req.join(totals.where(F.col("_tot").isNotNull()), item_col, "left_anti").withColumn("_k", k_expr(total))
    miss = range_lookup(rest, "_k", glob.select(out, "lo", "hi"), width)
    cols = [*requests.columns, out]
    return first.where("_hit").select(*cols).unionByName(hit.select(*cols)).unionByName(miss.select(*cols))
