"""Skew-safe ordered scans per key (lag / lead / last-non-null / row index /
running sum).

A plain ``Window.partitionBy(key)`` puts every row of a key in one task. One
user (a bot, a load test) can hold a third of all events, so a per-user window
would run in a single task over a third of the data. Instead every scan here
is two-level:

1. rows are split by ``(key, time bucket)`` and scanned locally with an
   ordinary window; a bucket is bounded by its time width, so a hot key is
   spread over as many tasks as it has buckets;
2. each ``(key, bucket)`` is reduced to one summary row (its last value,
   first value, row count, sum ...) by a partial aggregate;
3. a window over the summaries, per key and ordered by bucket, carries the
   value across bucket borders (one row per non-empty bucket: its size is the
   key's time span divided by the width, not its row count);
4. the carry is joined back on ``(key, bucket)``. The rows are already
   hash-partitioned on exactly those columns, so only the small summary side
   moves; chained scans on the same key reuse that partitioning.

The bucket column must be monotone in the scan order (it is derived from the
first order column, the event time).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bkt"


def add_time_bucket(df: DataFrame, ts_col: str, width_seconds: int,
                    name: str = BUCKET) -> DataFrame:
    """Bucket index = floor(epoch micros / width); monotone in time."""
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    return df.withColumn(name, F.floor(us / F.lit(int(width_seconds) * 1_000_000)))


def add_value_bucket(df: DataFrame, col: str, width: int, name: str = BUCKET) -> DataFrame:
    """Bucket a numeric order column (for scans not ordered by time)."""
    return df.withColumn(name, F.floor(F.col(col) / F.lit(int(width))))


ROWS_PER_RANGE = 1 << 20


def range_count(df: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> int:
    """Ranges for a global scan: as many as hold ``rows_per_range`` rows each, and
    at least one per core. One number comes to the driver."""
    rows = df.count()
    return max(1, min(rows, df.sparkSession.sparkContext.defaultParallelism), -(-rows // rows_per_range))


def add_range_bucket(df: DataFrame, order: list[str], n: int | None = None,
                     name: str = BUCKET) -> DataFrame:
    """Bucket for a scan with no key (a global order): range-partition by
    the order columns (Spark samples the bounds, so buckets are balanced
    even when one time range or value is hot) and use the partition id,
    which increases with the order.

    The sampled bounds depend on the exchange that computes them, and a scan
    reads its input in two branches (rows and summary) that Spark may not
    share. So the bucketed rows are written once to the shared checkpoint
    folder and read back; both branches then see the same buckets.
    ``n`` follows the rows (:func:`range_count`) unless given.
    """
    from ..session import materialize
    n = n or range_count(df)
    return materialize(df.repartitionByRange(n, *order).withColumn(name, F.spark_partition_id()),
                       "range_buckets")


@dataclass(frozen=True)
class Scan:
    """One scan output. ``kind`` is one of:

    ``lag``        value of the previous row of the key (null for the first)
    ``lead``       value of the next row of the key (null for the last)
    ``last_excl``  last non-null value strictly before the row
    ``last_incl``  last non-null value up to and including the row
    ``index``      0-based position of the row within its key
    ``sum_excl``   running sum of the value over earlier rows (0 for the first)
    ``sum_incl``   running sum including the row
    ``index_of_last``  0-based position (within the key) of the last row at
                   or before this one where the boolean ``value`` is true
    """
    kind: str
    value: str | Column | None
    out: str


def _v(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ordered_scan(df: DataFrame, keys: list[str], order: list[str], scans: list[Scan],
                 bucket: str = BUCKET) -> DataFrame:
    """Run several scans over rows of ``keys`` ordered by ``order``.

    ``df`` must already carry ``bucket`` (see :func:`add_time_bucket`). All
    scans share one local window, one summary aggregate, one summary window
    and one join.
    """
    columns = df.columns
    if keys:  # one struct stands for the keys: it equals itself also where they are null
        df = df.withColumn("_key", F.struct(*keys))
        keys = ["_key"]
    part = [*keys, bucket]
    w = Window.partitionBy(*part).orderBy(*order)
    w_all = Window.partitionBy(*part)
    sw = Window.partitionBy(*keys).orderBy(bucket)
    before = Window.unboundedPreceding
    ordkey = F.struct(*[F.col(c) for c in order])

    need_rn = any(s.kind in ("lag", "lead", "index", "index_of_last") for s in scans)
    need_before = any(s.kind in ("index", "index_of_last") for s in scans)
    need_cnt = any(s.kind == "lead" for s in scans)

    local = {}
    summ_aggs = []
    carry = {}
    for i, s in enumerate(scans):
        v = _v(s.value) if s.value is not None else None
        sv = f"_s{i}"
        if s.kind == "lag":
            local[s.out] = F.lag(v).over(w)
            summ_aggs.append(F.max_by(v, ordkey).alias(sv))
            carry[s.out] = F.lag(F.col(sv)).over(sw)
        elif s.kind == "lead":
            local[s.out] = F.lead(v).over(w)
            summ_aggs.append(F.min_by(v, ordkey).alias(sv))
            carry[s.out] = F.lead(F.col(sv)).over(sw)
        elif s.kind in ("last_excl", "last_incl"):
            hi = -1 if s.kind == "last_excl" else 0
            local[s.out] = F.last(v, ignorenulls=True).over(w.rowsBetween(before, hi))
            summ_aggs.append(F.max_by(v, F.when(v.isNotNull(), ordkey)).alias(sv))
            carry[s.out] = F.last(F.col(sv), ignorenulls=True).over(sw.rowsBetween(before, -1))
        elif s.kind == "index":
            local[s.out] = F.col("_rn") - 1
        elif s.kind == "index_of_last":
            pos = F.when(v, F.col("_rn") - 1)
            local[s.out] = F.last(pos, ignorenulls=True).over(w.rowsBetween(before, 0))
            summ_aggs.append(F.max(F.when(v, F.col("_rn") - 1)).alias(sv))
            carry[s.out] = F.last(F.col(sv) + F.col("_before"), ignorenulls=True) \
                .over(sw.rowsBetween(before, -1))
        elif s.kind in ("sum_excl", "sum_incl"):
            hi = -1 if s.kind == "sum_excl" else 0
            local[s.out] = F.sum(v).over(w.rowsBetween(before, hi))
            summ_aggs.append(F.sum(v).alias(sv))
            carry[s.out] = F.sum(F.col(sv)).over(sw.rowsBetween(before, -1))
        else:
            raise ValueError(f"unknown scan kind {s.kind!r}")

    extra = []
    if need_rn:
        extra.append(F.row_number().over(w).alias("_rn"))
    if need_cnt:
        extra.append(F.count(F.lit(1)).over(w_all).alias("_nb"))
    # row number first (same window spec: no extra shuffle or sort), so the
    # other local scans can use it
    loc = df.select("*", *extra) if extra else df
    loc = loc.select("*", *[c.alias(f"_l_{o}") for o, c in local.items()])

    # ``loc`` is already hash-partitioned on (keys, bucket): the summary
    # aggregate needs no shuffle, and its input exchange is reused
    summ = loc.groupBy(*part).agg(F.count(F.lit(1)).alias("_cnt"), *summ_aggs)
    if need_before:
        # rows of the key in earlier buckets (a window over the summary)
        summ = summ.withColumn("_before", F.coalesce(
            F.sum(F.col("_cnt")).over(sw.rowsBetween(before, -1)), F.lit(0)))
    summ = summ.select(
        *[F.col(k).alias(f"_k_{k}") for k in part],
        *([F.col("_before")] if need_before else []),
        *[c.alias(f"_c_{o}") for o, c in carry.items()])

    # plain equality of structs keeps the join on the rows' existing
    # partitioning and matches null keys
    cond = [loc[k] == summ[f"_k_{k}"] for k in part]
    j = loc.join(summ, cond, "left")

    outs = []
    for s in scans:
        lc, cc = F.col(f"_l_{s.out}"), F.col(f"_c_{s.out}")
        if s.kind == "lag":
            e = F.when(F.col("_rn") == 1, cc).otherwise(lc)
        elif s.kind == "lead":
            # the last row of a bucket takes the first value of the next one
            e = F.when(F.col("_rn") == F.col("_nb"), cc).otherwise(lc)
        elif s.kind in ("last_excl", "last_incl"):
            e = F.coalesce(lc, cc)
        elif s.kind == "index":
            e = lc + F.col("_before")
        elif s.kind == "index_of_last":
            e = F.coalesce(lc + F.col("_before"), cc)
        else:
            e = F.coalesce(lc, F.lit(0)) + F.coalesce(cc, F.lit(0))
        outs.append(e.alias(s.out))
    return j.select(*[F.col(c) for c in columns], *outs)

