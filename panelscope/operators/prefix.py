"""Running sums over a group's ordered values without gathering the group in one task.

Callers aggregate to one row per (group, value) first, so a value that half the
rows share is one row here. A group with more than `direct_limit` values is cut
into ordered buckets at sketch edges (`percentile_approx`); bucket totals get a
running sum over the buckets of a group, and rows one inside their bucket only.
The number of buckets follows from the largest group. Smaller groups are one
bucket, ranked in one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import broadcast_if_small, materialize, with_count_below

SKETCH_ACCURACY = 20000
#: Largest group that is sorted in one task; an argument of every operator that uses it.
DIRECT_LIMIT = 1_000_000
#: Values that a bucket should hold, and the most buckets a group is cut into.
BUCKET_ROWS = 250_000
MOST_BUCKETS = 4096

_G = "__pgrp"
_B = "__bucket"


def limit_of(direct_limit: int | None) -> int:
    return DIRECT_LIMIT if direct_limit is None else direct_limit


def max_group_size(df: DataFrame, keys: list[str]) -> int:
    """Largest group's row count: one small aggregate, decides the plan shape."""
    m = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return int(m or 0)


def _join_null_safe(rows: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on `keys`, where a NULL key is a value of its own, as in a window."""
    side = side.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return rows.join(side, on).drop(*[f"__r_{k}" for k in keys])


def ordered_prefix_sums(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Sequence[str],
    direct_limit: int | None = None,
    size_bound: int | None = None,
) -> DataFrame:
    """Adds `{c}_before` (strictly earlier in `order`) and `{c}_total` per group for each c.

    `size_bound`, when given, is a proven upper bound of every group's row count; at
    or under `direct_limit` it spares the size check."""
    by = list(by)
    keys = by if by else [_G]
    rows = df if by else df.withColumn(_G, F.lit(0))
    direct_limit = limit_of(direct_limit)
    largest = size_bound if size_bound is not None and size_bound <= direct_limit else max_group_size(rows, keys)
    if largest <= direct_limit:
        # Every group fits one task: a single running-sum window (lazy, one shuffle).
        w = Window.partitionBy(*keys)
        wo = w.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        out = rows.select(
            *rows.columns,
            *[F.sum(c).over(w).alias(f"{c}_total") for c in sums],
            *[F.coalesce(F.sum(c).over(wo), F.lit(0)).alias(f"{c}_before") for c in sums],
        )
        return out.drop(_G) if not by else out
    buckets = min(MOST_BUCKETS, max(8, -(-largest // max(1, min(BUCKET_ROWS, direct_limit)))))
    edges_p = [i / buckets for i in range(1, buckets)]
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(c).alias(f"{c}_total") for c in sums],
        F.percentile_approx(order, edges_p, max(SKETCH_ACCURACY, 10 * buckets)).alias("__edges"),
    )
    if by:
        stats = broadcast_if_small(materialize(stats), row_bytes=8 * buckets + 64)
        rows = _join_null_safe(rows, stats, keys)
        # Groups that fit one task stay one bucket (no edges to search).
        rows = rows.withColumn("__edges", F.when(F.col("__n") > direct_limit, F.col("__edges")).otherwise(
            F.array().cast("array<double>")))
    else:
        # One global group: its single stats row is inlined as literals (no join at all).
        st = stats.first()
        rows = rows.select(
            "*", F.lit(st["__n"]).alias("__n"), *[F.lit(st[f"{c}_total"]).alias(f"{c}_total") for c in sums],
            F.array(*[F.lit(float(e)) for e in st["__edges"]]).alias("__edges"),
        )
    rows = with_count_below(rows, "__edges", order, _B, buckets - 1).drop("__edges")
    btot = rows.groupBy(*keys, _B).agg(*[F.sum(c).alias(f"__bt_{c}") for c in sums])
    wb = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    boff = btot.select(*keys, _B, *[F.coalesce(F.sum(f"__bt_{c}").over(wb), F.lit(0)).alias(f"__bo_{c}") for c in sums])
    wl = Window.partitionBy(*keys, _B).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = _join_null_safe(rows, boff, [*keys, _B]).select(
        *rows.columns,
        *[(F.col(f"__bo_{c}") + F.coalesce(F.sum(c).over(wl), F.lit(0))).alias(f"{c}_before") for c in sums],
    )
    out = out.drop(_B, "__n")
    return out.drop(_G) if not by else out
