"""Exact, distributed group quantiles with linear interpolation.

Spark's exact `percentile` merges a value->count map of a whole group inside one
task, which does not survive a period holding a billion rows. Here a group is
never gathered whole. A mergeable sketch of each group (`percentile_approx`, whose error in
rank is bounded) brackets every wanted rank between two values; then rows are counted per
(group, value) inside the brackets and per gap between them outside, with map-side partial
sums. So a few thousandths of the rows are shuffled, and a value that half the rows share is one
row. Running counts over what is left (`ordered_prefix_sums`, in ordered buckets when a group is large)
give each value its range of ranks; and the value whose range holds a wanted
rank is picked by one aggregate. A rank outside its bracket would be an error of the sketch and raises.
An input of a proven small size goes without the sketch.

Interpolation is `lo + (hi - lo) * frac` with `h = (n - 1) * p`, the rule of
pandas' default and of SQL `quantile_cont` / `percentile_cont`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .prefix import _join_null_safe, limit_of, ordered_prefix_sums
from .util import broadcast_if_small, materialize, with_count_below

_G = "__qgrp"
_V = "__qval"
#: Share of a group's rows that a sketch may be off by, times 1 / ACCURACY, and the brackets' reach in that unit.
ACCURACY = 1000
REACH = 3
#: Rows of a group that is all bracket.
SMALL = 2 * ACCURACY


def bracketed_counts(vals: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Of `vals` (by columns, _V): by columns, _V, __cnt, __in: a row for each value in a bracket around a wanted
    rank, and for each gap between brackets one row, with its largest value and __in false."""
    ends = [(p - REACH / ACCURACY, p + REACH / ACCURACY) for p in probs]
    asked = sorted({x for pair in ends for x in pair if 0 < x < 1})
    keys = list(by) or [_G]
    rows = vals if by else vals.withColumn(_G, F.lit(0))
    sketch = F.percentile_approx(_V, asked, ACCURACY) if asked else F.array().cast("array<double>")
    found = rows.groupBy(*keys).agg(sketch.alias("__s"), F.count(F.lit(1)).alias("__n"))
    at = {x: F.element_at("__s", i) for i, x in enumerate(asked, start=1)}
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    few = F.col("__n") < SMALL  # its brackets would be narrower than a rank
    pairs = [(F.when(few, low).otherwise(at.get(a, low)), F.when(few, high).otherwise(at.get(b, high))) for a, b in ends]
    stats = materialize(found.select(*keys, F.sort_array(F.array(*[x for pair in pairs for x in pair])).alias("__edges"),
                                     F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in pairs]).alias("__pairs")))
    wide = _join_null_safe(rows, broadcast_if_small(stats, row_bytes=64 * len(probs) + 64), keys)
    wide = with_count_below(wide, "__edges", _V, "__gap", 2 * len(probs))
    inside = F.exists("__pairs", lambda x: (F.col(_V) >= x["a"]) & (F.col(_V) <= x["b"]))
    wide = wide.select(*by, _V, "__gap", inside.alias("__in"))
    own = F.when(F.col("__in"), F.col(_V))
    return wide.groupBy(*by, "__gap", "__in", own.alias("__own")).agg(F.count(F.lit(1)).alias("__cnt"), F.max(_V).alias(_V)).select(*by, _V, "__cnt", "__in")


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    direct_limit: int | None = None,
    size_bound: int | None = None,
) -> DataFrame:
    """One row per group: `by` columns, `n` (non-null values) and one column per prob.

    `size_bound`, when given, is a proven upper bound on the input's row count
    (so on every group); at or under `direct_limit` it spares the size check.

    NULL and NaN values are ignored, as pandas' `quantile` skips missing values.
    """
    probs = [float(p) for p in probs]
    if not probs or any(p < 0 or p > 1 for p in probs):
        raise ValueError(f"probabilities must be in [0, 1]: {probs}")
    names = list(names) if names is not None else [f"q{i}" for i in range(len(probs))]
    by = list(by)

    v = F.col(value) if isinstance(value, str) else value
    vals = df.select(*[F.col(b) for b in by], v.cast("double").alias(_V))
    vals = vals.where(F.col(_V).isNotNull() & ~F.isnan(F.col(_V)))
    if size_bound is not None and size_bound <= limit_of(direct_limit):
        counts = vals.groupBy(*by, _V).agg(F.count(F.lit(1)).alias("__cnt")).withColumn("__in", F.lit(True))
    else:
        counts = materialize(bracketed_counts(vals, by, probs))  # few rows, read by the size check and by the running counts
    ranked = ordered_prefix_sums(counts, by, _V, ["__cnt"], direct_limit, size_bound)

    n, before, upto = F.col("__cnt_total"), F.col("__cnt_before"), F.col("__cnt_before") + F.col("__cnt")
    aggs = [F.first(n).alias("n")]
    for i, p in enumerate(probs):
        h = (n - 1).cast("double") * F.lit(p)
        for side, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            value_of = F.when(F.col("__in"), F.col(_V)).otherwise(F.raise_error(F.lit("a wanted rank lies outside its bracket")).cast("double"))
            aggs.append(F.max(F.when((before <= rank) & (rank < upto), value_of)).alias(f"__{side}{i}"))
        aggs.append(F.first(h - F.floor(h)).alias(f"__f{i}"))
    keys = by if by else [F.lit(0).alias(_G)]
    picked = ranked.groupBy(*keys).agg(*aggs)
    return picked.select(
        *by, "n",
        *[(F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * F.col(f"__f{i}")).alias(name)
          for i, name in enumerate(names)],
    )
