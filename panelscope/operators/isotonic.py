"""Isotonic regression of a 0/1 label without gathering the scores (M7).

The fit is the slope of the greatest convex minorant of the running label sums, i.e. what
pooling adjacent violators gives. Pooling may be done in any order of neighbours, so
each range of scores is pooled by itself, then ranges are pooled in pairs until one
is left. Scores are first counted per distinct value, and a range hands on only its pools: of n
scores with 0/1 labels these are few (some n ** (1/3) where scores and labels are
noisy), which is also the size of the curve. Counts are integers and
pools are compared by cross products, so the curve is exact and reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import once
from .util import materialize

POOLS = "part int, lo double, hi double, n long, positives long"


@dataclass
class IsotonicCurve:
    """Scores ascending and the value at each; linear in between, constant beyond the ends."""

    boundaries: list[float]
    predictions: list[float]

    def transform(self, df: DataFrame, score: str, out: str) -> DataFrame:
        return df.withColumn(out, self.value_at(F.col(score)))

    def value_at(self, score: Column) -> Column:
        """The curve at `score`, a binary search in one expression of fixed size: a filter on the result that Spark moves below
        it copies this expression, where a projection for each step would be copied into the next and double."""
        n = len(self.boundaries)
        xs, ys = F.lit(self.boundaries), F.lit(self.predictions)
        steps = F.lit([1 << k for k in reversed(range(n.bit_length()))])

        def at(v: Column) -> Column:
            below = F.aggregate(steps, F.lit(0), lambda i, step: F.when((i + step <= n) & (F.get(xs, i + step - 1) < v), i + step).otherwise(i))
            return once(below, lambda i: between(v, i))

        def between(v: Column, i: Column) -> Column:
            x0, x1, y0, y1 = F.get(xs, i - 1), F.get(xs, i), F.get(ys, i - 1), F.get(ys, i)
            inside = F.when(v == x1, y1).otherwise(y0 + (y1 - y0) * (v - x0) / (x1 - x0))
            return F.when(i == 0, F.lit(self.predictions[0])).when(i == n, F.lit(self.predictions[-1])).otherwise(inside)

        return once(score.cast("double"), lambda v: F.when(v.isNotNull(), at(v)))


def pooled(rows: Iterator[tuple[float, float, int, int]]) -> list[tuple[float, float, int, int]]:
    """Adjacent violators of (lo, hi, n, positives) in order of lo, pooled: shares rise strictly from pool to pool."""
    held: list[tuple[float, float, int, int]] = []
    for lo, hi, n, k in rows:
        while held and held[-1][3] * n >= k * held[-1][2]:
            lo, _, m, j = held.pop()
            n, k = n + m, k + j
        held.append((lo, hi, n, k))
    return held


def _pools(part: int, held: list[tuple[float, float, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*held, strict=True)) or [[]] * 4
    kinds = (pa.float64(), pa.float64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([part] * len(held), pa.int32()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                                      names=["part", "lo", "hi", "n", "positives"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _range_pools(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over (lo, hi, n, positives), one ordered range a task: its pools."""
    yield _pools(TaskContext.get().partitionId(), pooled(_rows(batches)))


def _pair_pools(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over (part, lo, hi, n, positives) sorted by part and lo: the pools of each part."""
    held: list[tuple] = []
    last = None
    for part, *row in _rows(batches):
        if part != last and held:
            yield _pools(last, pooled(iter(held)))
            held = []
        held.append(tuple(row))
        last = part
    if held:
        yield _pools(last, pooled(iter(held)))


def isotonic_pools(scored: DataFrame, score: str, label: str = "y") -> DataFrame:
    """lo, hi, n, positives of each pool; rows without a score or label are left out."""
    rows = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = rows.groupBy(F.col(score).cast("double").alias("lo")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("positives"))
    ranged = counts.select("lo", F.col("lo").alias("hi"), "n", "positives").repartitionByRange("lo").sortWithinPartitions("lo")
    pools = materialize(ranged.mapInArrow(_range_pools, POOLS))
    while (parts := pools.agg(F.count_distinct("part")).first()[0]) > 1:
        # the parts' numbers rise with the scores; a number without pools leaves no gap in their order
        ends = [r[0] for r in pools.select("part").distinct().orderBy("part").collect()]  # as many as ranges
        pair = F.element_at(F.create_map(*(F.lit(x) for i, p in enumerate(ends) for x in (p, i // 2))), F.col("part"))
        merged = pools.withColumn("part", pair).repartition(max(1, parts // 2), "part").sortWithinPartitions("part", "lo")
        pools = materialize(merged.mapInArrow(_pair_pools, POOLS))
    return pools.drop("part")


def fit_isotonic(scored: DataFrame, score: str, label: str = "y") -> IsotonicCurve:
    """The curve through both ends of every pool."""
    xs: list[float] = []
    ys: list[float] = []
    for lo, hi, n, k in isotonic_pools(scored, score, label).orderBy("lo").collect():  # the curve itself
        for x in (lo, hi) if hi > lo else (lo,):
            xs.append(float(x))
            ys.append(k / n)
    if not xs:
        raise ValueError("cannot fit a curve without scored, labelled rows")
    return IsotonicCurve(xs, ys)
