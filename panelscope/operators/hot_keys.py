"""Joins to a table of one row per key, when a few keys may hold most of the rows.

A hash join sends all rows of a key to one task. Here the keys that hold more than one
part in SHARES of the rows, SHARES at most by that very rule, are joined by broadcast where
their rows lie; only the others are shuffled. NULL is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import limit_of

SHARES = 1000


def _on(keys: Sequence[str]):
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return on


def left_join_null_safe(rows: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`rows` with the other columns of `side`; every row stays."""
    joined = rows.alias("l").join(side.alias("r"), _on(keys), "left")
    return joined.select("l.*", *[F.col(f"r.`{c}`") for c in side.columns if c not in keys])


def heaviest(side: DataFrame, weight: str) -> tuple[int, int]:
    """Sum and largest of the weights."""
    total, most = side.agg(F.sum(weight), F.max(weight)).first()
    return total or 0, most or 0


def split_join(rows: DataFrame, side: DataFrame, keys: Sequence[str], weight: str, size_bound: int | None = None,
               weights: tuple[int, int] | None = None, shares: int = SHARES, direct_limit: int | None = None) -> DataFrame:
    """`rows` left-joined to `side`, which has one row per key, by NULL-safe keys.

    `weight`, a column of `side` that the result does not keep, counts the rows of each key. `rows` and `side` are read twice
    when a key is heavy. `size_bound`, a proven bound on the rows, spares the check when it is small; `weights` are `heaviest()`, if known."""
    plain = side.drop(weight)
    if size_bound is not None and size_bound <= limit_of(direct_limit):
        return left_join_null_safe(rows, plain, keys)
    total, most = weights or heaviest(side, weight)
    if not total or most * shares <= total:
        return left_join_null_safe(rows, plain, keys)
    is_heavy = F.col(weight) * shares > F.lit(total)
    heavy = F.broadcast(side.where(is_heavy).drop(weight))  # fewer than `shares` rows: each holds more than total / shares
    hot = rows.alias("l").join(heavy.alias("r"), _on(keys), "inner").select("l.*", *[F.col(f"r.`{c}`") for c in plain.columns if c not in keys])
    rest = rows.alias("l").join(heavy.alias("r"), _on(keys), "left_anti")
    return hot.unionByName(left_join_null_safe(rest, side.where(~is_heavy).drop(weight), keys))
