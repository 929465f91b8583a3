"""Small plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when a count proved its size at or under this many bytes.
BROADCAST_BYTES = 128 << 20


def broadcast_if_small(df: DataFrame, known_rows: int | None = None, row_bytes: int = 256) -> DataFrame:
    """Hint a broadcast only after checking the row count; else leave it to a shuffle join.

    `df` should be small by construction (one row per period, per group, per request
    batch); the check is what makes that a proven bound instead of an assumption.
    `row_bytes` is what a row of `df` takes at most; `known_rows` is an already proven
    upper bound (e.g. a counted input), which spares the counting job.
    """
    limit = max(1, BROADCAST_BYTES // row_bytes)
    if known_rows is not None and known_rows <= limit:
        return F.broadcast(df)
    if df.limit(limit + 1).count() <= limit:
        return F.broadcast(df)
    return df


def materialize(df: DataFrame) -> DataFrame:
    """Write a small intermediate table to the shared checkpoint folder and read it back.

    Cuts the lineage (the plan above becomes a leaf), survives executor loss, and
    keeps nested plans from growing with every derived table. The folder is the
    cluster's `spark.checkpoint.dir`; only an unset one (local tests) gets a default.
    """
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_count_below(df: DataFrame, edges: str, value: str, out: str, max_edges: int) -> DataFrame:
    """`out` = number of entries of the ascending array `edges` that are < `value`.

    A binary search in log2(max_edges) plain comparisons, one projection per step
    (each step reads the previous position once), so it stays inside whole-stage
    codegen instead of scanning the array with a higher-order function. Short
    arrays (up to 16 edges) use one projection summing plain comparisons."""
    if max_edges <= 16:
        hits = [F.when(F.try_element_at(F.col(edges), F.lit(i)) < F.col(value), 1).otherwise(0)
                for i in range(1, max_edges + 1)]
        total = hits[0]
        for h in hits[1:]:
            total = total + h
        return df.withColumn(out, total)
    step = 1
    while step * 2 <= max_edges:
        step *= 2
    df = df.withColumn(out, F.lit(0))
    size = F.size(edges)
    while step >= 1:
        nxt = F.col(out) + F.lit(step)
        probe = F.try_element_at(F.col(edges), nxt)  # 1-based: the (pos + step)-th edge
        df = df.withColumn(out, F.when((nxt <= size) & (probe < F.col(value)), nxt).otherwise(F.col(out)))
        step //= 2
    return df


def require_columns(df: DataFrame, columns, what: str = "input") -> None:
    """Raise before any job runs when required columns are absent."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")


def round6(c) -> F.Column:
    """Half-up rounding to 6 decimals done in binary: `floor(x * 1e6 + 0.5) / 1e6`.

    Unlike `round`, whose tie handling differs between SQL engines, these are
    plain IEEE operations, so equal inputs give equal outputs everywhere.
    """
    c = F.col(c) if isinstance(c, str) else c
    return (F.floor(c.cast("double") * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6))
