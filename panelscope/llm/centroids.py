"""Exact Lloyd clustering with ns-bounds.

Vectors become integers, floor(256 x) of each component, so distances, sums and centroids are
exact and reruns agree. All centroids that ever were are kept (rounds x clusters, a
bounded history). Every vector keeps, for every centroid, the distance when it
was last computed and the round of that. As a centroid moves on, that distance
is loosened by the norm of the centroid's whole displacement since then, not by the sum
of its steps: the triangle inequality gives a lower bound either way, and the
norm of the sum is never the larger. A centroid whose lower bound is above the
vector's distance to its nearest one so far is passed over; each that fails the test is rescanned exactly, which
renews its bound. Bounds are rounded down and displacements up, so a centroid
at an equal distance is always rescanned and ties go to the smaller number.

A round is one pass over the state table in the shared folder, which it replaces. Sums are made in
each task first, a row for each cluster, so no cluster is gathered anywhere; what is
collected is a row for each cluster.

Edge cases: rows whose vector is null, has another length than `width` or a null, NaN or infinite
component are left out. Fewer kept vectors than clusters give so many
clusters; none give an empty result. A null vec_id is kept, but comes last among the seeds. Repeated rows count
each. Of equal seed ids the one with the lesser components comes first. Components beyond
LARGEST would overflow a long distance and raise an error. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.runs import fixed_rows
from panelscope.llm.store import released, stored

WIDTH, CLUSTERS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
#: Largest magnitude of a scaled component: 64 squares of differences then fit a long.
LARGEST = 1 << 26
_UP = 1 + 1e-9  # more than the rounding of a root and a product
_BLOCK = 1 << 13  # vectors handled at once

Map = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def kept_vectors(embeddings: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of long) of the rows with `width` finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall("v", lambda x: F.abs(x) <= LARGEST)
    rows = embeddings.where((F.size("embedding") == width) & finite).select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"))
    return rows.select("vec_id", F.when(fits, F.col("v")).otherwise(F.raise_error(F.lit(f"a component is beyond {LARGEST} / {scale}"))).alias("v"))


def first_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors whose ids have the smallest hashes, as rows of a matrix."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(key.alias("key"), "v").orderBy(F.col("key").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r.v for r in rows], np.int64) if rows else np.zeros((0, 0), np.int64)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of x to c."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def _below(x: np.ndarray) -> np.ndarray:
    """32-bit floats that are not above x."""
    y = (x * (2 - _UP)).astype(np.float32)
    return np.where(y > x, np.nextafter(y, np.float32(-1)), y)


def assigned(x: np.ndarray, history: list[np.ndarray], before: np.ndarray, lower: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest of the newest centroids, squared distance to it, and how many distances were computed.

    `before` has each vector's last cluster, `lower` its distances when last computed and `seen` the rounds of that
    (-1: never); the last two are brought up to date in place."""
    now = len(history) - 1
    newest, every = history[-1], np.stack(history)
    moved = np.sqrt(((every - newest).astype(np.float64) ** 2).sum(axis=2)) * _UP  # of each round and centroid
    rows = np.arange(len(x))
    near, best = before.copy(), squared(x, newest[before])
    scans = len(x)
    old, own = best.copy(), before
    reach = np.sqrt(best.astype(np.float64)) * _UP
    for j, c in enumerate(newest):
        bound = np.where(seen[:, j] < 0, -1.0, lower[:, j] - moved[seen[:, j], j])
        fails = rows[(bound <= reach) & (own != j)]
        if not len(fails):
            continue
        scans += len(fails)
        d = squared(x[fails], c)
        lower[fails, j], seen[fails, j] = _below(np.sqrt(d.astype(np.float64))), now
        better = (d < best[fails]) | (d == best[fails]) & (j < near[fails])
        at = fails[better]
        near[at], best[at] = j, d[better]
        reach[at] = np.sqrt(best[at].astype(np.float64)) * _UP
    lower[rows, own], seen[rows, own] = _below(np.sqrt(old.astype(np.float64))), now
    return near, best, scans


STATE = "vec_id long, v binary, cluster int, distance long, lower binary, seen binary, scans int"


def _state(ids: pa.Array, x: np.ndarray, near: np.ndarray, best: np.ndarray, lower: np.ndarray, seen: np.ndarray, scans: int) -> pa.RecordBatch:
    def cells(m: np.ndarray) -> pa.Array:
        return pa.array([r.tobytes() for r in m], pa.binary())

    n = np.zeros(len(x), np.int32)
    n[:1] = scans  # of the block, on its first row
    return pa.RecordBatch.from_arrays(
        [ids, cells(x.astype(np.int32)), pa.array(near, pa.int32()), pa.array(best, pa.int64()), cells(lower.astype(np.float32)), cells(seen.astype(np.int16)), pa.array(n)],
        names=["vec_id", "v", "cluster", "distance", "lower", "seen", "scans"],
    )


def _begun(centroids: np.ndarray) -> Map:
    """Map function over (vec_id, v): the state after the first assignment."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(lo, _BLOCK)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(part.num_rows, -1)
                lower, seen = np.zeros((len(x), k), np.float32), np.full((len(x), k), -1, np.int16)
                near, best, scans = assigned(x, [centroids], np.zeros(len(x), np.int64), lower, seen)
                yield _state(part.column(0), x, near, best, lower, seen, scans)

    return run


def _moved_on(history: list[np.ndarray]) -> Map:
    """Map function over the state: the state under the newest centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = history[0].shape
        for batch in batches:
            for lo in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(lo, _BLOCK)
                x = fixed_rows(part.column(1), 4 * width).view(np.int32).astype(np.int64)
                lower = fixed_rows(part.column(4), 4 * k).copy().view(np.float32)
                seen = fixed_rows(part.column(5), 2 * k).copy().view(np.int16)
                before = part.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
                near, best, scans = assigned(x, history, before, lower, seen)
                yield _state(part.column(0), x, near, best, lower, seen, scans)

    return run


def _summed(k: int, width: int) -> Map:
    """Map function over (v, cluster): rows and sums of each cluster in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = fixed_rows(batch.column(0), 4 * width).view(np.int32).astype(np.int64)
            of = batch.column(1).to_numpy(zero_copy_only=False)
            order = np.argsort(of, kind="stable")
            here, first = np.unique(of[order], return_index=True)
            n += np.bincount(of, minlength=k)
            sums[here] += np.add.reduceat(x[order], first, axis=0)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some]), pa.array([s.tolist() for s in sums[some]], pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    return run


def moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Every centroid as the floor of its vectors' mean; one without vectors stays."""
    k, width = centroids.shape
    parts = state.select("v", "cluster").mapInArrow(_summed(k, width), "cluster int, n long, sums array<long>")
    totals = parts.groupBy("cluster").agg(F.sum("n"), *(F.sum(F.col("sums")[i]) for i in range(width))).collect()
    out = centroids.copy()
    for cluster, n, *sums in totals:
        out[cluster] = [s // n for s in sums]
    return out


def fitted(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH) -> tuple[DataFrame | None, list[np.ndarray]]:
    """The stored state after the last assignment, and the centroids before and after each round."""
    vectors = kept_vectors(embeddings, width)
    history = [first_centroids(vectors, clusters)]
    if not len(history[0]):
        return None, history
    state = stored(vectors.mapInArrow(_begun(history[0]), STATE), "vectors")
    for _ in range(rounds):
        history.append(moved(state, history[-1]))
        older, state = state, stored(state.mapInArrow(_moved_on(history), STATE), "vectors")
        released(older)
    return state, history


SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def clusters(embeddings: DataFrame, n_clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH) -> DataFrame:
    """Cluster, squared distance, inertias and centroid hash of every kept vector of `embeddings` (vec_id, embedding)."""
    spark = embeddings.sparkSession
    state, history = fitted(embeddings, n_clusters, rounds, width)
    if state is None:
        return spark.createDataFrame([], SCHEMA)
    inertia = dict(state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())  # a row for each cluster
    total = int(sum(inertia.values()))
    rows = [(k, int(inertia.get(k, 0)), total, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for k, c in enumerate(history[-1])]
    of = F.broadcast(spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))  # as many rows as clusters
    return state.select("vec_id", "cluster", "distance").join(of, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """DuckDB SQL for the rows of clusters(): plain Lloyd rounds over (row, component) tables."""
    parts = [
        f"""kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: isfinite(CAST(x AS DOUBLE)))) = {WIDTH}
)""",
        "x AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept)",
        f"""seeds AS (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR)), v) - 1 AS k, v FROM kept ORDER BY k LIMIT {CLUSTERS}
)""",
        "c0 AS MATERIALIZED (SELECT k, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM seeds)",
    ]
    for n in range(ROUNDS + 1):
        parts.append(f"d{n} AS (SELECT r, k, sum((x - c) * (x - c)) AS d FROM x JOIN c{n} USING (i) GROUP BY r, k)")
        parts.append(f"a{n} AS MATERIALIZED (SELECT r, k, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)")
        if n < ROUNDS:
            parts.append(f"s{n} AS (SELECT k, i, sum(x) AS s, count(*) AS n FROM a{n} JOIN x USING (r) GROUP BY k, i)")
            parts.append(f"c{n + 1} AS MATERIALIZED (SELECT k, i, CAST(coalesce((s - ((s % n) + n) % n) // n, c) AS BIGINT) AS c FROM c{n} LEFT JOIN s{n} USING (k, i))")
    last = ROUNDS
    parts.append(f"hashes AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{last} GROUP BY k)")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN hashes USING (k)"""


ORACLE = _oracle()
