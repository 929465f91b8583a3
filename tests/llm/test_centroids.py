import hashlib
import math

import numpy as np
import pytest

from panelscope.llm import centroids

SF = "/root/testdata/sf0.001"


def brute(rows, k=40, rounds=5, width=64):
    """(vec_id, vector) rows to the expected rows by plain Lloyd rounds with Python integers."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    cs = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for j in range(len(cs)):
            mine = [v for (_, v), c in zip(kept, of, strict=True) if c == j]
            if mine:
                cs[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    ends = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in ends)
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, j, d, sum(x for _, x, y in ends if y == j), total, names[j]) for i, d, j in ends), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()[:400]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert rows_of(centroids.clusters(df)) == brute([tuple(r) for r in rows])


@pytest.mark.parametrize("step", [1, 1 << 17])
def test_ties_copies_and_large_components(spark, step):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) * step for x in rng.integers(-2, 3, 4) / 256]) for i in range(300)]
    rows += rows[:100] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(centroids.clusters(df, 12, 5, 4)) == brute(rows, 12, 5, 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [1.0, 2.0], 1), (4, [1.0, None, 1.0], 1), (5, [nan, 1.0, 1.0], 1), (6, [inf, 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0], 1), (7, [0.5, -0.001, 2.0], None), (7, [0.5, -0.001, 2.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster int")
    got = rows_of(centroids.clusters(df, 40, 5, 3))
    assert got == brute([r[:2] for r in rows], 40, 5, 3) and len(got) == 3
    assert centroids.clusters(df.where("vec_id < 7"), 40, 5, 3).collect() == []
    with pytest.raises(Exception, match="beyond"):
        centroids.clusters(spark.createDataFrame([(1, [1e30, 0.0, 0.0])], "vec_id long, embedding array<double>"), 2, 1, 3).collect()


def test_bounds_spare_most_distances_and_are_looser_by_summed_steps(spark):
    rng = np.random.default_rng(7)
    middles = rng.normal(0, 8, (20, 16))
    rows = [(i, (middles[i % 20] + rng.normal(0, 1, 16)).tolist()) for i in range(2000)]
    state, history = centroids.fitted(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 20, 5, 16)
    assert state.agg({"scans": "sum"}).first()[0] < 2000 * 20 * 0.6
    direct = np.linalg.norm(history[-1] - history[0], axis=1)
    steps = sum(np.linalg.norm(b - a, axis=1) for a, b in zip(history, history[1:], strict=False))
    assert (direct <= steps + 1e-9).all() and (direct < steps - 1).any()
