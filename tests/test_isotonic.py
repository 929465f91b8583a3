import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from panelscope.operators.isotonic import fit_isotonic, isotonic_pools, pooled


def scored(spark, seed, n, digits):
    rng = np.random.default_rng(seed)
    s = np.round(rng.normal(size=n), digits)
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * s))).astype(int)
    return spark.createDataFrame(list(zip(s.tolist(), y.tolist(), strict=True)), "s double, y int").repartition(5)


@pytest.mark.parametrize("digits", [1, 2, 9])
def test_equals_mllib(spark, digits):
    df = scored(spark, digits, 4000, digits)
    curve = fit_isotonic(df, "s")
    vectors = VectorAssembler(inputCols=["s"], outputCol="x").transform(df.withColumn("label", F.col("y").cast("double")))
    other = IsotonicRegression(featuresCol="x", labelCol="label").fit(vectors)
    points = spark.range(0, 400).select((F.col("id") / 50.0 - 4).alias("s")).union(df.select("s"))
    want = {r.s: r.prediction for r in other.transform(VectorAssembler(inputCols=["s"], outputCol="x").transform(points)).collect()}
    for r in curve.transform(points, "s", "p").collect():
        assert r.p == pytest.approx(want[r.s], abs=1e-12)


def test_no_task_holds_all_scores(spark):
    df = scored(spark, 4, 20_000, 9)
    pools = isotonic_pools(df, "s").collect()
    assert sum(r.n for r in pools) == 20_000 and len(pools) < 200
    assert pools[0].lo == df.agg(F.min("s")).first()[0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5), st.integers(0, 5)), min_size=1, max_size=30), st.integers(1, 29))
def test_pooling_ranges_first_changes_nothing(counts, cut):
    rows = [(float(i), float(i), n, min(k, n)) for i, (n, k) in enumerate(counts)]
    whole = pooled(iter(rows))
    assert pooled(iter(pooled(iter(rows[:cut])) + pooled(iter(rows[cut:])))) == whole
    shares = [k / n for _, _, n, k in whole]
    assert all(a < b for a, b in zip(shares, shares[1:], strict=False))


def test_edges(spark):
    one = fit_isotonic(spark.createDataFrame([(0.5, 1), (0.5, 0), (None, 1), (0.1, None)], "s double, y int"), "s")
    assert (one.boundaries, one.predictions) == ([0.5], [0.5])
    xs = spark.createDataFrame([(-1.0,), (0.5,), (2.0,), (None,)], "s double")
    assert [r.p for r in one.transform(xs, "s", "p").collect()] == [0.5, 0.5, 0.5, None]
    with pytest.raises(ValueError, match="without scored"):
        fit_isotonic(spark.createDataFrame([], "s double, y int"), "s")
