import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelscope.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def _check(spark, groups, direct_limit):
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    out = exact_quantiles(df, "v", PROBS, by=["g"], names=[f"q{i}" for i in range(len(PROBS))],
                          direct_limit=direct_limit)
    for r in out.collect():
        want = np.quantile(np.array(groups[r.g]), PROBS)
        got = [r[f"q{i}"] for i in range(len(PROBS))]
        assert got == pytest.approx(list(want), rel=1e-12, abs=1e-12)
        assert r.n == len(groups[r.g])


def test_direct_path_matches_numpy(spark):
    rng = np.random.default_rng(1)
    _check(spark, {"a": rng.normal(size=50).tolist(), "b": [1, 1, 1, 2], "c": [5]}, 10**6)


def test_bucketed_path_matches_numpy(spark):
    rng = np.random.default_rng(2)
    big = rng.exponential(size=3000).round(3).tolist()  # many ties
    _check(spark, {"a": big, "b": rng.normal(size=700).tolist(), "c": [3, 1, 2]}, direct_limit=100)


def test_hot_value_group(spark):
    # one value holds a third of the rows
    vals = [7.0] * 500 + list(np.linspace(0, 10, 1000))
    _check(spark, {"hot": vals}, direct_limit=50)


def test_no_task_holds_the_copies_of_a_hot_value(spark):
    """Half of all rows are one value: what is ranked are distinct values, in buckets."""
    from unittest import mock

    from panelscope.operators import quantiles

    df = spark.range(4000).selectExpr("case when id % 2 = 0 then 9.0d else cast(id as double) / 7 end as v")
    seen = {}

    def spy(counts, *args, **kwargs):
        seen["rows"] = counts.count()
        return real(counts, *args, **kwargs)

    real = quantiles.ordered_prefix_sums
    with mock.patch.object(quantiles, "ordered_prefix_sums", spy):
        r = exact_quantiles(df, "v", [0.25, 0.5], names=["a", "b"], direct_limit=100).first()
    values = np.array([9.0 if i % 2 == 0 else i / 7 for i in range(4000)])
    assert (r.a, r.b) == pytest.approx(tuple(np.quantile(values, [0.25, 0.5])), rel=1e-12)
    assert seen["rows"] <= len(set(values))  # only the values near a wanted rank, and one for each gap between


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_property_any_small_list(spark, xs):
    _check(spark, {"g": xs}, direct_limit=10)


def test_global_quantile_and_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (float("nan"),)], "v double")
    r = exact_quantiles(df, "v", [0.5], names=["m"]).first()
    assert (r.n, r.m) == (2, 2.0)


def test_a_null_group_is_a_group_on_both_paths(spark):
    df = spark.createDataFrame([(None, "a", 1.0), (None, "a", 3.0), (1, None, 5.0), (1, "a", 7.0), (1, "a", 8.0)], "g int, h string, v double")
    for limit in (10**6, 0):
        got = {(r.g, r.h): (r.n, r.q0) for r in exact_quantiles(df, "v", [0.5], ["g", "h"], direct_limit=limit).collect()}
        assert got == {(None, "a"): (2, 2.0), (1, None): (1, 5.0), (1, "a"): (2, 7.5)}
