"""How often operators read their input."""

import numpy as np
import pytest

from panelscope.operators import scoring as SCO
from panelscope.operators.quantiles import exact_quantiles
from panelscope.operators.ranking import percentile_in_group

FEATS = ["lag_1"]


def counted(spark, df):
    """`df`, and an accumulator of the rows read of it."""
    reads = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            reads.add(len(frame))
            yield frame

    return df.repartition(2).mapInPandas(count, df.schema), reads


def test_quantiles_read_their_input_twice(spark):
    n = 6000
    df, reads = counted(spark, spark.range(n).selectExpr("id % 2 AS g", "cast(id AS double) / 7 AS v"))
    got = {r.g: (r.n, r.q) for r in exact_quantiles(df, "v", [0.75], by=["g"], names=["q"], direct_limit=10).collect()}
    for g in (0, 1):
        assert got[g] == (n // 2, pytest.approx(np.quantile(np.arange(g, n, 2) / 7, 0.75), rel=1e-12))
    assert reads.value <= 2 * n  # the sketch, and the counts around the wanted ranks


@pytest.mark.parametrize("limit", [10, 10**6])
def test_percentiles_read_their_input_twice(spark, limit):
    n = 3000
    df, reads = counted(spark, spark.range(n).selectExpr("id", "cast(id AS double) AS s", "id % 2 AS g"))
    got = {r.id: r.risk_percentile for r in percentile_in_group(df, ["g"], "s", direct_limit=limit).collect()}
    assert got == {i: pytest.approx((i // 2 + 1) * 100.0 / (n // 2)) for i in range(n)}
    assert reads.value <= 2 * n  # the counts, and the rows that get them


def test_features_are_read_three_times(spark):
    n = 3000
    rows = spark.range(n).selectExpr("lpad(cast(id AS string), 5, '0') AS entity", "2017 AS period", "cast(id AS double) AS lag_1")
    features, reads = counted(spark, rows)
    reqs = spark.range(3 * n).selectExpr("id AS request_id", "cast(id % 4000 AS string) AS raw_key", "cast(null AS int) AS as_of_period")
    out = SCO.score_requests(reqs, features, lambda df: df.withColumn("risk_score", df.lag_1 / n), FEATS, "v1", "logit")
    got = {r.request_id: (r.status, r.risk_score, r.risk_percentile_in_period) for r in out.drop("features_used").collect()}
    assert len(got) == 3 * n
    for i, answer in got.items():
        k = i % 4000
        assert answer == (("ok", k / n, pytest.approx((k + 1) * 100.0 / n)) if k < n else ("unknown_entity", None, None))
    assert reads.value <= 3 * n  # the bounds, the counts of scores, and the scored rows
