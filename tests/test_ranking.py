import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelscope.operators import ranking as RK


def brute_auc(y, s):
    pos = [a for a, t in zip(s, y) if t == 1]
    neg = [a for a, t in zip(s, y) if t == 0]
    if not pos or not neg:
        return None
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def scored(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "entity": [f"{i:05d}" for i in range(n)],
        "period": 1,
        "outcome_period": rng.integers(1, 4, n),
        "y": rng.integers(0, 2, n),
        "risk_score": rng.integers(0, 40, n) / 40.0,  # heavy ties
    })
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("limit", [10**6, 5])
def test_prefix_sums_direct_and_bucketed_agree(spark, limit):
    pdf, df = scored(spark)
    counts = df.groupBy("outcome_period", "risk_score").count()
    out = RK.ordered_prefix_sums(counts, ["outcome_period"], "risk_score", ["count"], direct_limit=limit)
    got = {(r.outcome_period, r.risk_score): (r.count_before, r.count_total) for r in out.collect()}
    for (g, s), (before, total) in got.items():
        sub = pdf[pdf.outcome_period == g]
        assert before == int((sub.risk_score < s).sum()) and total == len(sub)


def test_auc_matches_pair_count(spark):
    pdf, df = scored(spark)
    got = {r.outcome_period: r.auc for r in RK.roc_auc(df, ["outcome_period"]).collect()}
    for g, sub in pdf.groupby("outcome_period"):
        assert got[g] == pytest.approx(brute_auc(sub.y.tolist(), sub.risk_score.tolist()), abs=1e-12)
    pooled = RK.roc_auc(df, []).first().auc
    assert pooled == pytest.approx(brute_auc(pdf.y.tolist(), pdf.risk_score.tolist()), abs=1e-12)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, risk_score double")
    assert RK.roc_auc(df, []).first().auc is None


def test_top_share_flags_match_sorted_head(spark):
    pdf, df = scored(spark)
    out = RK.top_share_flags(df, ["outcome_period"], "risk_score", ["entity", "period"]).toPandas()
    for g, sub in pdf.groupby("outcome_period"):
        k = max(1, int(np.ceil(0.25 * len(sub))))
        want = set(sub.sort_values(["risk_score", "entity"], ascending=[False, True]).head(k).entity)
        got = set(out[(out.outcome_period == g) & (out.predicted_top_quartile == 1)].entity)
        assert got == want


def test_percentile_is_cume_dist(spark):
    pdf, df = scored(spark)
    out = RK.percentile_in_group(df, ["outcome_period"], "risk_score").toPandas()
    for _, r in out.sample(30, random_state=1).iterrows():
        sub = pdf[pdf.outcome_period == r.outcome_period]
        assert r.risk_percentile == pytest.approx((sub.risk_score <= r.risk_score).mean() * 100)


def test_top_share_flags_hot_tie_at_cut_in_ranges(spark):
    # a third of each period ties at the cut score: the tie pass must still be exact
    rows = []
    for g in (1, 2):
        for i in range(90):
            score = 0.5 if i % 3 == 0 else (0.9 if i % 3 == 1 and i < 30 else 0.1)
            rows.append((f"{(i * 37) % 1000:05d}", g - 1, g, int(i % 2), score))
    pdf = pd.DataFrame(rows, columns=["entity", "period", "outcome_period", "y", "risk_score"])
    df = spark.createDataFrame(pdf)
    out = RK.top_share_flags(df, ["outcome_period"], "risk_score", ["entity", "period"], direct_limit=5).toPandas()
    for g, sub in pdf.groupby("outcome_period"):
        k = max(1, int(np.ceil(0.25 * len(sub))))
        want = set(sub.sort_values(["risk_score", "entity", "period"], ascending=[False, True, True]).head(k).entity)
        got = set(out[(out.outcome_period == g) & (out.predicted_top_quartile == 1)].entity)
        assert got == want and len(out[out.outcome_period == g]) == len(sub)


def test_top_share_flags_keep_null_scores_and_groups(spark):
    rows = [("a", 1, 0.9), ("b", 1, None), ("c", 1, 0.1), ("d", None, 0.5), ("e", None, 0.4), ("f", None, None)]
    df = spark.createDataFrame(rows, "entity string, period int, risk_score double")
    for limit in (10**6, 0):
        out = RK.top_share_flags(df, ["period"], "risk_score", ["entity"], out="f", direct_limit=limit)
        assert {r.entity: r.f for r in out.collect()} == {"a": 1, "b": None, "c": 0, "d": 1, "e": 0, "f": None}


def test_auc_of_billions_of_rows(spark):
    from unittest import mock

    from panelscope.operators import ranking

    pre = spark.createDataFrame(
        [(4 * 10**9, 0, 0, 4 * 10**9, 6 * 10**9), (0, 6 * 10**9, 0, 4 * 10**9, 6 * 10**9)],
        "__pos long, __neg long, __neg_before long, __pos_total long, __neg_total long",
    ).withColumn("__neg_before", F.when(F.col("__pos") > 0, F.lit(6 * 10**9)).otherwise(F.lit(0)))
    rows = spark.createDataFrame([(1, 0.5), (0, 0.2)], "y int, risk_score double")
    with mock.patch.object(ranking, "ordered_prefix_sums", return_value=pre):
        assert ranking.roc_auc(rows, []).first().auc == 1.0
