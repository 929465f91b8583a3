import tempfile

import pytest
from pyspark.sql import functions as F

from panelscope.operators.hot_keys import split_join
from panelscope.operators.quantiles import ACCURACY, bracketed_counts, exact_quantiles
from panelscope.operators.ranking import percentile_in_group
from panelscope.plans import catalog as CAT
from panelscope.operators import scoring as SCO
from panelscope.operators.features import YEARLY_FEATURE_COLUMNS
from panelscope.sources import tables as T

SF = "/root/testdata/sf0.001"


def test_split_join_equals_a_plain_one_and_shuffles_no_hot_key(spark):
    rows = spark.range(0, 40_000).select("id", F.when(F.col("id") % 2 == 0, F.lit(None)).when(F.col("id") % 5 == 0, F.lit(7)).otherwise(F.col("id") % 3000).alias("k"))
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.coalesce(F.col("k"), F.lit(-1)) * 10).where("k is null or k <> 11")
    got = split_join(rows, counts, ["k"], "n", shares=100)
    want = rows.collect()
    known = {r.k: r.v for r in counts.collect()}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(((r.id, r.k, known.get(r.k)) for r in want), key=str)
    # what is hashed: no key has twice its share of a task
    heavy = counts.where(F.col("n") * 100 > 40_000).select("k")
    light = rows.join(F.broadcast(heavy.withColumnRenamed("k", "h")), F.col("k").eqNullSafe(F.col("h")), "left_anti")
    sizes = [r[0] for r in light.repartition(8, "k").groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert max(sizes) < 2 * sum(sizes) / 8


def test_percentile_keeps_a_null_period_on_every_path(spark):
    rows = [(i, None if i % 3 == 0 else i % 2, 0.5 if i % 2 else i / 100) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, period int, s double")
    want = {}
    for i, p, s in rows:
        group = [x for _, q, x in rows if q == p]
        want[i] = 100 * sum(x <= s for x in group) / len(group)
    for bound in (300, None):
        got = {r.id: r.risk_percentile for r in percentile_in_group(df, ["period"], "s", size_bound=bound, direct_limit=300 if bound else 0).collect()}
        assert got == pytest.approx(want)


def test_brackets_leave_a_small_part_of_the_values(spark):
    n = 300_000
    vals = spark.range(0, n).select((F.col("id") % 2).alias("g"), F.sin(F.col("id").cast("double")).alias("__qval"))
    kept = bracketed_counts(vals, ["g"], [0.75])
    assert kept.count() < n / 10 and kept.agg(F.sum("__cnt")).first()[0] == n
    assert kept.where("__in").count() <= n * 10 / ACCURACY
    got = {r.g: (r.n, r.q) for r in exact_quantiles(vals, "__qval", [0.75], by=["g"], names=["q"]).collect()}
    want = {r.g: r.q for r in vals.groupBy("g").agg(F.expr("percentile(__qval, 0.75)").alias("q")).collect()}
    assert {g: q for g, (_, q) in got.items()} == pytest.approx(want, abs=0) and {c for c, _ in got.values()} == {n // 2}


@pytest.mark.parametrize("limit", [0, 50])
def test_brackets_with_ties_nulls_and_small_groups(spark, limit):
    rows = [(i % 4 or None, float(i % 7) if i % 5 else (None if i % 2 else float("nan"))) for i in range(400)] + [(9, 1.0), (10, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {r[0]: r[2:] for r in exact_quantiles(df, "v", probs, by=["g"], direct_limit=limit).collect()}
    want = {r[0]: r[1] for r in df.where("v is not null and not isnan(v)").groupBy("g").agg(F.expr(f"percentile(v, array({','.join(map(str, probs))}))")).collect()}
    assert {g: list(q) for g, q in got.items()} == {g: pytest.approx(q) for g, q in want.items()}


def test_hot_requests_give_the_same_answers(spark):
    ev = CAT.events_pipeline(spark, SF)
    reqs = T.event_requests(spark, SF)
    many = reqs.unionByName(spark.range(0, 3000).select((F.col("id") + 10_000_000).alias("request_id"), F.lit("1").alias("raw_key"), F.lit(None).cast("int").alias("as_of_period")))
    score = lambda df: df.withColumn("risk_score", CAT.fixed_score())
    out = SCO.score_requests(many, ev.features, score, YEARLY_FEATURE_COLUMNS, "v", "t", T.EVENT_PERIOD_BOUNDS)
    few = SCO.score_requests(reqs, ev.features, score, YEARLY_FEATURE_COLUMNS, "v", "t", T.EVENT_PERIOD_BOUNDS, scored=SCO.scored_table(ev.features, score, YEARLY_FEATURE_COLUMNS))
    rows = {r.request_id: r for r in out.drop("features_used").collect()}
    assert len(rows) == many.count()
    for r in few.drop("features_used").collect():
        assert rows[r.request_id] == r
    assert len({tuple(r)[2:] for i, r in rows.items() if i >= 10_000_000}) == 1
