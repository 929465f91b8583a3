from panelscope.functions.scores import logistic_score
from panelscope.operators import scoring as SCO

FEATS = ["lag_1", "lag_3_mean_obs", "lag_5_mean_obs", "periods_since_last_obs"]


def features(spark):
    rows = [
        ("39049", 2015, 1.0, 1.0, 1.0, 0), ("39049", 2016, 2.0, 1.5, 1.2, 1), ("39049", 2017, 3.0, 2.0, 1.5, 1),
        ("06037", 2016, 5.0, 4.0, 3.0, 1), ("06037", 2017, 0.5, 2.0, 3.0, 1),
        ("01001", 2017, None, None, None, 0),  # exists, nothing scoreable
    ]
    return spark.createDataFrame(rows, "entity string, period int, lag_1 double, lag_3_mean_obs double, "
                                       "lag_5_mean_obs double, periods_since_last_obs int")


def score(df):
    return df.withColumn("risk_score", logistic_score(-1.0, {"lag_1": 0.5, "lag_3_mean_obs": 0.1,
                                                           "lag_5_mean_obs": 0.1, "periods_since_last_obs": -0.2}))


def run(spark, reqs):
    r = spark.createDataFrame(reqs, "request_id long, raw_key string, as_of_period int")
    out = SCO.score_requests(r, features(spark), score, FEATS, "v1", "logit")
    return {row.request_id: row for row in out.collect()}


def test_request_edge_cases(spark):
    out = run(spark, [
        (1, "39049", 2017), (2, "039049", 2016), (3, " 39049 ", None), (4, "6037", 2017),
        (5, "   ", 2017), (6, "AAAA", None), (7, "39049", 1999), (8, "39049", 2101),
        (9, "39049", 2100), (10, "39049", 2025), (11, "99999", None), (12, "1001", None), (13, "1234567", None),
    ])
    assert out[1].status == "ok" and out[1].as_of_period == 2017
    assert out[2].status == "ok" and out[2].entity == "39049" and out[2].as_of_period == 2016
    assert out[3].status == "ok" and out[3].as_of_period == 2017 and "latest available period (2017)" in out[3].notes
    assert out[4].entity == "06037" and out[4].status == "ok"
    assert [out[i].status for i in (5, 6, 7, 8, 13)] == ["invalid"] * 5
    # 2100 passes the request rule but is not available; bounds are returned
    assert out[9].status == "period_unavailable" and (out[9].available_periods_min, out[9].available_periods_max) == (2015, 2017)
    assert out[10].status == "period_unavailable" and out[10].as_of_period_available is False
    assert out[11].status == "unknown_entity" and out[11].available_periods_min is None
    assert out[12].status == "no_scoreable_period"
    # percentile within the period over every scoreable row of 2017: 39049 (3.0) vs 06037 (0.5)
    assert out[1].risk_percentile_in_period == 100.0 and out[4].risk_percentile_in_period == 50.0
    assert out[1].features_used["lag_1"] == 3.0


def test_empty_request_table(spark):
    assert run(spark, []) == {}


def test_repeated_requests_each_get_a_row(spark):
    out = run(spark, [(i, "39049", None) for i in range(50)])
    assert len(out) == 50 and {r.status for r in out.values()} == {"ok"}


def test_requests_are_read_three_times(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            reads.add(len(frame))
            yield frame

    keys = ["39049", "06037", "01001", "99999", "   ", "1234567"]
    rows = [(i, keys[i % 6], None if i % 5 == 0 else 2016 + i % 3) for i in range(3000)] + [(3000, "39049", 1999)]
    reqs = spark.createDataFrame(rows, "request_id long, raw_key string, as_of_period int").repartition(2)
    out = SCO.score_requests(reqs.mapInPandas(counted, reqs.schema), features(spark), score, FEATS, "v1", "logit")
    got = {r.request_id: r for r in out.drop("features_used").collect()}
    assert len(got) == len(rows) and reads.value <= 3 * len(rows)
    one = {(r.raw_key, q[2]): tuple(r)[1:] for q in rows for r in [got[q[0]]]}
    assert all(tuple(got[i])[1:] == one[k, p] for i, k, p in rows)
    # NULL is the key of invalid requests: their own period stays, and nothing else is answered
    assert {tuple(got[i])[2:9] for i in (4, 5, 3000)} == {
        (None, 2017, "invalid", None, "v1", "logit", None), (None, None, "invalid", None, "v1", "logit", None),
        ("39049", 1999, "invalid", None, "v1", "logit", None)}
