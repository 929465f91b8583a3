import tempfile

from pyspark.sql import functions as F

from panelscope.operators import scoring as SCO
from panelscope.operators.features import YEARLY_FEATURE_COLUMNS
from panelscope.plans import catalog as CAT
from panelscope.sources import tables as T
from panelscope.streaming.requests import publish, start_request_stream

SF = "/root/testdata/sf0.001"


def fixed(df):
    return df.withColumn("risk_score", CAT.fixed_score())


def rows_of(df):
    return sorted(map(tuple, df.drop("features_used").collect()), key=str)


def test_stream_equals_batch_and_goes_on_with_a_new_version(spark):
    tmp = tempfile.mkdtemp(prefix="stream-test-")
    reqs = T.event_requests(spark, SF)
    first, later = reqs.where("request_id % 3 > 0"), reqs.where("request_id % 3 = 0")
    first.repartition(3).write.parquet(f"{tmp}/requests")
    feats = CAT.events_features(spark, SF)
    spark.range(3).cache().count()
    held = spark.range(3).cache()

    def run(version):
        q = start_request_stream(spark, f"{tmp}/requests", version, YEARLY_FEATURE_COLUMNS, f"{tmp}/out", f"{tmp}/checkpoint",
                                 bounds=T.EVENT_PERIOD_BOUNDS, max_files_per_trigger=1)
        q.awaitTermination(300)
        return spark.read.parquet(f"{tmp}/out")

    def batch(part, score):
        return SCO.score_requests(part, feats, score, YEARLY_FEATURE_COLUMNS, "dev", "calibrated_weighted_logistic_regression", T.EVENT_PERIOD_BOUNDS)

    one = publish(feats, fixed, YEARLY_FEATURE_COLUMNS, f"{tmp}/static")
    assert rows_of(run(one)) == rows_of(batch(first, fixed))
    assert held.storageLevel.useMemory  # the session's cached tables stay
    assert run(one).count() == first.count()  # started again: nothing twice

    def half(df):
        return fixed(df).withColumn("risk_score", F.col("risk_score") / 2)

    later.repartition(2).write.mode("append").parquet(f"{tmp}/requests")
    two = publish(feats, half, YEARLY_FEATURE_COLUMNS, f"{tmp}/static")
    assert one != two
    assert rows_of(run(two)) == sorted(rows_of(batch(first, fixed)) + rows_of(batch(later, half)), key=str)
