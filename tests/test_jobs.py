import os
import tempfile

import pytest
from pyspark.sql import functions as F

from panelscope.operators import clean as C
from panelscope.operators import features as FE
from panelscope.plans import jobs as JB
from panelscope.plans import catalog as CAT

SF = "/root/testdata/sf0.001"


def test_raw_csv_reads_all_strings_and_cleans(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    with open(f"{d}/raw.csv", "w") as fh:
        fh.write("CoFIPS,Year,FILINGS,Filing_Rate,Other\n1001,2010,120,3.5,x\n39049,2011,0,2,y\n,2012,1,1,z\n")
    raw = JB.read_raw_csv(spark, f"{d}/raw.csv")
    assert all(t == "string" for _, t in raw.dtypes)
    panel = C.clean_panel(raw)
    assert sorted((r.entity, r.period) for r in panel.collect()) == [("01001", 2010), ("39049", 2011)]


def test_sinks_round_trip_and_standardize(spark):
    d = tempfile.mkdtemp(prefix="sink-")
    f = CAT.events_features(spark, SF)
    JB.write_table(f.drop("outcome_period"), f"{d}/features_csv", "csv")
    back = JB.standardize_features(spark.read.option("header", True).csv(f"{d}/features_csv"))
    assert back.columns == FE.YEARLY_OUTPUT and back.count() == f.count()
    assert back.where(F.col("outcome_period") != F.col("period") + 1).count() == 0
    JB.write_table(f.limit(3), f"{d}/features_json", "json")
    assert spark.read.json(f"{d}/features_json").count() == 3


def test_load_or_build_reuses_or_rebuilds(spark):
    d = tempfile.mkdtemp(prefix="lob-")
    calls = []

    def build():
        calls.append(1)
        return CAT.events_features(spark, SF)

    a = JB.load_or_build_features(spark, f"{d}/f", build, rebuild=False)
    b = JB.load_or_build_features(spark, f"{d}/f", build, rebuild=False)
    assert len(calls) == 1 and a.count() == b.count()
    # partitioned by period: a period filter prunes partitions
    latest = b.agg({"period": "max"}).first()[0]
    plan = spark.read.parquet(f"{d}/f").where(f"period = {latest}")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan


def test_monthly_standardize(spark):
    fm = FE.monthly_features(CAT.T.supplier_monthly(spark, SF), unique_keys=True)
    txt = fm.select(*[F.col(c).cast("string").alias(c) for c in fm.columns])
    back = JB.standardize_monthly_features(txt)
    assert dict(back.dtypes)["month"] == "date" and back.count() == fm.count()


def test_calibration_needs_five_rows_per_class(spark):
    import pytest

    with pytest.raises(ValueError, match="at least 5 rows of each class"):
        JB.train_job(spark, CAT.events_features(spark, SF))


def test_train_job_writes_artifacts_and_audit(spark):
    d = tempfile.mkdtemp(prefix="job-")
    f = CAT.events_features(spark, "/root/testdata/sf0.01")  # sf0.001 has < 5 positives to calibrate on
    out = JB.train_job(spark, f, model_version="t1", out_dir=d)
    m = spark.read.json(f"{d}/metrics").first()
    assert m.test_rows > 0 and 0.0 <= m.precision_at_0_5 <= 1.0
    meta = spark.read.json(f"{d}/metadata").first()
    assert meta.model_version == "t1" and set(meta.provenance.asDict()) >= {"spark_version", "created_at_utc"}
    summary = JB.metrics_summary(out["metrics"]).first()
    assert summary.overall.test_rows == m.test_rows
    JB.export_training_audit(f, f"{d}/audit")
    counts = spark.read.option("header", True).csv(f"{d}/audit/training_filter_counts")
    assert counts.count() == 10


def test_monthly_load_or_build_round_trip(spark):
    d = tempfile.mkdtemp()
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame(
            [("00001", "2020-01-01", 1, 0.5, 0.5, 0.25, 1)],
            "entity string, month string, y int, lag_1 double, lag_3_mean double, lag_12_mean double, month_of_year int",
        )

    a = JB.load_or_build_features(spark, f"{d}/m", build, rebuild=False, time="month")
    b = JB.load_or_build_features(spark, f"{d}/m", build, rebuild=False, time="month")
    assert len(built) == 1
    assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()]
    assert str(b.first().month) == "2020-01-01"


def test_a_corrupt_table_raises_and_stays(spark):
    d = tempfile.mkdtemp()
    os.makedirs(f"{d}/t")
    for name in ("part-0.parquet", "other.txt"):
        with open(f"{d}/t/{name}", "w") as f:
            f.write("not a table")

    def build():
        raise AssertionError("must not be built")

    with pytest.raises(Exception):  # noqa: B017 - whatever Spark's reader raises
        JB.load_or_build_features(spark, f"{d}/t", build, rebuild=False).collect()
    assert sorted(os.listdir(f"{d}/t")) == ["other.txt", "part-0.parquet"]
