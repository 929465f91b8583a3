import glob
import os
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from panelscope.operators import features as FE
from panelscope.plans import catalog as CAT
from panelscope.plans import jobs as JB
from panelscope.sources import tables as T

SF = "/root/testdata/sf0.001"


def files(folder):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/**/part-*", recursive=True)}


@pytest.fixture()
def several_files(spark):
    """Small tables stay in as many files as ranges."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def test_sorted_sinks_are_in_order_over_files(spark, several_files):
    d = tempfile.mkdtemp(prefix="layout-")
    rows = spark.range(0, 5000).select(F.format_string("%05d", (F.col("id") * 7919) % 5000).alias("entity"), (F.col("id") % 9).cast("int").alias("period"))
    JB.write_table(rows, f"{d}/csv", "csv", order=["entity", "period"])
    lines = [line for f in sorted(glob.glob(f"{d}/csv/part-*")) for line in open(f).read().splitlines()[1:]]
    assert lines == sorted(lines) and len(lines) == 5000 and len(glob.glob(f"{d}/csv/part-*")) > 1
    JB.write_table(rows, f"{d}/parquet", order=["entity", "period"])
    groups = []
    for f in glob.glob(f"{d}/parquet/part-*"):
        meta = pq.ParquetFile(f).metadata
        groups += [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
    hits = [g for g in groups if g.min <= "02500" <= g.max]
    assert len(groups) > 2 and len(hits) == 1  # a lookup reads one row group


def test_increments_equal_the_full_build_and_keep_old_files(spark):
    d = tempfile.mkdtemp(prefix="increments-")
    panel = CAT.weighted_events_panel(spark, SF).persist()
    build = lambda rows: FE.yearly_features(rows, unique_keys=True)
    old = JB.add_periods(spark, d, panel.where("period < 20"), build)
    assert old.count() == build(panel.where("period < 20")).count()
    before = files(f"{d}/features")
    for lo, hi in ((20, 21), (21, 30), (21, 30)):  # the last one twice
        table = JB.add_periods(spark, d, panel.where(f"period >= {lo} and period < {hi}"), build)
    full = build(panel)
    assert sorted(map(tuple, table.select(full.columns).collect()), key=str) == sorted(map(tuple, full.collect()), key=str)
    after = files(f"{d}/features")
    kept = {f: t for f, t in before.items() if "period=19/" not in f}
    assert kept and all(after[f] == t for f, t in kept.items())
    states = spark.read.parquet(f"{d}/states")
    assert states.groupBy("upto", "entity").count().agg(F.max("count")).first()[0] <= 12
    assert JB.add_periods(spark, d, panel.where("false"), build).count() == table.count()


def test_an_old_table_gets_the_outcome_column_for_good(spark):
    d = tempfile.mkdtemp(prefix="old-table-")
    f = CAT.events_features(spark, SF)
    JB.write_table(f.drop("outcome_period"), f"{d}/t", partition_by=["period"])
    got = JB.load_or_build_features(spark, f"{d}/t", None, rebuild=False)
    assert "outcome_period" in spark.read.parquet(f"{d}/t").columns
    assert sorted(map(tuple, got.select(f.columns).collect()), key=str) == sorted(map(tuple, f.collect()), key=str)
    times = files(f"{d}/t")
    JB.load_or_build_features(spark, f"{d}/t", None, rebuild=False)
    assert files(f"{d}/t") == times  # once
