"""Physical-plan checks: one entity shuffle for all windows, no Python, no cartesian product."""

import re

from panelscope.plans import catalog as CAT

SF = "/root/testdata/sf0.001"


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_yearly_features_plan_shape(spark):
    df = CAT.events_features(spark, SF).unpersist()
    from panelscope.operators import features as FE
    from panelscope.sources import tables as T
    from panelscope.operators import clean as C

    p = C.with_sample_weight(T.events_daily(spark, SF).withColumn("implied_exposure", C.implied_exposure()).persist())
    f = FE.yearly_features(p, unique_keys=True)
    plan = f._jdf.queryExecution().optimizedPlan().toString()
    phys = plan_text(f)
    # lags, gap, label and outcome marker share one Window operator over one entity partitioning
    entity_windows = [ln for ln in phys.splitlines() if re.search(r"Window \[.*\], \[entity#\d+\]", ln)]
    assert len(entity_windows) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(entity#\d+, \d+\)", phys)) == 1
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in phys and bad not in plan
    assert df is not None


def test_scan_prunes_columns(spark):
    from panelscope.sources import tables as T

    phys = plan_text(T.events_daily(spark, SF))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", phys)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "user_id", "value"}


def test_no_nested_loop_cartesian_or_python_in_registered_queries(spark):
    from panelscope.plans.catalog import QUERIES

    names = ["clean_panel", "sample_weight", "yearly_features", "monthly_features", "training_filter_counts",
             "split_semi_anti", "flag_top_quartile", "naive_flags", "backtest_summary", "calibration_deciles",
             "score_distribution", "roc_points", "auc_delta", "risk_percentile", "score_requests", "resolve_names",
             "latest_period_rows", "format_metrics"]
    for name in names:
        phys = plan_text(QUERIES[name](spark, SF))
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in phys, f"{name}: {bad}"
