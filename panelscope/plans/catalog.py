"""Registered queries: one callable `(spark, sf_dir) -> DataFrame` per operator.

Every query reads the given tables (or panels Spark derives from them) in full.
Computed doubles are rounded to 6 digits so the SQL oracle can compare values.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions import values as V
from ..operators import clean as C
from ..operators import features as FE
from ..operators import training as TR
from ..operators import metrics as MT
from ..operators import ranking as RK
from ..functions import scores as SC
from ..operators import isotonic as ISO
from ..operators import model as MD
from ..operators import scoring as SCO
from ..operators import resolve as RS
from . import backtest as BT
from . import jobs as JB
from ..functions import text as FM
from ..operators.util import round6
from ..sources import raw as R
from ..session import ensure_checkpoint_dir
from ..sources import tables as T
from ..streaming import requests as RQ


# ----------------------------------------------------------------- panels ----

class EventsPipeline(NamedTuple):
    panel: DataFrame      # B1 with implied exposure and capped weight
    features: DataFrame   # yearly feature table (persisted)
    rows: int             # panel rows: a proven bound on every group derived from it
    periods: int          # distinct periods


def events_pipeline(spark: SparkSession, sf: str) -> EventsPipeline:
    """B1 panel (persisted; it feeds several passes), its profile, and the features.

    The profile (one small aggregate) gives a proven row bound that spares the
    per-operator group-size checks on everything derived from this panel."""
    p = T.events_daily(spark, sf).withColumn("implied_exposure", C.implied_exposure()).persist()
    rows, periods = FE.panel_profile(p)
    w = C.with_sample_weight(p, size_bound=rows)
    f = FE.yearly_features(w, unique_keys=True, profile=(rows, periods)).persist()
    return EventsPipeline(w, f, rows, periods)


def weighted_events_panel(spark: SparkSession, sf: str) -> DataFrame:
    return events_pipeline(spark, sf).panel


def events_features(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly feature table over B1 (keys unique by construction: one groupBy)."""
    return events_pipeline(spark, sf).features


FEATURE_DOUBLES = {"lag_1", "lag_3_mean_obs", "lag_5_mean_obs", "sample_weight"}


def _r(df: DataFrame, cols) -> DataFrame:
    return df.select(*[round6(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------- sources, schema ----

def q_column_mapping(spark, sf):
    raw = R.raw_yearly_text(spark, sf)
    return C.map_columns(raw, C.YEARLY_REQUIRED)


def q_normalize_key(spark, sf):
    raw = R.raw_yearly_text(spark, sf)
    return raw.select("row_id", F.col("CoFIPS").alias("raw_key"), K.normalize_key("CoFIPS").alias("entity"))


def q_normalize_key_numeric(spark, sf):
    raw = R.raw_monthly_text(spark, sf)
    return raw.select(
        "row_id", F.col("County_FIPS").alias("raw_key"), K.normalize_key_numeric("County_FIPS").alias("entity")
    )


def q_normalize_key_request(spark, sf):
    raw = R.raw_yearly_text(spark, sf)
    return raw.select("row_id", F.col("CoFIPS").alias("raw_key"), K.normalize_key_request("CoFIPS").alias("entity"))


def q_repad_key(spark, sf):
    raw = R.raw_yearly_text(spark, sf)
    return raw.select("row_id", F.col("CoFIPS").alias("raw_key"), K.repad_key("CoFIPS").alias("entity"))


def q_coerce_numeric(spark, sf):
    raw = R.raw_yearly_text(spark, sf)
    return raw.select(
        "row_id",
        V.coerce_double("Year").alias("year_value"),
        V.coerce_int_truncated("Year").alias("year_int"),
        V.coerce_double("filings").alias("filings_value"),
        V.coerce_double("Filing_Rate").alias("rate_value"),
    )


def q_month_floor(spark, sf):
    raw = R.raw_monthly_text(spark, sf)
    return raw.select("row_id", V.month_floor("MONTH").alias("month"))


def q_invalid_row_counts(spark, sf):
    return C.invalid_row_counts(R.raw_yearly_text(spark, sf))


def q_invalid_row_counts_monthly(spark, sf):
    return C.invalid_row_counts_monthly(R.raw_monthly_text(spark, sf))


def q_weight_audit(spark, sf):
    panel = T.events_daily(spark, sf).withColumn("implied_exposure", C.implied_exposure())
    return _r(C.weight_audit(panel), {"weight_cap"})


def q_clean_panel(spark, sf):
    panel = C.clean_panel(R.raw_yearly_text(spark, sf))
    return _r(panel, {"exposure_count", "rate", "implied_exposure", "sample_weight"})


def q_clean_panel_monthly(spark, sf):
    panel = C.clean_panel_monthly(R.raw_monthly_text(spark, sf))
    return _r(panel, {"rate"})


def q_implied_exposure(spark, sf):
    p = T.events_daily(spark, sf)
    return p.select("entity", "period", round6(C.implied_exposure()).alias("implied_exposure"))


def q_sample_weight(spark, sf):
    p = weighted_events_panel(spark, sf)
    return p.select("entity", "period", round6("implied_exposure").alias("implied_exposure"),
                    round6("sample_weight").alias("sample_weight"))


def q_duplicate_keys(spark, sf):
    typed = C.typed_yearly(R.raw_yearly_text(spark, sf)).where(F.col("entity").isNotNull() & F.col("period").isNotNull())
    return FE.duplicate_keys(typed)


# --------------------------------------------------------------- features ----

def q_lag_features(spark, sf):
    f = FE.lag_features(T.events_daily(spark, sf))
    return _r(f.select("entity", "period", *FE.YEARLY_FEATURE_COLUMNS), {"lag_1", "lag_3_mean_obs", "lag_5_mean_obs"})


def q_period_threshold_flag(spark, sf):
    f = FE.period_threshold_flags(T.events_daily(spark, sf))
    return _r(f.select("entity", "period", "rate", "threshold", "flag"), {"rate", "threshold"})


def q_next_period_label(spark, sf):
    flagged = FE.period_threshold_flags(T.events_daily(spark, sf))
    return FE.next_period_label_window(flagged).select("entity", "period", "y")


def q_next_period_label_join(spark, sf):
    base = T.events_daily(spark, sf)
    flagged = FE.period_threshold_flags(base)
    return FE.next_period_label_join(base, flagged).select("entity", "period", "y")


def q_outcome_observed(spark, sf):
    from pyspark.sql import Window

    p = T.events_daily(spark, sf)
    nxt = Window.partitionBy("entity").orderBy("period").rangeBetween(1, 1)
    return p.select(
        "entity", "period", (F.count(F.lit(1)).over(nxt) > 0).cast("int").alias("has_outcome_observation")
    )


def q_yearly_features(spark, sf):
    return _r(events_features(spark, sf), {"lag_1", "lag_3_mean_obs", "lag_5_mean_obs", "sample_weight"})


def q_yearly_features_orders(spark, sf):
    p = T.orders_yearly(spark, sf).withColumn("implied_exposure", C.implied_exposure())
    f = FE.yearly_features(C.with_sample_weight(p), unique_keys=True)
    return _r(f, {"lag_1", "lag_3_mean_obs", "lag_5_mean_obs", "sample_weight"})


def q_yearly_features_raw(spark, sf):
    """W6 from the raw text rows, whose keys repeat: copies are averaged first."""
    f = FE.yearly_features(C.clean_panel(R.raw_yearly_text(spark, sf)), on_duplicates="average")
    return _r(f, {"lag_1", "lag_3_mean_obs", "lag_5_mean_obs", "sample_weight"})


def q_lag_features_monthly(spark, sf):
    f = FE.lag_features_monthly(T.supplier_monthly(spark, sf))
    return _r(f.select("entity", "month", *FE.MONTHLY_FEATURE_COLUMNS), {"lag_1", "lag_3_mean", "lag_12_mean"})


def q_next_month_label(spark, sf):
    flagged = FE.period_threshold_flags(T.supplier_monthly(spark, sf), period="month")
    return FE.next_month_label_window(flagged).select("entity", "month", "y")


def supplier_features(spark, sf) -> DataFrame:
    """Monthly feature table over B3 (panel persisted and profiled once)."""
    p = T.supplier_monthly(spark, sf).persist()
    return FE.monthly_features(p, unique_keys=True, profile=FE.panel_profile(p, "month")).persist()


def q_monthly_features(spark, sf):
    return _r(supplier_features(spark, sf), {"lag_1", "lag_3_mean", "lag_12_mean"})


def q_monthly_features_by_increments(spark, sf):
    """The same table from three deliveries of months, each added to the table of those before."""
    p = T.supplier_monthly(spark, sf).persist()
    months = [r[0] for r in p.select("month").distinct().orderBy("month").collect()]  # a row for each month
    folder = f"{ensure_checkpoint_dir(spark)}/monthly-{uuid.uuid4().hex}"
    cuts = [months[0], months[len(months) // 2], months[-1]] if len(months) > 2 else months[:1]
    out = None
    for lo, hi in zip(cuts, [*cuts[1:], None]):
        part = p.where((F.col("month") >= lo) & (F.col("month") < hi if hi else F.lit(True)))
        out = JB.add_periods(spark, folder, part, lambda rows: FE.monthly_features(rows, unique_keys=True), time="month")
    p.unpersist()
    return _r(JB.standardize_monthly_features(out), {"lag_1", "lag_3_mean", "lag_12_mean"})


# --------------------------------------------------------------- training ----

def q_training_set(spark, sf):
    return _r(TR.training_set(events_features(spark, sf)), FEATURE_DOUBLES)


def q_leakage_violations(spark, sf):
    return TR.leakage_violations(TR.training_set(events_features(spark, sf)))


def q_training_row_audit(spark, sf):
    return TR.training_row_audit(events_features(spark, sf))


def q_training_filter_counts(spark, sf):
    return TR.training_filter_counts(events_features(spark, sf))


def _split_frame(train: DataFrame, test: DataFrame, cols) -> DataFrame:
    return train.select(*cols, F.lit("train").alias("split")).unionByName(
        test.select(*cols, F.lit("test").alias("split"))
    )


def q_split_by_period(spark, sf):
    train, test, _ = TR.split_by_period(events_features(spark, sf), 2)
    return _split_frame(train, test, ["entity", "period", "outcome_period", "y"])


def q_split_by_outcome(spark, sf):
    f = events_features(spark, sf)
    held = [r[0] for r in TR.latest_k_periods(TR.labelled_rows(f), 2, "outcome_period").collect()]
    train, test = TR.split_by_outcome(f, held)
    return _split_frame(train, test, ["entity", "period", "outcome_period", "y"])


def q_split_by_month(spark, sf):
    fm = supplier_features(spark, sf)
    train, test, _ = TR.split_by_month(fm, 6)
    return _split_frame(train, test, ["entity", "month", "y"])


def q_fit_calibration_split(spark, sf):
    f = events_features(spark, sf)
    held = [r[0] for r in TR.latest_k_periods(TR.labelled_rows(f), 1, "outcome_period").collect()]
    train, _ = TR.split_by_outcome(f, held)
    fit, cal, _ = TR.fit_calibration_split(train)
    cols = ["entity", "period", "outcome_period", "y"]
    return fit.select(*cols, F.lit("fit").alias("part")).unionByName(cal.select(*cols, F.lit("calibration").alias("part")))


def q_latest_k_periods(spark, sf):
    return TR.latest_k_periods(TR.labelled_rows(events_features(spark, sf)), 2)


def q_latest_period_rows(spark, sf):
    return _r(TR.latest_period_rows(events_features(spark, sf)), FEATURE_DOUBLES)


# ------------------------------------------------- metrics (fixed scores) ----

# Explicit coefficients used to score rows for SQL-checked metrics
# (no fitted model, so both engines see the same scores).
FIXED_INTERCEPT = -3.0
FIXED_COEFFICIENTS = {"lag_1": 0.02, "lag_3_mean_obs": 0.02, "lag_5_mean_obs": 0.02, "periods_since_last_obs": -0.1}


def fixed_score() -> F.Column:
    return round6(SC.logistic_score(FIXED_INTERCEPT, FIXED_COEFFICIENTS)).alias("risk_score")


def fixed_detail_bound(spark, sf, holdout_count: int = 2) -> tuple[DataFrame, int, DataFrame]:
    """E1 with fixed parameters: the last `holdout_count` outcome periods, scored and
    flagged; with the panel row bound and the feature table."""
    ev = events_pipeline(spark, sf)
    f = ev.features
    held = [r[0] for r in TR.latest_k_periods(TR.labelled_rows(f), holdout_count, "outcome_period").collect()]
    _, test = TR.split_by_outcome(f, held)
    scored = test.select("entity", "period", "outcome_period", "y", fixed_score())
    return MT.flag_top_quartile(scored, size_bound=ev.rows).persist(), ev.rows, f


def fixed_holdout_detail(spark, sf, holdout_count: int = 2) -> DataFrame:
    return fixed_detail_bound(spark, sf, holdout_count)[0]


def q_score_with_params(spark, sf):
    f = events_features(spark, sf).dropna(subset=FE.YEARLY_FEATURE_COLUMNS)
    return f.select("entity", "period", fixed_score())


def q_flag_top_quartile(spark, sf):
    return fixed_holdout_detail(spark, sf)


def q_naive_flags(spark, sf):
    d, n, f = fixed_detail_bound(spark, sf)
    return _r(MT.naive_flags(d, f, size_bound=n), {"lag_1"})


def q_naive_join_guard(spark, sf):
    d, _, f = fixed_detail_bound(spark, sf)
    lag = f.select("entity", "period", "lag_1")
    return d.join(lag, ["entity", "period"], "left").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("lag_1").isNull()).alias("missing_lag_1")
    )


def q_risk_percentile(spark, sf):
    ev = events_pipeline(spark, sf)
    scored = ev.features.dropna(subset=FE.YEARLY_FEATURE_COLUMNS).select("entity", "period", fixed_score())
    return _r(RK.percentile_in_group(scored, ["period"], "risk_score", size_bound=ev.rows), {"risk_percentile"})


def q_precision_recall_at_half(spark, sf):
    return MT.precision_recall_at_half(fixed_holdout_detail(spark, sf))


def q_top_quartile_metrics(spark, sf):
    d, n, _ = fixed_detail_bound(spark, sf)
    return _r(MT.top_quartile_metrics(d, size_bound=n), {"positive_rate", "auc"})


def q_backtest_summary(spark, sf):
    d, n, _ = fixed_detail_bound(spark, sf)
    return _r(MT.backtest_summary(d, size_bound=n), {"auc"})


def q_roc_auc(spark, sf):
    d, n, _ = fixed_detail_bound(spark, sf)
    return _r(RK.roc_auc(d, ["outcome_period"], size_bound=n), {"auc"})


def q_calibration_deciles(spark, sf):
    d, n, _ = fixed_detail_bound(spark, sf)
    return _r(MT.calibration_deciles(d, size_bound=n), {"mean_pred", "observed_rate"})


def q_score_distribution(spark, sf):
    d, n, _ = fixed_detail_bound(spark, sf)
    return _r(MT.score_distribution(d, size_bound=n), set(MT.DISTRIBUTION_NAMES))


def q_roc_points(spark, sf):
    d, n, _ = fixed_detail_bound(spark, sf)
    return _r(RK.roc_points(d, [], size_bound=n), {"fpr", "tpr"})


def q_auc_delta(spark, sf):
    """Model AUC minus naive (lag_1) AUC, in basis points, for the last-1 and last-2 holdouts."""
    d, bound, f = fixed_detail_bound(spark, sf, 2)
    d = d.join(f.select("entity", "period", "lag_1"), ["entity", "period"])
    last = d.agg(F.max("outcome_period")).first()[0]
    # Each row once for each holdout that it belongs to and each of the two scores: one grouped AUC.
    held = F.when(F.col("outcome_period") == F.lit(last), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    each = d.select("y", F.explode(held).alias("holdout_periods"), "risk_score", "lag_1").select(
        "y", "holdout_periods", F.inline(F.array(F.struct(F.lit("model").alias("scored_by"), F.col("risk_score").alias("score")),
                                                 F.struct(F.lit("naive").alias("scored_by"), F.col("lag_1").cast("double").alias("score")))))
    auc = RK.roc_auc(each, ["holdout_periods", "scored_by"], score="score", size_bound=bound)
    out = auc.groupBy("holdout_periods").agg(
        F.max(F.when(F.col("scored_by") == "model", F.col("auc"))).alias("model_auc"),
        F.max(F.when(F.col("scored_by") == "naive", F.col("auc"))).alias("naive_auc"))
    return out.select("holdout_periods", round6("model_auc").alias("model_auc"), round6("naive_auc").alias("naive_auc"),
                      round6((F.col("model_auc") - F.col("naive_auc")) * 10000).alias("delta_bps"))


def q_top_predicted(spark, sf):
    d = fixed_holdout_detail(spark, sf, 1)
    return MT.top_rows(d, 25, "predicted")


def q_top_misses(spark, sf):
    return MT.top_rows(fixed_holdout_detail(spark, sf, 1), 25, "misses")


def q_top_surprises(spark, sf):
    return MT.top_rows(fixed_holdout_detail(spark, sf, 1), 25, "surprises")


def q_period_ranges(spark, sf):
    f = events_features(spark, sf)
    return f.agg(
        F.min("period").alias("period_min"), F.max("period").alias("period_max"),
        F.count_distinct("period").alias("distinct_periods"), F.count(F.lit(1)).alias("rows"),
        F.min("outcome_period").alias("outcome_period_min"), F.max("outcome_period").alias("outcome_period_max"),
    )


def q_format_metrics(spark, sf):
    d, n, _ = fixed_detail_bound(spark, sf)
    s = MT.backtest_summary(d, size_bound=n)
    return s.select("outcome_period", "level", FM.pct_text("precision_at_top_quartile").alias("precision_text"),
                    FM.pct_text("recall_at_top_quartile").alias("recall_text"), FM.auc_text("auc").alias("auc_text"))


# ------------------------------------------------ models (rows-only checks) ----

def _train_rows(spark, sf):
    f = events_features(spark, sf)
    return TR.training_set(f)


def q_select_regularization(spark, sf):
    train, _, _ = TR.split_by_period(_train_rows(spark, sf), 2)
    fit, cal, _ = TR.fit_calibration_split(TR.labelled_rows(train))
    best, tried = MD.select_regularization(fit, cal, FE.YEARLY_FEATURE_COLUMNS)
    rows = [(float(c), auc, c == best) for c, auc in tried] or [(best, None, True)]
    return _r(spark.createDataFrame(rows, "c double, calibration_auc double, chosen boolean"), {"calibration_auc"})


def q_isotonic_pools(spark, sf):
    """M7: the isotonic curve of all labelled rows of all periods under the fixed scores, pool by pool."""
    scored = TR.labelled_rows(events_features(spark, sf)).select("y", fixed_score())
    pools = ISO.isotonic_pools(scored, "risk_score")
    return pools.select("lo", "hi", F.col("n").alias("rows"), "positives", round6(F.col("positives") / F.col("n")).alias("value"))


def q_isotonic_scores(spark, sf):
    """M7: every scoreable row's fixed score through that curve."""
    f = events_features(spark, sf)
    curve = ISO.fit_isotonic(TR.labelled_rows(f).select("y", fixed_score()), "risk_score")
    rows = f.dropna(subset=FE.YEARLY_FEATURE_COLUMNS).select("entity", "period", fixed_score())
    return _r(curve.transform(rows, "risk_score", "calibrated"), {"calibrated"})


def q_fit_weighted_logit(spark, sf):
    train, _, _ = TR.split_by_period(_train_rows(spark, sf), 2)
    b0, bs = MD.fit_logit(train, FE.YEARLY_FEATURE_COLUMNS, MD.DEFAULT_C)
    names = ["intercept", *FE.YEARLY_FEATURE_COLUMNS]
    return _r(spark.createDataFrame(list(zip(names, [b0, *bs])), "term string, coefficient double"), {"coefficient"})


def _trained(spark, sf):
    train, test, _ = TR.split_by_period(_train_rows(spark, sf), 2)
    return MD.train_calibrated(train), test


def q_calibrate_scores(spark, sf):
    model, test = _trained(spark, sf)
    return model.transform(TR.labelled_rows(test)).select(
        "entity", "period", round6(model.raw_probability()).alias("raw_probability"),
        round6("risk_score").alias("risk_score"), F.lit(model.calibration_method).alias("calibration_method"))


def q_score_rows(spark, sf):
    model, _ = _trained(spark, sf)
    return _r(MD.score_rows(model, events_features(spark, sf)), {"risk_score"})


def q_score_latest(spark, sf):
    model, _ = _trained(spark, sf)
    return _r(MD.score_rows(model, TR.latest_period_rows(events_features(spark, sf))), {"risk_score"})


def q_fit_monthly_logit(spark, sf):
    out = JB.train_monthly_job(supplier_features(spark, sf), 6)
    m = out["model"]
    rows = list(zip(["intercept", *m.features], [m.intercept, *m.coefficients]))
    return _r(spark.createDataFrame(rows, "term string, coefficient double"), {"coefficient"})


def q_score_latest_monthly(spark, sf):
    """M9 (monthly): the monthly table keeps labelled rows only, so its latest month is the
    last labelled one (SURVEY X3); train on the rest, score that month."""
    fm = supplier_features(spark, sf)
    model = JB.train_monthly_job(fm, 6)["model"]
    return _r(MD.score_rows(model, TR.latest_period_rows(fm, "month"), keys=("entity", "month")), {"risk_score"})


def q_model_params(spark, sf):
    model, _ = _trained(spark, sf)
    return model.params_frame(spark)


def _parameters(spark, model) -> DataFrame:
    """A model's parameters, a row for each."""
    rows = [("chosen_regularization_c", model.chosen_c), ("intercept", model.intercept), *zip(model.features, model.coefficients),
            ("sigmoid_a", model.sigmoid_a), ("sigmoid_b", model.sigmoid_b)]
    return _r(spark.createDataFrame(rows, "parameter string, value double"), {"value"})


def q_model_parameters(spark, sf):
    return _parameters(spark, _trained(spark, sf)[0])


def q_final_parameters(spark, sf):
    return _parameters(spark, JB.train_final(events_features(spark, sf)))


def q_holdout_detail(spark, sf):
    model, test = _trained(spark, sf)
    return _r(BT.holdout_detail(model, test), {"risk_score"})


def q_evaluate_half(spark, sf):
    model, test = _trained(spark, sf)
    return BT.evaluate_half(model, test)


def q_backtest_last_period(spark, sf):
    f = events_features(spark, sf)
    _, _, metrics = BT.backtest(f, BT.last_outcome_periods(f, 1))
    return _r(metrics, {"positive_rate", "auc"})


def q_backtest_last_two(spark, sf):
    runs = BT.backtest_last_two(events_features(spark, sf))
    both = runs["last_period"][2].withColumn("holdout", F.lit("last_period")).unionByName(
        runs["last_two_periods"][2].withColumn("holdout", F.lit("last_two_periods")))
    return _r(both, {"positive_rate", "auc"})


def q_train_job(spark, sf):
    return JB.train_job(spark, events_features(spark, sf), source=sf)["metrics"]


def q_backtest_report(spark, sf):
    return _r(BT.backtest_report(events_features(spark, sf))["comparison"], {"auc"})


REPORT_DOUBLES = {"auc", "risk_score", "p01", "p05", "p50", "p95", "p99"}


def _report_query(name: str):
    """One table of the backtest report."""
    def run(spark, sf):
        return _r(BT.backtest_report(events_features(spark, sf))[name], REPORT_DOUBLES)

    return run


REPORT_QUERIES = {f"report_{name}": _report_query(name) for name in (
    "model_by_period", "model_last_period", "naive_by_period", "score_distribution", "top_predicted", "top_misses", "top_surprises")}


def q_train_final(spark, sf):
    """E5 (final): the model trained on every training row, as its parameter row."""
    return JB.train_final(events_features(spark, sf)).params_frame(spark)


def q_score_requests_model(spark, sf):
    """R1 with the final fitted model (the original's serving path); NULL periods
    resolve to each entity's latest scoreable period (M10)."""
    ev = events_pipeline(spark, sf)
    model = JB.train_final(ev.features)
    out = SCO.score_requests(T.event_requests(spark, sf), ev.features, model.transform, FE.YEARLY_FEATURE_COLUMNS,
                             "final", JB.MODEL_TYPE, bounds=T.EVENT_PERIOD_BOUNDS, size_bound=ev.rows)
    return _r(out.drop("features_used"), {"risk_score", "risk_percentile_in_period", "feature_lag_1", "feature_lag_3_mean_obs",
                                          "feature_lag_5_mean_obs", "feature_periods_since_last_obs"})


def q_model_metadata(spark, sf):
    return JB.train_job(spark, events_features(spark, sf), source=sf)["metadata"]


# --------------------------------------------------------- request scoring ----

def _scored_requests(spark, sf):
    ev = events_pipeline(spark, sf)
    return SCO.score_requests(
        T.event_requests(spark, sf), ev.features,
        lambda df: df.withColumn("risk_score", fixed_score()),
        FE.YEARLY_FEATURE_COLUMNS, "fixed-params", "logistic_fixed_params", bounds=T.EVENT_PERIOD_BOUNDS,
        size_bound=ev.rows,
    )


def q_features_used(spark, sf):
    """The nested map of features behind each score, a row for each entry."""
    out = _scored_requests(spark, sf).select("request_id", F.explode("features_used").alias("feature", "value"))
    return _r(out, {"value"})


def q_score_requests(spark, sf):
    out = _scored_requests(spark, sf)
    return _r(out.drop("features_used"), {"risk_percentile_in_period", "feature_lag_1", "feature_lag_3_mean_obs",
                                          "feature_lag_5_mean_obs", "feature_periods_since_last_obs"})


def q_score_request_stream(spark, sf):
    """All requests as a stream of files against a published version, read back from the file sink."""
    ev = events_pipeline(spark, sf)
    work = f"{ensure_checkpoint_dir(spark)}/request-stream-{uuid.uuid4().hex}"
    T.event_requests(spark, sf).write.parquet(f"{work}/requests")
    version = RQ.publish(ev.features, lambda df: df.withColumn("risk_score", fixed_score()), FE.YEARLY_FEATURE_COLUMNS, f"{work}/static", ev.rows)
    stream = RQ.start_request_stream(spark, f"{work}/requests", version, FE.YEARLY_FEATURE_COLUMNS, f"{work}/answers", f"{work}/checkpoint",
                                     "fixed-params", "logistic_fixed_params", T.EVENT_PERIOD_BOUNDS)
    stream.awaitTermination()
    out = spark.read.parquet(f"{work}/answers")
    return _r(out.drop("features_used"), {"risk_percentile_in_period", "feature_lag_1", "feature_lag_3_mean_obs",
                                          "feature_lag_5_mean_obs", "feature_periods_since_last_obs"})


def q_request_validation(spark, sf):
    v = SCO.validate_requests(T.event_requests(spark, sf), bounds=T.EVENT_PERIOD_BOUNDS)
    return v.select("request_id", "raw_key", "as_of_period", "entity", "invalid")


def q_score_requests_resolve(spark, sf):
    f = events_features(spark, sf)
    v = SCO.validate_requests(T.event_requests(spark, sf), bounds=T.EVENT_PERIOD_BOUNDS)
    keys = v.where(~F.col("invalid")).select("entity", "as_of_period").distinct()
    info = SCO.entity_bounds(f, FE.YEARLY_FEATURE_COLUMNS).drop("__exists")
    return keys.join(info, "entity", "left").withColumn(
        "resolved_period", F.coalesce(F.col("as_of_period"), F.col("available_periods_max")))


# ------------------------------------------------------------ name lookup ----

# The finder queries of the name-lookup fixture.
NAME_QUERIES = ["re", "gear", "blue b", "x"]


# Letters that fold to plain ones, and signs that fold to several characters.
FOLDED_LETTERS = ("aeioukn", "áèîõüＫ𝐧")
FOLDED_SUFFIX = " № Ⅱ㎏ ½ﬄ"


def name_queries(spark) -> DataFrame:
    return spark.createDataFrame(list(enumerate(NAME_QUERIES, start=1)), "query_id long, query_text string")


def part_name_index(spark, sf):
    """Postings and gram counts of the part names, stored in the shared folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/name-index-{uuid.uuid4().hex}"
    JB.write_name_index(T.part_names(spark, sf), folder)
    return JB.name_index(spark, folder)


def q_resolve_names(spark, sf):
    return RS.resolve_names(T.part_names(spark, sf), name_queries(spark))


def q_resolve_part_names(spark, sf):
    """R2 in bulk: a piece of every part name whose key is divisible by 100, against all names."""
    p = T.part_names(spark, sf).where(F.col("ord") % 100 == 0)
    piece = F.col("name").substr((F.floor(F.col("ord") / 100) % 4 + 1).cast("int"), F.lit(6))
    return RS.resolve_indexed(*part_name_index(spark, sf), p.select(F.col("ord").alias("query_id"), piece.alias("query_text")))


def q_name_gram_counts(spark, sf):
    _, counts = part_name_index(spark, sf)
    return counts


def q_fold_names(spark, sf):
    """Every part name in letters that fold to others: accents, full width, Roman numerals, letter-like signs, beyond the basic plane."""
    p = T.part_names(spark, sf)
    written = F.concat(F.translate("name", *FOLDED_LETTERS), F.lit(FOLDED_SUFFIX))
    return p.select("key", RS.normalize_text(written).alias("normalized_name"))


def q_display_name(spark, sf):
    names = RS.clean_lookup(T.part_names(spark, sf))
    return names.select("key", "name", RS.display_name("name").alias("display_name"),
                        F.col("norm_name").alias("normalized_name"))


# ------------------------------------------------- re-typing after a text trip ----

def _as_text(df: DataFrame) -> DataFrame:
    """Every column cast to STRING, as after a CSV round trip."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def q_feature_table_compat(spark, sf):
    p = T.orders_yearly(spark, sf).withColumn("implied_exposure", C.implied_exposure())
    f = FE.yearly_features(C.with_sample_weight(p), unique_keys=True).drop("outcome_period")
    return _r(JB.standardize_features(_as_text(f)), FEATURE_DOUBLES)


def q_standardize_features(spark, sf):
    f = events_features(spark, sf)
    blanked = f.withColumn("sample_weight", F.when(F.col("period") % 7 == 0, F.lit(None)).otherwise(F.col("sample_weight")))
    return _r(JB.standardize_features(_as_text(blanked)), FEATURE_DOUBLES)


def q_standardize_monthly_features(spark, sf):
    return _r(JB.standardize_monthly_features(_as_text(supplier_features(spark, sf))), {"lag_1", "lag_3_mean", "lag_12_mean"})


def q_split_semi_anti(spark, sf):
    lab = TR.labelled_rows(events_features(spark, sf))
    held = TR.latest_k_periods(lab, 2, "outcome_period")
    train, test = TR.split_by_periods_join(lab, held, "outcome_period")
    return _split_frame(train, test, ["entity", "period", "outcome_period", "y"])


QUERIES = {
    "column_mapping": q_column_mapping,
    "normalize_key": q_normalize_key,
    "normalize_key_numeric": q_normalize_key_numeric,
    "normalize_key_request": q_normalize_key_request,
    "repad_key": q_repad_key,
    "coerce_numeric": q_coerce_numeric,
    "month_floor": q_month_floor,
    "invalid_row_counts": q_invalid_row_counts,
    "invalid_row_counts_monthly": q_invalid_row_counts_monthly,
    "weight_audit": q_weight_audit,
    "standardize_monthly_features": q_standardize_monthly_features,
    "features_used": q_features_used,
    "clean_panel": q_clean_panel,
    "clean_panel_monthly": q_clean_panel_monthly,
    "implied_exposure": q_implied_exposure,
    "sample_weight": q_sample_weight,
    "duplicate_keys": q_duplicate_keys,
    "lag_features": q_lag_features,
    "period_threshold_flag": q_period_threshold_flag,
    "next_period_label": q_next_period_label,
    "next_period_label_join": q_next_period_label_join,
    "outcome_observed": q_outcome_observed,
    "yearly_features": q_yearly_features,
    "yearly_features_orders": q_yearly_features_orders,
    "yearly_features_raw": q_yearly_features_raw,
    "lag_features_monthly": q_lag_features_monthly,
    "next_month_label": q_next_month_label,
    "monthly_features": q_monthly_features,
    "training_set": q_training_set,
    "leakage_violations": q_leakage_violations,
    "training_row_audit": q_training_row_audit,
    "training_filter_counts": q_training_filter_counts,
    "split_by_period": q_split_by_period,
    "split_by_outcome": q_split_by_outcome,
    "split_by_month": q_split_by_month,
    "fit_calibration_split": q_fit_calibration_split,
    "latest_k_periods": q_latest_k_periods,
    "latest_period_rows": q_latest_period_rows,
    "score_with_params": q_score_with_params,
    "flag_top_quartile": q_flag_top_quartile,
    "naive_flags": q_naive_flags,
    "naive_join_guard": q_naive_join_guard,
    "risk_percentile": q_risk_percentile,
    "precision_recall_at_half": q_precision_recall_at_half,
    "top_quartile_metrics": q_top_quartile_metrics,
    "backtest_summary": q_backtest_summary,
    "roc_auc": q_roc_auc,
    "calibration_deciles": q_calibration_deciles,
    "score_distribution": q_score_distribution,
    "roc_points": q_roc_points,
    "auc_delta": q_auc_delta,
    "top_predicted": q_top_predicted,
    "top_misses": q_top_misses,
    "top_surprises": q_top_surprises,
    "period_ranges": q_period_ranges,
    "format_metrics": q_format_metrics,
    "select_regularization": q_select_regularization,
    "isotonic_pools": q_isotonic_pools,
    "isotonic_scores": q_isotonic_scores,
    "fit_weighted_logit": q_fit_weighted_logit,
    "calibrate_scores": q_calibrate_scores,
    "score_rows": q_score_rows,
    "score_latest": q_score_latest,
    "fit_monthly_logit": q_fit_monthly_logit,
    "score_latest_monthly": q_score_latest_monthly,
    "model_params": q_model_params,
    "model_parameters": q_model_parameters,
    "final_parameters": q_final_parameters,
    "holdout_detail": q_holdout_detail,
    "evaluate_half": q_evaluate_half,
    "backtest_last_period": q_backtest_last_period,
    "backtest_last_two": q_backtest_last_two,
    "train_job": q_train_job,
    "backtest_report": q_backtest_report,
    "model_metadata": q_model_metadata,
    "train_final": q_train_final,
    "score_requests_model": q_score_requests_model,
    "score_requests": q_score_requests,
    "score_request_stream": q_score_request_stream,
    "request_validation": q_request_validation,
    "score_requests_resolve": q_score_requests_resolve,
    "resolve_names": q_resolve_names,
    "resolve_part_names": q_resolve_part_names,
    "name_gram_counts": q_name_gram_counts,
    "fold_names": q_fold_names,
    "display_name": q_display_name,
    "feature_table_compat": q_feature_table_compat,
    "standardize_features": q_standardize_features,
    "split_semi_anti": q_split_semi_anti,
    "monthly_features_by_increments": q_monthly_features_by_increments,
    **REPORT_QUERIES,
}
