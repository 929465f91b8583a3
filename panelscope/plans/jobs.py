"""End-to-end jobs: build features, train, evaluate, describe, export.

Jobs write Parquet / JSON tables under an output folder on shared storage. A
written feature table is also the lineage cut between the expensive panel
build and the many passes of training and evaluation.
"""

from __future__ import annotations

import datetime as dt
import platform

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import repad_key
from ..operators import clean as C
from ..operators import features as FE
from ..operators import resolve as RS
from ..operators import training as TR
from ..operators.model import CalibratedLogit, train_calibrated, train_monthly
from ..operators.util import materialize
from .backtest import evaluate_half

# Descriptive metadata text.
LABEL_DEFINITION = "y = 1 when the entity's next-period rate is in that period's top quartile (rate >= p75)."
LIMITATIONS = [
    "Scores rank entities within a period; they are not calibrated across very different periods.",
    "Only observed periods are used; gaps are not imputed.",
    "The label needs an observation at exactly the next period.",
]
MODEL_TYPE = "calibrated_weighted_logistic_regression"


def standardize_features(df: DataFrame) -> DataFrame:
    """Re-type a yearly feature table read back from text."""
    out = df
    if "outcome_period" not in out.columns:  # S5: older tables lack it
        out = out.withColumn("outcome_period", F.col("period").try_cast("int") + 1)
    return out.select(
        repad_key("entity").alias("entity"),
        F.col("period").try_cast("int").alias("period"),
        F.col("outcome_period").try_cast("int").alias("outcome_period"),
        F.col("y").try_cast("double").cast("int").alias("y"),
        *[F.col(c).try_cast("double").alias(c) for c in ["lag_1", "lag_3_mean_obs", "lag_5_mean_obs"]],
        F.col("periods_since_last_obs").try_cast("double").cast("int").alias("periods_since_last_obs"),
        F.coalesce(F.col("sample_weight").try_cast("double"), F.lit(C.DEFAULT_SAMPLE_WEIGHT)).alias("sample_weight"),
    )


def standardize_monthly_features(df: DataFrame) -> DataFrame:
    """Re-type a monthly feature table read back from text."""
    return df.select(
        repad_key("entity").alias("entity"),
        F.to_date(F.col("month").cast("string")).alias("month"),
        F.col("y").try_cast("double").cast("int").alias("y"),
        *[F.col(c).try_cast("double").alias(c) for c in ["lag_1", "lag_3_mean", "lag_12_mean"]],
        F.col("month_of_year").try_cast("double").cast("int").alias("month_of_year"),
    )


def metrics_summary(metrics: DataFrame) -> DataFrame:
    """The compact metrics summary kept in metadata (six keys and `overall`)."""
    keys = ["test_rows", "test_period_start", "test_period_end", "auc", "precision_at_0_5", "recall_at_0_5"]
    present = [k for k in keys if k in metrics.columns]
    return metrics.select(*present, F.struct(*present).alias("overall"))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at `path`, in whatever file system it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def load_or_build_features(spark: SparkSession, path: str, build, rebuild: bool = True, time: str = "period") -> DataFrame:
    """Read a written feature table, or build and write it first (X15: rebuild by default).

    `time` is `period` for the yearly table and `month` for the monthly one. The
    table is written partitioned by it: latest-period scoring and per-period reads
    then prune partitions instead of scanning the table, and the written table cuts
    the lineage of the panel build. A table that is there but can't be read raises;
    it is never overwritten unless `rebuild` asks for that."""
    standardize = {"period": standardize_features, "month": standardize_monthly_features}[time]
    if rebuild or not table_exists(spark, path):
        write_table(build(), path, partition_by=[time], order=["entity"])
    found = spark.read.parquet(path)
    if time == "period" and "outcome_period" not in found.columns:  # S5: an older table gets the column for good
        whole = materialize(found.withColumn("outcome_period", F.col("period").try_cast("int") + 1))  # cut off from the files it replaces
        write_table(whole, path, partition_by=[time], order=["entity"])
        found = spark.read.parquet(path)
    return standardize(found)


def add_periods(spark: SparkSession, folder: str, new: DataFrame, build, time: str = "period", history: int = 12) -> DataFrame:
    """S5/S6 as an increment: `new` panel rows, all later than those there, join the feature table under `folder`.

    A state table holds each entity's last `history` observations, all that lags, rolling means and
    gaps look back on. The features of these and the new rows are built, and the partitions from the last old period
    on (its label is known only now) are written by dynamic overwrite; earlier partitions keep their files. A state is stored
    under the period it reaches, so adding the same rows again starts from the same state and gives the
    same table. `build` makes features from panel rows; what it takes from the panel, weights say, must not depend on other periods."""
    features, states = f"{folder}/features", f"{folder}/states"
    first, last = new.agg(F.min(time), F.max(time)).first()
    if first is None:
        return spark.read.parquet(features)
    since, rows = None, new
    if table_exists(spark, states):
        known = spark.read.parquet(states).where(F.col("upto") < F.lit(first))
        since = known.agg(F.max("upto")).first()[0]
        if since is not None:
            rows = known.where(F.col("upto") == F.lit(since)).drop("upto").unionByName(new)
    table = build(rows)
    if since is not None:
        table = table.where(F.col(time) >= F.lit(since))
    write_table(table, features, partition_by=[time], order=["entity"], dynamic=True)
    latest = Window.partitionBy("entity").orderBy(F.col(time).desc())
    state = rows.withColumn("__back", F.row_number().over(latest)).where(F.col("__back") <= history).drop("__back")
    write_table(state.withColumn("upto", F.lit(last)), states, partition_by=["upto"], order=["entity"], dynamic=True)
    return spark.read.parquet(features)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                order: list[str] | None = None, dynamic: bool = False) -> None:
    """Overwrite a table as Parquet, CSV (header) or JSON, optionally partitioned; `dynamic` replaces only the partitions that `df` has.

    T1/T2: with `order` the rows are dealt out in ranges of it and sorted, so the files, in order of
    their names, hold the rows in order (of each partition, if there are any), and the statistics of row groups
    let a lookup by the first column skip all but one or two."""
    if order:
        keys = [F.col(c) for c in [*(partition_by or []), *order]]
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    w = df.write.mode("overwrite")
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def write_name_index(lookup: DataFrame, path: str) -> None:
    """R2: the lookup's postings, a folder for each bucket and files sorted by gram (a hot gram may lie in several), and its gram counts."""
    write_table(RS.name_postings(lookup), f"{path}/postings", partition_by=["bucket"], order=["gram", "ord"])
    postings, _ = name_index(lookup.sparkSession, path, counts=False)
    RS.gram_counts(postings).write.mode("overwrite").parquet(f"{path}/counts")


def name_index(spark: SparkSession, path: str, counts: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Postings and gram counts of a stored index, as `resolve.resolve_indexed` takes them."""
    return spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/counts") if counts else None


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """A raw CSV with a header, every column as STRING (no inference)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def period_ranges(features: DataFrame) -> DataFrame:
    """Period span, distinct periods and rows of a feature table."""
    return features.agg(
        F.min("period").alias("period_min"), F.max("period").alias("period_max"),
        F.count_distinct("period").alias("distinct_periods"), F.count(F.lit(1)).alias("rows"),
    )


def model_metadata(spark: SparkSession, model: CalibratedLogit, train: DataFrame, metrics: DataFrame | None,
                   model_version: str, dataset_name: str, source: str) -> DataFrame:
    """One metadata row: version, periods, label, features, parameters, metrics, provenance."""
    ranges = period_ranges(train).first()
    params = model.params_row()
    # Outcomes lie one period on; the monthly table has no such column.
    outcomes = (train.agg(F.min("outcome_period"), F.max("outcome_period")).first()
                if "outcome_period" in train.columns else (None, None))
    m = metrics.first().asDict(recursive=True) if metrics is not None else {}
    summary = {k: m.get(k) for k in ("test_rows", "auc", "precision_at_0_5", "recall_at_0_5")}
    row = {
        "model_version": model_version,
        "model_type": MODEL_TYPE,
        "trained_on_dataset_name": dataset_name,
        "training_period_min": ranges["period_min"],
        "training_period_max": ranges["period_max"],
        "training_rows": ranges["rows"],
        "outcome_period_min": outcomes[0],
        "outcome_period_max": outcomes[1],
        "label_definition": LABEL_DEFINITION,
        "feature_list": list(model.features),
        "intercept": params["intercept"],
        "coefficients": params["coefficients"],
        "calibration_method": params["calibration"]["method"],
        "chosen_regularization_c": params["chosen_regularization_c"],
        "regularization_candidates": [float(c) for c in model.c_candidates],
        "calibration_time_values": [str(v) for v in model.calibration_time_values],
        "metrics_test_period_start": None if m.get("test_period_start") is None else str(m["test_period_start"]),
        "metrics_test_period_end": None if m.get("test_period_end") is None else str(m["test_period_end"]),
        "metrics_auc": summary.get("auc"),
        "metrics_precision_at_0_5": summary.get("precision_at_0_5"),
        "metrics_recall_at_0_5": summary.get("recall_at_0_5"),
        "metrics_test_rows": summary.get("test_rows"),
        "limitations": LIMITATIONS,
        "provenance": {
            "spark_version": spark.version,
            "python_version": platform.python_version(),
            "created_at_utc": dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"),
            "data_source": source,
            "model_version": model_version,
            "training_rows": str(ranges["rows"]),
        },
    }
    schema = (
        "model_version string, model_type string, trained_on_dataset_name string, training_period_min int, "
        "training_period_max int, training_rows long, outcome_period_min int, outcome_period_max int, label_definition string, feature_list array<string>, "
        "intercept double, coefficients map<string,double>, calibration_method string, "
        "chosen_regularization_c double, regularization_candidates array<double>, calibration_time_values array<string>, "
        "metrics_test_period_start string, metrics_test_period_end string, metrics_auc double, metrics_precision_at_0_5 double, "
        "metrics_recall_at_0_5 double, metrics_test_rows long, limitations array<string>, "
        "provenance map<string,string>"
    )
    return spark.createDataFrame([tuple(row.values())], schema)


def train_job(spark: SparkSession, features: DataFrame, model_version: str = "dev", dataset_name: str = "panel",
              source: str = "", out_dir: str | None = None, test_periods: int = 2) -> dict:
    """E5: training set -> leakage guard -> time split -> train -> evaluate -> metadata.

    With `out_dir`, writes the model, metrics and metadata there."""
    training = TR.training_set(features).persist()
    if training.limit(1).count() == 0:
        raise ValueError("The training set is empty after the non-null filter.")
    TR.assert_no_leakage(training)
    train, test, held = TR.split_by_period(training, test_periods)
    model = train_calibrated(train)
    metrics = evaluate_half(model, test).persist()
    meta = model_metadata(spark, model, train, metrics, model_version, dataset_name, source)
    if out_dir:
        model.save(f"{out_dir}/model", spark)
        write_table(metrics.coalesce(1), f"{out_dir}/metrics", "json")
        write_table(meta.coalesce(1), f"{out_dir}/metadata", "json")
    return {"model": model, "metrics": metrics, "metadata": meta, "held_out_periods": held}


def train_final(features: DataFrame) -> CalibratedLogit:
    """E5 (final): train on every training row."""
    training = TR.training_set(features)
    TR.assert_no_leakage(training)
    return train_calibrated(training)


def train_monthly_job(features_m: DataFrame, test_months: int = 6) -> dict:
    """E5 (monthly): last months held out, one-hot month model, evaluation at 0.5."""
    train, test, held = TR.split_by_month(features_m, test_months)
    model = train_monthly(train)
    return {"model": model, "metrics": evaluate_half(model, test, period="month"), "held_out_months": held}


def export_training_audit(features: DataFrame, out_dir: str) -> None:
    """Row audit and step counts as CSV tables."""
    write_table(TR.training_row_audit(features), f"{out_dir}/training_row_audit", "csv", order=["entity", "as_of_period"])
    write_table(TR.training_filter_counts(features).coalesce(1).orderBy("step_index"), f"{out_dir}/training_filter_counts", "csv")


def build_yearly_features(raw: DataFrame, on_duplicates: str = "error") -> DataFrame:
    """Raw text -> clean panel -> yearly features (the CLI's build step)."""
    return FE.yearly_features(C.clean_panel(raw), on_duplicates=on_duplicates)
