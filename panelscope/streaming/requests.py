"""Request-at-a-time scoring as a Structured Streaming job.

Request files that land in a folder meet the static side in two stream-static joins and go to a
Parquet file sink. The sink's log and the checkpoint commit each batch exactly once, so the query
may stop and start again at any time. No operator keeps state, so there is no watermark.

The static side is published as a version of its own: the scored, ranked rows and the bounds of
each entity, two tables in a new folder. A stream reads the version it is given; a later version takes over when
the query is started again with it on the same checkpoint, without a request lost or answered twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.scoring import YEAR_BOUNDS, answers, entity_bounds, scored_table, status_of, validate_requests

REQUEST_SCHEMA = "request_id long, raw_key string, as_of_period int"


def publish(features: DataFrame, score: Callable[[DataFrame], DataFrame], model_features: Sequence[str], folder: str,
            size_bound: int | None = None) -> str:
    """Write a version of the static side into `folder`; returns its place."""
    version = f"{folder}/version-{uuid.uuid4().hex}"
    scored_table(features, score, model_features, size_bound).write.parquet(f"{version}/scored")
    entity_bounds(features, model_features).write.parquet(f"{version}/entities")
    return version


def answered(spark: SparkSession, requests: DataFrame, version: str, model_features: Sequence[str], model_version: str,
             model_type: str, bounds: tuple[int, int] = YEAR_BOUNDS) -> DataFrame:
    """Requests, a table or a stream, joined to a published version. Keys of invalid requests are NULL and meet nothing."""
    req = validate_requests(requests, bounds=bounds)
    req = req.withColumn("__key", F.when(~F.col("invalid"), F.col("entity")))
    entities = spark.read.parquet(f"{version}/entities").withColumnRenamed("entity", "__key")
    met = req.join(entities, "__key", "left").withColumn("resolved_period", F.coalesce("as_of_period", "available_periods_max"))
    scored = spark.read.parquet(f"{version}/scored").withColumnsRenamed({"entity": "__key", "period": "resolved_period"})
    met = met.join(scored.withColumn("__hit", F.lit(True)), ["__key", "resolved_period"], "left")
    status = F.when(~F.col("invalid"), status_of(F.col("__exists"), F.col("available_periods_max"), F.col("__hit")))
    return answers(met.withColumn("status", status), model_features, model_version, model_type)


def start_request_stream(
    spark: SparkSession,
    requests_dir: str,
    version: str,
    model_features: Sequence[str],
    output_dir: str,
    checkpoint_dir: str,
    model_version: str = "dev",
    model_type: str = "calibrated_weighted_logistic_regression",
    bounds: tuple[int, int] = YEAR_BOUNDS,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; with `available_now` it processes every file present, then stops."""
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = answered(spark, reader.parquet(requests_dir), version, model_features, model_version, model_type, bounds)
    writer = out.writeStream.format("parquet").option("path", output_dir).option("checkpointLocation", checkpoint_dir).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
