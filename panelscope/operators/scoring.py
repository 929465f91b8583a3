"""Batch request scoring.

One join plan serves any number of requests. Each request row gets a `status`
instead of an HTTP error, and one bad request never aborts the batch:

* `invalid`             key fails the request rule, or the period is out of bounds
* `unknown_entity`      the key has no row in the feature table
* `no_scoreable_period` the entity has rows, none with every model feature
* `period_unavailable`  the requested period is not scoreable (bounds returned)
* `ok`                  scored; a NULL period resolves to the latest scoreable one

Plan: requests are reduced to distinct (entity, period) keys before any lookup
(repeated requests cost one lookup); per-entity bounds come from one aggregate
over the feature table; scores and within-period percentiles are computed only
for the periods some request resolved to. Percentiles are over every scoreable
row of the period (SURVEY X21). In the final join back, keys that many requests
share are joined where the requests lie (`hot_keys.split_join`). Invalid requests
share one key, NULL, which meets no entity. So the requests are read three times: once
for the keys, and once each for the shared and the other keys of the join back; keys,
resolved keys and their answers are kept between these reads.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import normalize_key_request
from .hot_keys import heaviest, split_join
from .ranking import percentile_in_group
from .util import broadcast_if_small, materialize

# Request statuses and the default period bounds of a request.
OK, INVALID, UNKNOWN, NO_SCOREABLE, UNAVAILABLE = (
    "ok", "invalid", "unknown_entity", "no_scoreable_period", "period_unavailable"
)
YEAR_BOUNDS = (2000, 2100)
_KEY = ["__entity", "__as_of_period"]  # what a request is looked up by


def validate_requests(requests: DataFrame, key: str = "raw_key", period: str = "as_of_period",
                      bounds: tuple[int, int] = YEAR_BOUNDS) -> DataFrame:
    """Normalised entity and an `invalid` flag per request."""
    lo, hi = bounds
    ent = normalize_key_request(key)
    p = F.col(period)
    return requests.withColumn("entity", ent).withColumn(
        "invalid", F.col("entity").isNull() | (p.isNotNull() & ((p < lo) | (p > hi)))
    )


def entity_bounds(features: DataFrame, model_features: Sequence[str]) -> DataFrame:
    """Per entity: it exists, and its min / max scoreable period."""
    scoreable = F.lit(True)
    for c in model_features:
        scoreable = scoreable & F.col(c).isNotNull()
    return features.groupBy("entity").agg(
        F.min(F.when(scoreable, F.col("period"))).alias("available_periods_min"),
        F.max(F.when(scoreable, F.col("period"))).alias("available_periods_max"),
        F.lit(True).alias("__exists"),
    )


def scored_table(
    features: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    model_features: Sequence[str],
    size_bound: int | None = None,
) -> DataFrame:
    """Scores and within-period percentiles of all scoreable rows of `features`."""
    scored = score(features.dropna(subset=list(model_features))).select("entity", "period", "risk_score", *model_features)
    return percentile_in_group(scored, ["period"], "risk_score", out="risk_percentile_in_period", size_bound=size_bound)


def score_requests(
    requests: DataFrame,
    features: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    model_features: Sequence[str],
    model_version: str,
    model_type: str,
    bounds: tuple[int, int] = YEAR_BOUNDS,
    size_bound: int | None = None,
    scored: DataFrame | None = None,
) -> DataFrame:
    """`requests(request_id, raw_key, as_of_period)` -> one scored row per request.

    `score(df)` adds `risk_score` to feature rows (a fitted model's `transform`
    or an explicit-parameter expression). `scored`, if given, is `scored_table`
    of the same features, made once for many batches; otherwise only the
    requested periods are scored. Invalid requests have no entity to look up: their key is NULL."""
    req = validate_requests(requests, bounds=bounds).withColumns(
        {k: F.when(~F.col("invalid"), F.col(c)) for k, c in zip(_KEY, ("entity", "as_of_period"))})
    keys = req.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("__requests")).persist()  # read by `resolved` and by `heaviest`
    info = entity_bounds(features, model_features).withColumnRenamed("entity", _KEY[0])
    resolved = keys.join(info, _KEY[0], "left").withColumn(
        "resolved_period", F.coalesce(F.col(_KEY[1]), F.col("available_periods_max"))
    ).persist()  # read by the period filter and by the final join

    if scored is None:
        periods = materialize(resolved.where(F.col("resolved_period").isNotNull())
                              .select(F.col("resolved_period").alias("period")).distinct())  # joined at each read of the scores
        scored = scored_table(features.join(broadcast_if_small(periods), "period", "left_semi"), score, model_features, size_bound)

    hit = resolved.join(
        scored.withColumnsRenamed({"entity": _KEY[0], "period": "resolved_period"}).withColumn("__hit", F.lit(True)),
        [_KEY[0], "resolved_period"], "left",
    )
    hit = hit.withColumn("status", status_of(F.col("__exists"), F.col("available_periods_max"), F.col("__hit")))
    hit = hit.persist()  # read by both sides of the split join
    out = split_join(req, hit, _KEY, "__requests", weights=heaviest(keys, "__requests"))
    return answers(out, model_features, model_version, model_type)


def status_of(exists: F.Column, latest: F.Column, hit: F.Column) -> F.Column:
    """Status of a valid request."""
    return (
        F.when(~F.coalesce(exists, F.lit(False)), F.lit(UNKNOWN))
        .when(latest.isNull(), F.lit(NO_SCOREABLE))
        .when(~F.coalesce(hit, F.lit(False)), F.lit(UNAVAILABLE))
        .otherwise(F.lit(OK))
    )


def answers(out: DataFrame, model_features: Sequence[str], model_version: str, model_type: str) -> DataFrame:
    """Result rows of requests that have met their entity's bounds and their score."""
    is_ok = F.col("status") == OK
    st = F.when(F.col("invalid"), F.lit(INVALID)).otherwise(F.col("status"))
    features_map = F.create_map(*[x for c in model_features for x in (F.lit(c), F.col(c).cast("double"))])
    return out.select(
        "request_id", "raw_key", "entity",
        F.when(is_ok & ~F.col("invalid"), F.col("resolved_period")).otherwise(F.col("as_of_period")).alias(
            "as_of_period"),
        st.alias("status"),
        F.when(is_ok, F.col("risk_score")).alias("risk_score"),
        F.lit(model_version).alias("model_version"),
        F.lit(model_type).alias("model_type"),
        F.when(~F.col("invalid"), is_ok).alias("as_of_period_available"),
        F.when(F.col("status").isin(OK, UNAVAILABLE) & ~F.col("invalid"), F.col("available_periods_min")).alias(
            "available_periods_min"),
        F.when(F.col("status").isin(OK, UNAVAILABLE) & ~F.col("invalid"), F.col("available_periods_max")).alias(
            "available_periods_max"),
        F.when(is_ok, F.col("risk_percentile_in_period")).alias("risk_percentile_in_period"),
        *[F.when(is_ok, F.col(c).cast("double")).alias(f"feature_{c}") for c in model_features],
        F.when(is_ok, features_map).alias("features_used"),
        F.when(is_ok & F.col("as_of_period").isNull(), F.concat(
            F.lit("as_of_period was not provided. Used latest available period ("),
            F.col("available_periods_max").cast("string"), F.lit(")."))).alias("notes"),
    )
