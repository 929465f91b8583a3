"""Readers for the input tables and the panels derived from them.

Every panel is a DataFrame `(entity STRING, period, exposure_count DOUBLE,
rate DOUBLE)` built with one map-side-combined aggregate over a base table, so
its work grows with the table. Rates come from DECIMAL sums and one double
division, which keeps them bit-equal across SQL engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import KEY_WIDTH

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# Day 0 of the daily event panel.
EVENTS_EPOCH = "2024-01-01"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _key(c) -> F.Column:
    """Zero-padded to the key width; a longer id stays whole, so ids never merge."""
    text = c.cast("string")
    return F.when(F.length(text) < KEY_WIDTH, F.lpad(text, KEY_WIDTH, "0")).otherwise(text)


def _rate(total, count) -> F.Column:
    return F.sum(total.cast("decimal(18,2)")).cast("double") / count


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: user x day panel from `events` (irregular: users skip days)."""
    ev = read_table(spark, sf_dir, "events")
    return (
        ev.select(
            _key(F.col("user_id")).alias("entity"),
            F.datediff(F.to_date("ts"), F.lit(EVENTS_EPOCH).cast("date")).alias("period"),
            F.col("value"),
        )
        .groupBy("entity", "period")
        .agg(
            F.count(F.lit(1)).cast("double").alias("exposure_count"),
            _rate(F.col("value"), F.count(F.lit(1))).alias("rate"),
        )
    )


def orders_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: customer x order-year panel from `orders`."""
    o = read_table(spark, sf_dir, "orders")
    return (
        o.select(
            _key(F.col("o_custkey")).alias("entity"),
            F.year("o_orderdate").cast("int").alias("period"),
            F.col("o_totalprice"),
        )
        .groupBy("entity", "period")
        .agg(
            F.count(F.lit(1)).cast("double").alias("exposure_count"),
            _rate(F.col("o_totalprice"), F.count(F.lit(1))).alias("rate"),
        )
    )


def supplier_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier x ship-month panel from `lineitem` (`month` is a DATE)."""
    li = read_table(spark, sf_dir, "lineitem")
    return (
        li.select(
            _key(F.col("l_suppkey")).alias("entity"),
            F.trunc(F.to_date("l_shipdate"), "MM").alias("month"),
            F.col("l_extendedprice"),
        )
        .groupBy("entity", "month")
        .agg((_rate(F.col("l_extendedprice"), F.count(F.lit(1))) / 1000).alias("rate"))
    )


# Valid request periods for the daily event panel (days since the epoch).
EVENT_PERIOD_BOUNDS = (0, 365)


def event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scoring request per event: exact, NULL, absent and out-of-range periods;
    padded, 6-digit, blank, unpadded, unknown (99999) and over-long keys."""
    ev = read_table(spark, sf_dir, "events")
    rid = F.col("event_id")
    padded = _key(F.col("user_id"))
    raw_key = (
        F.when(rid % 6 == 0, padded)
        .when(rid % 6 == 1, F.concat(F.lit("0"), padded))
        .when(rid % 6 == 2, F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
        .when(rid % 6 == 3, F.lit("99999"))
        .when(rid % 6 == 4, F.lit("   "))
        .otherwise(F.concat(F.col("user_id").cast("string"), F.lit("12")))
    )
    day = F.datediff(F.to_date("ts"), F.lit(EVENTS_EPOCH).cast("date"))
    as_of = (
        F.when(rid % 5 == 0, F.lit(None).cast("int"))
        .when(rid % 5 == 1, F.lit(40))
        .when(rid % 5 == 2, F.lit(-3))
        .otherwise(day)
    )
    return ev.select(rid.alias("request_id"), raw_key.alias("raw_key"), as_of.cast("int").alias("as_of_period"))


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name lookup records from `part` (name, group code, key, file order)."""
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("group_code"),
        F.col("p_partkey").cast("string").alias("key"),
        F.col("p_partkey").alias("ord"),
    )
