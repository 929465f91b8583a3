"""Raw, all-STRING inputs derived from the given tables, as CSV files would arrive.

Keys, periods, counts and rates are written as text in several spellings
(decimal keys, blank, long and wordy keys, fractional years, junk numbers,
type-suffixed numbers, NaN, negatives) so the cleaning operators meet every
case. Every row of the base table is kept; the spelling only varies with the
row id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def _money_text(c: str) -> F.Column:
    # DECIMAL text is printed alike by every SQL engine (no exponent forms).
    return F.col(c).cast("decimal(18,2)").cast("string")


def raw_yearly_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly-style raw rows from `events` (header case shuffled, one extra column)."""
    ev = read_table(spark, sf_dir, "events")
    rid = F.col("event_id")
    uid = F.col("user_id").cast("string")
    key_text = (
        F.when(rid % 7 == 0, F.concat(F.lit(" "), uid, F.lit(" ")))
        .when(rid % 7 == 1, F.concat(uid, F.lit(".0")))
        .when(rid % 7 == 2, F.lit(""))
        .when(rid % 7 == 3, F.concat(uid, F.lit("123456")))
        .when(rid % 7 == 4, F.col("event_type"))
        .otherwise(uid)
    )
    day = F.dayofmonth("ts").cast("string")
    period_text = (
        F.when(rid % 11 == 0, F.col("event_type"))
        .when(rid % 5 == 0, F.concat(day, F.lit(".7")))
        .otherwise(day)
    )
    count_text = (
        F.when(rid % 29 == 0, F.lit(""))
        .when(rid % 31 == 0, F.lit("-5"))
        .otherwise(F.get_json_object("props", "$.k"))
    )
    rate_text = (
        F.when(rid % 13 == 0, F.lit("NaN"))
        .when(rid % 17 == 0, F.concat(_money_text("value"), F.lit("d")))
        .when(rid % 19 == 0, F.lit("-1"))
        .when(rid % 23 == 0, F.lit("0"))
        .when(rid % 37 == 0, F.lit("inf"))
        .otherwise(_money_text("value"))
    )
    return ev.select(
        rid.alias("row_id"),
        key_text.alias("CoFIPS"),
        period_text.alias("Year"),
        count_text.alias("filings"),
        rate_text.alias("Filing_Rate"),
        F.col("event_type").alias("extra_note"),
    )


def raw_monthly_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly-style raw rows from `lineitem`: numeric-looking keys, mixed date spellings."""
    li = read_table(spark, sf_dir, "lineitem")
    rid = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    sk = F.col("l_suppkey").cast("string")
    key_text = (
        F.when(rid % 5 == 0, F.concat(sk, F.lit(".0")))
        .when(rid % 5 == 1, F.concat(F.lit("  "), sk))
        .when(rid % 5 == 2, F.concat(F.lit("0000"), sk, F.lit(".")))
        .otherwise(sk)
    )
    month_text = (
        F.when(rid % 4 == 0, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
        .when(rid % 4 == 1, F.date_format("l_shipdate", "MM/dd/yyyy"))
        .when(rid % 4 == 2, F.date_format("l_shipdate", "yyyy-MM"))
        .when(rid % 97 == 3, F.col("l_returnflag"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    )
    rate_text = F.when(rid % 41 == 0, F.lit("n/a")).otherwise(_money_text("l_extendedprice"))
    return li.select(
        rid.alias("row_id"),
        key_text.alias("County_FIPS"),
        month_text.alias("MONTH"),
        rate_text.alias("eviction filing rate"),
    )
