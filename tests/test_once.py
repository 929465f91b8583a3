"""Expressions that Spark copies, for a filter moved below its projection, must not grow by it."""

import numpy as np
from pyspark.sql import functions as F

from panelscope.functions import keys as K
from panelscope.functions import values as V
from panelscope.functions.once import once
from panelscope.operators.clean import clean_panel_monthly, typed_monthly
from panelscope.operators.isotonic import IsotonicCurve
from panelscope.operators.model import CalibratedLogit


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_once_reads_its_value_in_one_place(spark):
    df = spark.createDataFrame([("a1",), (None,), ("",)], "t string")
    out = df.select("t", once(F.regexp_replace("t", "[0-9]", ""), lambda d: F.when(d == "", F.lit("none")).otherwise(F.concat(d, d))).alias("v"))
    assert optimized(out).count("regexp_replace") == 1
    assert {r.t: r.v for r in out.collect()} == {"a1": "aa", None: None, "": "none"}


def test_curve_equals_interpolation_and_a_filter_does_not_multiply_it(spark):
    rng = np.random.default_rng(5)
    for n in (1, 2, 15, 16, 17, 100):
        xs = sorted({float(x) for x in rng.normal(size=n)})
        ys = sorted(float(y) for y in rng.random(len(xs)))
        curve = IsotonicCurve(xs, ys)
        points = [*xs, *(float(x) for x in rng.normal(size=50)), -9.0, 9.0]
        df = curve.transform(spark.createDataFrame([(p,) for p in points] + [(None,)], "s double"), "s", "p")
        got = {r.s: r.p for r in df.collect()}
        assert got.pop(None) is None
        assert np.allclose([got[p] for p in points], np.interp(points, xs, ys), atol=1e-12)
        assert df.where(F.col("p").isNotNull()).count() == len(points)
    model = CalibratedLogit(["s"], 0.5, [2.0], "isotonic", isotonic=curve)
    scored = model.transform(df.select("s").where(F.col("s").isNotNull()))
    kept = scored.where(F.col("risk_score").isNotNull()).select("risk_score")
    assert len(optimized(kept)) < 4 * len(optimized(scored))  # before: doubled by each step of the search


def test_a_filter_on_a_key_costs_few_patterns(spark):
    df = spark.createDataFrame([(" 12 ",), ("012345",), ("112345",), ("39049.0",), ("  ",), (None,), ("0.",), ("00007.",)], "k string")
    for rule, most, want in ((K.normalize_key, 2, {" 12 ": "00012", "39049.0": None}),
                             (K.normalize_key_request, 2, {"012345": "12345", "112345": None, "  ": None, " 12 ": "00012", None: None}),
                             (K.normalize_key_numeric, 6, {"39049.0": "39049", "0.": "00000", "00007.": "00007", " 12 ": "00012", "  ": None})):
        out = df.select("k", rule("k").alias("entity"))
        assert optimized(out.where(F.col("entity").isNotNull())).count("regexp_replace") <= most
        got = {r.k: r.entity for r in out.collect()}
        assert {k: got[k] for k in want} == want


def test_month_text_meets_the_one_format_of_its_shape(spark):
    texts = ["2024-03-05 10:11:12", "2024-03-05", "2024-03", "2024/03/05", "03/05/2024"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    fits = df.select("t", F.array(*[F.col("t").rlike(V._shape(f)) for f in V.MONTH_FORMATS]).alias("fits"))
    assert {r.t: r.fits for r in fits.collect()} == {t: [i == k for k in range(len(texts))] for i, t in enumerate(texts)}
    more = {"-0001-02-03": "-0001-02-01", "+12024-05": "+12024-05-01", "2024-02-30": None, "2024-3-05": None, "N": None, "": None, None: None,
            "2024-03-05T10:11:12": None, " 2024-03-05 10:11:12.25 ": "2024-03-01", "2024-03-05 24:00:00": None}
    got = spark.createDataFrame([(t,) for t in more], "t string").select("t", V.month_floor("t").cast("string").alias("m"))
    assert {r.t: r.m for r in got.collect()} == more


def test_monthly_cleaning_parses_each_text_once(spark):
    raw = spark.createDataFrame([(" 1.0", "2024-03", "2.5"), ("2", "03/05/2024", "n/a"), ("x", "2024-03", "1"), ("3", "N", "1"), (None, None, None)],
                                "`County FIPS` string, MONTH string, `Eviction Filing Rate` string")
    out = clean_panel_monthly(raw)
    assert [(r.entity, str(r.month), r.rate) for r in out.collect()] == [("00001", "2024-03-01", 2.5)]
    assert out.schema.simpleString() == typed_monthly(raw).schema.simpleString()
    assert optimized(out).count("gettimestamp") == len(V.MONTH_FORMATS)  # twice as many when a filter copies the parsing
