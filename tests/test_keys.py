from panelscope.functions.keys import normalize_key, normalize_key_numeric, normalize_key_request, repad_key
from panelscope.functions.values import coerce_double, coerce_int_truncated, month_floor


def apply(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn("x")).collect()]


def test_request_key_edge_cases(spark):
    got = apply(spark, normalize_key_request, ["06037", "6037", " 39049 ", "039049", "   ", "AAAA", "1234567", None])
    assert got == ["06037", "06037", "39049", "39049", None, None, None, None]


def test_loader_key_rule(spark):
    got = apply(spark, normalize_key, ["1001", " 6037 ", "", "abc", "1234567", "039049", None, "12-34"])
    assert got == ["01001", "06037", None, None, None, None, None, "01234"]


def test_numeric_key_rule(spark):
    got = apply(spark, normalize_key_numeric, ["39049.0", "1001.0", "000039049.0", ".5", "5.", "1e5", "6037"])
    assert got == ["39049", "01001", "39049", "00000", "00005", "00015", "06037"]


def test_repad_never_truncates(spark):
    assert apply(spark, repad_key, ["123", "1234567", " 42 ", "-12", None]) == ["00123", "1234567", "00042", "-0012", None]


def test_numeric_coercion(spark):
    got = apply(spark, coerce_double, ["0", "-1", "NaN", "inf", "1.0d", "3.5", " 2 ", "", "1e3", "1e999", None])
    assert got == [0.0, -1.0, None, None, None, 3.5, 2.0, None, 1000.0, None, None]
    assert apply(spark, coerce_int_truncated, ["2010", "2010.7", "x", "-3.9"]) == [2010, 2010, None, -3]


def test_month_floor(spark):
    import datetime as dt

    got = apply(spark, month_floor, ["2024-03-17", "2024-03", "03/17/2024", "2024-03-17 10:11:12.5", "x", None])
    m = dt.date(2024, 3, 1)
    assert got == [m, m, m, m, None, None]


def test_wider_request_keys(spark):
    df = spark.createDataFrame([(v,) for v in ["100000", "01000001", "12345678", "7"]], "x string")
    got = [r[0] for r in df.select(normalize_key_request("x", 7)).collect()]
    assert got == ["0100000", "1000001", None, "0000007"]


def test_panel_keys_never_merge(spark, tmp_path):
    rows = [(10000, "2024-01-02 00:00:00", 1.0), (100000, "2024-01-02 00:00:00", 2.0), (1000001, "2024-01-02 00:00:00", 3.0), (7, "2024-01-02 00:00:00", 4.0)]
    events = spark.createDataFrame(rows, "user_id long, ts string, value double").selectExpr("user_id", "cast(ts as timestamp) as ts", "value")
    events.write.parquet(str(tmp_path / "events.parquet"))
    from panelscope.sources.tables import events_daily

    got = {r.entity for r in events_daily(spark, str(tmp_path)).collect()}
    assert got == {"10000", "100000", "1000001", "00007"}
