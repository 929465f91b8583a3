import __spark_entry__ as entry


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["entity", "period", "outcome_period", "y"]


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
