import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture()
def odd(spark):
    """Nulls in every column, empty and blank and very long texts, repeated rows and ids, columns with clashing names."""
    rows = [
        (1, "", "en", "a", 0, 1, "k"), (2, None, "en", "a", 0, 1, "k"), (3, " \n\t", None, None, 3, 1, None),
        (4, "one two three", "de", "b", 13, 2, "k"), (4, "one two three", "de", "b", 13, 2, "k"), (4, "other words here", "de", "b", 16, 2, "k"),
        (5, "word " * 60_000, "fr", "a", None, 3, "k"), (None, "no id at all", "en", "b", 12, 4, "k"), (6, "ÉÈ 你好 Ω" * 30, "es", None, 240, 4, "k"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node long, part string")


@pytest.fixture()
def nothing(odd):
    return odd.where("false")


@pytest.fixture()
def no_labels(labels):
    return labels.where("false")
