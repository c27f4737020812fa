import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, key string, score string, digest string"
LONG = " ".join(f"word{i % 977} thing{i % 31}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, names that clash."""
    extra = ("en", "s", 1, "r", "k", "0.5", "d")
    none = (None,) * 7
    rows = [
        (1, None, *none), (2, "", *extra), (3, "", *extra), (None, "no id at all", *extra), (None, None, *none),
        (4, LONG, *extra), (5, LONG, *extra), (5, LONG, *extra), (6, "a", *extra), (7, "\t \n", *extra),
        (8, "x" * 50_000, *extra), (9, "\U0001f600 ▁ \x00 é 中文", *extra), (9, "another text of nine", *extra),
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)
