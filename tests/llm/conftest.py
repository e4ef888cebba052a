import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _id string, h int, key string"


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and very long texts, ties, repeated rows and clashing columns."""
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    rows = [
        (1, "the cat sat on the mat and looked at the dog all day long today", "en", "a"), (2, None, "en", "a"), (3, "", None, "b"), (4, "   \n\t ", "fr", None), (5, long, "en", "a"),
        (6, "the cat sat on the mat and looked at the dog all day long today", "fr", "b"), (6, "the cat sat on the mat and looked at the dog all day long today", "fr", "b"),
        (None, "no id here", "de", "c"), (7, "é ü 日本語 4111111111111111", "de", "c"), (8, "1234 5678", None, None), (9, "x", "en", "a"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "clash", 1, "clash") for r in rows], COLUMNS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)
