import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty texts, repeated rows, a repeated id, a column named like a result."""
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, words, "en", "a", 10, "x"), (2, words, "en", "a", 10, "y"), (2, words, "en", "a", 10, "y"),
            (3, None, None, None, None, None), (None, words + " tail", "de", None, 1, "n"),
            (None, None, None, None, None, None), (4, "", "en", "b", 0, ""), (4, "other text of id four", "en", "b", 0, ""),
            (5, " \n\t ", "fr", "b", 4, "z"), (6, "long " * 30_000, "fr", "c", 1, "z"),
            (7, words.replace("w30", "zz"), "en", "a", 1, "q")]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
