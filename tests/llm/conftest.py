import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words long, rep string, chunk string, _id string, n_lines long"
ODD = [
    (1, "alpha beta gamma delta", "en", "a", 22, 0.5, 1, "x", "y", "z", 7),
    (1, "alpha beta gamma delta", "en", "a", 22, 0.5, 1, "x", "y", "z", 7),
    (None, "alpha beta gamma delta", None, None, None, None, None, None, None, None, None),
    (2, None, None, "a", None, None, None, None, None, None, None),
    (3, "", "en", None, 0, None, None, None, None, None, None),
    (4, " \n\t \n", "fr", "b", 5, None, None, None, None, None, None),
    (5, "é" * 30 + " " + "x" * 5000, "fr", "b", 5031, None, None, None, None, None, None),
    (6, "\n".join(f"line {k % 7} of a long text" for k in range(3000)), "en", "a", 1, None, None, None, None, None, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and long texts, equal rows, and columns whose names may clash."""
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
