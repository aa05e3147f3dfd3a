"""Small tables with every awkward row."""

import pytest

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 400


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows and clashing column names."""
    rows = [
        (1, "One two three four five six seven eight.", "a", 7),
        (2, "One two three four five six seven eight.", None, None),
        (2, "One two three four five six seven eight.", None, None),
        (3, None, "a", 1),
        (4, "", "b", 2),
        (None, "A text without a key", "b", 3),
        (None, None, None, None),
        (5, LONG, "c", 4),
        (6, " \t\n ", "c", 5),
        (7, "Żółć 漢字 🙂 é <|endoftext|> x", "c", 6),
    ]
    schema = "doc_id long, text string, score string, n_tokens long, id long"
    return spark.createDataFrame([(*r, r[0]) for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("1 = 0")
