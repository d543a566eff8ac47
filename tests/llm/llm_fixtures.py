import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, p double, n long"


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def words(rng, n, size=300):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of (id, text) pairs, with extra columns whose names the operators use themselves."""

    def make(pairs, lang="en", source="s0"):
        return spark.createDataFrame([(i, t, lang, source, len(t or ""), "k", 0.5, 7) for i, t in pairs], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, repeated and missing ids."""
    rng = random.Random(3)
    long = " ".join(words(rng, 60_000, 5000))
    some = " ".join(words(rng, 200))
    rows = [
        (1, some, "en", "a", 5, None, None, None), (1, some, "en", "a", 5, None, None, None), (2, some, None, None, None, None, None, None),
        (None, some, "de", "b", 1, "x", 1.0, 1), (3, None, "en", "a", None, None, None, None), (4, "", "en", "a", 0, None, None, None),
        (5, " \n\t ", "en", "a", 4, None, None, None), (6, long, "en", "a", len(long), None, None, None), (7, "12 !? 34", "en", "c", 8, None, None, None),
        (8, "é" * 700 + " naïve 　 text", "fr", "c", 700, None, None, None), (1, "another text with the same id", "en", "a", 5, None, None, None),
        (None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, DOCS)
