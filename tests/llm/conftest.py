import random

import pytest

WORDS = "the of and to in is that it for was on are as with his they at be this from have or by one had not but what all were".split()


@pytest.fixture(scope="session")
def prose():
    """Seeded invented prose: ``prose(n_words, seed)``."""
    def make(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(WORDS) + r.choice(["", "ly", "er", "ing", "ed", "é"]) for _ in range(n))
    return make


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Documents with nulls, empty and long texts, repeated rows, and extra columns whose names clash with inner ones."""
    base = prose(400, 1)
    rows = [(1, base), (2, base), (2, base), (3, base.upper().replace("É", "é")), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "one two"),
            (None, base), (None, None), (9, base + " " + prose(4, 2)), (10, prose(60_000, 3)), (11, "é" * 120 + " x"), (12, "!!! 123 ???"),
            (13, prose(300, 5) + " " + base)]
    rows = [(i, t, "en" if n % 3 else None, "src" if n % 2 else None, len(t or ""), n, 0.5, "x", n) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n long, score double, row string, c int").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
