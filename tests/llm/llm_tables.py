import random

import pytest

NAMES = "doc_id long, text string, lang string, source string, score double, size long, n long"


@pytest.fixture(scope="session")
def table(spark):
    """A table of documents with columns that clash with names the operators use."""

    def make(rows):
        return spark.createDataFrame([(i, t, lang, src, 0.5, 7, 8) for i, t, lang, src in rows], NAMES)

    return make


@pytest.fixture(scope="session")
def hard(table):
    """Nulls in any column, empty and blank texts, repeated rows, one very long text, ties."""
    rnd = random.Random(4)
    words = ["stone", "river", "Cloud", "été", "straße", "año", "the", "of", "and", "x" * 300]
    long_text = " ".join(rnd.choice(words) for _ in range(20_000))
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60))), rnd.choice(["en", "de", None]), rnd.choice(["a", "b", None])) for i in range(60)]
    rows += [(60, None, None, None), (61, "", "en", "a"), (62, " \n\t ", None, "b"), (63, "12 34 !!", "en", "a"), (64, long_text, "en", "a")]
    rows += [(65, rows[3][1], "en", "a"), (66, rows[3][1].replace(" ", "\n"), "de", "b"), (67, rows[4][1], None, None), rows[5], rows[5], (None, "no id at all", "en", "a")]
    return table(rows)


@pytest.fixture(scope="session")
def empty(table):
    return table([])
