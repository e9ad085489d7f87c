import random

import pytest

WORDS = "The the house And and river walks ÉTÉ été slowly, under bridge idiot moron x".split(" ")


def text_of(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


#: Null in every column, empty and blank texts, a long text, repeated rows, equal texts, and
#: column names that the operators use themselves.
DOCS_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, "
               "f int, size string, key string, score string, rank string, ids string")


def docs_rows():
    extra = (None, 1, "s", "k", "score", "r", "ids")
    made = [
        (1, text_of(1, 40), "en", "b", 1), (2, text_of(1, 40), None, "a", 2),
        (3, text_of(1, 39) + " end", "en", None, None), (4, None, "en", "b", None),
        (5, "", "fr", "a", 0), (6, " \t\n\x0b", "fr", "ä", 4), (7, "One", "en", "b", 3),
        (None, text_of(9, 12), "en", "b", 5), (8, text_of(2, 6000), "de", "b", 6),
        (8, text_of(2, 6000), "de", "b", 6), (9, "MIT License. CC-BY", "en", "c", 1),
        (10, "gnu general public license", "en", "c", 1),
        (11, "GNU General Public License version 3, cc by", "en", "c", 1),
    ]
    return [(*r, *extra) for r in made]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(docs_rows(), DOCS_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS_SCHEMA)
