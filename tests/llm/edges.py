"""Small tables with the awkward rows that every corpus operator must take."""

import random

import pytest

# Extra columns carry the names that the operators use inside.
DOC_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, id bigint, text_hash string, "
    "doc bigint, score double, copies int, node bigint, hits string, quality int, found int, kept_text string, size int, bin int"
)
CLASH = ("own", 7, "own", 8, 0.5, 9, 10, "own", 11, 12, "own", 13, 14)

_dice = random.Random(6)


def _word():
    return "".join(_dice.choice(["an", "er", "in", "th", "o", "re", "st", "la", "u", "mi"]) for _ in range(_dice.randrange(1, 5)))


PROSE = " ".join(_word() for _ in range(120))
LONG = " ".join(_word() for _ in range(60_000))


def rows():
    base = [
        (1, PROSE, "en", "a", 5),
        (2, None, "en", "a", 0),
        (3, "", "en", "b", 0),
        (4, " \n\t \n", None, None, 4),
        (5, LONG, "en", None, len(LONG)),
        (6, PROSE, "de", "b", 5),
        (6, PROSE, "de", "b", 5),  # a repeated row
        (6, "another text under the same id", "de", "b", 5),
        (None, PROSE + " more", None, "c", None),
        (None, None, None, None, None),
        (8, "naïve ÉCOLE 日本語 text", "fr", "c", 20),
        (9, "one", "fr", "", 3),
        (10, "a\nb\nc\nd\ne\nf\ng\nh\n" * 4, "fr", "c", 20),
    ]
    return [r + CLASH for r in base]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(rows(), DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
