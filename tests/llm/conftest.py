import random

import pytest

from tests.conftest import spark, tmp_out  # noqa: F401

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score string, n_words string, "
          "spans string, kept string, size string, component_id string, weight string, token string, key string")


def prose(seed: int, words: int, line: int = 12) -> str:
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("aeioubdgklmnprst") for _ in range(r.randint(2, 8))) for _ in range(400)]
    out = []
    for k in range(words):
        out.append(r.choice(vocabulary) + (".\n" if k % line == line - 1 else " "))
    return "".join(out)


def table(spark, rows):
    """documents with columns whose names clash with results; rows of
    (doc_id, text, lang, source)."""
    return spark.createDataFrame([(d, t, a, s, len(t or ""), *["x"] * 9) for d, t, a, s in rows], SCHEMA)


def odd_rows():
    """Null in any column, empty and blank texts, no letters, a very long
    text, ties and repeated rows."""
    long = prose(7, 20_000)
    return [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (4, "12345 -- !!", "de", "a"),
        (5, prose(1, 120), "en", None), (6, prose(1, 120), "en", "b"), (6, prose(1, 120), "en", "b"),
        (7, long, "fr", "b"), (8, long[:4000] + " other end", "fr", "a"), (9, "É", None, "a"), (10, "a", "xx", "a"),
        (11, "two words", "de", "c"), (None, prose(3, 60), "es", "c"), (12, "x" * 5000, "en", "c"),
        (13, prose(4, 80) + "\n" + prose(4, 80), "de", "c"),
    ]


@pytest.fixture()
def odd(spark):  # noqa: F811
    return table(spark, odd_rows())


@pytest.fixture()
def empty(spark):  # noqa: F811
    return table(spark, [])
