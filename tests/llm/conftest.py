import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, fp int, digest string, n int, row int, shard int, label string"
SMALL = "/root/testdata/sf0.001"


def frame(spark, rows):
    """(doc_id, text, lang, source) rows with n_chars and clashing extra columns."""
    return spark.createDataFrame(
        [(i, t, lang, src, len(t or ""), "x", 1, None, 2, 3, 4, "y") for i, t, lang, src in rows], SCHEMA)


def odd_rows():
    rng = random.Random(5)
    words = ["the", "of", "and", "house", "river", "Ärger", "niño", "naïve", "x", "zebra", "blue", "42"]
    long = ". ".join(" ".join(rng.choice(words) for _ in range(9)) for _ in range(6000))
    return [(1, None, None, None), (2, "", "en", ""), (3, " \n\t ", "en", "a"), (4, "one", "en", "a"),
            (5, "one two. ", None, "a"), (6, long, "en", "b"), (7, long + " end", "en", "b"),
            (8, "same text here", "de", "b"), (9, "same text here", "de", "b"), (9, "same text here", "de", "b"),
            (None, "same text here", None, None), (None, None, None, None), (10, "", "fr", "c"),
            (-11, "Ünïcödé \U0001F600 mail a.b@c.de " * 3, "de", "c"), (1 << 60, "one two three four", "en", "c")]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, odd_rows())


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
