import random

import pytest

#: Columns whose names the operators use themselves.
CLASHING = "n", "c", "id", "row", "size", "k", "q", "s", "x", "text2", "score", "hits", "mix", "posterior", "n_words", "bucket", "component", "source_size", "_text"
SCHEMA = "doc_id bigint, text string, source string, " + ", ".join(f"{c} string" for c in CLASHING)


def make(spark, rows):
    return spark.createDataFrame([(i, t, s, *["x"] * len(CLASHING)) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, a very long one, repeated rows, equal ids, clashing columns."""
    long = " ".join(f"w{k % 977}" for k in range(200_000))
    rows = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "One", "b"), (5, long, "b"), (6, "Ünï cödé \u4e2d\u6587 words here and there", None),
        (7, "same text twice over here", "a"), (7, "same text twice over here", "a"), (None, "no id at all", "c"), (None, None, None),
        (8, "other text, equal id", "b"), (8, "Other text of equal id", "c"), (9, "same text twice over here", "b"),
    ]
    return make(spark, rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return make(spark, [(1, "x", "a")]).limit(0)


def prose(seed, count, vocabulary=400):
    random_ = random.Random(seed)
    return " ".join(f"word{random_.randrange(vocabulary)}" for _ in range(count))
