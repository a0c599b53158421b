import random

import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with everything that may be odd: nulls, empty and blank texts, repeats, a long text, clashing names."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    rows = [
        (1, "the same text of some words that is here twice or more", "a"), (1, "the same text of some words that is here twice or more", "b"),
        (2, "the same text of some words that is here twice or more", None), (None, "the same text of some words that is here twice or more", "c"),
        (3, None, "d"), (None, None, None), (4, "", "e"), (5, " \t\n ", "f"), (6, "é漢 😀<|endoftext|>", "g"), (7, long, "h"), (8, "one", "i"),
    ]
    kind = "doc_id long, text string, _id string"
    return spark.createDataFrame(rows, kind).withColumnsRenamed({"_id": "_text"}).selectExpr("doc_id", "text", "_text", "1 AS _hash", "'x' AS words")
