"""Rows with every odd case: nulls, empty and long texts, ties, repeated rows, clashing names."""

import pytest

PROSE = ("The old ship sailed past the quiet harbour at dawn, and the crew of nine sang a slow song about the long way home. "
         "No one on the pier waved back, for the town had slept through the storm and would sleep through the morning as well.")
WORDS = "north river stone candle window garden letter mirror silver branch meadow lantern harbor copper ribbon anchor".split()


def sentence(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + k * k + k * seed) % len(WORDS)] + str((seed + k * 3) % 11) for k in range(n))


def odd_rows():
    long = " ".join(sentence(k, 40) for k in range(400))
    return [
        (1, PROSE, "en"), (2, PROSE.replace(" ", "\n"), None), (3, PROSE + "  ", "en"), (4, None, "en"), (5, "", None), (6, " \t\n", "de"),
        (7, long, "en"), (8, long + " end", None), (9, "one two", "en"), (10, "One  TWO", "en"), (11, "é" * 150, "fr"), (12, "x" + "é" * 150, "fr"),
        (13, PROSE.replace("nine", "ten"), "en"), (14, PROSE.upper(), "en"), (15, "<|endoftext|> a <|endoftext|>", "en"),
        (16, sentence(3, 30), "en"), (17, sentence(3, 30).replace("stone", "STONE"), "en"), (9, "one two", "en"), (None, "lost id", "en"),
        (None, None, None),
    ] + [(100 + k, sentence(5, 60) + f" w{k % 4}", "en") for k in range(12)]


#: Names that the operators use for their own columns.
CLASHING = ("id", "score", "_s", "_rank", "_sha", "_rule", "keep_id", "key", "pos", "n", "rule", "host", "_text", "_row", "doc", "hash", "item")


@pytest.fixture(scope="session")
def odd(spark):
    docs = spark.createDataFrame(odd_rows(), "doc_id long, text string, lang string").repartition(5)
    for c in CLASHING:
        docs = docs.selectExpr("*", f"'{c}' AS `{c}`")
    return docs.cache()


@pytest.fixture(scope="session")
def unique(odd):
    """The odd rows with ids that are there and differ."""
    return odd.where("doc_id is not null").dropDuplicates(["doc_id"]).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0).cache()


@pytest.fixture(scope="session")
def table_of(spark, sf):
    return lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
