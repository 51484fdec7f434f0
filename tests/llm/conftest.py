"""Frames with the odd cases that every corpus operator must take."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))

ODD_ROWS = [
    (1, "A line of text here\nshared line\n\n", "en", "s1", 5),
    (2, "a LINE of text here\nShared Line \n\n", "en", "s1", 5),
    (3, None, None, None, None),
    (4, "", "en", "s2", 0),
    (4, "", "en", "s2", 0),
    (5, " \t\n ", "de", None, 3),
    (6, LONG, "en", "s1", len(LONG)),
    (7, LONG + " one more", "en", "s3", len(LONG)),
    (8, "é à ü ß É, naïve. Σ ς", "fr", "s3", 9),
    (None, "no id at all but some words in here", "en", "s2", 1),
    (9, "twin row", "en", "s2", 8),
    (9, "twin row", "en", "s2", 8),
    (9, "other text under the same id", "en", "s2", 8),
    (-3, "x", "en", "s4", 1),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD_ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    """200 documents of the given tables, enough for brute force."""
    read = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return spark.createDataFrame([tuple(r) for r in read.collect()], read.schema)  # a cached read would stand in for every later plan on that file


@pytest.fixture
def clashing(odd):
    """The odd rows with columns named like those the operators make or use inside."""
    from pyspark.sql import functions as F

    names = ["__id", "__text", "__digest", "__hash", "__source", "__n", "__row", "__score", "doc", "text_hash", "term", "tf", "beginning", "last", "f", "item", "rank", "blocks", "found", "labels", "id", "n", "key", "size", "score", "kept", "spans", "uid", "a", "b", "host", "t", "w", "n_lines", "target", "name", "at", "length"]
    return odd.withColumns({n: F.lit(f"own {n}") for n in names})
