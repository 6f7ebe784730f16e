from __future__ import annotations

import pytest

#: Rows with a null id, null, empty and blank texts, ties, repeated rows and a very long text.
WORDS = [f"w{i:03d}" for i in range(60)]
EDGES = [
    (1, "Alpha beta gamma delta epsilon", "en", "a", 30),
    (2, "Alpha  beta gamma\tdelta epsilon", "en", "a", 31),
    (3, None, None, None, None),
    (4, "", "de", "b", 0),
    (5, " \t\n", "de", "b", 3),
    (6, "x", None, "c", 1),
    (7, " ".join(WORDS), "en", "a", 299),
    (8, "front matter " + " ".join(WORDS), "en", "a", 312),
    (8, "front matter " + " ".join(WORDS), "en", "a", 312),
    (None, " ".join(WORDS), "fr", "a", 299),
    (None, None, "fr", None, None),
    (9, "Ünïcödé 漢字 \U0001f600 ́ 1234 !!", "fr", "d", 20),
    (10, " ".join(f"long{i % 977}" for i in range(30_000)), "de", "e", 200_000),
    (11, "alpha beta gamma delta epsilon", "en", "z", 30),
    (12, "½ ² 12 !!", "en", "z", 8),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edges(spark):
    """The edge rows in several partitions, with columns whose names the operators use inside."""
    frame = spark.createDataFrame(EDGES, SCHEMA)
    extra = ("keep_id", "n", "kept", "group", "digest", "node", "shard", "keys", "size", "id", "block", "label")
    return frame.selectExpr("*", *(f"'other' AS `{c}`" for c in extra)).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
