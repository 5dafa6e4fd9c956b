import random

import pytest

from marquetry.llm.common import ship

# Columns that clash with names that the operators use inside.
CLASHING = "key label shard fp line set size token rows text_ id name rank a b root node spans bytes row lines lang source"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text) rows, with clashing extra columns."""

    def make(rows):
        names = [c for c in CLASHING.split()]
        schema = ", ".join(["doc_id long", "text string", *[f"{c} string" for c in names]])
        df = spark.createDataFrame([(i, t, *["x"] * len(names)) for i, t in rows], schema)
        return df.repartition(3)

    return make


@pytest.fixture(scope="session")
def prose():
    """Invented sentences, the same for the same seed."""

    def make(seed, words=60, vocabulary=400):
        rng = random.Random(seed)
        names = ["".join(random.Random(f"w{i}").choices("abcdefghiklmnoprstu", k=2 + i % 7)) for i in range(vocabulary)]
        return " ".join(rng.choice(names) for _ in range(words))

    return make


@pytest.fixture
def messy(documents, prose):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    text = prose(1)
    return documents(
        [(1, text), (1, text), (2, None), (3, ""), (4, "   \n \t"), (None, text), (None, None), (5, prose(5, 30_000)), (6, "ß É 你好 \U0001d54f a"), (7, text)]
    )
