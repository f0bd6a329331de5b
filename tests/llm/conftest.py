import random

import pytest
from corpus_fixtures import SCHEMA, prose, word

@pytest.fixture(scope="session")
def edge_rows():
    """Nulls everywhere, empty and very long texts, copies, near copies, repeated rows."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    base = [prose(rng, 60) for _ in range(6)]
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r ", "en", "a", 7), (4, "one", "en", "b", 3),
        (5, "one", "en", "b", 3), (6, "ONE", "de", None, 3), (7, "two words", "de", None, 9), (None, "two words", None, "a", 9),
        (None, None, None, None, None), (8, long, "fr", "c", len(long)), (9, long + " end", "fr", "c", len(long) + 4),
        (10, "é ü 日本 " * 30, "fr", "c", 0), (11, "x\n" * 40, "en", "a", 80), (11, "x\n" * 40, "en", "a", 80),
    ]
    for i, t in enumerate(base):
        w = t.split()
        for k in range(4):
            v = list(w)
            for _ in range(k):
                v[rng.randrange(len(v))] = word(rng)
            rows.append((100 + 10 * i + k, " ".join(v), "en", rng.choice(["a", "b", None]), 0))
        rows.append((100 + 10 * i + 9, t, "en", "a", 0))
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clash_docs(spark, edge_rows):
    """The same documents with extra columns named like the operators' own."""
    extra = "_id long, _text string, _key long, _rid long, _row string, _cid long, _source string, kept string, score string, n_words string, size string"
    rows = [(*r, 1, "x", 2, 3, "y", 4, "z", "k", "s", "w", "v") for r in edge_rows]
    return spark.createDataFrame(rows, f"{SCHEMA}, {extra}")


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)

