import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: extra columns whose names the operators use inside
CLASHES = ["row", "tie", "token", "doc", "rank", "n", "features", "label", "pos", "key", "block", "pass", "gid", "part",
           "norm", "slot", "bucket", "score", "x", "y", "tokens", "copies", "deleted", "n_lines",
           "__id", "__source", "__copies", "__copy", "__doc", "__tie", "__runs"]


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and long texts, ties, repeated rows, near and exact copies, one dominant source."""
    rng = random.Random(5)
    rows = [(None, "text without an id and a few more words", "en", None, None), (1, None, None, None, None),
            (2, "", "en", "a", 0), (3, " \t\n ", "en", "a", 4), (4, "one", "en", "b", 3), (5, "One", "en", "b", 3)]
    base = words(rng, 80)
    for i in range(10, 40):
        rows.append((i, base if i % 3 else words(rng, 60) + "\n" + words(rng, 30), "en", "a", 1))
    for i in range(40, 60):  # near copies with one to four changed words
        w = base.split()
        for _ in range(1 + i % 4):
            w[rng.randrange(len(w))] = f"edit{i}"
        rows.append((i, " ".join(w), "en", "c", 1))
    shared = words(rng, 25)
    for i in range(60, 80):
        rows.append((i, words(rng, 20) + "\n" + shared + "\n" + words(rng, 20), "en", "a", 1))
    rows.append((80, words(rng, 30_000), "en", "a", 1))
    rows.append((81, "x" * 50_000, "en", "a", 1))
    rows += [rows[12], rows[12], (12, "another text under a used id, long enough to be shingled", "en", "a", 1)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows, DOC_SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
