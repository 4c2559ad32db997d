import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadastra.llm import hard_negatives as H
from cadastra.llm.queries import QUERIES
from tests.conftest import SF_CHECK

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchors=100, seven=True):
    """The contract over all pairs; rows of equal id and score are told apart by nothing that shows."""
    used = [(i, v, (lab + 1) % 10 if seven and i is not None and i % 7 == 0 else lab) for i, v, lab in rows
            if lab is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    q = [[math.floor(256 * float(np.float32(c))) for c in v] for _, v, _ in used]
    last = lambda i: (i is None, i or 0)
    out = []
    for a, (i, _, lab) in enumerate(used):
        if i is None or i % anchors:
            continue
        s = [sum(x * y for x, y in zip(q[a], v)) for v in q]
        order = sorted(range(len(used)), key=lambda j: (-s[j], last(used[j][0])))
        for p in [j for j in order if j != a and used[j][2] == lab][:5]:
            ok = [j for j in order if used[j][2] != lab and 80 * s[p] <= 100 * s[j] <= 100 * s[p]][:5]
            out += [(i, used[p][0], k, used[j][0], s[p], s[j]) for k, j in enumerate(ok, 1)]
    return sorted(out, key=str)


def mined(df, anchors=100):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, H.mine(H.integer_rows(df, label, 256), F.col("vec_id") % anchors == 0).collect()), key=str)


def test_query_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").collect()]
    want = brute(rows)
    assert want and sorted(map(tuple, QUERIES["op12_hard_negatives"](spark, SF_CHECK).collect()), key=str) == want


def test_many_chunks_stripes_and_copies(spark, monkeypatch):
    rng = random.Random(3)
    centre = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    near = lambda c: [x + rng.gauss(0, 0.2) for x in c]
    rows = [(i, near(centre[i % 6]), rng.randrange(4)) for i in range(900)]
    rows += [(i, rows[5][1], 5 if i % 2 else 3) for i in range(900, 1300)]  # a third are copies of one vector
    monkeypatch.setattr(H, "MEMBERS", 10)
    monkeypatch.setattr(H, "STRIPE", 100)
    monkeypatch.setattr(H, "SAMPLE_NUMBERS", 800)
    want = brute(rows, anchors=10)
    assert want and mined(spark.createDataFrame(rows, SCHEMA), anchors=10) == want


def test_edge_rows(spark):
    rng = random.Random(4)
    vector = lambda: [rng.gauss(0, 1) for _ in range(6)]
    rows = [(i, vector(), rng.randrange(3)) for i in range(120)]
    rows += [(200, [0.0] * 6, 1), (201, [0.0] * 6, 1), (300, rows[0][1], 0), (300, rows[0][1], 0), (300, vector(), 0),
             (None, rows[0][1], 0), (None, rows[0][1], 2), (401, rows[0][1], 1), (402, rows[0][1], 1), (-100, vector(), 1)]
    out = [(500, None, 1), (600, vector(), None), (601, [None] * 6, 1), (700, [float("nan")] + [0.0] * 5, 1),
           (800, [float("-inf")] + [0.0] * 5, 1), (900, [1.0, 2.0], 1), (901, [], 1)]
    df = spark.createDataFrame(rows + out, SCHEMA).withColumns(
        {c: F.lit("clash") for c in ("gid", "q", "cluster", "bound", "score", "anchor", "target", "place")})
    assert mined(df) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 1)], [(100, [1.0, 2.0], 1)], [(100, [1.0, 2.0], 1), (101, [1.0, 2.0], 1)],
                                  [(100, None, 1)], [(100, [-1.0, 0.0], 1), (101, [1.0, 0.0], 1), (102, [1.0, 0.0], 2)]])
def test_without_partners(spark, rows):
    found = H.mine(H.integer_rows(spark.createDataFrame(rows, SCHEMA), F.col("label"), 256), F.col("vec_id") % 100 == 0)
    assert found.count() == 0 and found.columns == [c.split()[0] for c in H.OUT.split(", ")]


def test_entries_beyond_doubles(spark):
    """Scores that doubles do not hold are exact; larger entries are held within the limit."""
    big = H.LARGEST / 256
    rows = [(100, [big, big, 3.0], 1), (101, [big, big, 1.0], 1), (102, [big, big, 0.5], 2), (103, [big, big, 1.0], 2),
            (104, [big * 4, big, 0.75], 2)]
    found = mined(spark.createDataFrame(rows, SCHEMA))
    held = [(i, [min(c, big) for c in v], lab) for i, v, lab in rows]
    assert found == brute(held) and len(found) == 3


@pytest.mark.parametrize("same", [True, False])
def test_a_walk_ends_early_and_misses_nothing(monkeypatch, same):
    rng = np.random.default_rng(6)
    monkeypatch.setattr(H, "STEP", 16)
    seen = []
    scores = H._scores
    monkeypatch.setattr(H, "_scores", lambda a, b: seen.append(len(b)) or scores(a, b))
    d, n = 4, 2000
    centre = rng.standard_normal(d)
    q = np.floor(256 * (np.where(np.arange(n)[:, None] < 300, centre, -centre) + 0.05 * rng.standard_normal((n, d)))).astype(np.int32)
    own = np.floor(256 * (centre + 0.05 * rng.standard_normal((3, d)))).astype(np.int32)
    centres = H.centroids_of(own.astype(float), 1)
    radius = H._angles(own, centres).max(0)
    label = rng.integers(0, 2, n)
    lists = lambda m: pa.array(list(m), pa.list_(pa.int32()))
    items = pa.table({"bound": H._bounds(q, centres, radius)[:, 0], "gid": np.arange(n), "vec_id": np.arange(n), "label": label, "q": lists(q)})
    far = 1 << 61
    members = pa.table({"gid": np.arange(n, n + 3), "label": np.array([0, 1, 0]), "length": np.linalg.norm(own, axis=1),
                        "q": lists(own), "tops": pa.array([[far]] * 3), "needs": pa.array([[-far]] * 3)})
    found = H.walk(members, items, d, same, 5).to_pylist()
    exact = own.astype(np.int64) @ q.astype(np.int64).T
    for m, lab in enumerate([0, 1, 0]):
        ok = np.flatnonzero((label == lab) == same)
        want = ok[np.lexsort((ok, -exact[m][ok]))][:5]
        assert [r["gid"] for r in found if r["anchor"] == n + m] == want.tolist()
    assert sum(seen) <= 320 + 16
