import math
import random

import numpy as np
import pytest

from cadastra.llm import whitening as W
from cadastra.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def dense(a):
    calls = []

    def product(block):
        calls.append(block.shape[1])
        return a @ block
    return product, calls


@pytest.mark.parametrize("d,n", [(64, 900), (5, 40), (200, 500), (40, 12)])
def test_eigenvectors_reach_double_precision(d, n):
    rng = np.random.default_rng(d)
    c = rng.standard_normal((n, d)) * rng.uniform(1, 30, d)
    c -= c.mean(0)
    a = c.T @ c / n
    product, calls = dense(a)
    values, vectors, residuals = W.jacobi_davidson(product, d, 16)
    want = np.linalg.eigvalsh(a)[::-1][:16]
    assert len(values) == min(16, d) and np.abs(values - want).max() < 1e-12 * want[0]
    assert residuals.max() < 2 * W.TOLERANCE * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert max(calls) <= 24  # blocks, never the matrix


@pytest.mark.parametrize("spectrum", [[5.0] * 20 + [1.0] * 44, [5.0] * 3 + [0.0] * 61, [1e6] + [1.0] * 63, [2.0] * 64])
def test_equal_and_zero_eigenvalues(spectrum):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    a = (q * spectrum) @ q.T
    values, vectors, _ = W.jacobi_davidson(lambda b: a @ b, 64, 16)
    assert np.abs(values - sorted(spectrum)[::-1][:16]).max() < 1e-12 * max(spectrum)
    assert np.abs(a @ vectors - vectors * values).max() < 1e-11 * max(spectrum)


def brute(rows, k=16):
    """(vec_id -> deviation, whitened row), explained, n; by whole matrices."""
    a = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in a])
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    c = (n * u - s) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return [i for i, _ in a], ((n * x - s) ** 2).sum(1), (n * x - s) / n @ q / np.sqrt(e), e / np.trace(c.T @ c / n), n


def check(found, rows, k=16):
    ids, deviation, whitened, explained, n = brute(rows, k)
    k = len(explained)
    want = sorted((i, int(dev), tuple(np.abs(z).round(7))) for i, dev, z in zip(ids, deviation, whitened))
    per = {}
    by_row = sorted(found, key=lambda r: r["component"])
    for r in by_row:
        per.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append((r["deviation"], abs(r["whitened"])))
        assert r["n"] == n and abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-9
    got = []
    for i, by in per.items():
        assert sorted(by) == list(range(1, k + 1))
        for copy in range(len(by[1])):
            got.append((i, by[1][copy][0], tuple(np.round([by[j][copy][1] for j in range(1, k + 1)], 7))))
    assert [g[:2] for g in sorted(got)] == [w[:2] for w in want]
    assert np.abs(np.array([g[2] for g in sorted(got)]) - np.array([w[2] for w in want])).max() < 1e-6


def test_query_against_whole_matrices(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    check(QUERIES["op11_whitening"](spark, SF_SMALL).collect(), rows)


def test_edge_rows(spark):
    from pyspark.sql import functions as F
    rng = random.Random(2)
    vector = lambda: [rng.gauss(0, 1 + j) for j in range(20)]
    rows = [(i, vector(), 0) for i in range(60)]
    rows += [(100 + i, rows[3][1], 1) for i in range(40)]  # a third are copies of one vector
    bad = [(200, None, 0), (201, [None] + [0.0] * 19, 0), (202, [float("nan")] + [0.0] * 19, 0),
           (203, [float("inf")] + [0.0] * 19, None), (204, [1.0, 2.0], 0), (205, [], 0)]
    df = spark.createDataFrame(rows + bad, SCHEMA).withColumns({c: F.lit("clash") for c in ("x", "n", "i", "s", "component", "d")})
    check(W.whiten(df).collect(), rows)
    few = [(i, [rng.gauss(0, 1) for _ in range(5)], None) for i in range(30)]
    check(W.whiten(spark.createDataFrame(few, SCHEMA)).collect(), few)


def test_without_variance_or_rows(spark):
    same = spark.createDataFrame([(1, [0.5, 0.25], 0), (None, [0.5, 0.25], 0)], SCHEMA)
    found = W.whiten(same).collect()
    assert len(found) == 4 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in found} == \
        {(1, 0, None, None, None)}
    assert {r["vec_id"] for r in found} == {1, None}
    # a dimension without variance has no whitened value, the others have
    line = spark.createDataFrame([(i, [float(i), 0.5], 0) for i in range(9)], SCHEMA)
    assert {(r["component"], r["whitened"] is None) for r in W.whiten(line).collect()} == {(1, False), (2, True)}
    for rows in ([], [(1, None, 0)]):
        empty = W.whiten(spark.createDataFrame(rows, SCHEMA))
        assert empty.count() == 0 and empty.columns == [c.split()[0] for c in W._OUT.split(", ")]


def test_sizes_beyond_64_bits(spark):
    rows = [(i, [float(i) * 1e9, 1.0], 0) for i in range(1, 9)] + [(9, [3e38, 0.0], 0)]
    found = W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 18 and all(r["deviation"] is None for r in found if r["vec_id"] == 9)
    assert all(math.isfinite(r["whitened"]) for r in found if r["component"] == 1)
