"""Embedding whitening by block Jacobi-Davidson with distributed, matrix-free centred products.

*Numbers.* An entry ``c`` becomes the integer ``floor(scale * c) + shift``; the fit list holds every distinct
integer vector ``x`` once. With ``n`` of them and sums ``S`` the centred vector is ``(n * x - S) / n``, whose
numerator is exact, so nothing is lost to the size of the entries.

*Products.* The covariance is never formed. ``V @ B`` for a block of vectors ``B`` is one Spark job over the
written fit list: every task adds ``c (c' B)`` of its rows up, Spark adds the tasks' sums by dimension, and
(dimension x block) numbers come back. What the driver holds are blocks of that size, whatever the rows.

*Eigenvectors.* A block of Ritz vectors is improved together. The correction equation of each,
``(1 - QQ')(V - theta)(1 - QQ') t = -r`` with ``Q`` the locked vectors and the block, is solved roughly by MINRES;
all columns run in step, so a step is one job. Corrections widen the subspace, Rayleigh-Ritz follows, and leading
vectors are locked once their residual, from a product of its own, is down to ``TOLERANCE`` of the largest
eigenvalue. A wide subspace restarts from its best Ritz vectors. At the end the remaining subspace must
hold no eigenvalue above the locked ones.

Defined results: rows with a null vector or null or non-finite entries are left out; of several vector lengths
the most frequent one counts (the longest of those that tie) and rows of others are left out; integers are held
within ``LARGEST`` of ``shift``. Repeated vectors count once in the fit list and every row is whitened; a null
id is an id like any other. Eigenvalues that are zero next to the largest give null ``whitened`` and no part of
the identity error; without variance ``explained`` is null too. ``deviation`` is null beyond 63 bits. There
are as many components as dimensions if those are fewer; no usable row gives no rows. Columns other than the id and
the vector do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = 1 << 40
#: residuals at which vectors are locked, in parts of the largest eigenvalue
TOLERANCE = 2.0 ** -45
#: Ritz vectors beyond the wanted ones in the first block
GUARD = 4
#: MINRES steps of a correction, and the part of the residual at which a column stops earlier
INNER_STEPS, INNER_PART = 5, 0.02
#: rows that a task works on at once
CHUNK = 4096

_OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")

Product = Callable[[np.ndarray], np.ndarray]


# -- eigenvectors: small matrices on the driver, products from elsewhere

def _corrections(product: Product, theta: np.ndarray, residual: np.ndarray, against: np.ndarray) -> np.ndarray:
    """MINRES on the projected correction equation of every column, one product a step for all columns."""
    inside = lambda m: m - against @ (against.T @ m)
    size = lambda m: np.sqrt((m * m).sum(0))
    ratio = lambda a, b: np.divide(a, b, out=np.zeros_like(a), where=b > 0)
    right = inside(-residual)
    beta = size(right)
    first, eta = beta, beta.copy()
    v, before = ratio(right, np.broadcast_to(beta, right.shape)), np.zeros_like(right)
    beta = np.zeros_like(beta)
    w, w_before, x = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    c, c_before, s, s_before = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(INNER_STEPS):
        if not (np.abs(eta) > INNER_PART * first).any():
            break
        image = inside(product(v) - v * theta)
        alpha = (v * image).sum(0)
        following = image - v * alpha - before * beta
        beta_next = size(following)
        delta = c * alpha - c_before * s * beta
        rho = np.hypot(delta, beta_next)
        w_next = ratio(v - w_before * (s_before * beta) - w * (s * alpha + c_before * c * beta), np.broadcast_to(rho, v.shape))
        c_before, c, s_before, s = c, ratio(delta, rho), s, ratio(beta_next, rho)
        x += w_next * (c * eta)
        eta = -s * eta
        w_before, w, before, v = w, w_next, v, inside(ratio(following, np.broadcast_to(beta_next, v.shape)))
        beta = beta_next
    return x


def _orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the orthonormal ``against``."""
    out = np.zeros((len(new), 0))
    for t in new.T:
        length = np.linalg.norm(t)
        for _ in range(3):  # each pass removes what rounding left of the one before
            for q in (against, out):
                t = t - q @ (q.T @ t)
        if np.linalg.norm(t) > 1e-10 * length > 0:
            out = np.column_stack([out, t / np.linalg.norm(t)])
    return out


def _leading(small: np.ndarray) -> int:
    """How many of the first entries hold without a gap."""
    return len(small) if small.all() else int(np.argmin(small))


def jacobi_davidson(product: Product, d: int, wanted: int, outer: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors, residual norms) of the ``wanted`` largest ones, falling."""
    rng = np.random.default_rng(11)
    wanted = min(wanted, d)
    block = min(d, wanted + GUARD)
    widest = max(4 * block, block + 8)
    locked, values = np.zeros((d, 0)), np.zeros(0)
    basis = _orthonormal(rng.standard_normal((d, block)), locked)
    image, largest = product(basis), 0.0
    for _ in range(outer):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        largest = max(largest, theta[0] if len(theta) else 0.0)
        limit = TOLERANCE * largest
        if len(values) >= wanted and (not len(theta) or theta[0] <= values.min() + limit):
            break
        left = max(wanted - len(values), 1)
        residual = image - basis * theta
        residual -= locked @ (locked.T @ residual)
        ready = _leading(np.linalg.norm(residual[:, :left], axis=0) <= limit)
        if ready:  # a product of its own decides, not one carried through turns of the basis
            image[:, :ready] = product(basis[:, :ready])
            theta[:ready] = (basis[:, :ready] * image[:, :ready]).sum(0)
            off = image[:, :ready] - basis[:, :ready] * theta[:ready]
            ready = _leading(np.linalg.norm(off - locked @ (locked.T @ off), axis=0) <= limit)
            locked, values = np.column_stack([locked, basis[:, :ready]]), np.r_[values, theta[:ready]]
            basis, image = basis[:, ready:], image[:, ready:]
            if ready:
                continue
        free = d - locked.shape[1] - basis.shape[1]
        if not free:  # nothing left to widen by: only rounding is between the basis and its image
            basis = _orthonormal(basis, locked)
            image = product(basis)
            continue
        if basis.shape[1] + left > widest:
            basis, image = basis[:, :left + GUARD], image[:, :left + GUARD]
        at = min(left, free, basis.shape[1])
        new = _corrections(product, theta[:at], residual[:, :at], np.column_stack([locked, basis[:, :left + GUARD]]))
        known = np.column_stack([locked, basis])
        new = _orthonormal(new, known)
        if not new.shape[1]:
            new = _orthonormal(rng.standard_normal((d, 1)), known)
        basis, image = np.column_stack([basis, new]), np.column_stack([image, product(new)])
    else:
        raise ArithmeticError(f"only {len(values)} of {wanted} components reached double precision")
    image = product(locked)
    small = locked.T @ image
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    theta, turn = theta[::-1][:wanted], turn[:, ::-1][:, :wanted]
    vectors = locked @ turn
    return theta, vectors, np.linalg.norm(image @ turn - vectors * theta, axis=0)


# -- sums over the fit list

def integer_vectors(rows: DataFrame, vec_col: str, id_col: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x): the usable rows as integer vectors, of every length; written."""
    usable = F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))

    def entry(c: Column) -> Column:
        scaled = F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST))))
        return scaled.cast("long") + F.lit(shift).cast("long")

    return materialise(rows.where(F.col(vec_col).isNotNull() & usable)
                       .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vec_col, entry).alias("x")), "whiten-rows")


def _chunks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for k in range(0, b.num_rows, CHUNK):
            part = b.slice(k, CHUNK)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _numerators(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S``, as Python integers where 64 bits might not do."""
    if len(x) and n * int(np.abs(x).max()) + max(abs(int(s)) for s in sums) >= 1 << 63:
        return x.astype(object) * n - sums
    return x * np.int64(n) - sums.astype(np.int64)


class FitList:
    """The written list of distinct vectors with its count and sums, and sums of matrices over its centred rows."""

    def __init__(self, vectors: DataFrame, d: int):
        self.rows, self.d = materialise(vectors.select("x").distinct(), "whiten-fit"), d

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, x in _chunks(batches, d):  # a chunk's sums fit in 64 bits; Spark adds them as decimals
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(np.full(d, len(x))), pa.array(x.sum(0))],
                                                 names=["i", "n", "s"])

        made = self.rows.mapInArrow(add_up, "i long, n long, s long").groupBy("i").agg(
            F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
        found = sorted(made.collect(), key=lambda r: r["i"])  # one row a dimension
        self.n, self.sums = found[0]["n"], np.array([int(r["s"]) for r in found], object)

    def summed(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over chunks of centred rows of the small matrix ``of`` (chunk), divided by n; one job."""
        d, n, sums = self.d, self.n, self.sums
        rows, columns = of(np.zeros((0, d))).shape

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((rows, columns))
            for _, x in _chunks(batches, d):
                total += of(_numerators(x, n, sums).astype(np.float64) / n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows)), *(pa.array(c) for c in total.T)],
                                             names=["i", *(f"y{k}" for k in range(columns))])

        schema = ", ".join(["i long", *(f"y{k} double" for k in range(columns))])
        made = self.rows.mapInArrow(add_up, schema).groupBy("i").agg(*[F.sum(f"y{k}").alias(f"y{k}") for k in range(columns)])
        found = sorted(made.collect(), key=lambda r: r["i"])
        return np.array([r[1:] for r in found], np.float64).reshape(rows, columns) / n

    def product(self, block: np.ndarray) -> np.ndarray:
        """The covariance times ``block``."""
        return self.summed(lambda c: c.T @ (c @ block))


def whiten(rows: DataFrame, components: int = COMPONENTS, vec_col: str = "embedding", id_col: str = "vec_id",
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    vectors = integer_vectors(rows, vec_col, id_col, scale, shift)
    lengths = vectors.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("c")).where("d > 0")
    most = lengths.orderBy(F.desc("c"), F.desc("d")).first()
    if most is None:
        return rows.sparkSession.createDataFrame([], _OUT)
    d = most["d"]
    vectors = vectors.where(F.size("x") == d)
    fit = FitList(vectors, d)
    trace = float(fit.summed(lambda c: (c * c).sum().reshape(1, 1))[0, 0])
    values, directions, _ = (jacobi_davidson(fit.product, d, components) if trace > 0 else
                             (np.zeros(min(components, d)), np.eye(d)[:, :components], None))
    directions = directions * np.where(np.take_along_axis(directions, np.abs(directions).argmax(0)[None], 0) < 0, -1.0, 1.0)
    there = values > d * TOLERANCE * (values[0] if len(values) else 0)
    scaled = directions[:, there] / np.sqrt(values[there])
    k, n, sums = len(values), fit.n, fit.sums
    error = None
    if there.any():
        def squares(c: np.ndarray) -> np.ndarray:
            z = c @ scaled
            return np.vstack([z.T @ z, z.sum(0)])
        found = fit.summed(squares)
        error = float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(len(found) - 1)).max())
    explained = [float(v / trace) if trace > 0 else None for v in values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _chunks(batches, d):
            over = _numerators(x, n, sums)
            if over.dtype != object and d * max(int(np.abs(over).max()), 1) ** 2 >= 1 << 63:
                over = over.astype(object)
            deviation = (over * over).sum(1).tolist()
            z = np.full((len(x), k), np.nan)
            z[:, there] = over.astype(np.float64) / n @ scaled
            whitened = z.ravel()
            # the id and the deviation of a row stand at each of its components
            at = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(whitened), n)),
                pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()).take(at),
                pa.array(whitened, mask=np.isnan(whitened)), pa.array(explained * len(x), pa.float64()),
                pa.array([error] * len(whitened), pa.float64())], names=[c.split()[0] for c in _OUT.split(", ")])

    return vectors.mapInArrow(project, _OUT)
