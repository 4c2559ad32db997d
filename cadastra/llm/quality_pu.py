"""Quality: positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives are documents labelled good; the unlabelled sample is web text taken from all
documents without looking at any label. A linear model over dense text features and a few of their
squares is fitted by minimising (Kiryo et al. 2017)

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss, so a score is the chance that a document is good. The class prior is not
given: it is estimated by the best-bin rule (Garg et al. 2021) from a first classifier of positives
against unlabelled text, on rows held back from it: over the score's upper tails, the smallest ratio of
the unlabelled share to the positive share, with its confidence width. The unlabelled share is counted
over all documents but the few that the first classifier was fitted on.

Fitting uses at most ``sample_rows`` positives and as many unlabelled documents, by hash order; a
document is an id and a text, and counts once however often it is repeated. The features of these (a few
numbers a document) are the only thing that reaches the driver. Every document is scored by one
arithmetic expression in Spark.

Defined results: null text is empty; without any trusted positive every score is 0.5 (nothing is
known against a document); an empty table gives no rows; repeated rows get equal scores; a very long
text is read whole, as one row of a task. Other columns, whatever their names, are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lowest, materialise
from .dense_text import NAMES, dense

SAMPLE_ROWS = 20_000
STEPS, RATE, DECAY = 1500, 0.05, 1e-4
_LIMIT = 6.0


def _features(rows: DataFrame) -> DataFrame:
    kept = [f for f in rows.schema.fields if f.name != "text"]
    names = [f.name for f in kept]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + "".join(f", f_{n} double" for n in NAMES)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([dense(t, t.split()) for t in b.column("text").to_pylist()]).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), *(pa.array(c) for c in found.T)],
                                             names=[*names, *(f"f_{n}" for n in NAMES)])

    return rows.mapInArrow(compute, schema)


def _fit(x: np.ndarray, slope) -> np.ndarray:
    """Weights by full-batch Adam; ``slope(margins)`` is the loss's derivative in each row's margin."""
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(1, STEPS + 1):
        g = x.T @ slope(x @ w) + DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _design(raw: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((raw - mean) / scale, -_LIMIT, _LIMIT)
    return np.hstack([np.ones((len(z), 1)), z, z * z - 1])


def _margins(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``x @ w``, column by column: a row's margin is the same whatever rows are around it."""
    z = np.zeros(len(x))
    for column, weight in zip(x.T, w, strict=True):
        z += column * weight
    return z


#: (weights, rows that they were fitted on, cuts in falling order) -> unlabelled documents at or above each cut, and all
Count = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, int]]


def class_prior(x: np.ndarray, positive: np.ndarray, count: Count | None = None) -> float:
    """Best-bin estimate of the share of positives in the unlabelled rows.

    ``count`` counts them wherever they are; without it they are the unlabelled rows of ``x`` held back.
    """
    held = np.arange(len(x)) % 2 == 1
    n_p, n_u = max(1, (positive & ~held).sum()), max(1, (~positive & ~held).sum())
    weight = np.where(positive, 1 / n_p, 1 / n_u) * ~held / 2
    w = _fit(x, lambda z: weight * (_sigmoid(z) - positive))
    z = _margins(x, w)
    p, u = np.sort(z[positive & held])[::-1], np.sort(z[~positive & held])[::-1]
    if not len(p):
        return 0.5
    # tails that hold at least a tenth of the held-back positives
    cuts = p[max(1, len(p) // 10) - 1:]
    above, n = count(w, ~held, cuts) if count else (np.searchsorted(-u, -cuts, side="right"), len(u))
    if not n:
        return 0.5
    share_p = np.searchsorted(-p, -cuts, side="right") / len(p)
    share_u = above / n
    width = np.sqrt(np.log(4 / 0.1) / 2) * (1 / np.sqrt(n) + 1 / np.sqrt(len(p)))
    best = np.argmin((share_u + width) / share_p)
    return float(np.clip(share_u[best] / share_p[best], 0.05, 0.95))


def _count_all(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, fitted: DataFrame,
               cuts: np.ndarray) -> tuple[np.ndarray, int]:
    """Documents of ``rows`` but ``fitted`` at or above each of the ``cuts`` (falling), and all of them."""
    rising = cuts[::-1]
    keys = [f for f in rows.schema.fields if f.name in ("doc_id", "tie")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keys) + ", reached int"

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = np.column_stack([b.column(f"f_{n}").to_numpy() for n in NAMES])
            reached = np.searchsorted(rising, _margins(_design(raw, mean, scale), w), side="right")
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in keys), pa.array(reached, pa.int32())],
                                             names=[*(f.name for f in keys), "reached"])

    left = rows.mapInArrow(reach, schema).distinct().join(F.broadcast(fitted), ["doc_id", "tie"], "left_anti")
    n = np.zeros(len(cuts) + 1, np.int64)
    for r in left.groupBy("reached").agg(F.count("*").alias("n")).collect():  # a row per cut at most
        n[r["reached"]] = r["n"]
    return np.cumsum(n[::-1])[:-1], int(n.sum())


def fit_nnpu(x: np.ndarray, positive: np.ndarray, prior: float) -> np.ndarray:
    """Weights that minimise the non-negative risk (the correction step when the negative part is below 0)."""
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())

    def slope(z: np.ndarray) -> np.ndarray:
        s = _sigmoid(z)
        up = np.where(positive, prior / n_p * (s - 1), 0.0)                         # prior * R_p(+)
        down = np.where(positive, -prior / n_p * s, s / n_u)                        # R_u(-) - prior * R_p(-)
        loss = np.logaddexp(0, z)                                                   # loss of calling a row negative
        risk = (loss[~positive].sum() / n_u) - prior * loss[positive].sum() / n_p
        return up + down if risk >= 0 else -down

    return _fit(x, slope)


def score_quality(docs: DataFrame, labels: DataFrame, learnable: Column, sample_rows: int = SAMPLE_ROWS,
                  id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, tie (a hash of the text) and score (0..1) of every row of ``docs``.

    ``learnable`` says which labels may be used.
    """
    rows = materialise(_features(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tie"),
                                             F.coalesce(F.col(text_col), F.lit("")).alias("text"))), "quality-features")
    trusted = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
               .where(learnable & (F.col("label") == 1) & F.col("doc_id").isNotNull()).select("doc_id"))
    order = F.xxhash64(F.lit("quality"), "doc_id")
    documents = rows.select("doc_id", "tie").where("doc_id IS NOT NULL")

    def sample(some: DataFrame, salt: str) -> DataFrame:
        return lowest(some, F.xxhash64(F.lit(salt), "doc_id", "tie"), ["doc_id", "tie"], sample_rows)

    known = lowest(trusted, order, ["doc_id"], sample_rows)
    positives = sample(documents.join(F.broadcast(known), "doc_id"), "trusted").withColumn("positive", F.lit(True))
    unlabelled = sample(documents, "web").withColumn("positive", F.lit(False))
    chosen = positives.unionByName(unlabelled)  # 2 * sample_rows documents at most
    data = (rows.join(F.broadcast(chosen), ["doc_id", "tie"]).dropDuplicates(["doc_id", "tie", "positive"])
            .orderBy(order, "positive", "tie").select("doc_id", "tie", "positive", *[f"f_{n}" for n in NAMES]).toPandas())
    positive = data.pop("positive").to_numpy(bool) if len(data) else np.zeros(0, bool)
    if not positive.any():
        return rows.select("doc_id", "tie", F.lit(0.5).alias("score"))

    keys = list(zip(data.pop("doc_id").tolist(), data.pop("tie").tolist()))
    raw = data.to_numpy(float)
    mean, scale = raw.mean(axis=0), np.maximum(raw.std(axis=0), 1e-9)
    x = _design(raw, mean, scale)

    def count(w: np.ndarray, fitted: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, int]:
        known = [keys[i] for i in np.flatnonzero(fitted & ~positive)]
        known = docs.sparkSession.createDataFrame(known, documents.schema)
        return _count_all(rows, mean, scale, w, known, cuts)

    prior = class_prior(x, positive, count)
    w = fit_nnpu(x, positive, prior)

    k = len(NAMES)
    margin = F.lit(float(w[0]))
    for i, n in enumerate(NAMES):
        v = F.least(F.lit(_LIMIT), F.greatest(F.lit(-_LIMIT), (F.col(f"f_{n}") - float(mean[i])) / float(scale[i])))
        margin = margin + v * float(w[1 + i]) + (v * v - 1) * float(w[1 + k + i])
    return rows.select("doc_id", "tie", (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias("score"))
