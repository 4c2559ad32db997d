"""Toxicity: gradient-boosted trees over dense text features, with isotonic calibration.

*Lexicon.* From part of the labelled documents the operator learns which words, and which word
beginnings of three to eight letters, occur mainly in toxic ones; a short list of common insults is
added. Words are lower-cased and stripped of punctuation.

*Features* (whole text, inside Arrow tasks): lexicon density, weight and peak; the same after undoing
look-alike characters and separators (obfuscation); share of lexicon words near a second-person word;
rates of capitals, punctuation, symbols, repetition and mixed letter-symbol words.

*Model.* Spark's gradient-boosted trees on the rest of the labelled documents, then isotonic
regression on a part that the trees have not seen. Scoring is ``transform`` in the JVM.

The labelled rows are a sample bounded by ``label_rows``, taken in the order of a hash of the id; half
of it gives the lexicon, a third the trees, the rest the calibration. Labels, language, source and id
are no features. An id with several texts is several documents with one label, and all count to the bound.

Defined results: null text is empty; empty texts get the score of their (zero) features; a very long text
is read whole, as one row of a task; repeated label rows of a document count once, toxic if any says so;
repeated rows get equal scores, and so do equal texts; without toxic or without clean examples the score is
the lexicon share of the words, held to 0..1; an empty table gives no rows. Other columns, whatever their
names, are neither read nor returned.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lowest, materialise
from .dense_text import NAMES, dense

LABEL_ROWS = 20_000
LEXICON_SIZE = 5_000
#: fixed values: common English insults, and second-person words of the larger European languages
INSULTS = ["idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "dumb",
           "fool", "jerk", "ugly", "filthy", "vermin"]
SECOND_PERSON = ["you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
                 "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "ti", "tus", "usted", "ustedes", "vosotros"]
#: fixed values: characters that stand in for letters
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")
NEAR = 5
CACHE = 400_000
_EDGES = re.compile(r"^\W+|\W+$")
_MIXED = re.compile(r"[^\W\d_][^\w\s'’-]+[^\W\d_]|[^\W\d_]\d|\d[^\W\d_]")
_SEPARATORS = re.compile(r"[\W_]+")


def keys_of(word: str) -> list[str]:
    """What the lexicon may hold of a word: the word, and its beginnings marked with a star."""
    w = _EDGES.sub("", word.lower())
    return [w, *(w[:k] + "*" for k in range(3, min(9, len(w))))] if w else []


class _Words(dict):
    """raw word -> (weight, weight after undoing obfuscation, second person, mixed); bounded."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def weight(self, word: str) -> float:
        return max((self.lexicon.get(k, 0.0) for k in keys_of(word)), default=0.0)

    def __missing__(self, word: str):
        if len(self) >= CACHE:
            self.clear()
        plain, bare = self.weight(word), _EDGES.sub("", word.lower())
        mixed = bool(_MIXED.search(word))
        undone = self.weight(_SEPARATORS.sub("", word.lower().translate(LOOKALIKES))) if mixed and not plain else 0.0
        found = (plain, undone, bare in _PERSONS, mixed)
        self[word] = out = found if any(found) else None
        return out


_PERSONS = frozenset(SECOND_PERSON)
FEATURES = [*NAMES, "hits", "density", "weight", "peak", "distinct_hits", "undone_density", "near_person", "person", "mixed",
            "capital_words", "peak_share"]


def features(text: str, known: _Words) -> list[float]:
    words = text.split()
    n = max(1, len(words))
    marked = [(i, w, m) for i, w in enumerate(words) if (m := known[w]) is not None]
    hits = [(i, w, m[0] or m[1]) for i, w, m in marked if m[0] or m[1]]
    persons = [i for i, _, m in marked if m[2]]
    near = 0
    if hits and persons:
        at = 0
        for i, _, _ in hits:
            while at + 1 < len(persons) and abs(persons[at + 1] - i) <= abs(persons[at] - i):
                at += 1
            near += abs(persons[at] - i) <= NEAR
    total, peak = sum(x for *_, x in hits), max((x for *_, x in hits), default=0.0)
    most = Counter(w for _, w, _ in hits).most_common(1)
    return [*dense(text, words), math.log1p(len(hits)), 100.0 * len(hits) / n, math.log1p(total), peak,
            math.log1p(len({w for _, w, _ in hits})), 100.0 * sum(1 for *_, m in marked if m[1]) / n,
            near / max(1, len(hits)), 100.0 * len(persons) / n, 100.0 * sum(1 for *_, m in marked if m[3]) / n,
            sum(map(str.isupper, words)) / n, most[0][1] / len(hits) if most else 0.0]


def _with_features(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``rows`` (doc_id, text, label?) with ``features`` in place of the text."""
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", features array<double>"
    names = [f.name for f in kept]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words(lexicon)
        for b in batches:
            found = [features(t, known) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(found, pa.list_(pa.float64()))],
                                             names=[*names, "features"])

    return rows.mapInArrow(compute, schema)


def learn_lexicon(rows: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Weights of words and word beginnings that occur mainly in toxic texts; at most ``size`` of them.

    Counted in Spark, documents once per key; each task adds up its batches before the shuffle.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = (Counter(), Counter())
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist()):
                seen[label].update({k for w in set(text.split()) for k in keys_of(w)})
            keys = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([s[k] for k in keys], pa.int64()) for s in seen)],
                                             names=["key", "clean", "toxic"])

    total = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(total) < 2:
        return {}
    odds = (F.log((F.col("toxic") + 0.1) / total[1]) - F.log((F.col("clean") + 0.1) / total[0]))
    found = (rows.mapInArrow(count, "key string, clean long, toxic long").groupBy("key")
             .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
             .where("toxic >= 3 AND toxic >= clean").withColumn("weight", odds)
             .orderBy(F.desc(F.col("toxic") * F.col("weight")), "key").limit(size))
    return {r["key"]: float(r["weight"]) for r in found.select("key", "weight").collect()}


def _sample(docs: DataFrame, labels: DataFrame, learnable: Column, label_rows: int) -> DataFrame:
    """(doc_id, text, label, role): at most ``label_rows`` labelled documents, by hash order of the id.

    A document is an id with a text; repeated rows count once.
    """
    one = (labels.where(learnable & F.col("label").isNotNull() & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max("label").cast("int").alias("label")))
    mixed = F.xxhash64(F.lit("toxicity"), "doc_id")
    known = lowest(one, mixed, ["doc_id"], label_rows).withColumn("role", F.pmod(F.shiftright(mixed, 20), F.lit(12)))
    tied = docs.withColumn("tie", F.xxhash64("text"))
    found = materialise(tied.select("doc_id", "tie").join(F.broadcast(known), "doc_id").distinct(), "tox-chosen")
    chosen = lowest(found, mixed, ["doc_id", "tie"], label_rows)
    return materialise(tied.join(F.broadcast(chosen), ["doc_id", "tie"]).dropDuplicates(["doc_id", "tie"]).drop("tie"),
                       "tox-sample")  # label_rows rows at most


def score_toxicity(docs: DataFrame, labels: DataFrame, learnable: Column, label_rows: int = LABEL_ROWS,
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id and score (0..1) of every row of ``docs``; ``learnable`` says which labels may be used."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = _sample(rows, labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")), learnable,
                     label_rows)
    lexicon = {w: 3.0 for w in INSULTS} | learn_lexicon(sample.where("role < 6"))
    fit = materialise(_with_features(sample.where("role >= 6").select("doc_id", "label", "role", "text"), lexicon)
                      .select(F.col("label").cast("double").alias("label"), "role", "features"), "tox-fit")
    fit = fit.withColumn("x", array_to_vector("features"))
    trees, steps = fit.where("role < 10"), fit.where("role >= 10")
    scored = _with_features(rows, lexicon)
    if trees.select("label").distinct().count() < 2 or steps.isEmpty():
        at = FEATURES.index("density")
        return scored.select("doc_id", F.least(F.lit(1.0), F.col("features")[at] / 100).alias("score"))
    # leaves of the boosted trees are log-odds steps; the raw margin is calibrated
    model = GBTClassifier(labelCol="label", featuresCol="x", predictionCol="class", maxIter=30,
                          maxDepth=4, stepSize=0.2, seed=7).fit(trees)

    def margins(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1])

    curve = IsotonicRegression(labelCol="label", featuresCol="margin", predictionCol="score").fit(
        margins(steps).select("label", "margin"))
    return curve.transform(margins(scored.withColumn("x", array_to_vector("features")))).select(
        "doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))).alias("score"))
