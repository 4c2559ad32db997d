import random

import numpy as np
from pyspark.sql import functions as F

from cadastra.llm import quality_pu as Q, toxicity as T
from cadastra.llm.common import lowest
from cadastra.llm.queries import QUERIES, held_out
from tests.conftest import SF_CHECK
from tests.llm.conftest import DOC_SCHEMA, words

LABELS = "doc_id long, quality int, toxic int"


def auc(y, s):
    y, s = np.asarray(y), np.asarray(s)
    _, at, c = np.unique(s, return_inverse=True, return_counts=True)
    rank = (np.cumsum(c) - (c - 1) / 2)[at]
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def scored(spark, key, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    rows = QUERIES[key](spark, SF_CHECK).collect()
    held = [(labels[r["doc_id"]], r["score"], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == 1000
    return [np.array(c) for c in zip(*held)]


def test_quality_held_out(spark):
    y, s, p = scored(spark, "op4_quality", "quality")
    assert auc(y, s) > 0.97 and (y == p).mean() > 0.95


def test_toxicity_held_out(spark):
    y, s, p = scored(spark, "op1_toxicity", "toxic")
    assert auc(y, s) > 0.8 and (y == p).mean() > 0.9


def test_prior_and_risk_on_known_classes():
    rng = np.random.default_rng(0)
    n, prior = 4000, 0.6
    good = rng.random(n) < prior
    u = np.where(good[:, None], rng.normal(1.5, 1, (n, 2)), rng.normal(-1.5, 1, (n, 2)))
    p = rng.normal(1.5, 1, (n, 2))
    x = np.hstack([np.ones((2 * n, 1)), np.vstack([p, u])])
    positive = np.arange(2 * n) < n
    x, positive = x[(order := rng.permutation(2 * n))], positive[order]
    found = Q.class_prior(x, positive)
    assert abs(found - prior) < 0.08
    w = Q.fit_nnpu(x, positive, found)
    z = np.hstack([np.ones((n, 1)), u]) @ w
    assert ((z > 0) == good).mean() > 0.95


def test_edges(spark, edge_docs, no_docs, edge_rows):
    labels = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(0, 80)] + [(3, 0, 1), (None, 1, 1), (4, None, None)], LABELS)
    q = Q.score_quality(edge_docs, labels, ~held_out(3, 1)).collect()
    t = T.score_toxicity(edge_docs, labels, ~held_out(4, 2)).collect()
    for rows in (q, t):
        assert len(rows) == len(edge_rows) and all(0 <= r["score"] <= 1 for r in rows)
    none = labels.where("doc_id < 0")
    assert {r["score"] for r in Q.score_quality(edge_docs, none, F.lit(True)).collect()} == {0.5}
    assert T.score_toxicity(edge_docs, none, F.lit(True)).count() == len(edge_rows)
    assert Q.score_quality(no_docs, labels, F.lit(True)).count() == 0
    assert T.score_toxicity(no_docs, labels, F.lit(True)).count() == 0


def numbered_texts(n):
    rng = random.Random(8)
    return [(i, words(rng, 10 + i) + "." * (i % 7), "en", "a", 1) for i in range(n)]


def test_a_repeated_id_does_not_fill_the_sample(spark, monkeypatch):
    first = spark.range(60).orderBy(F.xxhash64(F.lit("web"), "id")).first()[0]
    rows = numbered_texts(60)
    docs = spark.createDataFrame(rows + [rows[first]] * 400, DOC_SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in {first, *range(10)}], LABELS)
    seen = []
    monkeypatch.setattr(Q, "class_prior", lambda x, positive, *_: seen.append((x, positive)) or 0.5)
    assert Q.score_quality(docs, labels, F.lit(True), sample_rows=20).count() == 460
    (x, positive), = seen
    assert len(np.unique(x[~positive], axis=0)) == (~positive).sum() == 20
    assert len(np.unique(x[positive], axis=0)) == positive.sum() == len({first, *range(10)})


def test_prior_is_counted_over_all_documents(spark, monkeypatch):
    rows = numbered_texts(200)
    docs = spark.createDataFrame(rows + rows[:50], DOC_SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 4)], LABELS)
    seen, real = [], Q.class_prior

    def prior(x, positive, count):
        def counted(w, fitted, cuts):
            above, n = count(w, fitted, cuts)
            seen.append((x, positive, w, fitted, cuts, above, n))
            return above, n
        seen.append(real(x, positive, counted))
        return seen[-1]

    monkeypatch.setattr(Q, "class_prior", prior)
    Q.score_quality(docs, labels, F.lit(True), sample_rows=20)
    (x, positive, _, fitted, cuts, above, n), _ = seen
    assert n == 200 - (fitted & ~positive).sum() > 180  # repeated rows are one document
    assert len(above) == len(cuts) and (np.diff(above) >= 0).all() and above[-1] <= n
    del seen[:]
    Q.score_quality(docs, labels, F.lit(True))  # all documents are in the sample: the held-back ones are counted
    (x, positive, w, fitted, cuts, above, n), found = seen
    u = Q._margins(x, w)[~fitted & ~positive]
    assert n == len(u) and above.tolist() == [(u >= c).sum() for c in cuts] and found == real(x, positive)


def test_obfuscated_and_near_person_words():
    known = T._Words({"idiot": 3.0, "achl*": 2.0})
    at = {n: k for k, n in enumerate(T.FEATURES)}
    f = T.features("you are an i.d.i.o.t an 1d1ot", known)
    assert f[at["undone_density"]] > 0 and f[at["near_person"]] == 1.0 and f[at["person"]] > 0
    assert T.features("Achlstein sagt", known)[at["peak"]] == 2.0
    assert T.features("", known) == [0.0] * len(T.FEATURES)


def plain_features(text, lexicon):
    """The lexicon features by their definitions, word by word and pair by pair."""
    def weight(word):
        return max((lexicon.get(k, 0.0) for k in T.keys_of(word)), default=0.0)

    words = text.split()
    n = max(1, len(words))
    hits, undone, mixed, persons = [], 0, 0, []
    for i, w in enumerate(words):
        odd = T._MIXED.search(w) is not None
        repaired = T._SEPARATORS.sub("", w.lower().translate(T.LOOKALIKES)) if odd else ""
        found = weight(w) or (weight(repaired) if odd else 0.0)
        if found:
            hits.append((i, w, found))
        undone += bool(odd and not weight(w) and weight(repaired))
        mixed += odd
        if T._EDGES.sub("", w.lower()) in T.SECOND_PERSON:
            persons.append(i)
    near = sum(any(abs(i - p) <= T.NEAR for p in persons) for i, *_ in hits)
    most = max((sum(1 for _, v, _ in hits if v == w) for _, w, _ in hits), default=0)
    return {"density": 100 * len(hits) / n, "peak": max((x for *_, x in hits), default=0.0),
            "weight": np.log1p(sum(x for *_, x in hits)), "distinct_hits": np.log1p(len({w for _, w, _ in hits})),
            "undone_density": 100 * undone / n, "near_person": near / max(1, len(hits)), "person": 100 * len(persons) / n,
            "mixed": 100 * mixed / n, "capital_words": sum(w.isupper() for w in words) / n,
            "peak_share": most / len(hits) if hits else 0.0}


def test_features_match_plain_code():
    rng = random.Random(21)
    pool = ["you", "You,", "tu", "idiot", "IDIOT!", "1d1ot", "i.d.i.o.t", "achly", "Achse", "it's", "THE", "the", "a1", "?!", "loser"]
    lexicon = {"idiot": 3.0, "loser": 1.5, "ach*": 0.5, "achl*": 2.0}
    at = {n: k for k, n in enumerate(T.FEATURES)}
    for _ in range(200):
        text = " ".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
        got = T.features(text, T._Words(lexicon))
        for name, value in plain_features(text, lexicon).items():
            assert abs(got[at[name]] - value) < 1e-9, (name, text)


def test_weights_minimise_the_risk():
    rng = np.random.default_rng(5)
    n, prior = 1500, 0.5
    good = rng.random(n) < prior
    x = np.vstack([rng.normal(1, 1, (n, 2)), rng.normal(np.where(good, 1, -1)[:, None], 1, (n, 2))])
    x = np.hstack([np.ones((2 * n, 1)), x])
    positive = np.arange(2 * n) < n

    def risk(w):
        z = x @ w
        up, down = np.logaddexp(0, -z), np.logaddexp(0, z)
        return (prior * up[positive].mean() + max(0.0, down[~positive].mean() - prior * down[positive].mean())
                + Q.DECAY / 2 * (w @ w))

    w = Q.fit_nnpu(x, positive, prior)
    assert all(risk(w) <= risk(w + d) + 1e-4 for d in rng.normal(0, 0.2, (200, 3)))


def test_lowest_equals_a_whole_sort(spark):
    mixed = F.xxhash64(F.lit("web"), "id")
    rows = spark.range(3000).union(spark.range(5).crossJoin(spark.range(400).toDF("n")).select("id"))
    want = [r["id"] for r in rows.distinct().orderBy(mixed, "id").limit(50).collect()]
    assert [r["id"] for r in lowest(rows, mixed, ["id"], 50).collect()] == want
    assert lowest(rows, mixed, ["id"], 9000).count() == 3000
    copies = spark.range(20000).select((F.col("id") % 60).alias("id"))  # few distinct rows: the bound is raised
    want = [r["id"] for r in copies.distinct().orderBy(mixed, "id").limit(50).collect()]
    assert [r["id"] for r in lowest(copies, mixed, ["id"], 50).collect()] == want
    assert lowest(rows.limit(0), mixed, ["id"], 50).count() == 0


def test_a_repeated_id_does_not_fill_the_toxicity_sample(spark):
    rows = [(i, text) for i, text, *_ in numbered_texts(60)]
    rows += [(7, rows[7][1])] * 300 + [(7, f"another text {k}") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, label int")
    got = [(r["doc_id"], r["text"], r["label"]) for r in T._sample(docs, labels, F.lit(True), 30).collect()]
    assert len(got) == len(set(got)) <= 30 and all(i % 2 == y for i, _, y in got)
    got = [(r["doc_id"], r["text"]) for r in T._sample(docs, labels, F.lit(True), 1000).collect()]
    assert sorted(got) == sorted(set(rows))
