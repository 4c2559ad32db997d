import collections
import math

from pyspark.sql import functions as F

from cadastra.llm.mixing import mix_sources, mixed_documents, mixture_exponent
from tests.conftest import SF_CHECK


def test_entropy_is_reached_and_not_overshot(spark):
    shares = [0.7, 0.1, 0.1, 0.05, 0.05]
    s = spark.createDataFrame([(str(i), int(p * 1e6), p) for i, p in enumerate(shares)], "source string, tokens long, share double")
    a = mixture_exponent(s, 1e6, 0.9, None)
    def entropy(a):
        w = [p ** a for p in shares]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)
    assert entropy(a) >= 0.9 * math.log(5) - 1e-5 and entropy(a + 1e-3) < 0.9 * math.log(5)
    b = mixture_exponent(s, 1e6, None, 1.5)
    assert b == 1.0  # without a target the shares stay
    c = mixture_exponent(s, 1e6, 1.0, 2.0)
    w = [p ** c for p in shares]
    assert abs(max(x / sum(w) / p for x, p in zip(w, shares)) - 2.0) < 1e-3


def test_budget_and_passes(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 7), "big" if i % 10 else "small") for i in range(2000)],
                                 "doc_id long, text string, source string")
    total = sum(1 + i % 7 for i in range(2000))
    rows = mix_sources(docs, budget=total, target_entropy=0.9).collect()
    per = collections.Counter()
    seen = set()
    for r in rows:
        per[r["source"]] += r["tokens"]
        assert (r["doc_id"], r["pass"]) not in seen
        seen.add((r["doc_id"], r["pass"]))
    assert total - 20 <= sum(per.values()) <= total  # less than one document short in each source
    assert per["small"] > 1.5 * total / 10


def test_a_very_long_document_does_not_cost_the_rest_of_a_pass(spark):
    from cadastra.llm.common import md5_long
    first = spark.range(1, 301).orderBy(md5_long(F.col("id").cast("string"))).first()[0]  # tried first in its block
    docs = [(i, "w " * (30_000 if i == first else 60 + i % 9), "small") for i in range(1, 301)]
    docs += [(i, "w " * 100, None) for i in range(1000, 1900)]
    tokens = collections.Counter()
    for _, text, source in docs:
        tokens[source] += text.count("w")
    # a quarter of each source, without a whole pass: less than the long document
    budget = sum(tokens.values()) // 4
    rows = mix_sources(spark.createDataFrame(docs, "doc_id long, text string, source string"), budget=budget).collect()
    got = collections.Counter()
    for r in rows:
        got[r["source"]] += r["tokens"]
    assert len({(r["doc_id"], r["pass"]) for r in rows}) == len(rows) and first not in {r["doc_id"] for r in rows}
    for source in tokens:  # less than one of the other documents short
        assert -100 < got[source] - budget * tokens[source] / sum(tokens.values()) <= 1


def test_order_within_a_pass_is_a_permutation_of_blocks(spark):
    from cadastra.llm import mixing
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    old, mixing.BLOCK_TOKENS = mixing.BLOCK_TOKENS, 500
    try:
        m = mix_sources(docs, max_repeats=2.0, target_entropy=1.0).cache()
    finally:
        mixing.BLOCK_TOKENS = old
    per = m.select("source", "pass", "block", "place").distinct()
    one = per.groupBy("source", "pass").agg(F.count("*").alias("n"), F.max("place").alias("m"))
    assert one.where("n <> m AND pass = 0").count() == 0
    orders = collections.defaultdict(list)
    for r in per.orderBy("place").collect():
        orders[r["source"], r["pass"]].append(r["block"])
    s = next(s for s, p in orders if p == 1)
    assert orders[s, 0][:5] != orders[s, 1][:5]


def test_edge_rows(edge_docs, no_docs, edge_rows):
    kept = mixed_documents(edge_docs, max_repeats=3.0, target_entropy=1.0)
    assert kept.columns == edge_docs.columns
    ids = {r[0] for r in kept.select("doc_id").collect()}
    assert ids == {r[0] for r in edge_rows}  # without a budget nobody is lost
    assert mix_sources(no_docs, budget=100, target_entropy=0.9).count() == 0


def test_a_cut_block_of_many_documents_takes_linear_time(spark):
    import time
    from cadastra.llm.mixing import _fitting
    n, room = 1_000_000, 9_000_000
    cut = spark.range(n).select(F.lit("s").alias("source"), F.lit(room).cast("long").alias("room"), F.col("id").alias("key"),
                                F.when(F.col("id") % 1000 == 500, 10_000_000).otherwise(F.col("id") % 20).cast("long").alias("tokens"))
    t = time.time()
    got = _fitting(cut).agg(F.count("*").alias("n"), F.max("key_").alias("last")).first()
    assert time.time() - t < 60
    used, want, last = 0, 0, 0
    for k in range(n):
        size = 10_000_000 if k % 1000 == 500 else k % 20
        if used + size <= room:
            used, want, last = used + size, want + 1, k
    assert (got["n"], got["last"]) == (want, last)


def test_other_column_names(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "big" if i % 5 else None) for i in range(200)], "key_id long, body string, origin string")
    kept = mixed_documents(docs, max_repeats=2.0, target_entropy=1.0, id_col="key_id", text_col="body", source_col="origin")
    assert kept.columns == docs.columns and kept.select("key_id").distinct().count() == 200
