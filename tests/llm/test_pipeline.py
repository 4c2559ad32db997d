import collections

import corpus_pipeline as C
from cadastra.llm import mixing, quality_pu
from cadastra.llm.common import materialise, table
from cadastra.llm.queries import held_out
from tests.conftest import SF_SMALL
from tests.llm.test_jaccard import plain as plain_jaccard
from tests.llm.test_line_dedup import plain as plain_lines


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def test_stages_against_plain_code(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    good = materialise(C.quality(spark, docs, SF_SMALL), "t")
    scores = quality_pu.score_quality(docs, table(spark, SF_SMALL, "labels"), ~held_out(3, 1))
    kept = {r["doc_id"] for r in scores.collect() if r["score"] >= 0.5}
    assert {r["doc_id"] for r in good.collect()} == kept and good.columns == columns

    cut = materialise(C.lines(spark, good, SF_SMALL), "t")
    short = [r for r in good.collect() if r["text"].count("\n") < 60]  # the brute force is cubic in the lines
    if len(short) == good.count():
        want = plain_lines([(r["doc_id"], r["text"]) for r in short], 40)
        assert {r["doc_id"]: r["text"] for r in cut.collect()} == {i: x for (i, t), x in want.items() if x or not t}
    assert cut.columns == columns and all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    near = materialise(C.near_duplicates(spark, cut, SF_SMALL), "t")
    comp = plain_jaccard([(r["doc_id"], r["text"]) for r in cut.collect()])
    assert {r["doc_id"] for r in near.collect()} == {i for i, _, c in comp if i == c} and near.columns == columns

    mixed = materialise(C.mix(spark, near, SF_SMALL), "t")
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert set(times) == {r["doc_id"] for r in near.collect()} and max(times.values()) <= 2 and mixed.columns == columns

    packed = C.pack(spark, mixed, SF_SMALL).collect()
    tokens = collections.Counter()
    for r in packed:
        tokens[r["sequence_id"]] += r["length"]
    assert max(tokens.values()) <= 1024
    assert collections.Counter(r["doc_id"] for r in packed if r["piece"] == 0) == times


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    """Nulls, repeated ids and rows, clashing extra columns: every stage runs and keeps the columns."""
    docs = edge_docs
    for name, stage in C.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF_SMALL), "t")
        assert docs.columns == edge_docs.columns, name
        kept = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
        assert docs.select(*kept).distinct().collect() == [("clash",) * len(kept)], name
    assert C.pack(spark, docs, SF_SMALL).count() > 0
    for name, stage in C.STAGES:
        assert stage(spark, no_docs, SF_SMALL).count() == 0, name


def test_one_row_of_each_group_stays(spark, edge_docs, edge_rows):
    kept = C.near_duplicates(spark, edge_docs, SF_SMALL).select("doc_id", "text").collect()
    comp = plain_jaccard([(i, t) for i, t, *_ in edge_rows])
    groups = {c for i, n, c in comp if n}
    # id 12 names two texts that are not linked: two groups with one smallest id
    assert len([r for r in kept if r["text"] and r["text"].strip()]) == len(groups) + 1


def test_mixture_of_the_pipeline_is_bounded(spark):
    docs = table(spark, SF_SMALL, "documents")
    m = mixing.mix_sources(docs, max_repeats=C.MAX_REPEATS, target_entropy=1.0)
    assert m.agg({"pass": "max"}).first()[0] <= 1
