import collections
import hashlib
import re

from pyspark.sql import functions as F

from cadastra.llm.exact_dedup import build_directory, dedup_exact, slot_of


def plain(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = collections.defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t, *_ in rows:
        g = groups[norm(t)]
        keep = min((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=str)


def test_matches_plain_code(edge_docs, edge_rows):
    assert got(dedup_exact(edge_docs)) == plain(edge_rows)


def test_directory_doubling_and_collisions(edge_docs, edge_rows):
    # hashes that collide on purpose: few values, and one digest for everything
    weak = dedup_exact(edge_docs, capacity=2, max_depth=4, key_hash=lambda c: F.shiftleft(F.length(c) % 5, 61))
    assert got(weak) == plain(edge_rows)
    blind = dedup_exact(edge_docs, capacity=2, key_hash=lambda c: F.length(c) % 7, digest=lambda c: F.lit("same"))
    assert got(blind) == plain(edge_rows)


def test_no_bucket_is_overfull_before_the_last_depth(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key_hash"))
    d = build_directory(keys, capacity=300, max_depth=10)
    sizes = keys.withColumn("slot", slot_of(F.col("key_hash"), 10)).join(d, "slot").groupBy("bucket", "local_depth").count()
    assert sizes.agg(F.sum("count")).first()[0] == 5000
    assert sizes.where("count > 300").count() == 0 and d.select("local_depth").distinct().count() >= 1


def test_empty_table(no_docs):
    assert dedup_exact(no_docs).count() == 0


def test_hot_texts_are_aggregated_before_they_are_routed(spark, edge_rows, edge_docs):
    assert got(dedup_exact(edge_docs, hot_copies=2)) == plain(edge_rows)
    blind = dedup_exact(edge_docs, hot_copies=2, capacity=2, key_hash=lambda c: F.length(c) % 7, digest=lambda c: F.lit("same"))
    assert got(blind) == plain(edge_rows)


def test_owners_have_key_ranges_and_the_index_files_answer_alone(spark, edge_rows, monkeypatch):
    from cadastra.llm import exact_dedup as D
    kept = {}
    monkeypatch.setattr(D, "materialise", lambda df, name, made=D.materialise: kept.setdefault(name, made(df, name)))
    rows = [r[:2] for r in edge_rows] + [(1000 + i, f"text {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = got(dedup_exact(docs, capacity=20))
    assert result == plain(rows)
    index = kept["dedup-index"]
    # a file holds a range of (bucket, key hash), and ranges of different files do not meet
    files = index.groupBy(F.input_file_name().alias("f")).agg(F.min(F.struct("bucket", "key_hash")).alias("a"),
                                                              F.max(F.struct("bucket", "key_hash")).alias("z")).orderBy("a").collect()
    assert len(files) > 1 and all(tuple(x["z"]) < tuple(y["a"]) for x, y in zip(files, files[1:]))
    assert index.groupBy("bucket").agg(F.count_distinct("key_hash").alias("n")).where("n > 20").count() == 0
    # without the texts: entries, directory and index files give every answer
    depth = D.depth_for(len(rows), 20)
    directory = kept["dedup-directory"].select("slot", "bucket")
    entries = kept["dedup-entries"].withColumn("slot", slot_of(F.col("key_hash"), depth)).join(directory, "slot")
    alone = D.look_up(entries, index).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    assert got(alone) == result


def test_depth_follows_the_rows():
    from cadastra.llm.exact_dedup import CAPACITY, depth_for
    assert depth_for(0, CAPACITY) == 4 and depth_for(50_000_000_000, CAPACITY) == 24
    assert 50e9 / 2 ** depth_for(50_000_000_000, CAPACITY) < CAPACITY
