import collections
import random
import re

from cadastra.llm import jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, percent=80):
    """(n_shingles, component_id) of each row, all pairs compared."""
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else
                    frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)))
    by = collections.defaultdict(list)
    for k, s in enumerate(sets):
        by[s].append(k)
    kinds = [s for s in by if s]
    up = {s: s for s in kinds}
    def root(s):
        while up[s] is not s:
            s = up[s]
        return s
    for a in range(len(kinds)):
        for b in range(a):
            common = len(kinds[a] & kinds[b])
            if 100 * common >= percent * (len(kinds[a]) + len(kinds[b]) - common):
                up[root(kinds[a])] = root(kinds[b])
    least = {}
    for k, s in enumerate(sets):
        if s and rows[k][0] is not None:
            r = root(s)
            least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    return sorted([(i, len(s), least.get(root(s)) if s else i) for (i, _), s in zip(rows, sets)], key=str)


def got(df):
    return sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()], key=str)


def test_edges(edge_docs, edge_rows, no_docs):
    out = J.linked_components(edge_docs).cache()
    assert got(out) == plain([(i, t) for i, t, *_ in edge_rows])
    assert J.linked_components(no_docs).count() == 0
    heads = out.where("first AND n_shingles > 0").select("component_id").collect()
    assert {r[0] for r in heads} == {r["component_id"] for r in out.where("n_shingles > 0").collect()}


def test_frequent_passages_and_large_groups(spark, monkeypatch):
    """Small thresholds, so that frequent shingles, whole sets, several cells and all steps occur."""
    monkeypatch.setattr(J, "FREQUENT", 3)
    monkeypatch.setattr(J, "BLOCK", 4)
    rng = random.Random(9)
    w = lambda n: [f"w{rng.randrange(500)}" for _ in range(n)]
    passage, base, rows = w(60), w(90), []
    for i in range(150):
        kind = i % 5
        if kind == 0:
            t = w(8) + passage + w(5)
        elif kind == 1:
            t = list(base)
            for _ in range(rng.randrange(6)):
                t[rng.randrange(len(t))] = f"e{i}"
        elif kind == 2:
            t = passage[: rng.randint(40, 60)]
        elif kind == 3:
            t = passage + base[: rng.randint(0, 40)]
        else:
            t = w(rng.randint(1, 40))
        rows.append((1000 - i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(J.linked_components(df)) == plain(rows)


def test_stored_shingles_shared_with_whole_sets_only(spark, monkeypatch):
    """A shingle of one ordinary document that a deep one holds beyond its stored part is an entry of both."""
    monkeypatch.setattr(J, "FREQUENT", 3)
    rng = random.Random(6)
    w = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    passage, rows = w(60), []
    for i in range(12):
        tail = w(18)
        rows += [(2 * i, " ".join(passage + tail)), (2 * i + 1, " ".join(tail + w(3)))]
    made, real = collections.defaultdict(list), J.materialise
    monkeypatch.setattr(J, "materialise", lambda df, name: made[name].append(real(df, name)) or made[name][-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "xxhash64(text) AS tie", "text")
    classes = J._sets(docs, 80)
    postings = {(r["token"], r["row"]) for r in J._postings(classes, docs, 80).collect()}
    frequent = {r["token"] for r in made["jaccard-marks"][0].where("last = 1").collect()}
    deep = {r["row"] for df in made["jaccard-deep"] for r in df.collect()}
    prefixes, texts = {}, dict(rows)
    for c in classes.collect():
        s = c["low"] if c["row"] not in deep else J.shingle_set(texts[c["doc_id"]]).tolist()
        order = sorted(s, key=lambda t: (t in frequent, t))
        prefixes[c["row"]] = order[:min(c["n"], c["n"] - J._overlap(c["n"], 80) + J.LONGEST)]
    counts = collections.Counter(t for p in prefixes.values() for t in p)
    assert deep and len(deep) < len(rows)
    assert postings == {(t, row) for row, p in prefixes.items() for t in p if counts[t] > 1}


def test_stored_hashes_and_whole_sets_are_dealt_once(spark, monkeypatch):
    """The large tables are shuffled once each: stored hashes joined by shingle, sets of compared documents by cell."""
    monkeypatch.setattr(J, "FREQUENT", 3)
    rng = random.Random(6)
    w = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    passage, rows = w(60), []
    for i in range(12):
        tail = w(18)
        rows += [(3 * i, " ".join(passage + tail)), (3 * i + 1, " ".join(tail + w(3))), (3 * i + 2, " ".join(passage + tail[1:]))]
    plans, real = [], J.materialise

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    monkeypatch.setattr(J, "materialise", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        found = got(J.linked_components(spark.createDataFrame(rows, "doc_id long, text string")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == plain(rows)
    # the scan of low in a plan that joins it by shingle other than with a broadcast list
    by_shingle = [n for n, p in plans if "posexplode(low" in p and re.search(r"(SortMergeJoin|ShuffledHashJoin) \[token", p)]
    assert by_shingle == ["jaccard-entries"]
    links = [p for n, p in plans if n == "jaccard-links"]
    assert len(links) == 2 and not any(re.search(r"SortMergeJoin|ShuffledHashJoin", p) for p in links)
    assert all(len(re.findall(r"Exchange hashpartitioning", p)) == 1 for p in links)


def test_components(spark):
    from cadastra.llm.components import component_roots
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    up = {}
    def root(x):
        while up.get(x, x) != x:
            x = up[x]
        return x
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    nodes = {x for p in links if p[0] != p[1] for x in p}
    found = {r["node"]: r["root"] for r in component_roots(spark.createDataFrame(links, "x long, y long")).collect()}
    assert found == {x: root(x) for x in nodes}


def test_many_texts_under_one_id(spark):
    """Texts are found again by id and text, so one id with many texts costs a row each, not a pair each."""
    import hashlib
    import random
    from cadastra.llm import jaccard_join as J
    from tests.llm.conftest import words
    rng = random.Random(8)
    texts = [words(rng, 40) for _ in range(300)]
    rows = spark.createDataFrame([(7, k, t) for k, t in enumerate(texts)], "doc_id long, tie long, text string")
    wanted = spark.createDataFrame([(i, 7, i, bytearray(hashlib.blake2b(J.shingle_set(t).tobytes(), digest_size=16).digest()))
                                    for i, t in enumerate(texts)], "row long, doc_id long, tie long, digest binary")
    assert J._whole_sets(rows, wanted).count() == 300
    docs = spark.createDataFrame([(7, t) for t in texts + texts[:5]], "doc_id long, text string")
    found = J.linked_components(docs).collect()
    assert len(found) == 305 and {r["component_id"] for r in found} == {7}
