from cadastra.llm.line_dedup import dedup_lines, later_copies, longest_earlier, meet, suffix_levels


def plain(rows, min_chars):
    """Every run of every document against all earlier ones, by brute force."""
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0]))
    first, out = {}, {}
    for n, (i, t) in enumerate(docs):
        lines = t.split("\n")
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(map(len, lines[a:b])) >= min_chars:
                    first.setdefault(tuple(lines[a:b]), (n, a))
    for n, (i, t) in enumerate(docs):
        lines, gone = t.split("\n"), set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                if sum(map(len, lines[a:b])) >= min_chars and first[tuple(lines[a:b])] != (n, a):
                    gone |= set(range(a, b))
        out[i, t] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_matches_brute_force(spark):
    import random
    rng = random.Random(3)
    pool = ["a", "bb", "", "cccc", "a longer line that counts alone", "dd dd", "eeeee"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "no id\na longer line that counts alone"), (102, "same id"), (5, rows[5][1])]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, pos string, n_lines int")
    for least in (1, 8, 20):
        got = dedup_lines(df, least).collect()
        want = plain(rows, least)
        assert len(got) == len(rows)
        assert all(r["text"] == (want[r["doc_id"], t] if (t := _source(rows, r)) is not None else None) for r in got
                   if r["doc_id"] != 5), least


def _source(rows, r):
    return next(t for i, t in rows if i == r["doc_id"])


def test_long_shared_run_and_chance_lines(spark):
    passage = "\n".join(f"sentence {k} of a passage" for k in range(20))
    rows = [(i, f"own start {i}\nThe.\n{passage}\nown end {i}") for i in range(30)]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1]
    assert all(got[i] == f"own start {i}\nown end {i}" for i in range(1, 30))  # "The." is part of the repeated run
    lone = [(1, "The.\nfirst own line"), (2, "The.\nsecond own line")]
    assert {tuple(r)[:2] for r in dedup_lines(spark.createDataFrame(lone, "doc_id long, text string")).collect()} == set(lone)


def test_edges(edge_docs, no_docs):
    assert dedup_lines(edge_docs).count() == edge_docs.count()
    assert dedup_lines(no_docs).count() == 0


def longest(rows):
    """The longest common prefix of every suffix with an earlier one, from a plain list of all suffixes."""
    seen, out = [], {}
    for i, t in rows:
        lines = t.split("\n")
        for a in range(len(lines)):
            best = 0
            for other in seen:
                n = 0
                while n < min(len(other), len(lines) - a) and other[n] == lines[a + n]:
                    n += 1
                best = max(best, n)
            if best:
                out[i, a] = best
            seen.append(lines[a:])
    return out


def test_common_prefixes_and_maximal_runs(spark):
    import random
    rng = random.Random(11)
    rows = [(i, "\n".join(rng.choice("abc") for _ in range(rng.randint(1, 40)))) for i in range(25)]
    rows += [(100, "\n".join("z" * 37)), (101, rows[4][1]), (102, rows[4][1] + "\n" + rows[5][1]), (103, "own")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = longest(rows)
    levels = suffix_levels(df)
    assert 5 <= len(levels) <= 7  # 36 equal lines follow one another
    assert {(r["doc"], r["pos"]): r["lines"] for r in longest_earlier(levels).collect()} == want
    maximal = {k: n for k, n in want.items() if want.get((k[0], k[1] - 1), 0) <= n}
    assert {(r["doc"], r["pos"]): r["lines"] for r in later_copies(df).collect()} == maximal


def test_ranks_are_a_suffix_order(spark):
    rows = [(1, "b\na\nc\na\nb"), (2, "a\nc\na\nb\nb\na"), (3, "c\na\nb\na\nc")]
    levels = suffix_levels(spark.createDataFrame(rows, "doc_id long, text string"))
    first = {(r["doc"], r["pos"]): r["rank"] for r in levels[0].collect()}
    text = {i: t.split("\n") for i, t in rows}
    for k, level in enumerate(levels):
        ranked = [((r["rank"]), tuple(first[r["doc"], r["pos"] + j] for j in range(1 << k)), r["doc"], r["pos"])
                  for r in level.collect()]
        order = sorted(ranked)
        assert [x[1] for x in order] == sorted(x[1] for x in ranked)  # ranks ascend with the line ids
        assert len({x[0] for x in ranked}) == len({tuple(text[d][p:p + (1 << k)]) for _, _, d, p in ranked})


def test_frequent_groups_meet_their_rows(spark):
    from pyspark.sql import functions as F
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"), "id")
    groups = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("least")).where("n > 1 OR key < 3000")
    for how, n in (("inner", 4000), ("left", 6000)):
        got = meet(rows, groups, ["key"], 6000, how).collect()
        assert len(got) == n and len({r["id"] for r in got}) == n
        assert all(r["least"] == (None if r["key"] >= 3000 else r["key"]) for r in got)
