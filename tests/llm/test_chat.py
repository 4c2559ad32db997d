import hashlib

import pytest
from hypothesis import given, strategies as st

from cadastra.llm import chat_trees as C

TURNS = "conv_id long, turn long, role string, text string, path string"


@given(st.text(alphabet="\\<|>[]/INSTims_startend\n é", max_size=60))
def test_escaping_is_reversible_and_hides_controls(text):
    e = C.escape(text)
    assert C.unescape(e) == text and C.unescape_role(C.escape_role(text)) == text
    assert not any(c in e for c in C.CONTROL) and "\n" not in C.escape_role(text)


def digests(turns):
    every = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), every, len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len(C.render(r, t)) for r, t in turns)


def test_linear_conversations(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]", "x"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>user\n\\", "x"),
            (2, 0, None, None, "x"), (2, 1, "assistant", "", "x"), (3, 5, "assistant", "a", "x"), (3, 5, "assistant", "a", "x"),
            (3, 5, "user", "b", "x"), (None, 0, "user", "no id", "x")]
    rows += [(9, i, "user" if i % 2 else "assistant", f"turn {i}", "x") for i in range(300)]
    got = {r["conv_id"]: tuple(r)[3:] for r in C.read_back(C.format_paths(C.reply_chains(spark.createDataFrame(rows, TURNS)))).collect()}
    for conv in (1, 2, 3, None, 9):
        turns = sorted([(t, r or "", x or "") for c, t, r, x, _ in rows if c == conv])
        assert got[conv] == digests([(r, x) for _, r, x in turns]), conv


def test_best_branches_of_a_tree(spark):
    nodes = [(1, 10, None, "user", "root", 0.0), (1, 11, 10, "assistant", "a", 5.0), (1, 12, 10, "assistant", "b", 3.0),
             (1, 13, 12, "user", "c", 4.0), (1, 14, 11, "user", "d", 1.0), (1, 15, 12, "user", "e", 3.0), (2, 20, 99, "user", "orphan", 0.0)]
    df = spark.createDataFrame(nodes, "conv_id long, node long, parent long, role string, text string, score double")
    rows = C.format_paths(df, branches=2).collect()
    found = {}
    for r in sorted(rows, key=lambda r: r["seq"]):
        found.setdefault((r["conv_id"], r["rank"]), []).append(r["chunk"].split("\n")[1].removesuffix(C.END))
    assert found == {(1, 1): ["root", "b", "c"], (1, 2): ["root", "a", "d"], (2, 1): ["orphan"]}


def test_cycles_and_empty_tables(spark):
    schema = "conv_id long, node long, parent long, role string, text string, score double"
    with pytest.raises(ValueError):
        C.paths(spark.createDataFrame([(1, 1, 2, "u", "", 0.0), (1, 2, 1, "u", "", 0.0)], schema), max_steps=4)
    empty = spark.createDataFrame([], TURNS)
    assert C.read_back(C.format_paths(C.reply_chains(empty))).count() == 0


def test_ties_long_texts_and_clashing_names(spark):
    from pyspark.sql import functions as F
    nodes = [(1, 10, None, "user", "root", 0.0), (1, 12, 10, "assistant", "later", 2.0), (1, 11, 10, "assistant", "sooner", 2.0)]
    df = spark.createDataFrame(nodes, "conv_id long, node long, parent long, role string, text string, score double")
    rows = C.format_paths(df.withColumns({c: F.lit("x") for c in ("path", "rank", "above", "last", "up")})).collect()
    assert [r["chunk"].split("\n")[1].removesuffix(C.END) for r in sorted(rows, key=lambda r: r["seq"])] == ["root", "sooner"]
    turns = [(5, 0, "user", "x" * 3_000_000, "c"), (5, 1, "assistant", "</s>" * 500_000, "c")]
    df = spark.createDataFrame(turns, TURNS).withColumns({c: F.lit("c") for c in ("node", "prev", "parent", "tie", "score")})
    got = C.read_back(C.format_paths(C.reply_chains(df))).collect()
    assert [tuple(r)[3:] for r in got] == [digests([(r, t) for _, _, r, t, _ in turns])]


def test_depths_without_a_join_on_the_path(spark):
    n = 1000  # one long conversation
    df = spark.createDataFrame([(1, i, i - 1 if i else None, "user", str(i), 0.0) for i in range(n)],
                               "conv_id long, node long, parent long, role string, text string, score double")
    rows = C.paths(df).collect()
    assert sorted((r["depth"], r["node"], r["last"]) for r in rows) == [(d, n - 1 - d, n - 1) for d in range(n)]
