import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from cadastra.llm import bpe_codec as B
from cadastra.llm.queries import QUERIES
from tests.conftest import SF_SMALL

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
TOKENIZER, CODEC = Tokenizer.from_file(PATH), B.Codec(PATH, PATTERN)
PARTS = ["<|endoftext|>", "<|endoftext|", " ", "  ", "\n", "ab", "don't", "é", "<|", "|>", " aaaaaaaa", "xxxx", "\u3000", "\x85", "12"]


def same(texts):
    ids = [i.tolist() for i in CODEC.encode(texts)]
    assert ids == [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    for i in ids:
        assert CODEC.decode(np.array(i, np.int64)).decode("utf-8", "replace") == TOKENIZER.decode(i, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    same(texts)


def test_control_strings_runs_and_blanks():
    rng = random.Random(3)
    same(["".join(rng.choices(PARTS, k=rng.randint(0, 20))) for _ in range(2000)])


def test_long_words_and_long_texts(monkeypatch):
    rng = random.Random(4)
    texts = ["x" * 50_000, "ab" * 20_000, "".join(rng.choices("abcdefghij0123", k=30_000)), " ".join(["word"] * 5000), ""]
    same(texts)
    monkeypatch.setattr(B, "GROUP_CHARS", 100)  # texts in parts, groups of few words
    monkeypatch.setattr(B, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(B, "CACHE", 50)
    same(texts + ["".join(rng.choices(PARTS, k=200)) for _ in range(50)])
    assert len(CODEC.known) <= 50 and all(len(w) <= B.LONG_WORD for w in CODEC.known)


def test_any_ids_decode_as_there():
    rng = random.Random(5)
    for _ in range(200):
        ids = [rng.randrange(50_400) for _ in range(rng.randint(0, 40))]  # wrong UTF-8 and unknown ids too
        assert CODEC.decode(np.array(ids, np.int64)).decode("utf-8", "replace") == TOKENIZER.decode(ids, skip_special_tokens=False)


def test_files_of_another_kind_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        file = json.load(f)
    merges = file["model"]["merges"]
    for change in ({"merges": merges[::-1]}, {"ignore_merges": True}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps({**file, "model": {**file["model"], **change}}))
        with pytest.raises(ValueError):
            B.Codec(str(path), PATTERN)


def expected(rows):
    out = []
    for doc_id, text in rows:
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(TOKENIZER.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_over_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op13_bpe_codec"](spark, SF_SMALL).collect()), key=str) == expected(docs)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    encoded = B.encode_documents(edge_docs.drop("ids"), PATH, PATTERN)
    found = B.decode_documents(encoded, PATH, PATTERN).collect()
    assert len(found) == len(edge_rows)
    want = sorted([(r[0], TOKENIZER.encode(r[1] or "", add_special_tokens=False).ids, r[1] or "") for r in edge_rows], key=str)
    assert sorted(map(tuple, found), key=str) == want
    assert B.decode_documents(B.encode_documents(no_docs, PATH, PATTERN), PATH, PATTERN).count() == 0
    some = spark.createDataFrame([(1, None), (None, [220, None, 99999, 220])], "doc_id long, ids array<int>")
    assert {tuple(r)[0]: r["text"] for r in B.decode_documents(some, PATH, PATTERN).collect()} == {1: "", None: "  "}
