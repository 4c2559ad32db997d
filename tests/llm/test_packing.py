import collections
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import AddedToken, Tokenizer

from cadastra.llm import packing as P

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def encoder():
    return P.Encoder(PATH, PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab C.,'1é\n\t   　<|>\x85", max_size=40))
def test_ids_are_the_tokenizer_s(text):
    t = Tokenizer.from_file(PATH) if not hasattr(test_ids_are_the_tokenizer_s, "t") else test_ids_are_the_tokenizer_s.t
    if not hasattr(test_ids_are_the_tokenizer_s, "t"):
        t.encode_special_tokens = True
        test_ids_are_the_tokenizer_s.t, test_ids_are_the_tokenizer_s.e = t, P.Encoder(PATH, PATTERN)
    ids = np.frombuffer(test_ids_are_the_tokenizer_s.e.encode(text), "<u4").tolist()
    assert ids == t.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_the_tokenizer_s(encoder, tmp_path):
    """A tokenizer left at its defaults: control strings in a text are ids of their own."""
    rng = random.Random(3)
    parts = ["<|endoftext|>", "<|endoftext|", " ", "  ", "\n", "ab", "don't", "é", "<|", "|>", "x <|endoftext|> y"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>\n", "a  <|endoftext|>  b"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(500)]
    default = Tokenizer.from_file(PATH)
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u4").tolist() == default.encode(t, add_special_tokens=False).ids
    # tokens that take white space along, and one that begins another
    default.add_tokens([AddedToken("<|end", normalized=False), AddedToken("ab", lstrip=True, single_word=True)])
    default.save(path := str(tmp_path / "more.json"))
    more = P.Encoder(path, PATTERN)
    for t in texts:
        assert np.frombuffer(more.encode(t), "<u4").tolist() == default.encode(t, add_special_tokens=False).ids


def test_added_tokens_are_packed(spark):
    texts = {1: "a <|endoftext|> b", 2: "<|endoftext|>" * 40, 3: "no control string"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(P.pack(P.tokenized_pieces(df, PATH, PATTERN, 16), 16).collect(), texts, Tokenizer.from_file(PATH), 16)


def test_groups_of_texts_take_little_memory():
    """A worker holds the numbers of one small group, however many texts a batch has."""
    rng = random.Random(9)
    texts = [" ".join(f"{rng.getrandbits(24):x}" for _ in range(200)) for _ in range(500)] * 12  # 8 MB
    column, fresh = pa.array(texts), P.Encoder(PATH, PATTERN)
    tracemalloc.start()
    try:
        n = sum(map(len, fresh.encode_all(column)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n > 4 * 1_200_000
    assert peak < 80 << 20, peak >> 20


def test_texts_encoded_together(encoder, tmp_path, monkeypatch):
    """Groups and caches of any size give each text's own ids; a known or repeated stretch is not encoded again."""
    rng = random.Random(8)
    parts = ["<|endoftext|>", " ", " ", "  ", "\n", " \n", "ab", "don't", "é", "\x85", "\u3000", "word", "日本", "x" * 70, ","]
    texts = ["", " ", "  ", "one", "<|endoftext|>"] + ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(800)]
    default = Tokenizer.from_file(PATH)
    ids = [np.array(default.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for together, learn, cache in ((1, 1, 1), (500, 40, 50), (8 << 20, 1 << 20, 600_000)):
        monkeypatch.setattr(P, "TOGETHER", together)
        monkeypatch.setattr(P, "LEARN", learn)
        monkeypatch.setattr(P, "CACHE", cache)
        for kind in (pa.string(), pa.large_string()):
            assert list(encoder.encode_all(pa.array(texts, kind))) == ids
    assert list(encoder.encode_all(pa.array([], pa.string()))) == []
    fresh, learnt, real = P.Encoder(PATH, PATTERN), [], P.Encoder.learn
    monkeypatch.setattr(P.Encoder, "learn", lambda self, s: learnt.extend(s) or real(self, s))
    for _ in range(2):
        list(fresh.encode_all(pa.array(["a new word and a new word again"] * 50)))
    assert sorted(learnt) == ["a", "again", "and", "new", "word"]


def test_a_worker_keeps_its_encoder():
    assert P.worker_encoder(PATH, PATTERN) is P.worker_encoder(PATH, PATTERN)


def check(rows, texts, tokenizer, capacity):
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [P.END_ID], "<u4")
        at = 0
        for k, r in enumerate(sorted(pieces.pop(doc_id), key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (k, at) and (k == 0 or r["length"] == capacity)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_round_trip(spark, edge_rows, tokenizer):
    texts = {i: t for i, t, *_ in edge_rows if i is not None}
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in texts.items()], "doc_id long, text string, task string, length int")
    rows = P.pack(P.tokenized_pieces(df, PATH, PATTERN, 64), 64).collect()
    n = check(rows, texts, tokenizer, 64)
    assert n <= 1.05 * sum(r["length"] for r in rows) / 64 + 1


def test_repeated_rows_and_empty_table(spark, edge_docs, no_docs):
    pieces = P.tokenized_pieces(edge_docs, PATH, PATTERN)
    assert P.pack(pieces).count() == pieces.count()
    assert P.pack(P.tokenized_pieces(no_docs, PATH, PATTERN)).count() == 0


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for s in sorted(lengths, reverse=True):
        fit = [k for k, g in enumerate(gaps) if g >= s]
        if fit:
            k = min(fit, key=lambda k: gaps[k])
            gaps[k] -= s
        else:
            gaps.append(capacity - s)
    return len(gaps)


def test_plan_is_no_worse_than_best_fit_piece_by_piece():
    rng = random.Random(2)
    for spread in (30, 60, 100):
        lengths = [rng.randint(1, spread) for _ in range(3000)]
        runs = P.plan_bins(collections.Counter(lengths), 100)
        assert collections.Counter(s for n, b in runs for s in b for _ in range(n)) == collections.Counter(lengths)
        assert all(sum(b) <= 100 and sum(3 * s > 100 for s in b) <= 2 for _, b in runs)
        assert sum(n for n, _ in runs) <= 1.01 * best_fit_decreasing(lengths, 100)
