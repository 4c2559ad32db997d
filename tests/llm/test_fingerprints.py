import hashlib
import random

import numpy as np

from cadastra.llm import shingles
from cadastra.llm.fingerprints import BINS, fingerprint, fingerprint_pairs, likeness


def sets(text):
    w = text.split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_likeness_estimates_jaccard():
    rng = random.Random(1)
    errors = []
    for share in (0.0, 0.2, 0.5, 0.8, 0.95):
        for n in (12, 60, 2000):
            w = [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
            cut = int(n * share)
            a, b = " ".join(w), " ".join(w[:cut] + [f"v{rng.randrange(10 ** 6)}" for _ in range(n - cut)])
            x, y = sets(a), sets(b)
            errors.append(likeness(fingerprint(a), fingerprint(b)) - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.05 and np.sqrt(np.mean(np.square(errors))) < 0.12
    assert len(fingerprint("a b")) == BINS // 2 and fingerprint("") == b""
    assert likeness(fingerprint("one"), fingerprint("two")) < 0.3  # single shingles do not agree by chance
    assert likeness(b"", b"") == 1.0 and likeness(b"", fingerprint("x")) == 0.0


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    text = " ".join(f"word{i}é" for i in range(500)) + " " + "z" * 900 + " end"
    whole = shingles.word_hashes(text)
    monkeypatch.setattr(shingles, "PIECE", 64)
    assert (shingles.word_hashes(text) == whole).all() and len(whole) == 502


def test_pairs(edge_docs, edge_rows, spark):
    got = sorted([tuple(r)[:3] + (r["fingerprint"],) for r in fingerprint_pairs(edge_docs).collect()], key=str)
    rows = [(i, t or "") for i, t, *_ in edge_rows]
    assert sorted([(i, len(t), fingerprint(t).hex()) for i, t in rows], key=str) == sorted([(a, b, d) for a, b, _, d in got], key=str)
    # with unique ids the edited text is known as well
    unique = sorted({i: t for i, t in rows if i is not None}.items())
    found = {r["doc_id"]: r for r in fingerprint_pairs(spark.createDataFrame(unique, "doc_id long, text string")).collect()}
    for k, (i, t) in enumerate(unique):
        other = unique[(k + 1) % len(unique)][1]
        e = t[:len(t) - len(t) // 2] + other[:len(t) // 2]
        r = found[i]
        assert r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest() and r["edited_fingerprint"] == fingerprint(e).hex()
        assert r["near_next"] == likeness(fingerprint(t), fingerprint(other))


def test_small_tables(spark, no_docs):
    assert fingerprint_pairs(no_docs).count() == 0
    one = fingerprint_pairs(spark.createDataFrame([(7, "a b c d e f")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
