"""Document fingerprints: one-permutation MinHash, optimal densification, packed low-order bits.

Every word shingle (five words) of a text is hashed once; the high bits name one of ``BINS`` bins,
and each bin keeps its smallest value. An empty bin copies the bin that a fixed sequence of hashes of
its own number reaches first among the filled ones (optimal densification: empty bins choose
independently of each other). Of each bin ``BITS`` bits are stored, drawn from the value mixed with
the bin's number, so that copied values do not agree or differ all at once by chance. With ``m`` the
share of equal bins, the likeness is ``(m - c) / (1 - c)`` with ``c = 2 ** -BITS`` (the chance of
equal bits for unequal values), held to 0..1.

``fingerprint_pairs`` also compares each document with an edited copy and with the next document by
id. Rows are dealt by ranges of ids and sorted, so the next document is the next row of the task;
only the last row of each range meets the first row of the following one in a second, small step.

Defined results: null text is empty; a text without words has an empty fingerprint, which is like
another empty one (1.0) and unlike any other (0.0); ids that repeat are ordered by a hash of the
text; a null id comes first; one row alone is its own next document; an empty table gives no rows; a very
long text is read whole, as one row of a task. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shuffle_partitions
from .shingles import mix, shingle_hashes, word_hashes

BINS, BITS = 256, 4
_TRIES = 1 << 12
_SHIFT = np.uint64(64 - 8)
_BIN_SALT = mix(np.arange(BINS, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
#: the bins that an empty bin tries, one column per bin
_ROUTE = (mix(np.arange(_TRIES * BINS, dtype=np.uint64) ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(BINS)).astype(
    np.uint8).reshape(_TRIES, BINS)


def fingerprint(text: str) -> bytes:
    """Packed fingerprint of a whole text; empty bytes if it has no words."""
    h = np.sort(shingle_hashes(word_hashes(text)))
    if not len(h):
        return b""
    bins = (h >> _SHIFT).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    values, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    values[bins[first]], filled[bins[first]] = h[first], True
    source = np.arange(BINS)
    todo = np.flatnonzero(~filled)
    for at, size in ((0, 16), (16, 240), (256, _TRIES - 256)):
        if not len(todo):
            break
        route = _ROUTE[at:at + size, todo]
        hit = filled[route]
        step = hit.argmax(axis=0)
        found = hit[step, np.arange(len(todo))]
        source[todo[found]] = route[step[found], np.flatnonzero(found)]
        todo = todo[~found]
    source[todo] = bins[0]  # beyond the last try
    bits = (mix(values[source] ^ _BIN_SALT) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return ((bits[0::2] << 4) | bits[1::2]).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard likeness of two texts' shingle sets, corrected for chance agreement."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(v, np.uint8) for v in (a, b))
    d = x ^ y
    m = (np.count_nonzero(d & 0xF0 == 0) + np.count_nonzero(d & 0x0F == 0)) / BINS
    chance = 2.0 ** -BITS
    return min(1.0, max(0.0, (m - chance) / (1 - chance)))


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by as many first ones of ``following``."""
    n = len(text) // 2
    return text[:len(text) - n] + following[:n]


_ROW = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()), ("fp", pa.binary()),
        ("edited_fp", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()),
        ("kind", pa.string()), ("text", pa.string())]
_ROW_SCHEMA = ("doc_id long, n_chars long, edited_sha256 binary, fp binary, edited_fp binary, near_edited double, "
               "near_next double, part int, kind string, text string")


def _compared(doc_id, text: str, fp: bytes, following: str, next_fp: bytes, part: int) -> tuple:
    other = edited(text, following)
    data = other.encode()
    other_fp = fp if other == text else fingerprint(other)
    return (doc_id, len(text), hashlib.sha256(data).digest(), fp, other_fp, likeness(fp, other_fp),
            likeness(fp, next_fp), part, "row", None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _ROW)], names=[n for n, _ in _ROW])


def fingerprint_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, its edited copy's, and the two likenesses."""
    n = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    dealt = (rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(n, "doc_id", "tie")
             .sortWithinPartitions("doc_id", "tie").drop("tie"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        edge = lambda kind, doc_id, text: (doc_id, None, None, None, None, None, None, part, kind, text)
        for b in batches:
            out = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                fp = fingerprint(text)
                if last is None:
                    out.append(edge("first", doc_id, text))
                else:
                    out.append(_compared(*last, text, fp, part))
                last = (doc_id, text, fp)
            if out:
                yield _batch(out)
        if last:
            yield _batch([edge("last", *last[:2])])

    found = materialise(dealt.mapInArrow(compare, _ROW_SCHEMA), "fingerprints")

    # the last row of each range with the first row of the next one that has rows; after the last, the first
    firsts = found.where("kind = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    lasts = found.where("kind = 'last'").select("part", "doc_id", "text")
    parts = found.where("kind = 'first'").select("part")  # at most one row per shuffle partition
    every = Window.orderBy("part")
    order = parts.select("part", F.coalesce(F.lead("part").over(every), F.min("part").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next_part"))
    pairs = lasts.join(order, "part").join(firsts, "next_part").select("doc_id", "text", "following", "part")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [_compared(r["doc_id"], r["text"], fingerprint(r["text"]), r["following"], fingerprint(r["following"]),
                             r["part"]) for r in b.to_pylist()]
            if out:
                yield _batch(out)

    every_row = found.where("kind = 'row'").unionByName(pairs.mapInArrow(close, _ROW_SCHEMA))
    as_hex = lambda c: F.lower(F.hex(c)).alias
    return every_row.select("doc_id", "n_chars", as_hex("edited_sha256")("edited_sha256"), as_hex("fp")("fingerprint"),
                            as_hex("edited_fp")("edited_fingerprint"), "near_edited", "near_next")
