"""Best-fit packing of tokenized documents into sequences of ``capacity`` tokens.

*Pieces.* A document is its token ids and an end id. Longer ones are cut into full pieces of
``capacity`` tokens, the first piece being the rest. Every task writes its pieces with their rank
among the pieces of equal length that it made itself.

*Plan.* Pieces of one length are interchangeable, so the plan needs only how many there are of each
length: at most ``capacity`` counts, whatever the input. Full pieces fill a sequence each. Pieces above
one third of the capacity (at most two fit together) are matched greedily: each, longest first,
with the longest partner that fits. Shorter pieces then go, longest first, into the tightest gap left
(best fit), opening a new sequence only when none is wide enough. The plan works on runs of equal
sequences, not on single ones, and yields slots: (length, first rank, sequences, pieces a sequence).

*Places.* A piece's rank among all pieces of its length is its rank in its task plus what earlier
tasks made of that length (a running sum of counts, not of pieces). A binary search in the slots turns
(length, rank) into a sequence and an offset.

Defined results: null text is empty and is one end id; repeated rows are packed each; an empty table
gives no rows; a null doc_id is packed like any other; a very long text is encoded whole in one task and
leaves it as pieces. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

CAPACITY = 1024
END_ID = 2
CACHE = 600_000
#: bytes of text that are encoded together (a longer text alone)
TOGETHER = 4 << 20
#: bytes of unknown stretches that the tokenizer is handed at once (it holds far more than the ids of their tokens)
LEARN = 1 << 18

_FIELDS = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
           ("ids_crc32", pa.int64()), ("task", pa.int32()), ("task_rank", pa.int64())]
_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, task_rank long"

class _Joined(Exception):
    """A stretch that the pattern may join with the white space before it."""


class Encoder:
    """Byte-level BPE ids of whole texts as little-endian unsigned 32-bit bytes, with bounded caches.

    The public pattern always starts a new token at a space followed by a character that is not white
    space, so a text is the concatenation of what lies between such spaces; each distinct stretch is
    split by the pattern once and each distinct word merged by the tokenizer's model once.

    As in ``Tokenizer.encode``, the contents of added tokens (control strings) are ids of their own
    wherever they stand in a text, and what lies between them is encoded by itself.
    """

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.split = self.tokenizer.model, regex.compile(pattern).findall
        # the byte-level alphabet: printable bytes stand for themselves, others for U+0100 and up
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        # tokens that take white space along or only stand as whole words are left to the tokenizer
        self.plain = not any(t.lstrip or t.rstrip or t.single_word for t in added.values())
        contents = sorted(self.added, key=len, reverse=True)
        self.at_added = regex.compile("(" + "|".join(map(regex.escape, contents)) + ")").split
        # without added tokens; and the bytes of each token, a character of the alphabet each
        self.bare = Tokenizer(self.model)
        if self.tokenizer.pre_tokenizer is not None:
            self.bare.pre_tokenizer = self.tokenizer.pre_tokenizer
        vocabulary = self.bare.get_vocab(with_added_tokens=False)
        self.size = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.size[list(vocabulary.values())] = list(map(len, vocabulary))
        self.words: dict[str, bytes] = {}
        self.stretches: dict[str, bytes] = {}

    def word(self, w: str) -> bytes:
        found = self.words.get(w)
        if found is None:
            if len(self.words) >= CACHE:
                self.words.clear()
            ids = [t.id for t in self.model.tokenize(w.encode().decode("latin-1").translate(self.alphabet))]
            found = self.words[w] = np.array(ids, "<u4").tobytes()
        return found

    def stretch(self, s: str) -> bytes:
        """Ids of a space and ``s``; not known (``_Joined``) if ``s`` begins with white space or is empty."""
        if not s or s[0].isspace():
            raise _Joined
        if len(self.stretches) >= CACHE:
            self.stretches.clear()
        found = b"".join(map(self.word, self.split(" " + s)))
        if len(s) <= 64:
            self.stretches[s] = found
        return found

    def encode(self, text: str) -> bytes:
        if not any(a in text for a in self.added):
            return self.between(text)
        if not self.plain:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join([self.added[p] if k % 2 else self.between(p) for k, p in enumerate(self.at_added(text))])

    def between(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        parts = text.split(" ")
        get, make = self.stretches.get, self.stretch
        try:
            return b"".join(map(self.word, self.split(parts[0]))) + b"".join([get(p) or make(p) for p in parts[1:]])
        except _Joined:  # spaces beside other white space: the pattern decides over the whole text
            return b"".join(map(self.word, self.split(text)))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """``encode`` of every text, in order; texts of up to ``TOGETHER`` bytes are split and looked up together."""
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TOGETHER, side="right")))
            yield from self.together(texts.slice(at, to - at))
            at = to

    def learn(self, stretches: list[str]) -> list[bytes]:
        """``stretch`` of each of them: encoded as one text and told apart by the bytes of its tokens."""
        if not stretches:
            return []
        known = np.array(self.bare.encode_batch_fast([" " + " ".join(stretches)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(self.size[known])
        stops = np.cumsum([1 + len(s.encode()) for s in stretches])
        at = np.searchsorted(ends, stops)
        if at[-1] != len(known) - 1 or (ends[at] != stops).any():  # not a token a byte string: one by one
            return list(map(self.stretch, stretches))
        raw, cuts = known.tobytes(), (4 * (at + 1)).tolist()
        found = [raw[a:b] for a, b in zip([0, *cuts], cuts)]
        if len(self.stretches) + len(stretches) > CACHE:
            self.stretches.clear()
        self.stretches.update((s, i) for s, i in zip(stretches, found) if len(s) <= 64)
        return found

    def together(self, texts: pa.Array) -> Iterator[bytes]:
        """Each distinct stretch of the texts is looked up once; the ids of a text are gathered by number."""
        parts = pc.split_pattern(texts, " ")
        bounds = parts.offsets.to_numpy()
        coded = parts.values.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        number = coded.indices.to_numpy().copy()
        first = [distinct[k] for k in number[bounds[:-1]]]
        number[bounds[:-1]] = np.arange(len(distinct), len(distinct) + len(texts))  # no space before these
        ids, joined = list(map(self.stretches.get, distinct)), np.zeros(len(distinct) + len(texts), bool)
        unknown = [k for k, found in enumerate(ids) if found is None]
        for k in unknown:
            if not distinct[k] or distinct[k][0].isspace():  # spaces beside other white space: see between
                ids[k], joined[k] = b"", True
        unknown = np.array([k for k in unknown if not joined[k]], np.int64)
        ends = np.cumsum(pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)[unknown], dtype=np.int64) // LEARN
        for some in np.split(unknown, np.flatnonzero(np.diff(ends)) + 1):
            for k, found in zip(some.tolist(), self.learn([distinct[k] for k in some.tolist()])):
                ids[k] = found
        ids += [b"".join(map(self.word, self.split(s))) for s in first]
        alone = np.logical_or.reduceat(joined[number], bounds[:-1])
        for a in self.added:
            alone |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        known = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = np.cumsum(size) - size
        size, start = size[number], start[number]
        ends = np.cumsum(size)
        # half the memory, unless one very long text is on its own
        kind = np.int32 if max(ends[-1], len(known)) < 1 << 31 else np.int64
        at = np.repeat((start - ends + size).astype(kind), size)
        at += np.arange(ends[-1], dtype=kind)
        found = known[at]
        ends = ends[bounds[1:] - 1].tolist()
        for k, (a, b) in enumerate(zip([0, *ends], ends)):
            yield self.encode(texts[k].as_py()) if alone[k] else found[a:b].tobytes()


@lru_cache(maxsize=1)
def worker_encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this Python worker: what one task has learnt serves the next."""
    return Encoder(path, pattern)


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: the first may be shorter, the others are full."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def tokenized_pieces(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The pieces of all documents, with task and rank in the task (written, so that ranks stay)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, made, task = worker_encoder(path, pattern), [0] * (capacity + 1), TaskContext.get().partitionId()
        for b in batches:
            out = []
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), encoder.encode_all(b.column("text"))):
                ids += end
                for piece, (start, length) in enumerate(pieces_of(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                    out.append((doc_id, piece, start, length, crc, task, made[length]))
                    made[length] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), _FIELDS)],
                                                 names=[n for n, _ in _FIELDS])
        b = out = None  # the worker lives on for tasks of other stages
        pa.default_memory_pool().release_unused()

    return materialise(rows.mapInArrow(cut, _SCHEMA), "pack-pieces")


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Runs of equal sequences (how many, lengths in order of offset) that hold ``counts`` pieces."""
    done: list[tuple[int, tuple[int, ...]]] = []
    gaps: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)  # gap -> runs with that gap

    def put(n: int, lengths: tuple[int, ...]) -> None:
        gap = capacity - sum(lengths)
        if gap:
            if gap not in gaps or not gaps[gap]:
                bisect.insort(widths, gap)
            gaps[gap].append((n, lengths))
        else:
            done.append((n, lengths))

    widths: list[int] = []  # gaps that some run has, ascending
    left = {s: n for s, n in counts.items() if n}
    if capacity in left:
        put(left.pop(capacity), (capacity,))
    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    while large:
        s = large[0]
        partner = next((t for t in large if t <= capacity - s and (t != s or left[s] > 1)), None)
        if partner is None:
            put(left[s], (s,))
            left[s] = 0
        else:
            n = left[s] // 2 if partner == s else min(left[s], left[partner])
            put(n, (s, partner))
            left[s] -= n
            left[partner] -= n
        large = [t for t in large if left[t]]
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        while n:
            at = bisect.bisect_left(widths, s)
            if at == len(widths):  # no gap is wide enough: new sequences, as full of s as they get
                per = min(n, capacity // s)
                put(n // per, (s,) * per)
                n -= n // per * per
                continue
            gap = widths[at]
            many, lengths = gaps[gap].pop()
            if not gaps[gap]:
                widths.pop(at)
            per = min(n, gap // s)
            used = min(many, n // per)
            if many > used:
                put(many - used, lengths)
            put(used, lengths + (s,) * per)
            n -= used * per
    return done + [run for runs in gaps.values() for run in runs]


def slots_of(runs: list[tuple[int, tuple[int, ...]]]) -> dict[str, np.ndarray]:
    """Per (length, first rank): first sequence, pieces of that length a sequence, first offset."""
    rank, sequence, found = defaultdict(int), 0, []
    for n, lengths in sorted(runs):
        at, offset = 0, 0
        while at < len(lengths):
            s, per = lengths[at], 0
            while at < len(lengths) and lengths[at] == s:
                per, at = per + 1, at + 1
            found.append((s, rank[s], sequence, per, offset))
            rank[s] += n * per
            offset += s * per
        sequence += n
    found.sort()
    columns = np.array(found, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "rank", "sequence", "per", "offset"), columns))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset."""
    made = materialise(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "pack-counts")
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    slots = slots_of(plan_bins(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = made.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = (pieces.join(before, ["length", "task"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("before") + F.col("task_rank")).alias("rank")))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    span = 1 << 50  # (length, rank) as one sorted number: 1024 lengths, 2**50 ranks
    starts = slots["length"] * span + slots["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(starts, length * span + rank, side="right") - 1
            nth = rank - slots["rank"][at]
            sequence = slots["sequence"][at] + nth // slots["per"][at]
            offset = slots["offset"][at] + nth % slots["per"][at] * length
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names[:5]), pa.array(sequence), pa.array(offset)],
                                             names=names)

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
