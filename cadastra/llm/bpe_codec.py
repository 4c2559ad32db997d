"""Byte-level BPE encoding and decoding of whole texts by batched numpy merge rounds.

*Tables.* From the tokenizer file: every merge as one number, ``left id * vocabulary + right id``, sorted,
with its rank and the id that it makes. The rank of a pair is found by binary search over these keys.

*Encoding.* A text is cut at the contents of added tokens (control strings, ids of their own), the rest into
words by the public pattern. The words that a group of texts holds for the first time lie one after another
in one flat array of symbols, first one symbol a byte. A round finds the lowest rank of every word
(``minimum.reduceat``), merges all places that have it (from the left, where places overlap), closes the
gaps, and looks up only the pairs beside a merge; words without a pair that merges leave the array. All
places of a word's lowest rank may go at once because a merge never makes a pair of lower rank; a file that
breaks this is refused.

*Decoding.* The bytes of all ids lie in one array; a gather over (start, length) of the ids makes a text's
bytes, which are read as UTF-8 (wrong bytes become U+FFFD). Ids that the file does not know are left out.

Bounded: a group holds at most ``GROUP_CHARS`` characters, longer texts pass in parts; the cache of words is
emptied at ``CACHE`` entries and holds no words above ``LONG_WORD`` characters.

Defined results: null text is empty and has no ids; null id lists decode to empty text; a null id and
repeated rows are rows like any other; empty tables give no rows; other columns do not matter, whatever
their names.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_CHARS = 1 << 20
CACHE = 300_000
LONG_WORD = 64
WORDS_AT_ONCE = 1 << 16
#: rank of a pair that no merge joins
NONE = np.iinfo(np.int32).max


def byte_characters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 and up."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def _concatenated(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... (``length`` of them) of every entry, one entry after another."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)


class Codec:
    """Tables of one tokenizer file; see the module's text."""

    def __init__(self, path: str, pattern: str):
        import regex
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, kind = file["model"], (file.get("pre_tokenizer") or {}).get("type")
        ignored = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if model["type"] != "BPE" or kind != "ByteLevel" or file.get("normalizer") or any(model.get(k) for k in ignored) \
                or file["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("not a plain byte-level BPE file")
        vocab = model["vocab"]
        self.added = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in file.get("added_tokens", [])):
            raise ValueError("added tokens that depend on what stands beside them")
        self.size = 1 + max([*vocab.values(), *self.added.values()])
        alphabet = byte_characters()
        self.first = np.array([vocab[c] for c in alphabet], np.int64)
        self._merges(model["merges"], vocab)
        self._bytes(vocab, {c: b for b, c in enumerate(alphabet)})
        self.pattern = regex.compile(pattern)
        contents = sorted(self.added, key=len, reverse=True)
        self.at_added = regex.compile("(" + "|".join(map(regex.escape, contents)) + ")").split if contents else None
        self.known: dict[str, bytes] = {}

    def _merges(self, merges: list, vocab: dict[str, int]) -> None:
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        made = [vocab[a + b] for a, b in pairs]
        rank_of = dict(zip(made, range(len(made))))
        left, right = ([vocab[p[k]] for p in pairs] for k in (0, 1))
        if any(max(rank_of.get(x, -1), rank_of.get(y, -1)) >= r for r, (x, y) in enumerate(zip(left, right))):
            raise ValueError("a merge stands before the merge that makes one of its sides")
        keys = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), np.array(made, np.int64)

    def _bytes(self, vocab: dict[str, int], byte_of: dict[str, int]) -> None:
        spelled: list[bytes] = [b""] * self.size
        for token, i in vocab.items():
            spelled[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.added.items():
            spelled[i] = token.encode()
        self.lengths = np.array([len(b) for b in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(spelled), np.uint8)

    # -- encoding

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, ``NONE`` where no merge joins it."""
        key = left * self.size + right
        if not len(self.keys):
            return np.full(len(key), NONE, np.int32)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit bytes."""
        data = [w.encode() for w in words]
        lengths = np.fromiter(map(len, data), np.int64, len(data))
        ids = self.first[np.frombuffer(b"".join(data), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(ids), NONE, np.int32)  # of the pair that begins here
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.rank(ids[inside], ids[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            begins = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest, long = np.minimum.reduceat(rank, begins), np.diff(np.r_[begins, len(ids)])
            if (lowest == NONE).any():
                going = np.repeat(lowest != NONE, long)
                done.append((word[~going], ids[~going]))
                ids, word, rank = ids[going], word[going], rank[going]
                lowest, long = lowest[lowest != NONE], long[lowest != NONE]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, long))
            # places next to each other share a symbol: every second one of such a run, from the left
            run = np.r_[True, np.diff(at) != 1]
            nth = np.arange(len(at))
            at = at[(nth - np.maximum.accumulate(np.where(run, nth, 0))) % 2 == 0]
            ids[at] = self.made[rank[at]]
            stays = np.ones(len(ids), bool)
            stays[at + 1] = False
            ids, word, rank = ids[stays], word[stays], rank[stays]
            at -= np.arange(len(at))
            beside = np.concatenate([at, at[at > 0] - 1])
            rank[beside] = NONE
            beside = beside[beside + 1 < len(ids)]
            beside = beside[word[beside] == word[beside + 1]]
            rank[beside] = self.rank(ids[beside], ids[beside + 1])
        if not done:
            return [b""] * len(words)
        word, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        flat = ids[order].astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(word, minlength=len(words)))
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def stretches(self, text: str) -> Iterator[list[str] | int]:
        """What ``text`` consists of: lists of words, and ids of added tokens."""
        parts = self.at_added(text) if self.at_added else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield self.added[part]
            elif len(part) <= GROUP_CHARS:
                yield self.pattern.findall(part)
            else:
                matches = self.pattern.finditer(part)
                while words := [m.group() for m in islice(matches, WORDS_AT_ONCE)]:
                    yield words

    def learn(self, words: list[str]) -> list[str]:
        """Make the ids of all ``words`` known; those that are new are merged together and returned."""
        new = [w for w in set(words) if w not in self.known]
        if new:
            self.known.update(zip(new, self.merge(new)))
        return new

    def forget(self, new: list[str]) -> None:
        """Keep the cache within its bounds."""
        if len(self.known) > CACHE:
            self.known.clear()
        for w in new:
            if len(w) > LONG_WORD:
                self.known.pop(w, None)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str] | int]] = []
        chars = 0

        def flush() -> None:
            words = [w for _, x in held if not isinstance(x, int) for w in x]
            new = self.learn(words)
            get = self.known.__getitem__
            for k, x in held:
                out[k].append(x.to_bytes(4, "little") if isinstance(x, int) else b"".join(map(get, x)))
            held.clear()
            self.forget(new)

        for k, text in enumerate(texts):
            for x in self.stretches(text):
                held.append((k, x))
                if not isinstance(x, int) and len(text) > GROUP_CHARS:
                    flush()
            chars += len(text)
            if chars >= GROUP_CHARS:
                flush()
                chars = 0
        flush()
        return [np.frombuffer(b"".join(parts), "<u4") for parts in out]

    # -- decoding

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ``ids`` spell."""
        ids = ids[(ids >= 0) & (ids < self.size)]
        return self.blob[_concatenated(self.starts[ids], self.lengths[ids])].tobytes()


def _groups(values: list, sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of neighbours whose sizes add up to ``most`` or little more."""
    begin, total = 0, 0
    for k, n in enumerate(sizes, 1):
        total += n
        if total >= most or k == len(values):
            yield slice(begin, k)
            begin, total = k, 0


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every whole text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, pattern)
        for b in batches:
            texts = b.column("text").to_pylist()
            for part in _groups(texts, [len(t) for t in texts], GROUP_CHARS):
                found = codec.encode(texts[part])
                ends = np.cumsum([0, *map(len, found)])
                flat = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[part.start:part.stop], lists], names=["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, ids, text): the text that the ids of every row spell."""
    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    rows = rows.withColumn("ids", F.filter(F.coalesce("ids", F.array().cast("array<int>")), lambda i: i.isNotNull()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path, pattern)
        for b in batches:
            lists = b.column("ids")
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy().tolist()
            sizes = [y - x for x, y in zip(ends, ends[1:])]
            for part in _groups(sizes, sizes, GROUP_CHARS // 4):
                texts = [codec.decode(flat[x:y]).decode("utf-8", "replace") for x, y in
                         zip(ends[part.start:part.stop], ends[part.start + 1:part.stop + 1])]
                cut = b.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([cut.column("doc_id"), cut.column("ids"), pa.array(texts, pa.string())],
                                                 names=["doc_id", "ids", "text"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>, text string")
