"""Word and word-shingle hashes of whole texts, vectorised in numpy (used inside tasks).

Words are runs of bytes other than space and U+0009..U+000D in UTF-8. A word's hash is a polynomial
over its bytes modulo 2**64, read off a running sum, then mixed with its length; a shingle's hash
combines the hashes of ``k`` consecutive words in order. Long texts are hashed in pieces cut at white
space, so memory beyond the hashes does not grow with the text.
"""

from __future__ import annotations

import numpy as np

K = 5
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 14)
        def run(base: int) -> np.ndarray:
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            return np.cumprod(steps, dtype=np.uint64)
        _powers, _inverses = run(_BASE), run(pow(_BASE, -1, 1 << 64))
    return _powers[:n], _inverses[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers with well-spread bits (the finaliser of the public SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _piece_words(b: np.ndarray) -> np.ndarray:
    word = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    powers, inverses = _tables(len(b))
    run = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers, out=run[1:])
    h = (run[ends] - run[starts]) * inverses[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(text: str | bytes, lower: bool = False) -> np.ndarray:
    """uint64 hashes of the words of ``text`` in order; ``lower`` folds A-Z first."""
    b = np.frombuffer(text.encode() if isinstance(text, str) else text, np.uint8)
    if lower:
        b = _LOWER[b]
    if len(b) <= PIECE:
        return _piece_words(b)
    out, at = [], 0
    while at < len(b):
        end = min(len(b), at + PIECE)
        while end < len(b):  # on to the next white space, so that no word is cut
            gap = np.flatnonzero(_SPACE[b[end:end + PIECE]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(b), end + PIECE)
        out.append(_piece_words(b[at:end]))
        at = end
    return np.concatenate(out)


_PLACE = mix(np.arange(1, K + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def shingle_hashes(words: np.ndarray, k: int = K) -> np.ndarray:
    """Hash of every run of ``k`` words, in order; the whole sequence if there are fewer; none if empty."""
    if not len(words):
        return words
    size = min(k, len(words))
    h = np.zeros(len(words) - size + 1, np.uint64)
    for j in range(size):
        h += mix(words[j:len(words) - size + 1 + j] * _PLACE[j])
    return mix(h + np.uint64(size))
