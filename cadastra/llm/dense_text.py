"""Dense features of whole texts that both classifiers use (computed inside tasks)."""

from __future__ import annotations

import math
from operator import eq

import numpy as np

_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
#: fixed values: bytes counted as symbols and as ordinary punctuation
_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@\\^_`{}~", np.uint8)
_PUNCTUATION = np.frombuffer(b".,;:'\"()-", np.uint8)

NAMES = ["log_words", "word_length", "upper", "digits", "symbols", "punctuation", "exclamations", "questions", "bars",
         "repeated_next", "distinct", "sentence_words", "line_words", "line_copies"]


def dense(text: str, words: list[str]) -> list[float]:
    """The features ``NAMES`` of ``text``; ``words`` is ``text.split()``. All zero for a text without words."""
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    upper, lower = int(counts[_UPPER].sum()), int(counts[_LOWER].sum())
    visible = max(1, int(counts.sum() - counts[32] - counts[10]))
    lines = text.split("\n")
    share = lambda c: float(c) / visible
    return [
        math.log1p(n), len(text) / n, upper / max(1, upper + lower), share(counts[_DIGIT].sum()),
        share(counts[_SYMBOLS].sum()), share(counts[_PUNCTUATION].sum()), share(counts[33]), share(counts[63]),
        share(counts[124]), sum(map(eq, words, words[1:])) / n,
        math.log1p(len(set(words))) / math.log1p(n), math.log1p(n / (1 + text.count(". "))),
        math.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines),
    ]
