"""Substring dedup by super-k-mers of words.

A window is fifty consecutive words of one document.  Each word covered by a window
that also starts in a document with a smaller id is removed; windows are judged on
the input.  Consecutive windows that share a minimiser of ``SEED`` words travel as one
packed string to the bucket of that minimiser, where the windows of all strings are
sorted and equal neighbours take the smallest id.

Words are runs of other bytes than space, tab, line feed, vertical tab, form feed and
carriage return.  Null texts have none.  A null id is larger than all others.  Rows
that share an id are one document: none of them is smaller than the other.  A very long text is
cut into strings like any other.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame

from quittance.llm.batches import BLANK, Texts, word_hashes, words
from quittance.llm.windows import Found, Plan, Tokens, repeats

WINDOW = 50
SEED = 16


def word_tokens(texts: Texts) -> Tokens:
    """Words, with their bytes joined by single spaces."""
    found = words(texts, ~BLANK)
    size = found.end - found.start
    start = np.cumsum(size + 1) - (size + 1)
    data = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    data[within + np.repeat(start, size)] = texts.data[within + np.repeat(found.start, size)]
    return Tokens(word_hashes(texts.data, found), start, start + size, found.at, data.tobytes())


def packed_windows(packed: bytes, window: int = WINDOW) -> list[bytes]:
    space = np.flatnonzero(np.frombuffer(packed, np.uint8) == 0x20).tolist()
    start, end = [0, *(at + 1 for at in space)], [*space, len(packed)]
    return [packed[a:b] for a, b in zip(start, end[window - 1 :], strict=False)]


def smallest_ids(strings: list[tuple[bytes, int]], window: int = WINDOW) -> list[np.ndarray]:
    """Per string and window the smallest id of all strings with that window, by sorting."""
    entries = [(w, value, i, j) for i, (packed, value) in enumerate(strings) for j, w in enumerate(packed_windows(packed, window))]
    entries.sort()
    counts = [0] * len(strings)
    for _, _, i, _ in entries:
        counts[i] += 1
    out = [np.empty(n, np.int64) for n in counts]
    for _, same in groupby(entries, key=lambda entry: entry[0]):
        first = None
        for _, value, i, j in same:
            first = value if first is None else first
            out[i][j] = first
    return out


def repeated_windows(documents: DataFrame, window: int = WINDOW, seed: int = SEED) -> Found:
    """Spans of words to remove from each text, and what stays of it."""
    plan = Plan(
        tokens=word_tokens, joint=b" ", window=window, seed=seed, within=False, combine="min",
        settle=lambda strings: smallest_ids(strings, window), windows=lambda packed: packed_windows(packed, window),
    )
    return repeats(documents, plan)
