"""Substring dedup by interval expansion on the Burrows-Wheeler transform.

A byte is removed if it is covered by a string of ``LENGTH`` bytes that also starts
anywhere else, in the same document or another one; strings are judged on the input
and never cross documents.

Only strings that share a minimiser can be equal, so the corpus is dealt by minimiser
(``windows``) and every group gets a suffix array of its own, sorted as deep as the
threshold, and its Burrows-Wheeler transform.  Common prefixes come from the transform
alone: starting with the interval of all suffixes, each round extends the intervals
found in the round before by one symbol to the left.  An interval whose right border
has no value yet gives it the round's number as the common prefix length and is
extended further; values thus appear in increasing order.  The rounds stop at the
threshold: borders without a value separate suffixes that share at least that much.

Null texts are empty.  Repeated rows are repeats of one another.  A very long text is cut into
strings like any other; only its spans come together again in one row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from quittance.llm.batches import Texts, _VALUES
from quittance.llm.windows import Found, Plan, Tokens, repeats

LENGTH = 200
SEED = 64
_PACKED_SYMBOLS = 7  # symbols of nine bits in one number


def byte_tokens(texts: Texts) -> Tokens:
    place = np.arange(len(texts.data))
    return Tokens(_VALUES[0][texts.data], place, place + 1, texts.at, texts.data.tobytes())


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least, by doubling."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(_PACKED_SYMBOLS, np.uint64)])
    key = np.zeros(n, np.uint64)
    for i in range(_PACKED_SYMBOLS):
        key = key << np.uint64(9) | padded[i : i + n]
    known = _PACKED_SYMBOLS
    while True:
        order = np.argsort(key)
        ordered = key[order]
        new = np.ones(n, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        if known >= depth or new.all():
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new).astype(np.uint64)
        later = np.zeros(n, np.uint64)
        if known < n:
            later[: n - known] = rank[known:]
        key = rank << np.uint64(32) | later
        known *= 2


def short_prefix_borders(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True at i if suffixes i - 1 and i of the array share fewer than ``length`` symbols.

    Symbol 0 separates strings and is never extended over.  The border behind a suffix
    that ends at its separator may therefore stay open, but two suffixes with
    ``length`` symbols before their separators always have a border between them if
    these differ.
    """
    n = len(order)
    transform = symbols[order - 1]  # the first suffix is preceded by the last, a separator
    by_symbol = np.argsort(transform, kind="stable")
    first_of = np.empty(n, np.int64)  # where a suffix goes when its preceding symbol is put in front
    first_of[by_symbol] = np.arange(n)
    border = np.zeros(n + 1, bool)
    border[0] = border[n] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        width = high - low
        total = int(width.sum())
        if not total:
            break
        which = np.repeat(np.arange(len(low)), width)
        place = np.arange(total) - np.repeat(np.cumsum(width) - width, width) + low[which]
        symbol = transform[place].astype(np.int64)
        use = symbol > 0
        which, place, symbol = which[use], place[use], symbol[use]
        if not len(place):
            break
        # Places of an interval with one symbol lie side by side once it is put in front.
        kind = which * 512 + symbol
        by_kind = np.argsort(kind, kind="stable")
        kind, target = kind[by_kind], first_of[place[by_kind]]
        head = np.ones(len(kind), bool)
        head[1:] = kind[1:] != kind[:-1]
        at = np.flatnonzero(head)
        low, high = target[at], target[np.append(at[1:], len(kind)) - 1] + 1
        fresh = ~border[high]
        low, high = low[fresh], high[fresh]
        border[high] = True
    return border


def occurrences(strings: list[tuple[bytes, int]], length: int = LENGTH) -> list[np.ndarray]:
    """Per string and start the number of occurrences of the next ``length`` bytes, a string counting as often as its value."""
    sizes = np.array([len(packed) for packed, _ in strings])
    symbols = np.frombuffer(b"\0".join(packed for packed, _ in strings) + b"\0", np.uint8).astype(np.int16) + 1
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    symbols[begin + sizes] = 0
    order = suffix_array(symbols, length)
    border = short_prefix_borders(symbols, order, length)
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    full = (np.arange(len(symbols)) - begin[owner]) <= (sizes - length)[owner]
    group = np.cumsum(border[:-1]) - 1
    value = np.array([value for _, value in strings], np.int64)
    starts = full[order]
    totals = np.bincount(group[starts], value[owner[order[starts]]].astype(float), minlength=int(group[-1]) + 1 if len(group) else 0)
    per_place = np.zeros(len(symbols), np.int64)
    per_place[order] = totals[group].astype(np.int64)
    return [per_place[a : a + max(size - length + 1, 0)] for a, size in zip(begin.tolist(), sizes.tolist(), strict=True)]


def repeated_strings(documents: DataFrame, length: int = LENGTH, seed: int = SEED) -> Found:
    """Spans of bytes to remove from each text, and what stays of it."""
    plan = Plan(
        tokens=byte_tokens, joint=b"", window=length, seed=seed, within=True, combine="sum",
        settle=lambda strings: occurrences(strings, length),
        windows=lambda packed: [packed[i : i + length] for i in range(len(packed) - length + 1)],
    )
    return repeats(documents, plan)
