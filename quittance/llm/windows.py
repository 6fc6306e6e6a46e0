"""Repeated windows of a fixed number of tokens: the flow that substring operators share.

1. Every window has a minimiser: the ``seed`` consecutive tokens in it with the
   smallest hash (the leftmost of equals).  Equal windows have equal minimisers.  One
   pass lists each text's minimisers; those that occur once cannot be in a repeat.
2. Texts with a repeated minimiser are written once (``texts``).
3. Consecutive windows that share a minimiser travel as one packed string, a
   super-window.  Equal super-windows are combined before anything is gathered.
4. Super-windows meet by minimiser.  The operator's ``settle`` function finds equal
   windows among those of some minimisers at a time.  A minimiser with more than
   ``GROUP`` different super-windows is dealt to several groups; the windows of such
   groups are combined once more by digest.
5. What was found goes back to the occurrences, and becomes ranges of tokens per text.

Rows are found again by two hashes of id and text, so that repeated rows share a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quittance.llm.batches import Texts, blocks, mix
from quittance.llm.tables import kept, map_batches, noted, remove

GROUP = 2_000
BATCH_BYTES = 1 << 19
NO_ID = (1 << 63) - 1
_PLACE_BITS = 32  # more tokens than a cell can hold; of equal hashes the leftmost place wins, in equal windows the same one
_KEYS = ["key_1", "key_2"]


class Tokens(NamedTuple):
    """hash of each token; its byte range in ``data``; the first token of each row (one more at the end)."""

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray
    data: bytes

    def pack(self, a: int, b: int) -> bytes:
        """Bytes of tokens a to b."""
        return self.data[self.start[a] : self.end[b - 1]] if b > a else b""


class Plan(NamedTuple):
    """How an operator sees texts and windows.

    tokens: of a block.  joint: what stands between packed pieces of a text.
    window, seed: in tokens.  within: whether repeats within one text count.
    combine: ``min`` (a window's value is the smallest id that has it) or ``sum`` (how
    often it occurs).  settle: from (packed, value) of super-windows to an int64 array
    each, the combined value per window.  windows: the windows of a packed string.
    """

    tokens: Callable[[Texts], Tokens]
    joint: bytes
    window: int
    seed: int
    within: bool
    combine: str
    settle: Callable[[list[tuple[bytes, int]]], list[np.ndarray]]
    windows: Callable[[bytes], list[bytes]]


def _run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive entries, in about 2 log n steps."""
    base, mask = 0x9FB21C651E98DF25, (1 << 64) - 1
    out, done = None, 0
    power, width = hashes, 1
    while True:
        if n & width:
            out = power if out is None else out[: len(out) - width] * np.uint64(pow(base, width, mask + 1)) + power[done:]
            done += width
        if 2 * width > n:
            return mix(out)
        power = power[:-width] * np.uint64(pow(base, width, mask + 1)) + power[width:]
        width *= 2


def _sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    width = 1
    while 2 * width <= n:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - (n - width)], values[n - width :]) if n > width else values


def super_windows(tokens: Tokens, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first window, windows, minimiser hash) of each super-window; windows by their first token."""
    none = np.zeros(0, np.int64)
    if len(tokens.hashes) < window:
        return none, none, none, none
    seeds = _run_hashes(tokens.hashes, seed)
    place = np.arange(len(seeds), dtype=np.uint64)
    order = (mix(seeds ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | place
    least = (_sliding_min(order, window - seed + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    size = np.diff(tokens.at)
    row = np.repeat(np.arange(len(size)), np.maximum(size - window + 1, 0))
    if not len(row):
        return none, none, none, none
    count = np.maximum(size - window + 1, 0)
    begin = np.repeat(tokens.at[:-1] - (np.cumsum(count) - count), count) + np.arange(len(row))
    chosen = least[begin]
    new = np.ones(len(row), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], begin[at], np.diff(np.append(at, len(row))), seeds[chosen[at]].view(np.int64)


def _content() -> tuple[Column, Column]:
    return F.xxhash64("doc_id", "text").alias("key_1"), F.xxhash64("text", F.lit(1), "doc_id").alias("key_2")


def _listed(documents: DataFrame, plan: Plan) -> DataFrame:
    """Per row: doc_id, keys, number of tokens, digest of all tokens packed, minimisers."""
    frame = documents.select(F.col("doc_id").cast("long"), *_content(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(3)):
                tokens = plan.tokens(block)
                row, _, _, seeds = super_windows(tokens, plan.window, plan.seed)
                if not plan.within and len(row):
                    order = np.lexsort((seeds, row))
                    row, seeds = row[order], seeds[order]
                    new = np.ones(len(row), bool)
                    new[1:] = (row[1:] != row[:-1]) | (seeds[1:] != seeds[:-1])
                    row, seeds = row[new], seeds[new]
                rows = len(block.at) - 1
                digest = [
                    hashlib.sha256(tokens.pack(int(a), int(b))).hexdigest() for a, b in zip(tokens.at, tokens.at[1:], strict=False)
                ]
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), pa.array(seeds, pa.int64()))
                part = batch.slice(block.first, rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(np.diff(tokens.at), pa.int64()), pa.array(digest, pa.string()), lists],
                    names=["doc_id", *_KEYS, "n_tokens", "all_sha256", "seeds"],
                )

    return map_batches(frame, run, "doc_id long, key_1 long, key_2 long, n_tokens long, all_sha256 string, seeds array<long>")


def _packed(texts: DataFrame, plan: Plan) -> DataFrame:
    """The super-windows of the texts whose minimiser is wanted."""
    frame = texts.select("doc_id", *_KEYS, "rows", "wanted", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(5)):
                tokens = plan.tokens(block)
                row, begin, count, seeds = super_windows(tokens, plan.window, plan.seed)
                lists = batch.column(4).slice(block.first, len(block.at) - 1)
                use = np.zeros(len(row), bool)
                edge = np.searchsorted(row, np.arange(len(block.at)))
                for i, wanted in enumerate(lists):
                    part = slice(edge[i], edge[i + 1])
                    use[part] = np.isin(seeds[part], wanted.values.to_numpy(zero_copy_only=False))
                row, begin, count, seeds = row[use], begin[use], count[use], seeds[use]
                strings = [tokens.pack(a, a + n + plan.window - 1) for a, n in zip(begin.tolist(), count.tolist(), strict=True)]
                digest = [hashlib.blake2b(s, digest_size=16).digest() for s in strings]
                taken = batch.slice(block.first, len(block.at) - 1).select([0, 1, 2, 3]).take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *taken.columns[:4], pa.array(begin - tokens.at[row], pa.int64()), pa.array(count, pa.int32()), pa.array(seeds, pa.int64()),
                        pa.array(digest, pa.binary()), pa.array(strings, pa.binary()),
                    ],
                    names=["doc_id", *_KEYS, "rows", "begin", "windows", "seed", "digest", "packed"],
                )

    return map_batches(frame, 
        run, "doc_id long, key_1 long, key_2 long, rows long, begin long, windows int, seed long, digest binary, packed binary"
    )


# values and lengths: runs of windows with one value; marks: a digest per window where there are more groups.
_SETTLED = "seed long, digest binary, groups int, group int, values array<long>, lengths array<int>, marks array<binary>"


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of windows with equal values: (values, lengths)."""
    at = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return values[at], np.diff(np.append(at, len(values)))


def _settled(groups: DataFrame, plan: Plan) -> DataFrame:
    """Per super-window: the combined value of each window within its group; digests of windows if there are more groups."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        runs = [_runs(values) for values in plan.settle([(row[4], row[5]) for row in rows])]
        marks = [[hashlib.blake2b(w, digest_size=16).digest() for w in plan.windows(row[4])] if row[2] > 1 else None for row in rows]
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                *(pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)),
                pa.array([r[0] for r in runs], pa.list_(pa.int64())), pa.array([r[1] for r in runs], pa.list_(pa.int32())),
                pa.array(marks, pa.list_(pa.binary())),
            ],
            names=["seed", "digest", "groups", "group", "values", "lengths", "marks"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                own = row[0], row[3]
                if size >= BATCH_BYTES and own != last:  # a group is settled as a whole
                    yield flush(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
                last = own
        if rows:
            yield flush(rows)

    frame = groups.select("seed", "digest", "groups", "group", "packed", "value")
    return map_batches(frame.repartition("seed", "group").sortWithinPartitions("seed", "group"), run, _SETTLED)


def _ranges(occurrences: DataFrame, plan: Plan) -> DataFrame:
    """Ranges of tokens (first, end) that repeated windows cover, from occurrences with the runs of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = np.array(batch.column(4).value_lengths().to_numpy(zero_copy_only=False), np.int64)
            values = batch.column(4).flatten().to_numpy(zero_copy_only=False)
            length = batch.column(5).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), count)
            stop = np.cumsum(length)
            start = stop - length
            if plan.combine == "min":
                own = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
                hit = values < own[row]
            else:
                hit = values > 1
            follows = np.zeros(len(row), bool)  # a hit right behind a hit of the same row
            follows[1:] = hit[1:] & hit[:-1] & (row[1:] == row[:-1])
            first = np.flatnonzero(hit & ~follows)
            last = np.flatnonzero(hit & ~np.append(follows[1:], False))
            index = row[first]
            base = batch.column(3).to_numpy(zero_copy_only=False) - start[np.minimum(np.cumsum(count) - count, max(len(start) - 1, 0))]
            taken = batch.select(_KEYS).take(pa.array(index, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    *taken.columns, pa.array(base[index] + start[first], pa.int64()),
                    pa.array(base[index] + stop[last] - 1 + plan.window, pa.int64()),
                ],
                names=[*_KEYS, "first", "end"],
            )

    frame = occurrences.select("doc_id", *_KEYS, "begin", "values", "lengths")
    return map_batches(frame, run, "key_1 long, key_2 long, first long, end long")


def joined_ranges(pairs: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted((p["first"], p["end"]) for p in pairs):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((first, end))
    return out


def _cut(texts: DataFrame, plan: Plan) -> DataFrame:
    """Per changed text: spans of removed tokens and what stays, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, left, removed = [], [], []
            for block in blocks(batch.column(3)):
                tokens = plan.tokens(block)
                for i, pairs in enumerate(batch.column(2).slice(block.first, len(block.at) - 1).to_pylist()):
                    gone = joined_ranges(pairs)
                    base, top = int(tokens.at[i]), int(tokens.at[i + 1])
                    edges = [0, *(x for pair in gone for x in pair), top - base]
                    pieces = [tokens.pack(base + a, base + b) for a, b in zip(edges[::2], edges[1::2], strict=True) if b > a]
                    spans.append([{"first": a, "end": b} for a, b in gone])
                    left.append(plan.joint.join(pieces))
                    removed.append(sum(b - a for a, b in gone))
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(spans, kind), pa.array(removed, pa.int64()), pa.array(left, pa.binary())],
                names=[*_KEYS, "spans", "n_removed", "left"],
            )

    frame = texts.select(*_KEYS, "ranges", "text")
    return map_batches(frame, run, "key_1 long, key_2 long, spans array<struct<first: long, end: long>>, n_removed long, left binary")


class Found(NamedTuple):
    """rows: doc_id, keys, n_tokens, all_sha256 of every row; changed: keys, spans, n_removed, left (binary)."""

    rows: DataFrame
    changed: DataFrame

    def per_document(self) -> DataFrame:
        """doc_id, n_tokens, n_removed, spans (null if none), kept_sha256."""
        changed = self.changed.select(*_KEYS, "spans", "n_removed", F.sha2("left", 256).alias("left_sha256"))
        return self.rows.join(changed, _KEYS, "left").select(
            "doc_id", "n_tokens", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), "spans",
            F.coalesce("left_sha256", "all_sha256").alias("kept_sha256"),
        )


def _combined(split: DataFrame, plan: Plan) -> DataFrame:
    """Values per window of super-windows whose minimiser was dealt to several groups."""
    full = F.flatten(F.transform(F.arrays_zip("values", "lengths"), lambda run: F.array_repeat(run["values"], run["lengths"])))
    # Strings of one group lie in one task; deal them anew before they become rows.
    dealt = split.repartition("seed", "digest")
    each = dealt.withColumn("full", full).select("seed", "digest", "group", F.posexplode(F.arrays_zip("full", "marks")).alias("place", "at")).select(
        "seed", "digest", "group", "place", F.col("at.full").alias("value"), F.col("at.marks").alias("mark")
    )
    total = F.sum("value") if plan.combine == "sum" else F.min("value")
    values = each.groupBy("seed", "mark", "group").agg(F.first("value").alias("value")).groupBy("seed", "mark").agg(total.alias("value"))
    back = each.drop("value").join(values, ["seed", "mark"]).groupBy("seed", "digest").agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("all"))
    return back.select("seed", "digest", F.col("all.value").alias("values"), F.transform("all", lambda _: F.lit(1)).alias("lengths"))


def repeats(documents: DataFrame, plan: Plan) -> Found:
    """All rows, and the texts of which something is to be removed."""
    rows = kept(_listed(documents, plan), "minimisers", compression="zstd")
    seeds = rows.select(*_KEYS, F.explode("seeds").alias("seed"))
    # As a table it is shuffled by itself, and Spark can split what a frequent minimiser brings to the join.
    repeated = kept(seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("seed"), "repeated-minimisers")
    wanted = seeds.join(repeated, "seed", "left_semi").groupBy(*_KEYS).agg(F.collect_set("seed").alias("wanted"))
    copies = rows.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("rows"))
    texts = documents.select(F.col("doc_id").cast("long"), *_content(), "text")
    texts = kept(texts.join(wanted.join(copies, _KEYS), _KEYS).dropDuplicates(_KEYS), "texts", compression="zstd")
    with noted() as strings:
        packed = kept(_packed(texts, plan), "super-windows", compression="zstd")
    value = F.sum("rows") if plan.combine == "sum" else F.min(F.coalesce("doc_id", F.lit(NO_ID)))
    with noted() as different:
        distinct = kept(
            packed.groupBy("seed", "digest").agg(value.alias("value"), F.first("packed").alias("packed"), F.first("windows").alias("windows")),
            "distinct-windows", compression="zstd",
        )
    # From here on each string is needed once; of its occurrences the places are left.
    places = kept(packed.select("doc_id", *_KEYS, "begin", "seed", "digest"), "places", compression="zstd")
    remove(documents.sparkSession, strings)
    sizes = kept(distinct.groupBy("seed").agg(F.count(F.lit(1)).alias("n")), "sizes")
    sized = distinct.join(sizes, "seed").withColumn("groups", F.ceil(F.col("n") / GROUP).cast("int"))
    groups = sized.filter("n > 1").withColumn("group", F.pmod(F.xxhash64("digest"), F.col("groups")).cast("int"))
    settled = kept(_settled(groups, plan), "settled", compression="zstd")
    # A super-window alone with its minimiser: all its windows have its value.
    single = sized.filter("n = 1").select("seed", "digest", F.array("value").alias("values"), F.array("windows").alias("lengths"))
    single = kept(single, "single", compression="zstd")
    remove(documents.sparkSession, different)  # what is left are values, no strings
    whole = settled.filter("groups = 1").select("seed", "digest", "values", "lengths")
    found = single.union(whole).union(_combined(settled.filter("groups > 1"), plan))
    occurrences = places.join(found, ["seed", "digest"])
    ranges = _ranges(occurrences, plan).groupBy(*_KEYS).agg(F.collect_list(F.struct("first", "end")).alias("ranges"))
    changed = kept(_cut(texts.join(ranges, _KEYS), plan), "changed", compression="zstd")
    return Found(rows, changed)
