"""Line dedup that can be undone: sharded cuckoo filters over exact reference counts.

State: a table (shard, key, n) with the number of documents that hold each line key,
and per shard a cuckoo filter of the keys that ``min_documents`` or more documents
hold.  Inserting documents adds to the counts, deleting them subtracts; keys that
cross the threshold are inserted into or deleted from their shard's filter.  Removing
what was inserted gives back the state from before.

Cleaning maps over the texts and looks each line up in the filters; nothing but the
text's row is moved.  The keys of the texts that a filter takes for frequent by
mistake (two in a thousand million) are found beforehand with the exact counts, so
that the result is exact.  Filters are sent in waves of at most ``WAVE_BYTES``; each
wave is one map over the rows, and usually there is one.

A line's key is the line without blanks at both ends, A-Z lower-cased.  Lines with an
empty key always stay.  Null and empty texts are one empty line.  Each row is a
document of its own, also where ids repeat or are null.  A very long text is split in one task.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from quittance.llm.tables import free_name, kept, map_batches

MIN_DOCUMENTS = 10
SHARD_ROWS = 50_000
WAVE_BYTES = 32 << 20
_BLANKS = b" \t\n\x0b\x0c\r"
_ROWS = 1000
_SLOTS = 4
_KICKS = 500


def line_key(line: bytes) -> bytes:
    """16 bytes that stand for a line; nothing if the line is blank."""
    shown = line.strip(_BLANKS).lower()
    return hashlib.blake2b(shown, digest_size=16).digest() if shown else b""


def shard_of(key: bytes, shards: int) -> int:
    return int.from_bytes(key[12:], "little") % shards


def text_lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


class CuckooFilter:
    """32-bit fingerprints in buckets of four; a key has two buckets, each found from the other."""

    def __init__(self, keys: int = 0, table: np.ndarray | None = None):
        if table is None:
            buckets = 1 << max(1, int(np.ceil(np.log2(max(keys, 1) / _SLOTS / 0.8 + 1))))
            table = np.zeros((buckets, _SLOTS), np.uint32)
        self.table = table

    @classmethod
    def of(cls, keys: list[bytes]) -> CuckooFilter:
        size = len(keys)
        while True:
            made = cls(size)
            if all(made.insert(key) for key in keys):
                return made
            size = max(2 * size, 16)

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        return cls(table=np.frombuffer(raw, np.uint32).reshape(-1, _SLOTS).copy())

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[:4], "little") or 1
        first = int.from_bytes(key[4:12], "little") % len(self.table)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995 >> 7)) % len(self.table)  # the number of buckets is a power of two

    def __contains__(self, key: bytes) -> bool:
        mark, first, second = self._places(key)
        return mark in self.table[first] or mark in self.table[second]

    def insert(self, key: bytes) -> bool:
        """False if there was no room; the filter must then be built anew, larger."""
        mark, first, second = self._places(key)
        for bucket in (first, second):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        bucket = second
        for kick in range(_KICKS):
            slot = kick % _SLOTS
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
            bucket = self._other(bucket, mark)
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        return False

    def delete(self, key: bytes) -> bool:
        mark, first, second = self._places(key)
        for bucket in (first, second):
            at = np.flatnonzero(self.table[bucket] == mark)
            if len(at):
                self.table[bucket, at[0]] = 0
                return True
        return False

    def marks(self) -> tuple[set[int], int]:
        """What a worker needs for look-ups: (bucket, fingerprint) pairs as numbers, and the number of buckets."""
        bucket, slot = np.nonzero(self.table)
        return set((bucket.astype(np.uint64) << np.uint64(32) | self.table[bucket, slot].astype(np.uint64)).tolist()), len(self.table)


class State(NamedTuple):
    counts: DataFrame  # shard int, key binary, n long
    filters: DataFrame  # shard int, filter binary, keys long
    shards: int
    min_documents: int


_FILTER = "shard int, filter binary, keys long"


def empty_state(spark: SparkSession, shards: int = 16, min_documents: int = MIN_DOCUMENTS) -> State:
    return State(
        spark.createDataFrame([], "shard int, key binary, n long"), spark.createDataFrame([], _FILTER), shards, min_documents
    )


def document_keys(documents: DataFrame, shards: int, text: str = "text") -> DataFrame:
    """(shard, key, n): in how many documents each key is, combined per batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[bytes] = Counter()
            for value in batch.column(0).to_pylist():
                found.update({line_key(line) for line in text_lines(value)})
            found.pop(b"", None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard_of(key, shards) for key in found], pa.int32()), pa.array(list(found), pa.binary()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                names=["shard", "key", "n"],
            )

    return map_batches(documents.select(text), run, "shard int, key binary, n long").groupBy("shard", "key").agg(F.sum("n").alias("n"))


def _updated(state: State, documents: DataFrame, sign: int, text: str) -> State:
    delta = document_keys(documents, state.shards, text).withColumn("change", F.col("n") * sign).drop("n")
    least = F.lit(state.min_documents)
    before = F.coalesce("n", F.lit(0))
    after = before + F.coalesce("change", F.lit(0))
    both = kept(
        state.counts.join(delta, ["shard", "key"], "full").select(
            "shard", "key", after.alias("n"),
            F.when((before < least) & (after >= least), 1).when((before >= least) & (after < least), -1).otherwise(0).alias("crossed"),
        ),
        "line-counts",
    )
    counts = both.filter("n > 0").select("shard", "key", "n")

    def change(number: tuple, old: pd.DataFrame, crossed: pd.DataFrame) -> pd.DataFrame:
        keys = int(old["keys"].sum()) if len(old) else 0
        made = CuckooFilter.from_bytes(bytes(old["filter"].iloc[0])) if len(old) else CuckooFilter(0)
        going = [bytes(k) for k in crossed.loc[crossed["crossed"] < 0, "key"]]
        coming = [bytes(k) for k in crossed.loc[crossed["crossed"] > 0, "key"]]
        for k in going:
            made.delete(k)
        fits = keys - len(going) + len(coming) <= made.table.size * 0.9 and all(made.insert(k) for k in coming)
        # Without room the shard's filter is marked for building anew from the exact counts.
        raw = made.to_bytes() if fits else None
        return pd.DataFrame({"shard": [number[0]], "filter": [raw], "keys": [keys - len(going) + len(coming)]})

    filters = kept(
        state.filters.groupBy("shard").cogroup(both.filter("crossed <> 0").select("shard", "key", "crossed").groupBy("shard")).applyInPandas(change, _FILTER),
        "line-filters",
    )

    def build(number: tuple, keys: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of([bytes(k) for k in keys["key"]])
        return pd.DataFrame({"shard": [number[0]], "filter": [made.to_bytes()], "keys": [len(keys)]})

    full = filters.filter("filter IS NULL").select("shard")
    rebuilt = counts.filter(F.col("n") >= least).join(full, "shard", "left_semi").groupBy("shard").applyInPandas(build, _FILTER)
    return state._replace(counts=counts, filters=kept(filters.filter("filter IS NOT NULL").unionByName(rebuilt), "line-filters"))


def insert(state: State, documents: DataFrame, text: str = "text") -> State:
    return _updated(state, documents, 1, text)


def delete(state: State, documents: DataFrame, text: str = "text") -> State:
    """Takes documents out that were inserted before."""
    return _updated(state, documents, -1, text)


class _Wave:
    """Filters of some shards, ready for look-ups in a worker."""

    def __init__(self, filters: dict[int, bytes], shards: int, mistaken: set[bytes]):
        self.mistaken = mistaken
        self.shards = shards
        self._filters = {shard: CuckooFilter.from_bytes(raw).marks() for shard, raw in filters.items()}

    def holds(self, key: bytes) -> bool:
        """Whether the key is in one of these filters, by its fingerprint."""
        found = self._filters.get(shard_of(key, self.shards))
        if found is None:
            return False
        marks, buckets = found
        mark = int.from_bytes(key[:4], "little") or 1
        first = int.from_bytes(key[4:12], "little") % buckets
        if first << 32 | mark in marks:
            return True
        return (first ^ (mark * 0x5BD1E995 >> 7)) % buckets << 32 | mark in marks

    def frequent(self, key: bytes) -> bool:
        return bool(key) and self.holds(key) and key not in self.mistaken


def _waves(state: State) -> Iterator[dict[int, bytes]]:
    wave: dict[int, bytes] = {}
    size = 0
    for row in state.filters.orderBy("shard").toLocalIterator():
        if wave and size + len(row["filter"]) > WAVE_BYTES:
            yield wave
            wave, size = {}, 0
        wave[row["shard"]] = bytes(row["filter"])
        size += len(row["filter"])
    if wave:
        yield wave


def _mistaken(state: State, keys: DataFrame, wave: dict[int, bytes]) -> set[bytes]:
    """Keys below the threshold that the filters of the wave hold: about two in 10**9 of all."""
    shared = state.counts.sparkSession.sparkContext.broadcast((wave, state.shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = _Wave(*shared.value, set())
        for batch in batches:
            found = [key for key in batch.column(0).to_pylist() if filters.holds(key)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["key"])

    rare = map_batches(keys.filter(F.col("n") < state.min_documents).select("key"), run, "key binary")
    return {bytes(row.key) for row in rare.toLocalIterator()}


def clean(state: State, documents: DataFrame, text: str = "text", indexed: bool = False) -> DataFrame:
    """Adds n_lines (before) and n_dropped, and drops the frequent lines from the text; other columns stay.

    The two are the last columns; where the frame has such names, theirs are longer.
    indexed: the documents are among those inserted, so that the counts hold all their keys.
    """
    spark = documents.sparkSession
    keys = state.counts
    if not indexed:
        seen = document_keys(documents, state.shards, text).select("shard", "key")
        keys = kept(seen.join(state.counts, ["shard", "key"], "left").select("key", F.coalesce("n", F.lit(0)).alias("n")), "line-keys")
    columns = documents.columns
    counts = [free_name(documents, name) for name in ("n_lines", "n_dropped")]
    frame = documents.select("*", *[F.lit(start).cast("long").alias(name) for start, name in zip((-1, 0), counts, strict=True)])
    place, n_lines_at, n_dropped_at = columns.index(text), len(columns), len(columns) + 1
    for wave in [*_waves(state)] or [{}]:
        shared = spark.sparkContext.broadcast((wave, state.shards, _mistaken(state, keys, wave) if wave else set()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            filters = _Wave(*shared.value)
            for batch in batches:
                for start in range(0, batch.num_rows, _ROWS):
                    part = batch.slice(start, _ROWS)
                    texts, totals, dropped = [], [], []
                    for value, n, gone in zip(*(part.column(i).to_pylist() for i in (place, n_lines_at, n_dropped_at)), strict=True):
                        found = text_lines(value)
                        stay = [line for line in found if not filters.frequent(line_key(line))]
                        texts.append(b"\n".join(stay))
                        totals.append(len(found) if n < 0 else n)
                        dropped.append(gone + len(found) - len(stay))
                    arrays = list(part.columns)
                    arrays[place] = pa.array(texts, pa.binary()).cast(arrays[place].type)
                    arrays[n_lines_at], arrays[n_dropped_at] = pa.array(totals, pa.int64()), pa.array(dropped, pa.int64())
                    yield pa.RecordBatch.from_arrays(arrays, names=part.schema.names)

        frame = map_batches(frame, run, frame.schema)
    return frame


def shards_for(rows: int) -> int:
    """A power of two, at least 16, of shards for a corpus of so many rows."""
    return 1 << max(4, (rows // SHARD_ROWS).bit_length())


def dedup_lines(documents: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """One row per document: doc_id, text without frequent lines, n_lines, n_dropped."""
    frame = documents.select("doc_id", "text")
    state = insert(empty_state(frame.sparkSession, shards_for(frame.count()), min_documents), frame)
    return clean(state, frame, indexed=True)
