"""Exact dedup by a tree merge of sorted digest runs.

Each input partition makes runs of at most ``RUN_ROWS`` rows: their digests in order, equal
ones combined.  In round r the runs are taken in groups of ``fan_in`` ** r; a group's digests are dealt
to as many ranges as it has runs, so that every merge takes one slice of ``fan_in``
earlier merges, and merges stay about as large as a run.  After the last round one
group is left and each range of the digests has been merged whole.  A merge keeps,
per digest, the row with the most characters, then the smallest id, and the number
of rows.  Rows count as equal if SHA-256, length and a second hash of the normalised
text agree.  A digest that a third of all rows share is combined within its run
first, and brings at most ``fan_in`` entries to any merge.

The way back joins per run: first the runs' entries with the result (at most one
entry per run and digest), then the rows of each run with its entries.

Null texts count as empty, and all empty (or all blank) texts are equal.  Null ids
come after all others.  Of rows that agree in everything, one stays.  A very long text is read
whole, only its digests move.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from quittance.llm.tables import content_keys, kept, map_batches, without_rows

FAN_IN = 8
RUN_ROWS = 200_000  # of one run, so a merge has about as many in memory, however short the texts are
_BLANKS = b" \t\n\x0b\x0c\r"


def normal_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, _BLANKS)


def _keys(documents: DataFrame) -> DataFrame:
    """A table: per row its number, id, length, content keys, digests and the run that it belongs to."""
    frame = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        *content_keys(), "text",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            found = []
            for text in batch.column(5).to_pylist():
                raw = normal_bytes(text)
                found.append((hashlib.sha256(raw).digest(), len(raw).to_bytes(8) + xxhash.xxh3_64_digest(raw)))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5], pa.array([d for d, _ in found], pa.binary()), pa.array([c for _, c in found], pa.binary()),
                    pa.array([part] * len(found), pa.int64()), pa.array([(seen + i) // RUN_ROWS for i in range(len(found))], pa.int64()),
                ],
                names=["row", "doc_id", "n_chars", "key_1", "key_2", "digest", "proof", "part", "piece"],
            )
            seen += len(found)

    names = "row long, doc_id long, n_chars long, key_1 long, key_2 long, digest binary, proof binary, part long, piece long"
    keys = kept(map_batches(frame, run, names), "keys")
    pieces = (keys.agg(F.max("piece")).first()[0] or 0) + 1
    return keys.withColumn("run", F.col("part") * pieces + F.col("piece")).drop("part", "piece")


_ENTRY = "run long, digest binary, proof binary, n_chars long, doc_id long, row long, n long"
_ENTRY_ARROW = pa.schema(
    [
        ("run", pa.int64()), ("digest", pa.binary()), ("proof", pa.binary()), ("n_chars", pa.int64()), ("doc_id", pa.int64()),
        ("row", pa.int64()), ("n", pa.int64()),
    ]
)


def _order(entry: tuple) -> tuple:
    _, digest, proof, n_chars, doc_id, row, _ = entry
    return digest, proof, -n_chars, doc_id is None, doc_id, row


def _combined(entries: Iterator[tuple]) -> Iterator[tuple]:
    """Ordered entries in, the first of each digest out, with the sum of the counts."""
    for _, same in groupby(entries, key=lambda entry: entry[1:3]):
        first = next(same)
        yield (*first[:6], first[6] + sum(entry[6] for entry in same))


def _rows(data: pa.Table | pa.RecordBatch) -> list[tuple]:
    return list(zip(*(data.column(name).to_pylist() for name in _ENTRY_ARROW.names), strict=True))


def _table(entries: Iterator[tuple]) -> pa.Table:
    columns = list(zip(*entries, strict=True)) or [()] * len(_ENTRY_ARROW)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ENTRY_ARROW, strict=True)], schema=_ENTRY_ARROW)


def _local_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs, a batch at a time; the first round merges them like any other runs."""
    for batch in batches:
        yield from _table(_combined(iter(sorted(_rows(batch), key=_order)))).to_batches()


def _merge(data: pa.Table) -> pa.Table:
    runs: dict[int, list[tuple]] = {}
    for entry in _rows(data):
        runs.setdefault(entry[0], []).append(entry)
    # Shuffles deliver a run in pieces that are sorted each; sorting joins sorted pieces in linear time.
    ordered = [sorted(run, key=_order) for run in runs.values()]
    return _table(_combined(heapq.merge(*ordered, key=_order)))


def _range_of(bits: int):
    """The first bits of the digest as a number."""
    return F.shiftright(F.conv(F.hex(F.substring("digest", 1, 7)), 16, 10).cast("long"), 56 - bits) if bits else F.lit(0).cast("long")


def merged(keys: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct text: digest, proof, row and doc_id that stay, n (rows with the text)."""
    runs = (keys.agg(F.max("run")).first()[0] or 0) + 1
    bits = (fan_in - 1).bit_length()
    fan_in = 1 << bits
    rounds = 1
    while fan_in**rounds < runs:
        rounds += 1
    entries = map_batches(keys.withColumn("n", F.lit(1).cast("long")).select(*_ENTRY_ARROW.names), _local_runs, _ENTRY)
    for done in range(1, rounds + 1):
        group = F.floor(F.col("run") / fan_in).cast("long")
        # A round merges runs with equal numbers after the division; the next one sees that number as the run.
        entries = (
            entries.withColumn("of", group)
            .withColumn("range", _range_of(done * bits))
            .groupBy("of", "range")
            .applyInArrow(_merge, _ENTRY)
            .withColumn("run", F.floor(F.col("run") / fan_in).cast("long"))
        )
    return entries.drop("run")


def resolve(keys: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """Per row of ``keys``: row, doc_id, content keys, digest, keep_id, keep_row, group_size."""
    result = kept(merged(keys, fan_in), "digests").select(
        "digest", "proof", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("n").alias("group_size")
    )
    per_run = keys.groupBy("run", "digest", "proof").agg(F.count(F.lit(1)).alias("here")).join(result, ["digest", "proof"])
    return keys.select("row", "doc_id", "key_1", "key_2", "run", "digest", "proof").join(per_run.drop("here"), ["run", "digest", "proof"])


def exact_groups(documents: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document, dropped ones too."""
    found = resolve(_keys(documents), fan_in)
    return found.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(documents: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The documents that stay, with all their columns.

    Dropped rows are found again by two hashes of id and text; of rows that agree in
    both, one stays.
    """
    found = resolve(_keys(documents), fan_in)
    return without_rows(documents, found.select("key_1", "key_2", (F.col("row") == F.col("keep_row")).alias("kept")))
