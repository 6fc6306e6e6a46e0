"""Benchmark decontamination: one Aho-Corasick automaton over the test items, one scan of each text.

Texts are normalised to words: A-Z lower-cased, then runs of letters, digits and
bytes above ASCII.  Every ten consecutive words of an item are a pattern (all words
of a shorter item).  The automaton works on words, not on characters: each word of
the items is one symbol and every other word is one symbol that no pattern has, so
that a text is scanned in as many steps as it has words.  Word numbers lead back to
character offsets of the original text.

The items are held in blocks of at most ``block_words`` words, which bounds what the
driver, a broadcast and a worker have in memory; a usual benchmark is one block and takes
one scan. More blocks take a scan each, one after the other.

Null texts have no words.  Items without words have no pattern and are never found.
Items that share an id count once.  An item whose id is null is listed as ``null``.
Repeated rows and ids are judged row by row.  Without items nothing is hit.  An empty table
gives no rows.  A very long text is scanned whole, in one task's memory.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import chain

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.pandas.types import from_arrow_schema

from quittance.llm.tables import free_name, kept, map_batches

WINDOW = 10
BLOCK_WORDS = 500_000
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_ROWS = 500
_FOUND = pa.schema(
    [
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)
_HITS = pa.schema(
    [
        ("key_1", pa.int64()), ("key_2", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)


def normal_words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


Block = list[tuple[str, list[bytes]]]


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[Block]:
    block: Block = []
    size = 0
    for row in benchmark.select(F.col(item_id).cast("string"), F.col(text)).toLocalIterator():
        found = normal_words(row[1])
        if block and size + len(found) > block_words:
            yield block
            block, size = [], 0
        if found:
            block.append(("null" if row[0] is None else row[0], found))
            size += len(found)
    if block:
        yield block


def _symbol(number: int) -> str:
    return chr(number if number < 0xD800 else number + 0x800)


class Matcher:
    """The automaton of one block."""

    def __init__(self, block: Block, window: int):
        import ahocorasick

        self.symbols: dict[bytes, str] = {}
        patterns: dict[str, set[str]] = {}
        for item, found in block:
            line = "".join(self.symbols.setdefault(word, _symbol(len(self.symbols) + 1)) for word in found)
            for start in range(max(len(line) - window, 0) + 1):
                patterns.setdefault(line[start : start + window], set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern, items in patterns.items():
            self.automaton.add_word(pattern, (len(pattern), items))
        self.automaton.make_automaton()

    def scan(self, found: list[bytes], hit: bytearray, items: set[str]) -> None:
        if not self.symbols:  # no items
            return
        symbol = self.symbols.get
        for last, (n, owners) in self.automaton.iter("".join([symbol(word, "\0") for word in found])):
            hit[last - n + 1 : last + 1] = b"\1" * n
            items |= owners


@lru_cache(1)
def _matcher(key: str, block: Broadcast, window: int) -> Matcher:
    return Matcher(block.value, window)


def _spans(text: str, hit: bytearray) -> list[dict[str, int]]:
    """Character offsets of the maximal runs of hit words."""
    raw = text.encode("utf-8", "surrogatepass").lower()
    places = [m.span() for m in _WORD.finditer(raw)]
    spans = []
    at = hit.find(1)
    while at >= 0:
        end = hit.find(0, at)
        end = len(hit) if end < 0 else end
        start_byte, end_byte = places[at][0], places[end - 1][1]
        start = len(raw[:start_byte].decode("utf-8", "surrogatepass"))
        spans.append({"start": start, "end": start + len(raw[start_byte:end_byte].decode("utf-8", "surrogatepass"))})
        at = hit.find(1, end)
    return spans


def _runs(hit: bytearray) -> list[tuple[int, int]]:
    runs, at = [], hit.find(1)
    while at >= 0:
        end = hit.find(0, at)
        end = len(hit) if end < 0 else end
        runs.append((at, end))
        at = hit.find(1, end)
    return runs


def _text_keys(text: str) -> list[Column]:
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def _block_hits(frame: DataFrame, text: str, block: Block, window: int) -> DataFrame:
    """(key_1, key_2, runs, items) of the texts in which a window of the block occurs; runs of word numbers."""
    shared = frame.sparkSession.sparkContext.broadcast(block)
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(name, shared, window)
        for batch in batches:
            rows = []
            for key_1, key_2, value in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                words, names = normal_words(value), set()
                hit = bytearray(len(words))
                matcher.scan(words, hit, names)
                if names:
                    rows.append((key_1, key_2, [{"start": a, "end": b} for a, b in _runs(hit)], sorted(names)))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _HITS, strict=True)], schema=_HITS)

    texts = frame.select(*[key.alias(f"key_{i}") for i, key in enumerate(_text_keys(text), 1)], F.col(text).alias("text"))
    try:
        return kept(map_batches(texts, run, from_arrow_schema(_HITS)), "block-hits")
    finally:
        shared.destroy()


def scan(
    frame: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS, found_as: str = "found",
) -> DataFrame:
    """Adds the struct ``found_as`` (n_words, n_hit, items, spans) to all columns of the frame.

    Items come to the driver a block of ``block_words`` at a time. One block is sent to the tasks
    and scanned for in one map. With more, each block has a scan of its own that leaves the
    hits of the texts that have any; the block is dropped before the next one is read, and
    its automaton is built once per Python worker. A last map joins the hits to the texts.
    """
    blocks = _blocks(benchmark, item_id, item_text, block_words)
    first, second = next(blocks, []), next(blocks, None)
    schema = StructType([*frame.schema.fields, StructField(found_as, from_arrow_schema(_FOUND))])
    place, width, kind = frame.columns.index(text), len(frame.columns), pa.struct(list(_FOUND))

    def added(part: pa.RecordBatch, words: list[list[bytes]], hits: list[bytearray], items: list[set[str]]) -> pa.RecordBatch:
        rows = [
            {"n_words": len(found), "n_hit": hit.count(1), "items": sorted(names), "spans": _spans(value, hit) if names else []}
            for value, found, hit, names in zip(part.column(place).to_pylist(), words, hits, items, strict=True)
        ]
        return pa.RecordBatch.from_arrays([*part.columns[:width], pa.array(rows, kind)], names=[*part.schema.names[:width], found_as])

    if second is None:
        shared = frame.sparkSession.sparkContext.broadcast(first)
        key = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(key, shared, window)
            for batch in batches:
                for start in range(0, batch.num_rows, _ROWS):
                    part = batch.slice(start, _ROWS)
                    words = [normal_words(value) for value in part.column(place).to_pylist()]
                    hits, items = [bytearray(len(found)) for found in words], [set() for _ in words]
                    for found, hit, names in zip(words, hits, items, strict=True):
                        matcher.scan(found, hit, names)
                    yield added(part, words, hits, items)

        return map_batches(frame, run, schema)

    hits = [_block_hits(frame, text, block, window) for block in chain((first, second), blocks)]
    both = reduce(DataFrame.union, hits).dropDuplicates(["key_1", "key_2", "runs", "items"])
    by_text = kept(both.groupBy("key_1", "key_2").agg(F.flatten(F.collect_list("runs")).alias("runs"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")), "text-hits")
    names = [free_name(frame, name) for name in ("key_1", "key_2", "runs", "items")]
    renamed = by_text.toDF(*names)
    keyed = frame.select("*", *[key.alias(name) for key, name in zip(_text_keys(text), names[:2], strict=True)])
    joined = keyed.join(renamed, names[:2], "left").select(*frame.columns, *names[2:])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                words = [normal_words(value) for value in part.column(place).to_pylist()]
                hits = [bytearray(len(found)) for found in words]
                for hit, runs in zip(hits, part.column(width).to_pylist(), strict=True):
                    for r in runs or ():
                        hit[r["start"] : r["end"]] = b"\1" * (r["end"] - r["start"])
                yield added(part, words, hits, [set(found or ()) for found in part.column(width + 1).to_pylist()])

    return map_batches(joined, combine, schema)


def items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def contamination(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: words, hit words, items found, their digest, spans in characters of the text."""
    found = scan(documents.select("doc_id", "text"), benchmark, **options)
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        items_digest(F.col("found.items")).alias("items_sha256"), (F.col("found.n_hit") > 0).alias("contaminated"),
        "found.items", "found.spans",
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no word is hit, with all their columns."""
    name = free_name(documents, "found")
    found = scan(documents, benchmark, found_as=name, **options)
    return found.filter(F.col(name).getField("n_hit") == 0).select(*documents.columns)
