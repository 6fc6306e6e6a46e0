"""WARC archives with revisit records, and the capture index merged from sorted runs.

Writing: records with equal payloads of at least ``LEAST_BYTES`` become one response
(the largest id) and revisits of it; every payload below that is a response.  A
record is text, so archives are written by Spark's own writer to the shared folder
(gzip, at most ``records`` per file), without a local file.

Reading: every archive is opened as a whole, decompressed in pieces and parsed by
its Content-Length fields.  Each archive gives one run of index entries in order of
(URL key, time, id).  An external merge makes one history of them: runs are cut
into key ranges, and each range merges its runs with a loser tree, so that the
result is ordered by partition and within it.  The runs are kept as a table first, so
that archives are parsed once, and the number of ranges follows the number of captures.
An entry names its archive and where its record lies in the decompressed archive;
``fetch`` reads records by that.

Null pages have an empty payload.  Null or broken URLs have an empty key.  Ids are
expected to be unique; rows that repeat an id and its payload give a record each.  A null
id is a record without a number, which no other refers to by it.  Captures with equal URL and time are in
the order of their ids.  Line breaks inside a URL are percent-encoded in the record.  An empty table
gives no archive entries; further columns are not read.  A damaged archive ends the run with an
error that names it and the place.  A payload has to fit one cell, and so has an archive,
compressed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from quittance.llm.tables import kept, map_batches
from quittance.session import new_folder
from quittance.sources.listing import open_bytes

LEAST_BYTES = 1000
RECORDS_PER_FILE = 2000
CAPTURES_PER_RANGE = 200_000
VERSION = b"WARC/1.1"
FIRST_CAPTURE = "2024-01-01 00:00:00"


# ---------------------------------------------------------------- which records are revisits


def record_types(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, refers_to (null for responses)."""
    payload = F.coalesce("html", F.lit(""))
    frame = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("html"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload.cast("binary")).alias("payload_digest"),
    )
    copies = (
        frame.filter(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1").drop("n")
    )
    return frame.join(copies, ["payload_digest", "payload_bytes"], "left").select(
        *frame.columns, F.when(F.col("first_id") != F.col("page_id"), F.col("first_id")).alias("refers_to")
    )


# ---------------------------------------------------------------- writing


def _record(columns: DataFrame) -> F.Column:
    """The record as text, without the last line feed, which the writer adds."""
    end = "\r\n"
    revisit = F.col("refers_to").isNotNull()
    name = lambda id_column: F.concat(F.lit("<urn:page:"), id_column.cast("string"), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "), F.col("payload_bytes").cast("string"),
        F.lit(end + end),
    )
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit(VERSION.decode() + end + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{end}WARC-Record-ID: "), name(F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        F.coalesce(F.concat(F.lit(f"{end}WARC-Target-URI: "), url), F.lit("")),
        F.lit(f"{end}WARC-Date: "), F.date_format("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit(f"{end}WARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(
            revisit,
            F.concat(
                F.lit(f"{end}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{end}WARC-Refers-To: "),
                name(F.col("refers_to")),
            ),
        ).otherwise(""),
        F.lit(f"{end}Content-Type: application/http; msgtype=response{end}Content-Length: "), block_bytes.cast("string"), F.lit(end + end),
        http, F.when(revisit, "").otherwise(F.col("html")), F.lit("\r\n\r"),
    )


def write_archives(pages: DataFrame, folder: str | None = None, records: int = RECORDS_PER_FILE, least_bytes: int = LEAST_BYTES) -> str:
    """Writes one record per page; returns the folder.

    Capture times, which pages do not carry, are one second per id after ``FIRST_CAPTURE``.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    captured = F.timestamp_seconds(F.unix_timestamp(F.lit(FIRST_CAPTURE)) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1 << 32)))
    frame = record_types(pages, least_bytes).withColumn("captured", captured)
    frame.select(_record(frame).alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", records).text(folder)
    return folder


# ---------------------------------------------------------------- reading


class _Stream:
    """Decompressed bytes of an archive, a piece at a time."""

    def __init__(self, raw: bytes):
        self._raw, self._at, self._unzip, self._ready = memoryview(raw), 0, zlib.decompressobj(31), bytearray()
        self.taken = 0  # bytes handed out

    def _more(self) -> bool:
        while self._at < len(self._raw):
            piece = self._raw[self._at : self._at + 65536]
            self._at += len(piece)
            made = self._unzip.decompress(piece)
            while self._unzip.eof and (rest := self._unzip.unused_data):
                self._unzip = zlib.decompressobj(31)
                made += self._unzip.decompress(rest)
            if made:
                self._ready += made
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before the mark, which is taken off too; None at the end."""
        while (at := self._ready.find(mark)) < 0:
            if not self._more():
                return None
        found = bytes(self._ready[:at])
        del self._ready[: at + len(mark)]
        self.taken += at + len(mark)
        return found

    def take(self, n: int) -> bytes:
        while len(self._ready) < n and self._more():
            pass
        found = bytes(self._ready[:n])
        del self._ready[:n]
        self.taken += len(found)
        return found

    def skip(self, n: int) -> None:
        while n > 0 and (gone := len(self.take(min(n, 1 << 20)))):
            n -= gone

    @property
    def rest(self) -> bytes:
        return bytes(self._ready)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    return {pair[0].lower(): pair[1] for pair in pairs if len(pair) == 2}


class Record(NamedTuple):
    """Header fields, HTTP head and payload; where the record lies in the decompressed archive."""

    fields: dict[str, str]
    http: bytes
    payload: bytes
    offset: int
    length: int


def _next_record(stream: _Stream) -> Record | None:
    offset = stream.taken
    head = stream.until(b"\r\n\r\n")
    if head is None:
        if stream.rest:
            raise ValueError("cut off")
        return None
    fields = _fields(head)
    size = int(fields["content-length"])
    block = stream.take(size)
    if not head.startswith(b"WARC/") or len(block) != size or stream.take(4) != b"\r\n\r\n":
        raise ValueError("cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    return Record(fields, http, payload, offset, stream.taken - offset)


def records(raw: bytes, name: str = "archive") -> Iterator[Record]:
    """The records of a compressed archive."""
    stream = _Stream(raw)
    while True:
        try:
            record = _next_record(stream)
        except (zlib.error, KeyError, ValueError) as problem:
            raise ValueError(f"{name} is damaged behind byte {stream.taken} of its content: {problem}") from problem
        if record is None:
            return
        yield record


def url_key(url: str | None) -> str:
    """Host labels from the top domain down, then path and query, lower-cased; without scheme, ``www`` and fragment."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port and parts.port not in (80, 443) else ""
    except ValueError:
        return ""
    if not host:
        return ""
    query = f"?{'&'.join(sorted(parts.query.lower().split('&')))}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path.lower() or '/'}{query}"


_CAPTURE = "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, run string, offset long, length long"
_CAPTURE_ARROW = pa.schema(
    [
        ("url_key", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("run", pa.string()),
        ("offset", pa.int64()), ("length", pa.int64()),
    ]
)


def _page(name: str | None) -> int | None:
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _entry(record: Record, run: str) -> tuple:
    fields, http, payload, offset, length = record
    revisit = fields["warc-type"] == "revisit"
    digest = fields["warc-payload-digest"].removeprefix("sha1:") if revisit else hashlib.sha1(payload).hexdigest()
    size = int(_fields(http)["content-length"]) if revisit else len(payload)
    return (
        url_key(fields.get("warc-target-uri")), fields["warc-date"], _page(fields["warc-record-id"]), size, digest,
        fields["warc-type"], _page(fields.get("warc-refers-to")), run, offset, length,
    )


def _order(entry: tuple) -> tuple:
    return entry[0], entry[1], entry[2] is not None, entry[2] or 0, entry[5]


def _batch(entries: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*entries, strict=True)) or [()] * len(_CAPTURE_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CAPTURE_ARROW, strict=True)], schema=_CAPTURE_ARROW)


def sorted_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The index entries of each archive, in order; ``run`` names the archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                name = path.rsplit("/", 1)[-1]
                yield _batch(sorted((_entry(record, name) for record in records(raw.as_py(), name)), key=_order))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")
    return map_batches(files, run, _CAPTURE)


# ---------------------------------------------------------------- external merge


class LoserTree:
    """Merges sorted runs: inner nodes hold the loser of their match, so that each step plays one path."""

    def __init__(self, runs: Iterable[Iterable[tuple]], key):
        self._runs = [iter(run) for run in runs]
        self._key = key
        self._heads = [self._pull(i) for i in range(len(self._runs))]
        self._losers = [-1] * len(self._runs)
        self._winner = self._first(1) if self._runs else -1

    def _pull(self, run: int):
        entry = next(self._runs[run], None)
        return None if entry is None else (self._key(entry), run, entry)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._heads[a], self._heads[b]
        return y is None or (x is not None and x[:2] <= y[:2])

    def _first(self, node: int) -> int:
        """Plays all matches below a node; runs are the leaves n .. 2n - 1."""
        n = len(self._runs)
        if node >= n:
            return node - n
        a, b = self._first(2 * node), self._first(2 * node + 1)
        winner, self._losers[node] = (a, b) if self._beats(a, b) else (b, a)
        return winner

    def __iter__(self) -> Iterator[tuple]:
        n = len(self._runs)
        while n and self._heads[self._winner] is not None:
            run = self._winner
            yield self._heads[run][2]
            self._heads[run] = self._pull(run)
            node = (run + n) // 2
            while node:
                if self._beats(self._losers[node], run):
                    run, self._losers[node] = self._losers[node], run
                node //= 2
            self._winner = run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges what a key range got of each run; an entry out of order starts another run."""
    runs: dict[str, list[list[tuple]]] = {}
    for batch in batches:
        for entry in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            pieces = runs.setdefault(entry[7], [[]])
            if pieces[-1] and _order(entry) < _order(pieces[-1][-1]):
                pieces.append([])
            pieces[-1].append(entry)
    part: list[tuple] = []
    for entry in LoserTree((piece for run in runs.values() for piece in run), _order):
        part.append(entry)
        if len(part) == 10_000:
            yield _batch(part)
            part = []
    yield _batch(part)


def capture_history(runs: DataFrame, ranges: int | None = None) -> DataFrame:
    """All captures, ordered by URL key, time and id over the partitions and within them.

    ``runs`` is read twice, for the bounds of the ranges and for the merge, so it should
    be a table. A range holds about ``CAPTURES_PER_RANGE`` captures, which one task merges in memory.
    """
    columns = ["url_key", "captured", "page_id"]
    ranges = ranges or -(-max(1, runs.count()) // CAPTURES_PER_RANGE)
    return map_batches(runs.repartitionByRange(ranges, *columns), _merge, _CAPTURE)


def archived(pages: DataFrame) -> DataFrame:
    """Writes the archives, reads them back and returns one row per page in the order of the history."""
    runs = kept(sorted_runs(pages.sparkSession, write_archives(pages)), "index-runs")
    return capture_history(runs).withColumnRenamed("run", "archive")


def fetch(captures: DataFrame, folder: str, opener: Callable[[str], bytes] = open_bytes) -> DataFrame:
    """(page_id, record_type, payload) of captures, read by archive, offset and length.

    Each archive is opened once, by one task, and decompressed up to the last record
    that is wanted. A revisit has an empty payload: fetch what it refers to.
    """
    places = F.sort_array(F.collect_list(F.struct("offset", "length")))
    wanted = captures.select("archive", "offset", "length").distinct().groupBy("archive").agg(places.alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                stream, found = _Stream(opener(f"{folder.rstrip('/')}/{archive}")), []
                for place in places:
                    stream.skip(place["offset"] - stream.taken)
                    record = _next_record(stream)
                    if record is None or record.length != place["length"]:
                        raise ValueError(f"{archive} has no record of {place['length']} bytes at {place['offset']}")
                    found.append((_page(record.fields["warc-record-id"]), record.fields["warc-type"], record.payload))
                page_id, kind, payload = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(page_id, pa.int64()), pa.array(kind, pa.string()), pa.array(payload, pa.binary())], names=["page_id", "record_type", "payload"]
                )

    return map_batches(wanted, run, "page_id long, record_type string, payload binary")
