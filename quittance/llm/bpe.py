"""Byte-level BPE: the exact merges of a rank file, found by backtracking over longest matches.

All bytes are mapped to Latin-1 characters, so that one Aho-Corasick automaton over
the vocabulary reports every token that occurs in a piece of text.  Encoding takes
the longest token at each place and steps back to the next shorter one where two
neighbours could not stand side by side after merging.  Whether a pair can stand
is decided by undoing merges on both sides of the border, and is remembered.  Each
place is given up at most once, so the work is linear in the text.

Rank files are read by the driver, whose bounded table (the vocabulary) is
broadcast.  A text is first cut by the pre-tokeniser's pattern; the cut is found
with character classes in numpy and gives the same pieces as the pattern.

Nulls count as empty texts; an empty text has no tokens.  Repeated rows and repeated
or null ids are encoded row by row; other columns are not read.  A very long text is encoded
whole, its tokens are in one task's memory.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quittance.llm.tables import map_batches

# The pattern whose pieces ``pieces`` finds, as published with the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The contractions and the white space of that pattern.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
SPACES = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
ROWS_AT_ONCE = 200
REMEMBERED_PIECES = 300_000
REMEMBERED_PAIRS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


@lru_cache(1)
def _classes() -> np.ndarray:
    kinds = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        group = unicodedata.category(chr(code))[0]
        if group in "LN":
            kinds[code] = LETTER if group == "L" else NUMBER
    kinds[list(SPACES)] = SPACE
    return kinds


def pieces(texts: list[str]) -> tuple[bytes, list[int], list[int]]:
    """UTF-8 bytes of the texts one after the other, where pieces start, and each text's first piece.

    Both lists end with the total, and no piece reaches from one text into the next.
    """
    joined = "".join(texts)
    n = len(joined)
    raw = joined.encode("utf-8", "surrogatepass")
    if not n:
        return raw, [0], [0] * (len(texts) + 1)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    head_at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(text) for text in texts], out=head_at[1:])
    head = np.zeros(n + 1, bool)
    head[head_at] = True
    kind = _classes()[code]
    starts = head.copy()
    starts[1:n] |= kind[1:] != kind[:-1]
    # A run of white space before more text gives up its last character: a piece of its own,
    # or the head of the next piece if it is a plain space.
    space = kind == SPACE
    last_of_run = np.flatnonzero(space[:-1] & ~space[1:] & ~head[1:n])
    starts[last_of_run] = True
    starts[last_of_run[code[last_of_run] == 0x20] + 1] = False
    # Contractions: an apostrophe that starts a piece, with one of the fixed endings.
    for i in np.flatnonzero((code == 0x27) & starts[:n]).tolist():
        tail = joined[i + 1 : i + 3]
        if head[i + 1]:
            continue
        if i + 2 <= n and head[min(i + 2, n)]:
            tail = tail[:1]
        end = next((i + 1 + len(ending) for ending in CONTRACTIONS if tail.startswith(ending)), None)
        if end:
            starts[i + 1 : end] = False
            starts[end] = True
    first = np.zeros(n + 1, np.int64)
    np.cumsum(starts[:n], out=first[1:])
    first_piece = first[head_at].tolist()
    if len(raw) == n:
        return raw, np.flatnonzero(starts).tolist(), first_piece
    place = np.zeros(n + 1, np.int64)
    np.cumsum(1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF), out=place[1:])
    return raw, place[starts].tolist(), first_piece


class Encoder:
    """Encodes and decodes with one vocabulary; built once per Python worker."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.vocabulary = {rank: token for token, rank in ranks.items()}
        top = max(ranks.values(), default=0) + 1
        self._length = [0] * top
        for token, rank in ranks.items():
            self._length[rank] = len(token)
        self._known: dict[bytes, tuple[int, ...]] = {}
        self._known_before: dict[bytes, tuple[int, ...]] = {}
        self._stands: dict[int, bool] = {}
        automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            automaton.add_word(token.decode("latin-1"), rank)
        automaton.make_automaton()
        self._automaton = automaton
        self._learn_merges()

    def _learn_merges(self) -> None:
        """For each token the two tokens it was merged from, and the longest token that it starts with."""
        self._shorter: list[int | None] = [None] * len(self._length)
        self._halves: dict[int, tuple[int, int]] = {}
        self._merged: dict[tuple[int, int], int] = {}
        ranks = self.ranks
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            self._shorter[rank] = next((ranks[token[:i]] for i in range(len(token) - 1, 0, -1) if token[:i] in ranks), None)
            self._halves[rank] = (rank, rank)
            for i in range(len(token) - 1, 0, -1):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None and left < rank and right < rank and self._can_stand(left, right):
                    self._halves[rank] = (left, right)
                    self._merged[left, right] = rank
                    break
        self._stands.clear()

    def _can_stand(self, left: int, right: int) -> bool:
        """Whether the merges of left + right end with exactly these two tokens.

        Undo merges next to the border, the latest first.  A pair that would have
        been merged before the pieces it meets were complete rules them out.
        """
        bound = 1 << 62
        while True:
            merged = self._merged.get((left, right))
            if merged is not None and merged < bound:
                return False
            inner_left, inner_right = self._halves[left][1], self._halves[right][0]
            whole_left, whole_right = inner_left == left, inner_right == right
            if whole_left and whole_right:
                return True
            # On equal ranks the left one was merged first, so the right one is undone first.
            if not whole_left and (whole_right or left > right):
                bound, left = left, inner_left
            else:
                bound, right = right + 1, inner_right

    def _stand(self, left: int, right: int, key: int) -> bool:
        if len(self._stands) >= REMEMBERED_PAIRS:
            self._stands.clear()
        found = self._stands[key] = self._can_stand(left, right)
        return found

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        """Tokens of one piece; a piece that is itself a token stays whole."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        length_of, shorter, remembered = self._length, self._shorter, self._stands
        longest: list[int] = [0] * len(piece)
        for last, rank in self._automaton.iter(piece.decode("latin-1")):
            longest[last - length_of[rank] + 1] = rank  # later matches of a start are longer
        dead: set[int] = set()
        out: list[int] = []
        place, size, token, left = 0, len(piece), longest[0], -1
        while True:
            end = place + length_of[token]
            if end not in dead:
                if left < 0:
                    fits = True
                else:
                    key = left << 32 | token
                    fits = remembered.get(key)
                    if fits is None:
                        fits = self._stand(left, token, key)
                if fits:
                    out.append(token)
                    if end == size:
                        return tuple(out)
                    place, left, token = end, token, longest[end]
                    continue
            less = shorter[token]
            while less is None:
                dead.add(place)
                token = out.pop()
                place -= length_of[token]
                less = shorter[token]
                left = out[-1] if out else -1
            token = less

    def encode_all(self, texts: list[str]) -> Iterator[list[int]]:
        raw, at, first_piece = pieces(texts)
        learn, flat = self._learn, chain.from_iterable
        for first, end in zip(first_piece, first_piece[1:], strict=False):
            known = self._known.get
            places = at[first : end + 1]
            found = [known(p) or learn(p) for p in [raw[a:b] for a, b in zip(places, places[1:], strict=False)]]
            yield list(flat(found))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def _learn(self, piece: bytes) -> tuple[int, ...]:
        out = self._known.get(piece) or self._known_before.get(piece) or self.encode_piece(piece)
        if len(self._known) >= REMEMBERED_PIECES:
            self._known, self._known_before = {}, self._known  # what is in use finds its way back
        self._known[piece] = out
        return out

    def forget(self) -> None:
        """Drop remembered pieces that were not met lately; a worker may do other work next."""
        self._known_before = {}

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


_worker_encoders: dict[str, Encoder] = {}


def _worker_encoder(vocabulary_digest: str, broadcast) -> Encoder:
    """The encoder that this Python worker keeps from one task to the next."""
    if vocabulary_digest not in _worker_encoders:
        gc.disable()  # nothing here makes cycles, and the many small tuples are slow to walk
        _worker_encoders.clear()
        _worker_encoders[vocabulary_digest] = Encoder(broadcast.value)
    return _worker_encoders[vocabulary_digest]


def _per_text(frame: DataFrame, ranks: dict[bytes, int], text: str, keep: list[str], made: pa.Schema, make) -> DataFrame:
    """Map texts to the columns ``made``; the other columns kept pass through untouched."""
    shared = frame.sparkSession.sparkContext.broadcast(ranks)
    number = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(number, shared)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                rows = list(make(encoder, part.column(len(keep)).to_pylist()))
                columns = [pa.array([row[i] for row in rows], field.type) for i, field in enumerate(made)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *columns], names=[*keep, *made.names])
        encoder.forget()

    from pyspark.sql.pandas.types import from_arrow_schema
    from pyspark.sql.types import StructType

    chosen = frame.select(*keep, text)
    schema = StructType([*chosen.schema.fields[: len(keep)], *from_arrow_schema(made).fields])
    return map_batches(chosen, run, schema)


def _encode_rows(encoder: Encoder, values: list[str | None]):
    return ((ids,) for ids in encoder.encode_all([value or "" for value in values]))


def _decode_rows(encoder: Encoder, values: list[list[int] | None]):
    return ((encoder.decode(value or []),) for value in values)


def encode_documents(frame: DataFrame, ranks: dict[bytes, int], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Adds ``ids`` (array of int): the tokens of each whole text, without special tokens."""
    made = pa.schema([("ids", pa.list_(pa.int32()))])
    return _per_text(frame, ranks, text, list(keep), made, _encode_rows)


def decode_documents(frame: DataFrame, ranks: dict[bytes, int], ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Adds ``decoded`` (binary): the bytes that the tokens stand for."""
    made = pa.schema([("decoded", pa.binary())])
    return _per_text(frame, ranks, ids, list(keep), made, _decode_rows)


def round_trip_digests(frame: DataFrame, ranks: dict[bytes, int], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encodes, then decodes each text; n_tokens and digests of both results.

    Both steps run in one pass, so that token lists never leave the worker.
    """
    made = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    decimals = {rank: str(rank) for rank in ranks.values()}

    def make(encoder: Encoder, values: list[str | None]):
        for ids in encoder.encode_all([value or "" for value in values]):
            shown = ",".join(map(decimals.__getitem__, ids)).encode()
            yield len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest()

    return _per_text(frame, ranks, text, list(keep), made, make)


def default_ranks(spark: SparkSession | None = None, path: str | None = None) -> dict[bytes, int]:
    """The rank file at ``path``, or else the public multilingual one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return read_ranks(path)
