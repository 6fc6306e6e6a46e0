"""Alignment of two tokenizers on the same bytes.

Both tokenizers encode a text; token bytes are added up to the offsets at which tokens
end.  A dictionary per side maps each end to the token's index.  The keys that both
dictionaries hold, in order, cut the two id lists into groups: the shortest stretches
of tokens with the same bytes on either side.  Links are expanded per group: a pair of
an A and a B token whose byte ranges end together; that is the last token of either
side, since an earlier common end would have cut the group.

How often an id pair is linked is counted over the whole corpus.  Of two linked tokens
one ends with the other's bytes, so the vocabularies bound the number of different pairs
(``most_pairs``), and the counts can be broadcast for the second pass, in which every
document looks up its links.  The first pass keeps a document's links as a packed list
of pair numbers.

A is a byte-level vocabulary whose token strings stand for bytes; it encodes a space and
the text.  B is a piece vocabulary that adds the space itself; a piece is UTF-8 with
U+2581 as the space, ``<0xHH>`` is the byte HH.  Strings of special tokens inside a text
are plain text.  Null and empty texts, and texts that either tokenizer does not give back
byte for byte behind the space, have no tokens.

Null and repeated ids are carried through, every row is a document of its own and counts
in the pair counts; of pairs with equal counts all are best.  An empty table gives no rows.
Only ``doc_id`` and ``text`` are read.  A very long text is worked on whole; its tokens
are in one task's memory.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, count
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quittance.llm.tables import kept, map_batches

BLOCK_BYTES = 1 << 19
REMEMBERED = 300_000  # words
LONGEST_REMEMBERED = 64
_BORDER = re.compile(r"(?<=\S)(?= \S)")
SPACE = "\u2581"
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


class Paths(NamedTuple):
    a: str  # a byte-level vocabulary as the public ``tokenizers`` library stores it
    b: str  # a piece vocabulary as the public ``sentencepiece`` library stores it


def default_paths() -> Paths:
    import public_tokenizers

    return Paths(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for
    characters from U+0100 on.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Aligned(NamedTuple):
    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: bytes


NOTHING = Aligned(0, 0, 0, "", b"")


class Tokenizers:
    """Both tokenizers with the bytes of their ids.

    A is read from its vocabulary file and run by the ``tiktoken`` library, six times as
    fast; the two agree as long as ids rise with the merges, which is checked.
    """

    def __init__(self, paths: Paths):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        alphabet = byte_alphabet()
        stored = json.loads(Path(paths.a).read_text(encoding="utf-8"))
        if stored["model"]["type"] != "BPE" or stored["normalizer"] or stored["pre_tokenizer"] != _BYTE_LEVEL:
            raise ValueError(f"{paths.a} is no plain byte-level vocabulary")
        merges = [merge.split(" ") if isinstance(merge, str) else merge for merge in stored["model"]["merges"]]
        ids = [stored["model"]["vocab"]["".join(merge)] for merge in merges]
        if any(i >= j for i, j in zip(ids, ids[1:], strict=False)):
            raise ValueError(f"{paths.a} numbers its tokens in another order than its merges")
        ranks = {bytes(alphabet[c] for c in token): i for token, i in stored["model"]["vocab"].items() if all(c in alphabet for c in token)}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=paths.b)
        by_id = {i: token for token, i in ranks.items()}
        self.a_bytes = [by_id.get(i, b"") for i in range(max(ranks.values()) + 1)]
        pieces = list(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        self.b_bytes = [bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode() for i, piece in enumerate(pieces)]
        self.a_names, self.b_names = (list(map(str, range(len(side)))) for side in (self.a_bytes, self.b_bytes))
        self.a_length, self.b_length = (list(map(len, side)) for side in (self.a_bytes, self.b_bytes))
        self.pair_type = np.dtype(np.uint32 if len(self.a_bytes) * len(self.b_bytes) <= 1 << 32 else np.uint64)
        # Then no piece reaches over the space in front of a word.
        self.by_words = not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in pieces) and self.b.encode("a b", out_type=str) == [f"{SPACE}a", f"{SPACE}b"]
        self.known: dict[str, Aligned | None] = {}

    def encode(self, texts: Sequence[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides for texts that start with the space."""
        return [self.a.encode_ordinary(text) for text in texts], self.b.encode([text[1:] for text in texts], num_threads=1)

    def align(self, texts: Sequence[str]) -> list[Aligned | None]:
        """Groups and links of each text, which starts with the space; None if one side does not give it back.

        The texts are aligned at once, as if they were one: each ends where tokens of both sides end.
        """
        ids = self.encode(texts)
        raw = [text.encode() for text in texts]
        last = [np.cumsum(list(map(len, side))) for side in ids]  # tokens up to the end of each text
        flat = [list(chain.from_iterable(side)) for side in ids]
        ends = [np.cumsum([length[i] for i in side]) for length, side in zip((self.a_length, self.b_length), flat, strict=True)]
        text_ends = np.cumsum(list(map(len, raw)))
        whole = b"".join(raw)
        same = all(
            here.all() and np.array_equal(at[here - 1], text_ends) and b"".join([token[i] for i in side]) == whole
            for here, at, token, side in zip(last, ends, (self.a_bytes, self.b_bytes), flat, strict=True)
        )
        if not same:
            return [None] if len(texts) == 1 else [found for text in texts for found in self.align([text])]
        to_a, to_b = cuts(ends[0].tolist(), ends[1].tolist())
        groups = shown([self.a_names[i] for i in flat[0]], [self.b_names[i] for i in flat[1]], to_a, to_b)
        last_a, last_b = (np.array(side, np.int64)[np.array(to, np.int64) - 1] for side, to in zip(flat, (to_a, to_b), strict=True))
        links = (last_a * len(self.b_bytes) + last_b).astype(self.pair_type).tobytes()
        found, size = [], self.pair_type.itemsize
        i = at_a = at_b = 0
        for j, end_a, end_b in zip(np.searchsorted(to_a, last[0], side="right").tolist(), last[0].tolist(), last[1].tolist(), strict=True):
            found.append(Aligned(end_a - at_a, end_b - at_b, j - i, ";".join(groups[i:j]), links[i * size : j * size]))
            i, at_a, at_b = j, end_a, end_b
        return found

    def align_texts(self, texts: Sequence[str | None]) -> Iterator[Aligned]:
        """Word by word: a single space between two words is a border of tokens on both sides.

        No token of A or B reaches over it, so the groups of a text are those of its
        words, one after the other, and words are aligned once and remembered.
        """
        words = [(_BORDER.split(f" {text}") if self.by_words else [f" {text}"]) if text else [] for text in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = list({word for some in words for word in some if word not in self.known})
        if new:
            self.known.update(zip(new, self.align(new), strict=True))
        for text, some in zip(texts, words, strict=True):
            found = [self.known[word] for word in some]
            if None in found and len(found) > 1:  # only the whole text can tell
                found = self.align([f" {text}"])
            if not found or None in found:
                yield NOTHING
                continue
            n_a, n_b, n_groups, groups, links = zip(*found, strict=True)
            yield Aligned(sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), b"".join(links))
        for word in new:
            if len(word) > LONGEST_REMEMBERED:
                del self.known[word]


@lru_cache(1)
def _opened(paths: Paths) -> Tokenizers:
    return Tokenizers(paths)


def most_pairs(a_bytes: Sequence[bytes], b_bytes: Sequence[bytes]) -> int:
    """How many id pairs can ever be linked: those of which one's bytes end with the other's."""
    by_bytes: tuple[dict, dict] = ({}, {})
    for side, count in zip((a_bytes, b_bytes), by_bytes, strict=True):
        for token in side:
            count[token] = count.get(token, 0) + 1
    of_a, of_b = by_bytes
    b_in_a = sum(of_b.get(token[i:], 0) for token in a_bytes for i in range(len(token)))
    return b_in_a + sum(of_a.get(token[i:], 0) for token in b_bytes for i in range(1, len(token)))


def cuts(ends_a: Sequence[int], ends_b: Sequence[int]) -> tuple[list[int], list[int]]:
    """Where the groups end: indices behind the last token of each group, in A and in B."""
    at_a = dict(zip(ends_a, count(1)))
    at_b = dict(zip(ends_b, count(1)))
    common = sorted(at_a.keys() & at_b.keys())
    return list(map(at_a.__getitem__, common)), list(map(at_b.__getitem__, common))


def shown(names_a: Sequence[str], names_b: Sequence[str], to_a: Sequence[int], to_b: Sequence[int]) -> list[str]:
    """``a1,a2|b1`` for each group."""
    return [
        f"{names_a[i]}|{names_b[k]}" if j - i == m - k == 1 else f"{','.join(names_a[i:j])}|{','.join(names_b[k:m])}"
        for i, j, k, m in zip([0, *to_a], to_a, [0, *to_b], to_b, strict=False)
    ]


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups string, links binary"


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of about ``BLOCK_BYTES`` each, at least one text."""
    texts, size, first = [], 0, 0
    for row, value in enumerate(column):
        text = value.as_py()
        texts.append(text)
        size += len(text or "")
        if size >= BLOCK_BYTES:
            yield first, texts
            texts, size, first = [], 0, row + 1
    if texts:
        yield first, texts


def aligned(documents: DataFrame, paths: Paths | None = None, digests: bool = False) -> DataFrame:
    """Per document: n_a, n_b, n_groups, ``groups`` as text (its SHA-256 with ``digests``; '' without tokens), ``links``.

    ``links`` are the linked pairs in order, packed: id in A times the size of B, plus id in B.
    """
    paths = paths or default_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _opened(paths)
        for batch in batches:
            for first, texts in _texts(batch.column(1)):
                rows = []
                for found in both.align_texts(texts):
                    if digests and found.n_a:
                        found = found._replace(groups=hashlib.sha256(found.groups.encode()).hexdigest())
                    rows.append(found)
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(rows)), *[pa.array(c, pa.int64()) for c in columns[:3]],
                        pa.array(columns[3], pa.string()), pa.array(columns[4], pa.binary()),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups", "links"],
                )

    return map_batches(documents.select(F.col("doc_id").cast("long"), "text"), run, _ALIGNED)


def _pairs(links: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The pair numbers of all rows, one after the other, and where each row starts."""
    raw = links.to_pylist()
    at = np.concatenate([[0], np.cumsum([len(r) // kind.itemsize for r in raw], dtype=np.int64)])
    return np.frombuffer(b"".join(raw), kind), at


def pair_counts(found: DataFrame, paths: Paths | None = None) -> DataFrame:
    """(pair, a, b, n, best): how many links hold each id pair, and whether no pair of its B id has more."""
    paths = paths or default_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _opened(paths)
        for batch in batches:
            pair, n = np.unique(_pairs(batch.column(0), both.pair_type)[0], return_counts=True)
            pair = pair.astype(np.int64)
            a, b = np.divmod(pair, len(both.b_bytes))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (pair, a, b, n)], names=["pair", "a", "b", "n"])

    counted = map_batches(found.select("links"), run, "pair long, a long, b long, n long").groupBy("pair", "a", "b").agg(F.sum("n").alias("n"))
    counts = kept(counted, "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment(documents: DataFrame, paths: Paths | None = None) -> DataFrame:
    """One row per document: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    paths = paths or default_paths()
    found = kept(aligned(documents, paths, digests=True), "aligned", compression="zstd")
    # At most ``most_pairs`` rows, whatever the corpus: 324,300 for the default vocabularies.
    counts = pair_counts(found, paths).select("pair", "n", "best").toArrow().sort_by("pair")
    of_pair = tuple(counts.column(name).to_numpy() for name in ("pair", "n", "best"))
    sent = documents.sparkSession.sparkContext.broadcast(of_pair)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _opened(paths).pair_type
        pair, n, best = sent.value
        for batch in batches:
            mine, at = _pairs(batch.column(5), kind)
            place = np.searchsorted(pair, mine.astype(np.int64))
            sums = [np.diff(np.concatenate([[0], np.cumsum(part[place], dtype=np.int64)])[at]) for part in (best, n)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(np.diff(at)), *[pa.array(s) for s in sums], batch.column(4)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return map_batches(found, run, schema)
