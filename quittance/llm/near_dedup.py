"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is its set of five-word shingles (A-Z lower-cased; words are runs of
letters, digits and bytes above ASCII).  It has two signatures: in one every shingle
weighs 1, in the other 1 + log2 of its count.  ProbMinHash: a shingle arrives at the signature's registers as a Poisson process with
its weight as the rate, at every register once and in an order of its own; a register
keeps the shingle that arrives first.  A shingle stops as soon as its next arrival is
later than all registers of the document.  Two documents agree in a register with
the probability Jaccard similarity of their weighted shingles, which at equal weights
is the plain Jaccard similarity that decides about links: however differently two
documents repeat what they share, the first signature finds them.

Documents with equal shingle sets are one text from here on.  Signatures are cut into
bands; texts that agree in a band of either signature share a bucket.  A text has the
bands of all its documents, also where their counts differ.  The shingle sets decide: a plain
Jaccard similarity of at least ``SIMILARITY`` is a link (shingles by 32 bits of their
hash).  Linked texts become one class.  First come a few rounds in which one text of
each bucket is the pivot and every text of another class is compared with it, so that
large families become few classes without all their pairs.  The first pivot is the
text that shares the most buckets with others, as the text that a family was copied
from does; later ones are drawn by hash.  Then the texts of every bucket that still has
several classes besides its pivots are searched in full, by an exact filter: shingles are put in an
order, rare ones first, and two texts at 0.8 share one of the first fifth of either.  Texts with
such a shingle in common are compared pair by pair; where many share it, block by block within tasks,
from which only links leave.

A class is a component of links.  Documents without words are in no group; those with
fewer than five words have one shingle of all of them.  Null texts have no words.
Repeated rows are members like all others.  Null ids come last in the order of ids.  Of a very
long text the whole set of shingles is compared, in one cell of four bytes each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quittance.llm.batches import Texts, blocks, mix, run_hashes, word_hashes, words
from quittance.llm.graph import components
from quittance.llm.tables import content_keys, kept, map_batches, without_rows

SHINGLE_WORDS = 5
SIMILARITY = 0.8
REGISTERS = 128
BAND_ROWS = 4
PIVOT_ROUNDS = 3
BLOCK_BYTES = 2 << 20  # of shingle sets in one block of a bucket
BLOCK_TEXTS = 1000
PAIRED_TEXTS = 64  # that share a rare shingle; more are compared block by block within tasks
SLOTS = 1 << 20
_ROWS = 512
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, count) of the distinct shingles, by row and hash."""
    data = _LOWER[texts.data]
    found = words(Texts(data, texts.at, texts.first), _INSIDE)
    hashes = word_hashes(data, found)
    n = np.diff(found.at)
    runs = run_hashes(hashes, SHINGLE_WORDS)
    whole = found.row[SHINGLE_WORDS - 1 :] == found.row[: len(found.row) - SHINGLE_WORDS + 1] if len(runs) else np.zeros(0, bool)
    row, value = [found.row[: len(runs)][whole]], [runs[whole]]
    for short in np.flatnonzero((n > 0) & (n < SHINGLE_WORDS)).tolist():
        part = hashes[found.at[short] : found.at[short + 1]]
        row.append(np.array([short]))
        value.append(run_hashes(part, len(part)) ^ np.uint64(len(part)))
    rows, values = np.concatenate(row), np.concatenate(value)
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return rows[at], values[at], np.diff(np.append(at, len(rows)))


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int, registers: int = REGISTERS) -> np.ndarray:
    """rows x registers: the first shingle to arrive at each register (0 for rows without shingles).

    The number of registers is a power of two.
    """
    first = np.full(rows * registers, np.inf)
    owner = np.zeros(rows * registers, np.uint64)
    latest = np.full(rows, np.inf)
    last = np.uint64(registers - 1)
    # The order in which a shingle visits the registers: a permutation drawn by its hash.
    draw = mix(shingle ^ np.uint64(0xA0761D6478BD642F))
    odd_1, add_1 = draw | np.uint64(1), draw >> np.uint64(8)
    flip, odd_2, add_2 = draw >> np.uint64(16), draw >> np.uint64(24) | np.uint64(1), draw >> np.uint64(32)
    time = np.zeros(len(row))
    active = np.arange(len(row))
    for visit in range(registers):
        k = np.uint64(visit)
        s = shingle[active]
        uniform = ((mix(s + np.uint64((visit + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / (weight[active] * (registers - visit))
        soon = time < latest[row[active]]
        active, time = active[soon], time[soon]
        if not len(active):
            break
        place = ((odd_1[active] * k + add_1[active]) & last) ^ (flip[active] & last)
        place = (place * odd_2[active] + add_2[active]) & last
        flat = row[active] * registers + place.astype(np.int64)
        np.minimum.at(first, flat, time)
        won = first[flat] == time
        owner[flat[won]] = shingle[active[won]]
        latest = first.reshape(rows, registers).max(1)
    return owner.reshape(rows, registers)


def bands(signature: np.ndarray, band_rows: int = BAND_ROWS) -> np.ndarray:
    """rows x bands: one hash per band, which also tells the bands apart."""
    n = signature.shape[1] // band_rows
    out = np.tile(mix(np.arange(1, n + 1, dtype=np.uint64)), (len(signature), 1))
    for i in range(band_rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + signature[:, i::band_rows][:, :n])
    return out.view(np.int64)


def _blocks(column) -> Iterator[Texts]:
    for start in range(0, len(column), _ROWS):
        for block in blocks(column.slice(start, _ROWS)):
            yield block._replace(first=block.first + start)


def _signed(documents: DataFrame) -> DataFrame:
    """Per row: number, id, content keys, digest of the shingle set (null without words), size, bands at equal weights, further bands by counts."""
    frame = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), *content_keys(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch.column(4)):
                rows = len(block.at) - 1
                row, shingle, count = shingles(block)
                at = np.searchsorted(row, np.arange(rows + 1))
                made = bands(signatures(row, shingle, np.ones(len(row)), rows))
                # Without repeats both signatures are the same.
                repeats = np.zeros(rows, bool)
                repeats[row[count > 1]] = True
                place = np.cumsum(repeats) - 1
                own = repeats[row]
                more = bands(signatures(place[row[own]], shingle[own], 1 + np.log2(count[own]), int(repeats.sum())))
                differs = more != made[repeats]
                further_at = np.zeros(rows + 1, np.int64)
                further_at[1:][repeats] = differs.sum(1)
                further = pa.ListArray.from_arrays(pa.array(np.cumsum(further_at), pa.int32()), pa.array(more[differs], pa.int64()))
                digest = [
                    hashlib.blake2b(shingle[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(at, at[1:], strict=False)
                ]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, made.size + 1, made.shape[1]), pa.int32()), pa.array(made.reshape(-1), pa.int64())
                )
                part = batch.slice(block.first, rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], pa.array(digest, pa.binary()), pa.array(np.diff(at), pa.int32()), lists, further],
                    names=["row", "doc_id", "key_1", "key_2", "digest", "n", "bands", "further"],
                )

    return map_batches(frame, run, "row long, doc_id long, key_1 long, key_2 long, digest binary, n int, bands array<long>, further array<long>")


def _shingle_sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(text, n, shingles) of the wanted texts (text, key_1, key_2); shingles: sorted 32-bit numbers as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch.column(1)):
                row, shingle, _ = shingles(block)
                at = np.searchsorted(row, np.arange(len(block.at)))
                short = (shingle >> np.uint64(32)).astype(np.uint32)  # still in order within a row
                sets = [short[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]
                part = batch.slice(block.first, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(at), pa.int32()), pa.array(sets, pa.binary())], names=["text", "n", "shingles"]
                )

    texts = documents.select(*content_keys(), F.col("text").alias("words"))
    found = texts.join(wanted, ["key_1", "key_2"]).select("text", "words")
    # Repeated rows share id and text: one of them is enough.
    return map_batches(found, run, "text long, n int, shingles binary").dropDuplicates(["text"])


def jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared) if len(both) else 0.0


def _links(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            good = [jaccard(x, y) >= similarity for x, y in zip(left, right, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    size_a = sets.select(F.col("text").alias("a"), F.col("n").alias("n_a"))
    size_b = sets.select(F.col("text").alias("b"), F.col("n").alias("n_b"))
    # Sets whose sizes differ by more than the threshold cannot be similar enough.
    fits = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * similarity - 1e-6
    near = pairs.join(size_a, "a").join(size_b, "b").filter(fits).select("a", "b")
    left = sets.select(F.col("text").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("text").alias("b"), F.col("shingles").alias("set_b"))
    joined = near.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b")
    return map_batches(joined, run, "a long, b long")


def _linked_within(sets: list[bytes], roots: np.ndarray, left: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """All links (i, j) of two classes; with both sides in ``left`` only those across, else those within.

    Each set is compared with all later ones at once: an index lists the sets of each shingle.
    """
    size = np.array([len(s) // 4 for s in sets])
    values, number = np.unique(np.frombuffer(b"".join(sets), np.uint32), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(number, kind="stable")
    owners = owner[order]
    at = np.searchsorted(number[order], np.arange(len(values) + 1))
    starts = np.concatenate([[0], np.cumsum(size)])
    across = left.any() and not left.all()
    # The largest class need not look for the others: they find it.
    names, members = np.unique(roots, return_counts=True)
    largest = names[members.argmax()]
    for i in np.flatnonzero(roots != largest).tolist():
        mine = number[starts[i] : starts[i + 1]]
        first, n = at[mine], at[mine + 1] - at[mine]
        places = np.arange(n.sum()) + np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        shared = np.bincount(owners[places], minlength=len(sets))
        good = (shared / (size + size[i] - shared) >= similarity) & (roots != roots[i])
        if across:
            good &= left != left[i]
        for j in np.flatnonzero(good).tolist():
            if roots[j] == largest or i < j:
                yield i, j


def _slot_counts(sets: DataFrame) -> np.ndarray:
    """How many shingles of all sets fall into each of ``SLOTS`` slots; a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            counts += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint32) % SLOTS, minlength=SLOTS)
        slot = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(counts[slot])], names=["slot", "n"])

    found = map_batches(sets.select("shingles"), run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return counts


def rarest(shingles: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles of a set in an order of all shingles, rare ones first: two sets that are similar enough share one.

    They share at least ``similarity`` of either set, so not all of these can be missing from the other.
    """
    n = len(shingles) - int(np.ceil(similarity * len(shingles) - 1e-9)) + 1
    return shingles[np.lexsort((shingles, counts[shingles % SLOTS]))[:n]]


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(shingle, text, root, n): the rarest shingles of every set."""
    shared = sets.sparkSession.sparkContext.broadcast(_slot_counts(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [rarest(np.frombuffer(s, np.uint32), shared.value, similarity) for s in batch.column(3).to_pylist()]
            row = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            shingle = np.concatenate([*found, np.zeros(0, np.uint32)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shingle), *[batch.column(k).take(row) for k in range(3)]], names=["shingle", "text", "root", "n"])

    return map_batches(sets.select("text", "root", "n", "shingles"), run, "shingle long, text long, root long, n int")


def _rest_of_buckets(members: DataFrame, pivots: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """All links (a, b) between two classes in a bucket, besides those of its pivots; and others that come along.

    An exact search among the texts that are left: two of them that are similar enough share
    one of their rarest shingles. What copies of a template have to themselves is rare, so that those
    which are not similar enough hardly meet.
    """
    now = members.join(roots.select(F.col("node").alias("text"), "root"), "text").join(pivots, "bucket").filter(~F.array_contains("pivots", F.col("text")))
    mixed = now.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    left = now.join(mixed.select("bucket"), "bucket").select("text", "root").distinct()
    rest = kept(left.join(sets, "text").select("text", "root", "n", "shingles"), "rest-sets")
    prefixes = kept(_prefixes(rest, similarity), "rest-prefixes")
    groups = prefixes.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"), F.min("root").alias("low"), F.max("root").alias("high")
    ).filter("low <> high")
    shared = kept(prefixes.join(groups.select("shingle", "size", "shingles"), "shingle"), "rest-shared")
    few = shared.filter(F.col("size") <= PAIRED_TEXTS)
    one, other = (few.select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("text", "root", "n")]) for side in "ab")
    fits = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * similarity - 1e-6
    near = one.join(other, "shingle").filter((F.col("text_a") < F.col("text_b")) & (F.col("root_a") != F.col("root_b")) & fits)
    pairs = kept(near.select(F.col("text_a").alias("a"), F.col("text_b").alias("b")).distinct(), "rest-pairs")
    links = _links(pairs, rest, similarity)
    blocks_of = F.greatest(F.ceil(F.col("shingles") * 4 / BLOCK_BYTES), F.ceil(F.col("size") / BLOCK_TEXTS)).cast("int")
    many = shared.filter(F.col("size") > PAIRED_TEXTS).select(F.col("shingle").alias("bucket"), "text", "root", blocks_of.alias("blocks"))
    return links.union(_links_within_groups(many, rest, similarity)).distinct()


def _links_within_groups(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """All links (a, b) of two classes in groups (bucket, text, root, blocks) of many texts, block by block."""
    block = F.pmod(F.xxhash64("text", F.lit(1000)), "blocks").cast("int")
    dealt = members.select("bucket", "text", "root", block.alias("block"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    dealt = dealt.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "text", "root", (F.col("block") <= F.col("other")).alias("left"))
    filled = dealt.join(sets.select("text", "shingles"), "text")
    tasks = filled.groupBy("bucket", "i", "j").agg(F.collect_list(F.struct("text", "root", "left", "shingles")).alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for row in range(batch.num_rows):
                texts = batch.column(0)[row].values
                text, root, left = (texts.field(k).to_numpy(zero_copy_only=False) for k in ("text", "root", "left"))
                linked = _linked_within(texts.field("shingles").to_pylist(), root, left, similarity)
                found.update((int(min(text[i], text[j])), int(max(text[i], text[j]))) for i, j in linked)
            yield pa.RecordBatch.from_arrays([pa.array([pair[k] for pair in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return map_batches(tasks.select("texts"), run, "a long, b long")


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots after the classes of linked texts have become one; only classes with a link take part in the search."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    between = links.join(a, "a").join(b, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct()
    changed = components(between).select(F.col("node").alias("root"), F.col("root").alias("to"))
    return roots.join(changed, "root", "left").select("node", F.coalesce("to", "root").alias("root"))


def classes(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: row, doc_id, content keys, class (a number; null without words), from which ``groups`` makes ids."""
    signed = kept(_signed(documents), "signatures")
    texts = kept(
        signed.filter("digest IS NOT NULL").groupBy("digest").agg(F.min(F.struct("row", "key_1", "key_2", "bands")).alias("best"))
        .select("digest", F.col("best.row").alias("text"), "best.key_1", "best.key_2", "best.bands"),
        "texts",
    )
    # Documents of one text share its bands at equal weights; by counts each may have others.
    further = signed.filter("digest IS NOT NULL").select("digest", F.explode("further").alias("bucket")).distinct()
    members = texts.select("text", F.explode("bands").alias("bucket")).union(further.join(texts.select("digest", "text"), "digest").select("text", "bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = kept(members.join(shared, "bucket"), "shared-buckets")
    wanted = texts.join(members.groupBy("text").agg(F.sum("size").alias("near")), "text").select("text", "key_1", "key_2", "near")
    members = kept(members.drop("size").join(wanted.select("text", "near"), "text"), "members")
    sets = kept(_shingle_sets(documents, wanted.drop("near")), "shingles")
    roots = sets.select(F.col("text").alias("node"), F.col("text").alias("root"))
    orders = [-F.col("near"), *[F.xxhash64("text", F.lit(i)) for i in range(1, PIVOT_ROUNDS)]]
    firsts = [F.min(F.struct(order.alias("order"), "text"))["text"] for order in orders]
    pivots = kept(members.groupBy("bucket").agg(F.array(*firsts).alias("pivots")), "pivots")
    tried = None
    for number in range(PIVOT_ROUNDS):
        now = members.select("bucket", "text").join(roots.select(F.col("node").alias("text"), "root"), "text")
        pivot = pivots.select("bucket", F.col("pivots")[number].alias("b")).join(roots.select(F.col("node").alias("b"), F.col("root").alias("root_b")), "b")
        pairs = now.join(pivot, "bucket").filter("root <> root_b").select(F.least("text", "b").alias("a"), F.greatest("text", "b").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = kept(pairs, "pairs")
        found = kept(_links(pairs, sets, similarity), "pairs-linked")
        tried = pairs if tried is None else tried.union(pairs)
        if not found.isEmpty():
            roots = kept(_merged(roots, found), "classes")
    found = kept(_rest_of_buckets(members, pivots, roots, sets, similarity), "rest-linked")
    if not found.isEmpty():
        roots = kept(_merged(roots, found), "classes")
    by_digest = texts.join(roots.select(F.col("node").alias("text"), "root"), "text", "left").select(
        "digest", F.coalesce("root", "text").alias("class")
    )
    rows = signed.select("row", "doc_id", "key_1", "key_2", "digest")
    without = rows.filter("digest IS NULL").withColumn("class", F.lit(None).cast("long"))
    return rows.filter("digest IS NOT NULL").join(by_digest, "digest").select(*rows.columns, "class").union(without).drop("digest")


def groups(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: row, doc_id, content keys, class_id (its smallest doc_id), class_size, kept (one per class)."""
    found = kept(classes(documents, similarity), "document-classes")
    own = ["row", "doc_id", "key_1", "key_2"]
    alone = found.filter("class IS NULL").select(
        *own, F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept")
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    heads = kept(found.filter("class IS NOT NULL").groupBy("class").agg(first.alias("head"), F.count(F.lit(1)).alias("class_size")), "class-heads")
    grouped = found.filter("class IS NOT NULL").join(heads, "class").select(
        *own, F.col("head.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("head.row")).alias("kept")
    )
    return grouped.union(alone)


def without_near_copies(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each group (the smallest id), with all columns."""
    return without_rows(documents, groups(documents, similarity).select("key_1", "key_2", "kept"))
