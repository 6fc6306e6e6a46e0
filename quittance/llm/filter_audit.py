"""Audit of how filters interact, by truth-table survival words.

Every document becomes a 32-bit word: bit S says that it passes all filters of the
subset S of five.  Positional popcounts of the words, per part and label, give the
survivors of every subset; all 120 orders of the filters, and the Shapley value of
each, are differences of those 32 numbers.  The popcounts are carry-save: three words
of one weight become one of that weight and one of twice the weight, so that most bits
are never looked at one by one.

Filters (null texts are empty): A under 50 words; B distinct words under 65 in 100;
C more than 5 in 100 code points are A-Z; D a character of ``#$%&*|``; E the text of a
smaller id anywhere in the table.  Words are maximal runs without ASCII blanks.

A null source is the part ``''``; so is an empty one.  A null id is neither smaller nor
greater than another, so a row with it never fails E, but it makes no other row fail
either, and it has no label.  Rows that repeat an id with its text do not fail E by one
another.  Each row counts as a document.  A document is good (toxic) if any label of
its id says so.  An empty table has no parts.  Only ``doc_id``, ``text`` and ``source``
are read, so further columns never clash.  A text has to fit one cell and is worked on
whole; its words are held once while they are counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quittance.llm.tables import kept, map_batches

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
ALL = SUBSETS - 1
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
_WORD = r"[^\x20\x09-\x0D]+"
_COUNTS = [f"c{subset}" for subset in range(SUBSETS)]


def survival_words() -> np.ndarray:
    """By the set of filters that a document fails: the word with a bit for each subset that it survives."""
    failed, subset = np.arange(SUBSETS)[:, None], np.arange(SUBSETS)[None, :]
    return ((failed & subset == 0).astype(np.uint64) << subset.astype(np.uint64)).sum(1).astype(np.uint32)


def positional_popcounts(words: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """groups x 32: how many words of each group have each bit, by carry-save addition.

    ``group`` is in order.  In each step the words of a weight are taken in threes
    within their group, for all groups at once.
    """
    counts = np.zeros((groups, 32), np.int64)
    bits = np.arange(32, dtype=np.uint32)
    weight = 1
    while len(words):
        carried, carried_of = [], []
        while True:
            size = np.bincount(group, minlength=groups)
            threes = size // 3
            if not threes.any():
                break
            start = np.cumsum(size) - size
            of = np.repeat(np.arange(groups), threes)
            first = start[of] + 3 * (np.arange(len(of)) - np.repeat(np.cumsum(threes) - threes, threes))
            a, b, c = words[first], words[first + 1], words[first + 2]
            half = a ^ b
            carried.append(a & b | half & c)
            carried_of.append(of)
            left = np.arange(len(words)) - start[group] >= 3 * threes[group]
            words, group = np.concatenate([half ^ c, words[left]]), np.concatenate([of, group[left]])
            order = np.argsort(group, kind="stable")
            words, group = words[order], group[order]
        np.add.at(counts, group, ((words[:, None] >> bits & 1) * weight).astype(np.int64))
        if not carried:
            break
        words, group = np.concatenate(carried), np.concatenate(carried_of)
        order = np.argsort(group, kind="stable")
        words, group = words[order], group[order]
        weight *= 2
    return counts


def own_failures(text: Column) -> Column:
    """The filters A to D that a text fails, as bits 0 to 3."""
    found = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    tests = F.transform(
        F.array(found),
        lambda words: F.when(F.size(words) < MIN_WORDS, 1).otherwise(0)
        + F.when(100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words), 2).otherwise(0),
    )[0]
    return tests + F.when(100 * upper > MAX_UPPER_PERCENT * F.length(text), 4).otherwise(0) + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)


def _repeats(keys: DataFrame) -> DataFrame:
    """The keys with ``first_id``, the smallest id of their text.

    Each input part finds the smallest id of its texts, and parts compare those.  A part
    then tells its own rows, so a text that a third of all rows share meets in no task.
    """
    own = keys.groupBy("run", "digest").agg(F.min("doc_id").alias("first_id"))
    shared = own.groupBy("digest").agg(F.min("first_id").alias("first_id"))
    by_part = own.select("run", "digest").join(shared, "digest")
    return keys.join(by_part, ["run", "digest"])


def failures(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: part, doc_id, good, toxic, failed (bits of the filters that it fails)."""
    text = F.coalesce("text", F.lit(""))
    keys = kept(
        documents.select(
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("doc_id").cast("long"),
            F.sha2(text.cast("binary"), 256).alias("digest"), own_failures(text).cast("byte").alias("own"), F.spark_partition_id().alias("run"),
        ),
        "audit-keys",
    )
    failed = F.col("own") + F.when(F.col("first_id") < F.col("doc_id"), 16).otherwise(0)
    marked = _repeats(keys).select("part", "doc_id", failed.cast("int").alias("failed"))
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    joined = marked.join(said, "doc_id", "left")
    return joined.select("part", "doc_id", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")], "failed")


def survivors(failed: DataFrame) -> DataFrame:
    """Per part, good and toxic: c0 to c31, the documents that survive each subset of the filters."""
    schema = ", ".join(["part string, good boolean, toxic boolean", *[f"{c} long" for c in _COUNTS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = survival_words()
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            good, toxic, bits = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
            key = names.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 4 + good * 2 + toxic
            groups, group = np.unique(key, return_inverse=True)
            order = np.argsort(group, kind="stable")
            counts = positional_popcounts(table[bits[order]], group[order], len(groups))
            yield pa.RecordBatch.from_arrays(
                [names.dictionary.take(pa.array(groups // 4)), pa.array(groups // 2 % 2 == 1), pa.array(groups % 2 == 1), *[pa.array(c) for c in counts.T]],
                names=["part", "good", "toxic", *_COUNTS],
            )

    counted = map_batches(failed.select("part", "good", "toxic", "failed"), run, schema)
    return counted.groupBy("part", "good", "toxic").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def _at(counts: Column, subset: Column) -> Column:
    return F.element_at(counts, subset + 1)


def _shapley(counts: Column, bit: int) -> Column:
    """Sum over all orders: a subset comes just before the filter in |S|! (4 - |S|)! of them."""
    ways = (24, 6, 4, 6, 24)
    terms = [
        ways[subset.bit_count()] * (counts[subset] - counts[subset | bit]) for subset in range(SUBSETS) if not subset & bit
    ]
    return sum(terms[1:], terms[0])


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: the effect of the step's filter, from the survivors of all subsets.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (fail it, removed earlier),
    ``unique_fails`` (fail it alone), ``good_lost`` and ``toxic_lost`` (removed ones by label),
    ``shapley`` (removed by the filter in all 120 orders together).
    """
    of = survivors(failures(documents, labels))
    sums = {
        "total": lambda c: F.sum(c), "good": lambda c: F.sum(F.when(F.col("good"), F.col(c)).otherwise(0)),
        "toxic": lambda c: F.sum(F.when(F.col("toxic"), F.col(c)).otherwise(0)),
    }
    parts = of.groupBy("part").agg(*[F.array(*[total(c) for c in _COUNTS]).alias(f"n_{name}") for name, total in sums.items()])
    total = F.col("n_total")
    parts = parts.withColumn("values", F.array(*[_shapley(total, 1 << i) for i in range(len(FILTERS))]))
    orders = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = F.expr("ascii(substring(filter_order, step, 1)) - 65")
    before = F.expr("aggregate(filter(sequence(1, 5), i -> i < step), 0, (m, i) -> m | shiftleft(1, ascii(substring(filter_order, i, 1)) - 65))")
    steps = steps.select("*", place.alias("place"), before.alias("before")).withColumn("bit", F.expr("shiftleft(1, place)"))
    after = F.col("before").bitwiseOR(F.col("bit"))
    lost = {name: _at(F.col(f"n_{name}"), F.col("before")) - _at(F.col(f"n_{name}"), after) for name in sums}
    fails = _at(total, F.lit(0)) - _at(total, F.col("bit"))
    return steps.select(
        "part", "filter_order", "step", _at(total, after).alias("kept"), lost["total"].alias("removed"),
        (fails - lost["total"]).alias("redundant"), (_at(total, F.lit(ALL).bitwiseXOR(F.col("bit"))) - _at(total, F.lit(ALL))).alias("unique_fails"),
        lost["good"].alias("good_lost"), lost["toxic"].alias("toxic_lost"), _at(F.col("values"), F.col("place")).alias("shapley"),
    )
