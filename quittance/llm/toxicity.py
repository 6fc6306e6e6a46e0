"""Toxicity classifier with counterfactual regularisation.

A document is scored by a logistic model over the presence of words and of word
beginnings (four and five bytes), by hash, A-Z lower-cased.  Spark counts in how
many toxic and other documents of a bounded labelled sample each feature occurs; the
features that differ most between the two make up the model, at most
``MODEL_FEATURES``.

Counterfactuals: in every labelled sentence that names a group, each identity term
is swapped for another one of its kind.  Training penalises the squared change of a
document's score under the swap, so that naming a group by itself moves no score,
however often that group's mentions are toxic in the sample.

The word lists of ``IDENTITY_TERMS`` are a parameter.  Labels, language, source and
id are not inputs.  Null texts count as empty and get a score too.  Null ids are never
learnt from; of rows with one id one teaches, and ids with contradicting labels do not
(see ``labelled``).  Repeated rows are scored alike.  Labels of one class, or none, teach nothing: then every score
is close to 0 and no document counts as toxic.  An empty table gives no rows.  A very long
text is scored whole, a block of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quittance.llm import labelled
from quittance.llm.batches import Texts, Words, blocks, word_hashes, words
from quittance.llm.tables import free_name, kept, map_batches

THRESHOLD = 0.3
SAMPLE_ROWS = 8000
MODEL_FEATURES = 4096
LEAST_DOCUMENTS = 4
PENALTY = 4.0
L2 = 2e-4
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("old", "young", "disabled", "blind", "deaf"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
    ("christen", "muslime", "juden"), ("chrétiens", "musulmans", "juifs"), ("cristianos", "musulmanes", "judíos"),
)
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]?")
_WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each word and word beginning, repeats included."""
    data = _LOWER[texts.data]
    found = words(Texts(data, texts.at, texts.first), _INSIDE)
    size = found.end - found.start
    hashes, rows = [word_hashes(data, found)], [found.row]
    for tag, length in ((1, 4), (2, 5)):
        longer = size > length
        start = found.start[longer]
        begin = Words(start, start + length, found.row[longer], found.at)
        hashes.append(word_hashes(data, begin) ^ np.uint64(tag))
        rows.append(begin.row)
    return np.concatenate(hashes), np.concatenate(rows)


def distinct_features(text: str) -> np.ndarray:
    block = next(blocks(pa.array([text])))
    return np.unique(features(block)[0]).view(np.int64)


def counterfactual(text: str, groups: Sequence[Sequence[str]] = IDENTITY_TERMS) -> str:
    """The text with every identity term swapped for the next of its group, sentence by sentence."""
    swap = {term: group[(i + 1) % len(group)] for group in groups for i, term in enumerate(group)}
    return "".join(
        _WORD.sub(lambda m: swap.get(m[0].lower(), m[0]), sentence) for sentence in _SENTENCE.findall(text)
    )


class Model(NamedTuple):
    """Weights by sorted feature hash."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    maybe: np.ndarray  # by the first 20 bits of a hash: whether any feature of the model begins so

    def scores(self, texts: Texts) -> np.ndarray:
        rows = len(texts.at) - 1
        hashes, row = features(texts)
        some = self.maybe[(hashes >> np.uint64(44)).astype(np.int64)]
        hashes, row = hashes[some], row[some]
        at = np.searchsorted(self.hashes, hashes)
        same = self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes if len(self.hashes) else np.zeros(0, bool)
        pair = np.unique(row[same] * len(self.hashes) + at[same])
        width = max(len(self.hashes), 1)
        logits = self.bias + np.bincount(pair // width, self.weights[pair % width], minlength=rows)
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _model(hashes: np.ndarray, weights: np.ndarray, bias: float) -> Model:
    order = np.argsort(hashes)
    maybe = np.zeros(1 << 20, bool)
    maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True
    return Model(hashes[order], weights[order], float(bias), maybe)


class Sample(NamedTuple):
    """Labelled documents as (row, column) of the features they have, and what the swap takes (-1) and brings (+1)."""

    row: np.ndarray
    column: np.ndarray
    label: np.ndarray
    d_row: np.ndarray
    d_column: np.ndarray
    d_sign: np.ndarray
    changed: int  # documents that the swap changes

    @classmethod
    def of(cls, seen: list[np.ndarray], swapped: list[np.ndarray], label: np.ndarray) -> Sample:
        row = np.repeat(np.arange(len(seen)), [len(x) for x in seen])
        column = np.concatenate(seen) if seen else np.zeros(0, np.int64)
        changed = [i for i in range(len(seen)) if not np.array_equal(seen[i], swapped[i])]
        gone = [np.setdiff1d(seen[i], swapped[i]) for i in changed]
        come = [np.setdiff1d(swapped[i], seen[i]) for i in changed]
        d_row = np.repeat(np.arange(len(changed)), [len(a) + len(b) for a, b in zip(gone, come, strict=True)])
        d_column = np.concatenate([np.concatenate(p) for p in zip(gone, come, strict=True)]) if changed else np.zeros(0, np.int64)
        d_sign = np.concatenate([np.r_[-np.ones(len(a)), np.ones(len(b))] for a, b in zip(gone, come, strict=True)]) if changed else np.zeros(0)
        return cls(row, column, label, d_row, d_column.astype(np.int64), d_sign, len(changed))

    def gradient(self, w: np.ndarray, bias: float, penalty: float) -> np.ndarray:
        """Of the mean logistic loss + L2 / 2 + ``penalty`` * mean squared change of the logit under the swap; the bias last."""
        logit = bias + np.bincount(self.row, w[self.column], minlength=len(self.label))
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - self.label) / len(self.label)
        g = np.bincount(self.column, error[self.row], minlength=len(w)) + L2 * w
        if self.changed:
            change = np.bincount(self.d_row, self.d_sign * w[self.d_column], minlength=self.changed)
            g += penalty * np.bincount(self.d_column, 2 * change[self.d_row] * self.d_sign / self.changed, minlength=len(w))
        return np.append(g, error.sum())


def _train(sample: Sample, n: int, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights of ``n`` features and the bias, by steps along the gradient."""
    rate = np.clip(sample.label.mean(), 1e-3, 1 - 1e-3)
    w, bias = np.zeros(n), np.log(rate / (1 - rate))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):
        g = sample.gradient(w, bias, penalty)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def fit(
    documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, penalty: float = PENALTY,
    groups: Sequence[Sequence[str]] = IDENTITY_TERMS, model_features: int = MODEL_FEATURES,
) -> Model:
    """Learn from at most ``rows`` labelled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text or "" for text in batch.column(0).to_pylist()]
            seen = [distinct_features(text) for text in texts]
            swaps = [counterfactual(text, groups) for text in texts]
            swapped = [distinct_features(b) if a != b else x for a, b, x in zip(texts, swaps, seen, strict=True)]
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(seen, kind), pa.array(swapped, kind), batch.column(1).cast(pa.int32())], names=["seen", "swapped", "label"]
            )

    made = map_batches(labelled.sample(documents, labels, "toxic", rows), run, "seen array<long>, swapped array<long>, label int")
    made = kept(made, "toxic-sample")
    totals = made.agg(F.coalesce(F.sum("label"), F.lit(0)).alias("toxic"), F.count(F.lit(1)).alias("n")).first()
    toxic, others = int(totals.toxic), int(totals.n - totals.toxic)
    if not toxic or not others:
        return _model(np.zeros(0, np.uint64), np.zeros(0), -30.0)  # nothing to tell apart
    # Difference of the smoothed log rates, in units of its standard error.
    a, b = F.col("toxic") + 0.5, F.col("other") + 0.5
    gap = F.log(a / (toxic + 1)) - F.log(b / (others + 1))
    chosen = (
        made.select("label", F.explode("seen").alias("hash"))
        .groupBy("hash").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other"))
        .filter(F.col("toxic") + F.col("other") >= LEAST_DOCUMENTS)
        .withColumn("weight", gap / F.sqrt(1 / a + 1 / b)).filter(F.abs("weight") >= 3)
        .orderBy(F.abs("weight").desc(), "hash").limit(model_features)
    )
    hashes = np.array(sorted(row.hash for row in chosen.select("hash").collect()), np.int64)
    known = made.sparkSession.sparkContext.broadcast(hashes)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = []
            for name in ("seen", "swapped"):
                lists = [np.flatnonzero(np.isin(known.value, np.asarray(x, np.int64))) for x in batch.column(name).to_pylist()]
                columns.append(pa.array(lists, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([*columns, batch.column("label")], names=["seen", "swapped", "label"])

    data = map_batches(made, narrow, made.schema).toArrow()
    as_arrays = lambda name: [np.asarray(x, np.int64) for x in data.column(name).to_pylist()]
    sample = Sample.of(as_arrays("seen"), as_arrays("swapped"), data.column("label").to_numpy().astype(float))
    weights, bias = _train(sample, len(hashes), penalty)
    return _model(hashes.view(np.uint64), weights, bias)


def score(documents: DataFrame, model: Model, text: str = "text", score_as: str | None = None) -> DataFrame:
    """Adds the score (0 to 1, higher: more likely toxic) as the last column, ``score`` or a longer name that is free."""
    score_as = score_as or free_name(documents, "score")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.scores(block) for block in blocks(batch.column(place))]
            made = pa.array(np.concatenate(found) if found else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, score_as])

    return map_batches(documents, run, StructType([*documents.schema.fields, StructField(score_as, DoubleType())]))


def scores(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    found = score(documents.select("doc_id", "text"), fit(documents, labels, **options))
    return found.select(
        "doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents with a score below ``threshold``, with all their columns."""
    found = score(documents, fit(documents, labels, **options))
    return found.filter(F.col(found.columns[-1]) < threshold).select(*documents.columns)
