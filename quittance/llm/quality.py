"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a row x is the logistic function of
    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j,
and the pairs cost linear time, since their sum is half of
    sum_f (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2.
x holds the document's word counts by hash (logarithm, length 1) and standardised
statistics of its structure: shares of kinds of characters, word lengths,
repetition, and size as metadata.  Labels, language, source and id are not inputs.

The model is fitted on a bounded sample (``rows`` of ``fit``); its size is fixed and
it is broadcast.  Scoring takes whole texts, row by row; a very long one is a block of its
own.  Null texts count as empty and get a score too.  Null ids are never learnt from; of rows
with one id one teaches, and ids with contradicting labels do not (see ``labelled``).  Repeated
rows are scored alike, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quittance.llm import labelled
from quittance.llm.batches import BLANK, Texts, blocks, run_hashes, word_hashes, words
from quittance.llm.tables import free_name, map_batches

WORD_DIMENSIONS = 1024
FACTORS = 6
THRESHOLD = 0.7
_BLOCK_ROWS = 256


def _kinds() -> np.ndarray:
    kind = np.zeros(256, np.int64)  # 0: bytes above ASCII
    for code in range(128):
        c = chr(code)
        kind[code] = (
            1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 4 if c == "\n" else 5 if BLANK[code]
            else 6 if c in ".,;:'\"-()?" else 7 if c in "!" else 8 if c in "|" else 9 if c in "$%&*#@" else 10
        )
    return kind


_KIND = _kinds()
_KINDS = 11
STATISTICS = _KINDS + 12


def _distinct(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Number of distinct keys per row."""
    if not len(keys):
        return np.zeros(rows)
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (r[1:] != r[:-1])
    return np.bincount(r[new], minlength=rows).astype(float)


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(rows x WORD_DIMENSIONS word part, rows x STATISTICS raw statistics)."""
    rows = len(texts.at) - 1
    size = np.diff(texts.at).astype(float)
    of_byte = np.repeat(np.arange(rows), np.diff(texts.at))
    kinds = np.bincount(of_byte * _KINDS + _KIND[texts.data], minlength=rows * _KINDS).reshape(rows, _KINDS).astype(float)
    found = words(texts, ~BLANK)
    n = np.diff(found.at).astype(float)
    hashes = word_hashes(texts.data, found)
    counts = np.bincount(found.row * WORD_DIMENSIONS + (hashes % np.uint64(WORD_DIMENSIONS)).astype(np.int64), minlength=rows * WORD_DIMENSIONS)
    part = np.log1p(counts.reshape(rows, WORD_DIMENSIONS))
    part /= np.maximum(np.sqrt((part**2).sum(1, keepdims=True)), 1e-9)
    length = (found.end - found.start).astype(float)
    per_row = lambda values: np.bincount(found.row, values, minlength=rows)
    mean = per_row(length) / np.maximum(n, 1)
    spread = np.sqrt(np.maximum(per_row(length**2) / np.maximum(n, 1) - mean**2, 0))
    first, last = texts.data[found.start], texts.data[found.end - 1]
    pairs = run_hashes(hashes, 2)
    same_row = found.row[1:] == found.row[:-1]
    fives = run_hashes(hashes, 5)
    within = found.row[4:] == found.row[:-4]
    columns = [
        np.log1p(size), np.log1p(n), mean, spread,
        per_row(_KIND[first] == 2) / np.maximum(n, 1), per_row((_KIND[last] == 6)) / np.maximum(n, 1),
        per_row(_KIND[last] == 9) / np.maximum(n, 1), per_row((_KIND[last] == 7)) / np.maximum(n, 1),
        per_row(length == 1) / np.maximum(n, 1), _distinct(hashes, found.row, rows) / np.maximum(n, 1),
        _distinct(pairs[same_row], found.row[:-1][same_row], rows) / np.maximum(n - 1, 1),
        _distinct(fives[within], found.row[4:][within], rows) / np.maximum(n - 4, 1),
    ]
    return part, np.column_stack([kinds / np.maximum(size, 1)[:, None], *columns])


class Model(NamedTuple):
    centre: np.ndarray
    scale: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    fitted: bool = True  # False: there was no row to learn from

    def inputs(self, part: np.ndarray, statistics: np.ndarray) -> np.ndarray:
        return np.hstack([part, np.clip((statistics - self.centre) / self.scale, -4, 4) / 4])

    def logits(self, x: np.ndarray) -> np.ndarray:
        pairs = ((x @ self.factors) ** 2 - x**2 @ self.factors**2).sum(1) / 2
        return self.bias + x @ self.weights + pairs

    def scores(self, texts: Texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(self.inputs(*features(texts))), -30, 30)))


def _blocks(column) -> Iterator[Texts]:
    for start in range(0, len(column), _BLOCK_ROWS):
        for block in blocks(column.slice(start, _BLOCK_ROWS)):
            yield block._replace(first=block.first + start)


def _train(part: np.ndarray, statistics: np.ndarray, label: np.ndarray, steps: int = 600, seed: int = 7) -> Model:
    """Mini-batch descent with running moments (Adam) on the regularised log-loss."""
    centre, scale = statistics.mean(0), np.maximum(statistics.std(0), 1e-6)
    rate = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    random = np.random.default_rng(seed)
    d = part.shape[1] + statistics.shape[1]
    model = Model(centre, scale, float(np.log(rate / (1 - rate))), np.zeros(d), random.normal(0, 0.05, (d, FACTORS)))
    x = model.inputs(part, statistics)
    state = [np.zeros(1), model.weights.copy(), model.factors.copy()]
    state[0][0] = model.bias
    first, second = [np.zeros_like(s) for s in state], [np.zeros_like(s) for s in state]
    decay = (0.0, 1e-4, 1e-3)
    for step in range(1, steps + 1):
        batch = random.integers(0, len(x), min(512, len(x)))
        xb = x[batch]
        model = model._replace(bias=state[0][0], weights=state[1], factors=state[2])
        error = (1 / (1 + np.exp(-np.clip(model.logits(xb), -30, 30))) - label[batch]) / len(batch)
        inner = xb @ state[2]
        gradient = [
            np.array([error.sum()]), xb.T @ error,
            xb.T @ (error[:, None] * inner) - ((xb**2).T @ error)[:, None] * state[2],
        ]
        rate_now = 0.05 * (1 - step / (steps + 1))
        for i in range(3):
            g = gradient[i] + decay[i] * state[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            state[i] = state[i] - rate_now * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return model._replace(bias=float(state[0][0]), weights=state[1], factors=state[2])


def fit(documents: DataFrame, labels: DataFrame, rows: int = labelled.SAMPLE_ROWS) -> Model:
    """Learn from at most ``rows`` labelled documents; features are made by Spark, the fixed-size model here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _blocks(batch.column(0)):
                part, statistics = features(block)
                label = batch.column(1).slice(block.first, len(part))
                dense = [row.astype(np.float32).tobytes() for row in np.hstack([part, statistics])]
                yield pa.RecordBatch.from_arrays([pa.array(dense, pa.binary()), label.cast(pa.int32())], names=["x", "label"])

    made = map_batches(labelled.sample(documents, labels, "quality", rows), run, "x binary, label int").toArrow()
    if not made.num_rows:
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS), 0.0, np.zeros(WORD_DIMENSIONS + STATISTICS), np.zeros((WORD_DIMENSIONS + STATISTICS, FACTORS)), fitted=False)
    x = np.frombuffer(b"".join(made.column("x").to_pylist()), np.float32).reshape(made.num_rows, -1).astype(float)
    return _train(x[:, :WORD_DIMENSIONS], x[:, WORD_DIMENSIONS:], made.column("label").to_numpy().astype(float))


def score(documents: DataFrame, model: Model, text: str = "text", score_as: str = "score") -> DataFrame:
    """Adds the score (0 to 1, higher: better) to all columns of the frame."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.scores(block) for block in _blocks(batch.column(place))]
            made = pa.array(np.concatenate(scores) if scores else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, score_as])

    return map_batches(documents, run, StructType([*documents.schema.fields, StructField(score_as, DoubleType())]))


def scores(documents: DataFrame, labels: DataFrame, rows: int = labelled.SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (without any usable labelled row every score is 0.5)."""
    found = score(documents.select("doc_id", "text"), fit(documents, labels, rows))
    return found.select(
        "doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_rejected(documents: DataFrame, labels: DataFrame, rows: int = labelled.SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of at least ``threshold``, with all their columns.

    Without any usable labelled row nothing is known of them, and all of them stay.
    """
    model = fit(documents, labels, rows)
    if not model.fitted:
        return documents
    name = free_name(documents, "score")
    found = score(documents, model, score_as=name)
    return found.filter(F.col(name) >= threshold).select(*documents.columns)
