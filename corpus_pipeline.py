"""A corpus run: reject poor documents, drop copies and near copies, drop leaks of the benchmark, encode.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage
before it kept.  All but the last return the columns of ``documents``; each result
is written as Parquet and read again for the next stage, and with the call of the next stage the
intermediate tables of a stage are removed.  So write a stage's result before calling another.

Null texts are empty documents; null and repeated ids, repeated rows and further columns
are carried through (see the operators), a very long text is worked on whole.  An empty table stays empty.
Labels that teach nothing reject nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from quittance.llm import bpe, decontaminate, exact_dedup, near_dedup, quality
from quittance.llm.tables import kept, load, noted, remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_finished: list[str] = []  # tables of the last stage


def stage(fn: Stage) -> Stage:
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove(spark, _finished)
        with noted() as tables:
            try:
                return fn(spark, docs, sf_dir)
            finally:
                _finished.extend(tables)

    return run_stage


@stage
def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (operator 7), fitted on the labelled documents; those that it rejects go."""
    return quality.without_rejected(docs, load(spark, sf_dir, "labels"))


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup (operator 6): of equal texts the longest one stays."""
    return exact_dedup.without_copies(docs)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """ProbMinHash near-dedup (operator 9): of each group the document with the smallest id stays."""
    return near_dedup.without_near_copies(docs)


@stage
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (operator 5): documents with a passage of a test item go."""
    return decontaminate.without_contaminated(docs, load(spark, sf_dir, "benchmark"))


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE (operator 1): token count and digests of the tokens and of the text decoded from them."""
    return bpe.round_trip_digests(docs, bpe.default_ranks())


STAGES = [
    ("quality", reject_poor),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

# Models, signatures and merges are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; of the stages' results, the last one stays."""
    docs, before = load(spark, sf_dir, "documents"), []
    for name, function in STAGES:
        found = function(spark, docs, sf_dir)
        with noted() as result:
            docs = kept(found, f"pipeline-{name.replace(' ', '-')}")
        remove(spark, before)
        before = result
    remove(spark, _finished)
    return docs
