"""Labelled samples for the classifiers: which rows may teach, and how many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SAMPLE_ROWS = 6000
TASKS = 48  # features of long texts take time: spread the sample


def held_out(doc_id: Column) -> Column:
    """True for the fold that is never learnt from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def sample(documents: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled documents (text, label) outside the held-out fold.

    The choice depends on a hash of the id alone.  Rows without a label or id, and
    ids with contradicting labels, do not teach; of documents with one id, one teaches.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    ids = (
        usable.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .filter("label = other").drop("other")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    chosen = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most ``rows`` ids
    one = chosen.repartition(TASKS, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return one.select("text", F.col("label").cast("int"))
