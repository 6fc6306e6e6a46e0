"""Reading the given tables and keeping intermediate ones in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from quittance.session import new_folder

BATCH_BYTES = "4m"
_notes: list[list[str]] = []  # where ``noted`` writes down the tables that are made


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: later steps neither repeat nor vary it.

    The files outlive a lost executor.  They stay until the owner of
    ``spark.checkpoint.dir`` clears it.
    """
    path = new_folder(frame.sparkSession, name)
    for note in _notes:
        note.append(path)
    frame.write.parquet(path, **options)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of the tables that ``kept`` makes meanwhile."""
    note: list[str] = []
    _notes.append(note)
    try:
        yield note
    finally:
        _notes[:] = [other for other in _notes if other is not note]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing reads any more, and forget them."""
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(configuration).delete(path, True)


def content_keys() -> tuple[Column, Column]:
    """Two hashes that find a row's id and text again in a later pass."""
    return F.xxhash64("doc_id", "text").alias("key_1"), F.xxhash64("text", F.lit(1), "doc_id").alias("key_2")


def without_rows(documents: DataFrame, decided: DataFrame) -> DataFrame:
    """The documents that stay, with all columns; ``decided`` has the content keys of every row, and whether it is ``kept``.

    What is looked up are the dropped rows, by their keys, so that texts stay where they
    are as long as few enough go.  Rows with one id and text share their keys: where one of them stays and
    others go, one is chosen.
    """
    key_1, key_2 = free_name(documents, "key_1"), free_name(documents, "key_2")
    per_key = decided.groupBy("key_1", "key_2").agg(F.max("kept").alias("stays"), F.min("kept").alias("all_stay"))
    some_go = kept(per_key.filter("NOT all_stay").select(F.col("key_1").alias(key_1), F.col("key_2").alias(key_2), "stays"), "dropped")
    keyed = documents.select("*", *[key.alias(name) for key, name in zip(content_keys(), (key_1, key_2), strict=True)])
    rest = keyed.join(some_go.drop("stays"), [key_1, key_2], "left_anti")
    repeated = keyed.join(some_go.filter("stays").drop("stays"), [key_1, key_2], "left_semi").dropDuplicates([key_1, key_2])
    return rest.union(repeated).select(*documents.columns)


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, made longer until no column of the frame has it (Spark ignores case)."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(frame: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with batches bounded by their size, not only by their rows.

    Ten thousand long texts in one batch would cost an executor more memory than the
    work on them.  The setting is read when the plan runs, so it stays in the session.
    """
    frame.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return frame.mapInArrow(run, schema)
