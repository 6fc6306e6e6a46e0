"""Operators on a manifest table (one row per file)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from quittance import fixed_values as fv
from quittance.functions.scalars import has_suffix, local_path, slashes


def filter_by_suffix(
    manifest: DataFrame, name: str = "file_name", suffix: str = fv.PDF_SUFFIX, case_sensitive: bool = False
) -> DataFrame:
    return manifest.filter(has_suffix(F.col(name), suffix, case_sensitive))


def category_from_path(manifest: DataFrame, root: str = "", path: str = "path") -> DataFrame:
    """Keep files that lie directly in a subfolder of ``root``; add its name as category.

    Loose files in the root and files in deeper folders are dropped. Without a
    root, paths count as relative to it.
    """
    full = F.col(path)
    if root:
        full = local_path(full)
        prefix = F.concat(local_path(F.lit(root.rstrip("/"))), F.lit("/"))
        manifest = manifest.filter(F.startswith(full, prefix))
        full = F.substr(full, F.length(prefix) + 1)
    return manifest.filter(slashes(full) == 1).withColumn("category", F.substring_index(full, "/", 1))


CHANGES = "path string, file_name string, length long, modified timestamp, state string"


def manifest_changes(known: DataFrame, listed: DataFrame) -> DataFrame:
    """One row per path of either manifest with its ``state``: new, changed (by size or time), unchanged, gone."""
    old = known.select(F.col("path").alias("_path"), F.col("file_name").alias("_name"), F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    same = F.col("length").eqNullSafe(F.col("_length")) & F.col("modified").eqNullSafe(F.col("_modified"))
    state = (
        F.when(F.col("_path").isNull(), "new").when(F.col("path").isNull(), "gone").when(same, "unchanged").otherwise("changed")
    )
    joined = listed.select("path", "file_name", "length", "modified").join(old, F.col("path") == F.col("_path"), "full")
    gone = F.col("path").isNull()
    return joined.select(
        F.coalesce("path", "_path").alias("path"), F.coalesce("file_name", "_name").alias("file_name"),
        F.when(gone, F.col("_length")).otherwise(F.col("length")).alias("length"),
        F.when(gone, F.col("_modified")).otherwise(F.col("modified")).alias("modified"), state.alias("state"),
    )


def known_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files as of the last version in ``folder``; none where it does not exist yet."""
    try:
        versions = spark.read.schema(f"{CHANGES}, version int").parquet(folder)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        versions = spark.createDataFrame([], f"{CHANGES}, version int")
    last = F.max(F.struct("version", "file_name", "length", "modified", "state"))
    return versions.groupBy("path").agg(last.alias("last")).select("path", "last.*").filter("state <> 'gone'").drop("version", "state")


def pending_files(changes: DataFrame) -> DataFrame:
    """The files to process: new and changed ones."""
    return changes.filter(F.col("state").isin("new", "changed"))


def commit_manifest(changes: DataFrame, folder: str) -> int | None:
    """Add the changes as the next version, once what depends on them is written; None if nothing changed.

    A version holds changes only, so that the folder grows with them. A run that fails
    before this call finds the same files pending again. One run at a time may commit.
    """
    spark = changes.sparkSession
    real = changes.filter("state <> 'unchanged'").select("path", "file_name", "length", "modified", "state")
    if real.isEmpty():
        return None
    try:
        last = spark.read.schema(f"{CHANGES}, version int").parquet(folder).agg(F.max("version")).first()[0] or 0
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        last = 0
    real.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/version={last + 1}")
    return last + 1
