"""File listings and file contents through Spark's binary file source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from quittance import fixed_values as fv
from quittance.functions.scalars import basename, local_path, slashes
from quittance.session import new_folder


def _glob(suffixes: Sequence[str], case_sensitive: bool) -> str:
    def either_case(char: str) -> str:
        return f"[{char.lower()}{char.upper()}]" if char.isalpha() else char

    names = [s.lstrip(".") for s in suffixes]
    if not case_sensitive:
        names = ["".join(map(either_case, name)) for name in names]
    return "*." + (names[0] if len(names) == 1 else "{" + ",".join(names) + "}")


def _files(spark: SparkSession, root: str, pattern: str | None, recursive: bool, **options: str) -> DataFrame:
    """Files of an absolute path, which may hold wildcards.

    Spark lists subfolders in any case. Reading with recursive lookup keeps
    folder names of the form key=value from becoming columns; where subfolders
    are not wanted, their files are dropped by depth.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").options(**options)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(root)
    if recursive:
        return files
    depth = slashes(local_path(F.lit(root.rstrip("/")))) + 1
    return files.filter(slashes(local_path(F.col("path"))) == depth)


def _manifest(files: DataFrame) -> DataFrame:
    # "content" is not selected, so Spark lists the files without opening them.
    return files.select(
        "path", basename(F.col("path")).alias("file_name"), "length",
        F.col("modificationTime").alias("modified"),
    )


def scan_manifest(
    spark: SparkSession,
    root: str,
    suffixes: Sequence[str] = (fv.PDF_SUFFIX,),
    case_sensitive: bool = False,
    recursive: bool = False,
) -> DataFrame:
    """The files of a folder (or of ``root/*``) with one of the suffixes.

    Spark's file sources leave out names that start with ``_`` or ``.``.
    """
    return _manifest(_files(spark, root, _glob(suffixes, case_sensitive), recursive))


def scan_images(spark: SparkSession, root: str, recursive: bool = False) -> DataFrame:
    return scan_manifest(spark, root, fv.IMAGE_SUFFIXES, case_sensitive=True, recursive=recursive)


def read_bytes(spark: SparkSession, root: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """Path and content. Files that vanish or cannot be read are left out."""
    files = _files(spark, root, pattern, recursive, ignoreMissingFiles="true", ignoreCorruptFiles="true")
    return files.select("path", "length", "content")


def bytes_of_manifest(manifest: DataFrame, contents: DataFrame) -> DataFrame:
    """Exactly the listed files with their contents, NULL for a file that was not readable.

    For file systems that only Spark opens; ``listing.read_listed`` needs no copy.
    Contents are read once, into a table in the shared folder. From then on only
    paths are matched: which were read but are not listed (usually none), and which
    are listed but were not read.
    """
    spark = manifest.sparkSession

    def kept(frame: DataFrame, name: str) -> DataFrame:
        folder = new_folder(spark, name)
        frame.write.parquet(folder)
        return spark.read.schema(frame.schema).parquet(folder)

    read = kept(contents.filter(F.col("content").isNotNull()).select("path", "length", "content"), "contents")
    paths = manifest.select("path", "length").dropDuplicates(["path"])
    # As a table its size is known before the join, and contents only move if it is large.
    unlisted = kept(read.select("path").join(paths, "path", "left_anti"), "unlisted")
    unreadable = paths.join(read.select("path"), "path", "left_anti")
    return read.join(unlisted, "path", "left_anti").union(
        unreadable.select("path", "length", F.lit(None).cast("binary").alias("content"))
    )


def guarded_manifest(spark: SparkSession, root: str, **options) -> DataFrame:
    """``scan_manifest`` that reports a missing folder as a row instead of failing."""
    try:
        found = scan_manifest(spark, root, **options)
        return found.withColumn("outcome", F.lit("listed"))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        row = spark.range(1).select(
            F.lit(root).alias("path"), basename(F.lit(root)).alias("file_name"),
            F.lit(None).cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modified"),
        )
        return row.withColumn("outcome", F.lit("input_missing"))
