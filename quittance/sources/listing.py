"""Listings made by the executors, and contents of exactly the listed files."""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from quittance import fixed_values as fv
from quittance.functions.scalars import basename, has_suffix
from quittance.operators.running import running_sums
from quittance.session import new_folder

# Sent to the tasks as code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BYTES_PER_TASK = 64 << 20
_BATCH_ROWS = 1000
_BATCH_BYTES = 32 << 20
_ENTRIES = "path string, is_folder boolean, length long, modified timestamp"


class Entry(NamedTuple):
    path: str
    is_folder: bool
    length: int | None
    modified_ms: int | None


def _local(path: str) -> str | None:
    """The plain path of a local file, None for other file systems."""
    if path.startswith("/"):
        return path
    found = re.fullmatch(r"file:(?://)?(/.*)", path)
    return found[1] if found else None


def _arrow_files(path: str):
    """The file system of a URI as Arrow knows it, the path in it, and what comes before paths of it."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system, inner, path[: path.index(inner.rstrip("/"))] if inner.rstrip("/") in path else path.split("://")[0] + "://"


def list_folder(folder: str) -> Iterator[Entry]:
    """What lies directly in a folder; nothing for a folder that is gone. Links to folders are not followed."""
    local = _local(folder)
    if local is None:
        from pyarrow import fs

        system, inner, before = _arrow_files(folder)
        for info in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
            is_folder = info.type == fs.FileType.Directory
            yield Entry(before + info.path, is_folder, None if is_folder else info.size, info.mtime_ns and info.mtime_ns // 1_000_000)
        return
    try:
        entries = os.scandir(local)
    except FileNotFoundError:
        return
    with entries:
        for entry in entries:
            try:
                is_folder = entry.is_dir(follow_symlinks=False)
                stat = entry.stat()
                if is_folder or entry.is_file():
                    yield Entry(f"file:{entry.path}", is_folder, None if is_folder else stat.st_size, stat.st_mtime_ns // 1_000_000)
            except FileNotFoundError:  # gone since
                continue


def list_tree(
    spark: SparkSession, root: str, suffixes: Sequence[str] | None = (fv.PDF_SUFFIX,), case_sensitive: bool = False,
    depth: int | None = None, hidden: bool = False, lister: Callable[[str], Iterator[Entry]] = list_folder, tasks: int | None = None,
) -> DataFrame:
    """The manifest of ``scan_manifest``, listed by tasks: level by level, a frontier of folders at a time.

    ``depth`` 0 gives the files of the root, 1 those of its direct subfolders, None all
    at any depth. The driver learns whether a level has folders, and nothing else; each level is a
    table in the shared folder. Folders of a level are dealt evenly; one folder is
    listed by one task, as a stream where the file system is local. ``hidden`` keeps names
    that start with ``_`` or ``.``, which Spark's own listing leaves out. A root that does not exist has no files. ``lister`` replaces
    the listing of one folder, for file systems that Arrow cannot open by URI.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[Entry]) -> pa.RecordBatch:
            path, is_folder, length, modified = zip(*rows, strict=True)
            when = pa.array(modified, pa.timestamp("ms", "UTC")).cast(pa.timestamp("us", "UTC"))
            return pa.RecordBatch.from_arrays(
                [pa.array(path, pa.string()), pa.array(is_folder, pa.bool_()), pa.array(length, pa.int64()), when],
                names=["path", "is_folder", "length", "modified"],
            )

        rows: list[Entry] = []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                for entry in lister(folder):
                    rows.append(entry)
                    if len(rows) == _BATCH_ROWS:
                        yield table(rows)
                        rows = []
        if rows:
            yield table(rows)

    tasks = tasks or max(1, spark.sparkContext.defaultParallelism)
    frontier = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string").coalesce(1)
    found: DataFrame | None = None
    level = 0
    while True:
        folder = new_folder(spark, "listing")
        frontier.mapInArrow(run, _ENTRIES).write.parquet(folder)
        listed = spark.read.schema(_ENTRIES).parquet(folder).withColumn("file_name", basename(F.col("path")))
        if not hidden:
            listed = listed.filter(~F.col("file_name").rlike("^[_.]"))
        if depth is None or level == depth:
            files = listed.filter("NOT is_folder")
            found = files if found is None else found.union(files)
        folders = listed.filter("is_folder").select("path")
        if level == depth or folders.isEmpty():
            break
        frontier, level = folders.repartition(tasks), level + 1
    if found is None:
        found = listed.limit(0)
    if suffixes is not None:
        wanted = F.lit(False)
        for suffix in suffixes:
            wanted = wanted | has_suffix(F.col("file_name"), suffix, case_sensitive)
        found = found.filter(wanted)
    return found.select("path", "file_name", "length", "modified")


def open_bytes(path: str) -> bytes:
    """The content of a file by path or URI."""
    local = _local(path)
    if local is not None:
        with open(local, "rb") as file:
            return file.read()
    system, inner, _ = _arrow_files(path)
    with system.open_input_stream(inner) as file:
        return file.read()


def read_listed(manifest: DataFrame, opener: Callable[[str], bytes] = open_bytes, bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """``path``, ``length``, ``content`` and ``read_error`` of exactly the listed files, each opened once by the task that returns it.

    Only paths and lengths are dealt out, in lists of equal bytes, about ``bytes_per_task`` or
    as many as there are cores; contents are neither shuffled nor copied. A file that cannot be read has a NULL content and
    the reason. A path that is listed twice is read once. A file has to fit one cell.
    ``opener`` replaces opening, for file systems that Arrow cannot open by URI.
    """
    paths = manifest.groupBy("path").agg(F.coalesce(F.max("length"), F.lit(0)).cast("long").alias("length"))
    one_group = paths.withColumn("_cost", F.col("length") + 1).withColumn("_all", F.lit(0))
    placed = running_sums(one_group, ["_all"], ["path"], ["_cost"])
    total = placed.agg(F.max("_cost_total")).first()[0] or 0
    count = max(-(-total // bytes_per_task), manifest.sparkSession.sparkContext.defaultParallelism)
    size = max(1, -(-total // count))
    dealt = placed.withColumn("_list", F.least(F.floor((F.col("_cost_upto") - F.col("_cost")) / size), F.lit(count - 1)).cast("int"))
    dealt = dealt.repartitionById(count, "_list").select("path", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "length", "content", "read_error"])

        rows, size = [], 0
        for batch in batches:
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    content, problem = opener(path), None
                except Exception as failed:  # noqa: BLE001 - any failure belongs to its file
                    content, problem = None, str(failed)
                rows.append((path, length, content, problem))
                size += len(content or b"")
                if size >= _BATCH_BYTES or len(rows) == _BATCH_ROWS:
                    yield table(rows)
                    rows, size = [], 0
        if rows:
            yield table(rows)

    return dealt.mapInArrow(run, "path string, length long, content binary, read_error string")
