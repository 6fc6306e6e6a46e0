"""Numbered file names over sorted files, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from quittance import fixed_values as fv
from quittance.operators.manifest import filter_by_suffix
from quittance.session import shared_folder


def sort_by_name(files: DataFrame, name: str = "file_name", category: str | None = None) -> DataFrame:
    """Code-point order; a range-partitioned sort."""
    return files.orderBy(*([category] if category else []), name)


def number_rows(
    files: DataFrame, order: Sequence[str], groups: Sequence[str] = (), start: int = 0, number: str = "number",
    folder: str | None = None,
) -> DataFrame:
    """``start, start + 1, ...`` in order, anew for each group.

    Two passes, so that neither one huge group nor the whole table is sorted in
    one task: (1) range-partition on group and order, sort each partition and
    note the position of every row in it; (2) add how many rows of the group
    lie in earlier partitions. The first pass is kept, because range bounds are
    sampled and a repeated sort could cut elsewhere: as a table in ``folder``,
    which the caller owns and clears, or else with ``checkpoint()``.
    Needs ``order`` to be unique within a group. NULL is a group like others.
    """
    spark = files.sparkSession
    keys = [*groups, *order]
    placed = (
        files.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", 33))
    )
    if folder:
        placed.write.parquet(folder)
        placed = spark.read.schema(placed.schema).parquet(folder)
    else:
        shared_folder(spark)
        placed = placed.checkpoint()
    parts = placed.groupBy(*groups, "_part").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per partition and group: as small as the partition count plus the
    # number of groups, and a group spans no more rows than there are partitions.
    earlier = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    position = F.lit(start) + F.col("_before") + F.col("_place") - F.col("_first")
    renamed = offsets.select(
        *[F.col(name).alias(f"_g{i}") for i, name in enumerate(groups)], F.col("_part").alias("_of"), "_first", "_before"
    )
    same = F.col("_part") == F.col("_of")
    for i, name in enumerate(groups):
        same = same & F.col(name).eqNullSafe(F.col(f"_g{i}"))
    return placed.join(renamed, same).select(*files.columns, position.cast("bigint").alias(number))


def _renamed(numbered: DataFrame, name: str) -> DataFrame:
    return numbered.withColumn("new_name", F.concat(F.col("number").cast("string"), F.lit("_"), F.col(name)))


def number_files(
    manifest: DataFrame, start: int = fv.FIRST_PDF_NUMBER, name: str = "file_name", category: str = "category"
) -> DataFrame:
    """Rename manifest for the PDFs of each category. Running it twice prefixes twice."""
    return _renamed(number_rows(filter_by_suffix(manifest, name), [name], [category], start), name)


def number_all_files(
    manifest: DataFrame, start: int = fv.FIRST_FILE_NUMBER, name: str = "file_name", category: str = "category"
) -> DataFrame:
    """The same for every file of each category."""
    return _renamed(number_rows(manifest, [name], [category], start), name)


def number_global(
    manifest: DataFrame, start: int = fv.FIRST_FILE_NUMBER, order: Sequence[str] = ("path",), name: str = "file_name"
) -> DataFrame:
    """One numbering over the whole table."""
    return _renamed(number_rows(manifest, order, (), start), name)
