"""Partitioned outputs. Each overwrites its folder and returns nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Quotes, line breaks and outer white space of values have to survive.
CSV_OPTIONS = {
    "header": "true", "escape": '"', "emptyValue": "", "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def _by_category(rows: DataFrame, category: str) -> DataFrame:
    """Few files per category, yet a category that holds most rows is split
    over many tasks: the rebalance hint lets Spark size the parts at run time."""
    return rows.hint("rebalance", F.col(category))


def write_csv_by_category(rows: DataFrame, folder: str, category: str = "category") -> None:
    """One subfolder of CSV files with header per category."""
    writer = _by_category(rows, category).write.mode("overwrite").partitionBy(category)
    writer.options(**CSV_OPTIONS).csv(folder)


def read_csv_by_category(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The written rows again; quotes and line breaks in values survive.

    Empty and NULL values cannot be told apart in CSV.
    """
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine="true").csv(folder)


def write_json_sidecars(records: DataFrame, folder: str, name: str = "name", record: str = "record", buckets: int | None = None) -> None:
    """One JSON line per document: its sidecar name and its record.

    With ``buckets`` the lines are dealt by a hash of the name to so many subfolders of
    one file each, and ``read_sidecars`` finds a document by opening one file.
    """
    if buckets is None:
        records.select(name, record).write.mode("overwrite").json(folder)
        return
    dealt = records.select(name, record, F.lit(buckets).alias("of"), _bucket(F.col(name), buckets).alias("bucket"))
    dealt.repartitionById(buckets, "bucket").write.mode("overwrite").partitionBy("of", "bucket").json(folder)


def _bucket(name: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")


def read_sidecars(spark: SparkSession, folder: str, names: Sequence[str], name: str = "name", record: str = "record") -> DataFrame:
    """The records of the named documents from a folder written with ``buckets``: only their files are opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    of = [int(entry.getPath().getName().removeprefix("of=")) for entry in listed if entry.getPath().getName().startswith("of=")]
    rows = spark.read.schema(f"`{name}` string, `{record}` string, of int, bucket int").json(folder)
    if not names or not of:
        return rows.select(name, record).limit(0)
    wanted = spark.range(1).select(F.explode(F.lit(list(names))).alias("n")).select(_bucket(F.col("n"), of[0]).alias("b"))
    numbers = [row.b for row in wanted.distinct().collect()]  # as many as names are asked for
    return rows.filter(F.col("bucket").isin(numbers) & F.col(name).isin(list(names))).select(name, record)


def write_results_json(entries: DataFrame, folder: str, entry: str = "entry") -> None:
    """The ready-made JSON lines of ``results_map``."""
    entries.select(F.col(entry).alias("value")).write.mode("overwrite").text(folder)


def write_report(table: DataFrame, folder: str, category: str = "category") -> None:
    """A report table as Parquet, one subfolder per category."""
    _by_category(table, category).write.mode("overwrite").partitionBy(category).parquet(folder)
