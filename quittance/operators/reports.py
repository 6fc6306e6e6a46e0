"""Batch figures, report tables and image statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from quittance import fixed_values as fv
from quittance.functions.scalars import float_text, format_amount, format_date_display
from quittance.operators.running import running_sums

SUCCESS = ("ok", "missing_fields")


def _success(outcome: str) -> Column:
    return F.col(outcome).isin(*SUCCESS)


def batch_statistics(rows: DataFrame, groups: Sequence[str] = (), outcome: str = "outcome") -> DataFrame:
    """total, successful, failed - for the batch or per group."""
    return rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_success(outcome)).alias("successful"),
        F.count_if(~_success(outcome)).alias("failed"),
    )


def observe_statistics(rows: DataFrame, outcome: str = "outcome") -> tuple[DataFrame, Observation]:
    """The same figures, gathered while the rows are written anyway."""
    observation = Observation("batch_statistics")
    observed = rows.observe(
        observation,
        F.count(F.lit(1)).alias("total"),
        F.count_if(_success(outcome)).alias("successful"),
        F.count_if(~_success(outcome)).alias("failed"),
    )
    return observed, observation


def results_map(rows: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """``{path: text}`` as one JSON line per path; no group is gathered in one task."""
    entry = F.to_json(F.create_map(F.col(path), F.col(text)))
    return rows.select(F.col(path), entry.alias("entry"))


def _shown(name: str, dtype: str, failed: Column | None = None) -> Column:
    """A value as the sheet holds it; typed fields of failed rows hold the error mark."""
    value = F.col(name)
    if dtype == "double":
        text = float_text(value)
    elif dtype == "date":
        text = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    else:
        text = value.cast("string")
    shown = F.coalesce(text, F.lit("None"))
    return shown if failed is None or dtype not in ("double", "date") else F.when(failed, fv.ERROR).otherwise(shown)


def column_width_profile(
    rows: DataFrame, columns: Sequence[tuple[str, str]], groups: Sequence[str] = ("category",), outcome: str = "outcome"
) -> DataFrame:
    """Per group and column: longest text including the header, plus padding.

    ``columns`` pairs each column with its header; the last one is capped. One
    aggregation with one row per group, then turned into rows. Without a column
    ``outcome`` no row counts as failed.
    """
    types = dict(rows.dtypes)
    failed = ~_success(outcome) if outcome in types else None
    longest = [
        F.greatest(F.lit(len(header)), F.max(F.length(_shown(name, types[name], failed)))).alias(f"_w{i}")
        for i, (name, header) in enumerate(columns)
    ]
    entries = []
    for i, (_, header) in enumerate(columns):
        width = F.col(f"_w{i}") + fv.WIDTH_PADDING
        if i == len(columns) - 1:
            width = F.least(width, F.lit(fv.WIDTH_CAP))
        entries.append(F.struct(F.lit(header).alias("header"), width.alias("width")))
    return rows.groupBy(*groups).agg(*longest).select(*groups, F.inline(F.array(*entries)))


def report_columns(rows: DataFrame, dialect_typed: bool, with_ocr: bool = False, with_raw: bool = True) -> DataFrame:
    """The report sheet as a table: fixed column order, headers, display strings."""
    failed = ~_success("outcome")
    shown = [F.col("file_name").alias(fv.FILE_HEADER)]
    for key, name in fv.FIELDS:
        value = F.col(name)
        if dialect_typed and name == fv.DATE_FIELD:
            value = F.when(failed, F.lit(fv.ERROR)).otherwise(format_date_display(value))
        elif dialect_typed and name in fv.AMOUNT_FIELDS:
            value = F.when(failed, F.lit(fv.ERROR)).otherwise(format_amount(value))
        shown.append(value.alias(key))
    if with_ocr:
        shown.append(F.col("ocr_text").alias(fv.OCR_HEADER))
    if with_raw:
        shown.append(F.col("raw_response").alias(fv.RAW_HEADER))
    groups = ["category"] if "category" in rows.columns else []
    return rows.select(*groups, *shown)


def two_field_columns(rows: DataFrame) -> DataFrame:
    """The five-column sheet; its two comment columns are always empty."""
    name, date, amount, date_note, amount_note = fv.TWO_FIELD_HEADERS
    empty = F.lit(None).cast("string")
    return rows.select(
        F.col("file_name").alias(name), F.col("date_answer").alias(date), F.col("amount_answer").alias(amount),
        empty.alias(date_note), empty.alias(amount_note),
    )


def histogram(points: DataFrame, group: str, value: str) -> DataFrame:
    """Points per group and value. Combined before the shuffle, so a group that
    holds most points still sends few rows; grey values give 256 at most."""
    return points.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))


def mean_gate(points: DataFrame, group: str, value: str) -> DataFrame:
    """Per group: mean, points darker than a share of it, and whether to act.

    Mean and count come from the histogram; both are sums that combine before
    they move, for any numeric column and however many values a group has.
    """
    counts = histogram(points, group, value)
    means = counts.groupBy(F.col(group).alias("_of")).agg((F.sum(F.col(value) * F.col("n")) / F.sum("n")).alias("mean"))
    dark = F.sum(F.when(F.col(value) < F.col("mean") * fv.DARK_FACTOR, F.col("n")).otherwise(0))
    return (
        counts.join(means, F.col(group).eqNullSafe(F.col("_of")))
        .groupBy(group, "mean")
        .agg(dark.alias("dark_points"))
        .withColumn("act", (F.col("mean") < fv.WHITE_MEAN) & (F.col("dark_points") > fv.MIN_DARK_POINTS))
    )


def otsu_threshold(points: DataFrame, group: str, value: str, wide: bool = False) -> DataFrame:
    """Per group: the value that best splits the points into two classes.

    Highest between-class variance, the lower value on ties. All sums run over
    the histogram. Grey values make a histogram of 256 rows at most; with ``wide`` the
    histogram of a group may have any number of values, and its running sums are split over
    tasks.
    """
    counts = histogram(points, group, value).withColumn("s", F.col(value) * F.col("n"))
    if wide:
        sums = running_sums(counts, [group], [value], ["n", "s"])
    else:
        upto = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(group)
        sums = counts.select(
            group, value, *[F.sum(c).over(upto).alias(f"{c}_upto") for c in ("n", "s")], *[F.sum(c).over(whole).alias(f"{c}_total") for c in ("n", "s")]
        )
    w0, w1 = F.col("n_upto").cast("double"), (F.col("n_total") - F.col("n_upto")).cast("double")
    gap = F.col("s_upto") / w0 - F.try_divide(F.col("s_total") - F.col("s_upto"), w1)
    variance = F.coalesce(w0 * w1 * gap * gap, F.lit(0.0))
    best = F.max_by(F.col(value), F.struct(variance, -F.col(value)))
    return sums.groupBy(group).agg(best.alias("threshold"))


def salts_for(points: DataFrame, group: str, value: str) -> int:
    """How many tasks of a shuffled join the group with the most points deserves, by its share of all points."""
    sizes = histogram(points, group, value).groupBy(group).agg(F.sum("n").alias("rows"))
    largest, total = sizes.agg(F.max("rows"), F.sum("rows")).first()
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-largest * tasks // total)) if total else 1


def binarize(points: DataFrame, thresholds: DataFrame, group: str, value: str, salts: int | None = None) -> DataFrame:
    """255 above the group's threshold, else 0. NULL is a group like others.

    Thresholds hold one row per image, which may be too many to broadcast; Spark
    decides by their measured size. For the shuffled join, an image with more than
    a task's share of the points is spread: every threshold is repeated ``salts``
    times, and points are salted by the input partition they come from. Without
    ``salts`` the histogram is made once more to measure it; 1 leaves it to Spark.
    """
    salts = salts_for(points, group, value) if salts is None else salts
    bit = F.when(F.col(value) > F.col("threshold"), 255).otherwise(0)
    renamed = thresholds.select(F.col(group).alias("_of"), "threshold")
    same = F.col(group).eqNullSafe(F.col("_of"))
    if salts > 1:
        points = points.withColumn("_salt", F.spark_partition_id() % salts)
        renamed = renamed.withColumn("_salt_of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        same = same & (F.col("_salt") == F.col("_salt_of"))
    return points.join(renamed, same).select(*[c for c in points.columns if c != "_salt"], bit.alias("bit"))
