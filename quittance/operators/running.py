"""Running sums within groups of any size, split over tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from quittance.session import shared_folder


def running_sums(frame: DataFrame, groups: Sequence[str], order: Sequence[str], values: Sequence[str], tasks: int | None = None) -> DataFrame:
    """Add ``<value>_upto``, the sum over the rows of the group up to this one, and ``<value>_total``.

    Rows are dealt to tasks by ranges of group and order, so that a group of any size
    is spread; every task sums its own rows, and what lies in earlier tasks is added:
    a table with one row per task and group. The dealt rows are kept with
    ``checkpoint()``, because range bounds are sampled and may differ when computed twice.
    ``order`` has to be unique within a group. NULL is a group like others.
    """
    keys = [*groups, *order]
    dealt = frame.repartitionByRange(tasks, *keys) if tasks else frame.repartitionByRange(*keys)
    shared_folder(frame.sparkSession)
    dealt = dealt.withColumn("_part", F.spark_partition_id()).checkpoint()
    parts = dealt.groupBy(*groups, "_part").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    # A group has as many rows here as it spans tasks.
    whole = Window.partitionBy(*groups)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        *[F.col(name).alias(f"_g{i}") for i, name in enumerate(groups)], F.col("_part").alias("_of"),
        *[F.coalesce(F.sum(f"_sum_{v}").over(earlier), F.lit(0)).alias(f"_before_{v}") for v in values],
        *[F.sum(f"_sum_{v}").over(whole).alias(f"{v}_total") for v in values],
    )
    same = F.col("_part") == F.col("_of")
    for i, name in enumerate(groups):
        same = same & F.col(name).eqNullSafe(F.col(f"_g{i}"))
    upto = Window.partitionBy(*groups, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = dealt.select("*", *[F.sum(v).over(upto).alias(f"_own_{v}") for v in values])
    sums = [(F.col(f"_before_{v}") + F.col(f"_own_{v}")).alias(f"{v}_upto") for v in values]
    return own.join(offsets, same).select(*frame.columns, *sums, *[f"{v}_total" for v in values])
