"""Running sums split over tasks, and what is built on them."""

from __future__ import annotations

import random

from pyspark.sql import Window, functions as F

from quittance.operators import pages, reports
from quittance.operators.running import running_sums


def test_running_sums(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), i, rnd.randint(-5, 9)) for i in range(3000)]
    found = running_sums(spark.createDataFrame(rows, "g string, o int, v int"), ["g"], ["o"], ["v"], tasks=7).collect()
    sums, totals = {}, {}
    for g, _, v in rows:
        totals[g] = totals.get(g, 0) + v
    expected = []
    for g, o, v in rows:
        sums[g] = sums.get(g, 0) + v
        expected.append((g, o, v, sums[g], totals[g]))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert running_sums(spark.createDataFrame([], "g string, o int, v int"), ["g"], ["o"], ["v"]).collect() == []


def test_wide_histograms_are_spread(spark):
    """A group with very many values is summed by many tasks, with the same result as in one."""
    points = spark.range(400_000).select(F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("g"), ((F.col("id") * 7919) % 1_000_003).alias("v"))
    split = reports.otsu_threshold(points, "g", "v", wide=True).collect()
    assert sorted(map(tuple, split)) == sorted(map(tuple, reports.otsu_threshold(points, "g", "v").collect()))
    counts = reports.histogram(points, "g", "v")
    parts = running_sums(counts, ["g"], ["v"], ["n"], tasks=8)
    assert "Exchange SinglePartition" not in parts._jdf.queryExecution().executedPlan().toString()
    whole = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = counts.withColumn("n_upto", F.sum("n").over(whole))
    assert parts.select("g", "v", "n", "n_upto").exceptAll(plain).isEmpty()


def test_segments_hold_whole_pages_in_order(spark):
    rnd = random.Random(4)
    rows = [(d, p, None if rnd.random() < 0.1 else "".join(rnd.choice("aé😀") for _ in range(rnd.randint(0, 40)))) for d in (1, 2, None) for p in range(200)]
    rows += [(4, 0, "x" * 500), (4, 1, "y"), (5, 0, None)]
    rnd.shuffle(rows)
    found = pages.page_segments(spark.createDataFrame(rows, "doc_id int, page_no int, text string"), segment_chars=100).collect()
    for doc in (1, 2, None, 4, 5):
        mine = sorted((r.segment_no, r.first_page, r.text) for r in found if r.doc_id == doc)
        whole = [text or "" for d, _, text in sorted((r for r in rows if r[0] == doc), key=lambda r: r[1])]
        assert "".join(text for *_, text in mine) == "".join(whole)
        assert [first for _, first, _ in mine] == sorted(first for _, first, _ in mine) and len({n for n, *_ in mine}) == len(mine)
        assert all(len(text) < 100 + max(map(len, whole)) for *_, text in mine)


def test_a_document_of_many_pages_is_worked_on_by_many_tasks(spark):
    frame = spark.range(100_000).select(F.lit(7).alias("doc_id"), F.col("id").cast("int").alias("page_no"), F.concat(F.lit("page "), "id").alias("text"))
    found = pages.page_segments(frame, segment_chars=10_000)
    text = "".join(f"page {i}" for i in range(100_000))
    rows = found.withColumn("task", F.spark_partition_id()).collect()
    assert "".join(r.text for r in sorted(rows, key=lambda r: r.segment_no)) == text
    assert len({r.task for r in rows}) > 1 and max(len(r.text) for r in rows) < 10_020
