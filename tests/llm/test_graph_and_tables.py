"""Connected components, rows dropped by content keys, and tables that are removed."""

from __future__ import annotations

import os
import random

import pytest
import test_operators as brute
from pyspark.sql import functions as F

import corpus_pipeline
from quittance.llm import exact_dedup, near_dedup
from quittance.llm.graph import components
from quittance.llm.tables import content_keys, kept, noted, remove, without_rows

documents, clashing, none = brute.documents, brute.clashing, brute.none  # fixtures


def _roots(links):
    root = {}

    def top(i):
        while root.setdefault(i, i) != i:
            root[i] = i = root[root[i]]
        return i

    for a, b in links:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    return sorted((i, top(i)) for i in root)


def _path(n, seed):
    ids = list(range(n))
    random.Random(seed).shuffle(ids)
    return list(zip(ids, ids[1:]))


@pytest.mark.parametrize(
    "links",
    [
        [], [(1, 2)], [(5, i) for i in range(5)] + [(i, 9) for i in range(5)], [(i, i + 1) for i in range(500)], _path(600, 1),
        [(random.Random(i).randrange(300), random.Random(i + 999).randrange(300)) for i in range(260)], [(9, i) for i in range(9)],
    ],
)
def test_components(spark, links):
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == _roots([link for link in links if link[0] != link[1]])


def test_rounds_grow_with_the_logarithm(spark):
    with noted() as tables:
        found = components(spark.createDataFrame(_path(4096, 3), "a long, b long"))
    assert found.agg(F.min("root"), F.max("root"), F.count("node")).first() == (0, 0, 4096)
    rounds = sum("-parents-" in path for path in tables)
    assert rounds <= 12 and len(tables) <= 60


def test_rows_dropped_by_content(spark):
    rows = [(1, "a", 1), (1, "a", 1), (1, "b", 2), (None, None, 3), (None, None, 3), (2, "", 4), (None, "x", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, KEY_1 int")
    decide = frame.select(*content_keys(), F.when(F.col("text").isin("b", "x"), False).when(F.rand(1) < 2, F.monotonically_increasing_id() % 2 == 0).alias("kept"))
    kinds = {tuple(r) for r in without_rows(frame, decide.filter("kept IS NOT NULL")).select("doc_id", "text").collect()}
    assert (1, "b") not in kinds and (None, "x") not in kinds
    one = frame.filter("text = 'a'")
    keys = one.select(*content_keys())
    half = keys.limit(1).withColumn("kept", F.lit(True)).union(keys.limit(1).withColumn("kept", F.lit(False)))
    assert [tuple(r) for r in without_rows(one, half).collect()] == [(1, "a", 1)]
    assert without_rows(frame, keys.withColumn("kept", F.lit(True))).count() == len(rows)


def test_no_copy_of_the_documents_is_made(spark, documents):
    for drop in (exact_dedup.without_copies, near_dedup.without_near_copies):
        with noted() as tables:
            drop(documents)
        whole = [path for path in tables if {"doc_id", "text", "lang"} <= set(spark.read.parquet(path).columns)]
        assert whole == []


def _repeated(spark):
    """Null and repeated ids, repeated rows, clashing names, labels that teach nothing."""
    extra = "row long, found string, score double, key_1 string, dropped int, KEPT int"
    names = dict(part.split() for part in extra.split(", "))
    return spark.createDataFrame(brute._rows() * 2, brute.SCHEMA).select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in names.items()])


def test_pipeline_on_awkward_rows(spark, monkeypatch):
    frame = _repeated(spark)
    load = corpus_pipeline.load
    monkeypatch.setattr(corpus_pipeline, "load", lambda s, d, n: frame if n == "documents" else load(s, d, n).limit(0))
    docs, made = frame, []
    for name, stage in corpus_pipeline.STAGES:
        with noted() as tables:
            found = stage(spark, docs, "/root/testdata/sf0.001")
        docs = kept(found, f"awkward-{name[:4]}")
        made.append(list(tables))
        if name != "bpe":
            assert docs.columns == frame.columns
    best: dict[str, tuple] = {}
    for place, (doc_id, text, *_) in enumerate(brute._rows() * 2):
        normal = (text or "").translate({ord(c): None for c in brute.BLANKS})
        best[normal] = min(best.get(normal, (1,)), (-len(text or ""), doc_id is None, doc_id or 0, place, doc_id, text))
    apart = list(brute._near_expected([row[4:] for row in best.values()]))
    assert docs.count() == round(sum(1 / size for *_, size in apart))
    assert not any(os.path.exists(path) for tables in made[:-1] for path in tables)
    assert sorted(map(tuple, corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)


def test_tables_are_removed(spark):
    with noted() as tables:
        kept(spark.range(3), "short-lived")
    path = tables[0]
    assert os.path.exists(path)
    remove(spark, tables)
    assert not os.path.exists(path) and tables == []


@pytest.mark.parametrize("paired", [near_dedup.PAIRED_TEXTS, 2])
def test_search_of_the_rest_is_exact(spark, monkeypatch, paired):
    """Families without their source, of several sizes, some of them linked by chains."""
    monkeypatch.setattr(near_dedup, "PAIRED_TEXTS", paired)
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", 30)
    rows = brute._orphans(120, 20)
    rnd = random.Random(9)
    for family in range(3):
        words = brute._words(300 + family, 220).split()
        for _ in range(30):
            rows.append((len(rows), " ".join(w if rnd.random() > 0.015 + 0.01 * family else f"n{rnd.random():.7f}" for w in words), "en", "s", 1))
    found = near_dedup.groups(spark.createDataFrame(rows, brute.SCHEMA))
    assert brute._sorted(found.select("doc_id", "class_id", "class_size").collect()) == brute._sorted(brute._near_expected(rows))


def test_templates_that_do_not_link_take_work_in_proportion(spark):
    """Filled-in copies of one template at about 0.7 to each other: hardly any pair is compared."""
    source = brute._words(79, 400).split()

    def family(n):
        return [(i, " ".join(f"f{i}x{k}" if k % 27 == 0 else w for k, w in enumerate(source)), "en", "s", 1) for i in range(n)]

    pairs = []
    for n in (300, 1200):
        with noted() as tables:
            found = near_dedup.groups(spark.createDataFrame(family(n), brute.SCHEMA).repartition(8))
        assert found.filter("class_size = 1").count() == n
        pairs.append(sum(spark.read.parquet(path).count() for path in tables if "-pairs-" in path))
    assert pairs[1] < 8 * pairs[0] + 1000 and pairs[1] < 60 * 1200


def test_rarest_shingles():
    import numpy as np

    rnd = np.random.default_rng(1)
    for _ in range(300):
        x = rnd.choice(400, rnd.integers(1, 60), replace=False).astype(np.uint32)
        gone = rnd.integers(0, max(1, len(x) // 5) + 1)
        y = np.unique(np.concatenate([x[gone:], rnd.choice(400, 2).astype(np.uint32)]))
        shared = len(np.intersect1d(x, y))
        if shared >= 0.8 * len(np.union1d(x, y)):
            counts = rnd.integers(0, 5, near_dedup.SLOTS)
            assert np.intersect1d(near_dedup.rarest(x, counts, 0.8), near_dedup.rarest(y, counts, 0.8)).size


@pytest.mark.parametrize("fan_in", [2, 8])
def test_runs_and_merges_of_bounded_size(spark, monkeypatch, fan_in):
    """Short texts in few partitions: runs, and what one merge gets, stay small."""
    monkeypatch.setattr(exact_dedup, "RUN_ROWS", 50)
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["", "x", f"t{rnd.randrange(900)}", f" t{i} "]), "en", "s", 1) for i in range(3000)]
    frame = spark.createDataFrame(rows, brute.SCHEMA).coalesce(2)
    keys = exact_dedup._keys(frame)
    assert keys.groupBy("run").count().agg(F.max("count")).first()[0] <= 50 and keys.select("run").distinct().count() >= 60
    assert brute._sorted(exact_dedup.exact_groups(frame, fan_in).collect()) == brute._sorted(brute._exact_expected(rows))
