"""Queries against their SQL, and the pipeline stage by stage against brute force."""

from __future__ import annotations

import hashlib

import pytest
import test_operators as brute
from compare import connect, differences

import __spark_entry__ as contract
import corpus_pipeline
from quittance.llm import bpe, quality
from quittance.llm.queries import ORACLE_SQL, QUERIES
from quittance.llm.tables import kept, load

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_all_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries()) and ORACLE_SQL.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLE_SQL[name]) == []


def test_pipeline_stages(spark):
    tiktoken = pytest.importorskip("tiktoken")
    docs = load(spark, SF_DIR, "documents")
    columns = docs.columns
    items = [tuple(row) for row in load(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]

    def rows(frame):
        return [(row.doc_id, row.text) for row in frame.select("doc_id", "text").collect()]

    def stage(name, frame):
        return kept(dict(corpus_pipeline.STAGES)[name](spark, frame, SF_DIR), "stage")

    good = stage("quality", docs)
    scores = quality.scores(docs, load(spark, SF_DIR, "labels"))
    assert brute._sorted(rows(good)) == brute._sorted(rows(docs.join(scores.filter("predicted = 1"), "doc_id", "left_semi")))

    single = stage("exact dedup", good)
    assert {d for d, _ in rows(single)} == {row[0] for row in brute._exact_expected(rows(good)) if row[3]}

    apart = stage("near dedup", single)
    assert {d for d, _ in rows(apart)} == {c for _, c, _ in brute._near_expected(rows(single))}

    clean = stage("decontamination", apart)
    assert {d for d, _ in rows(clean)} == {row[0] for row in brute._decontaminated(rows(apart), items) if not row[-1]}
    assert [frame.columns for frame in (good, single, apart, clean)] == [columns] * 4

    ranks = bpe.default_ranks()
    known = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = [
        (d, len(ids := known.encode_ordinary(text)), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        for d, text in rows(clean)
    ]
    assert brute._sorted(stage("bpe", clean).collect()) == brute._sorted(expected)
    assert brute._sorted(corpus_pipeline.run(spark, SF_DIR).collect()) == brute._sorted(expected)


def test_pipeline_keeps_nothing_of_nothing(spark):
    frame = load(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        frame = kept(stage(spark, frame, SF_DIR), "stage")
    assert frame.collect() == []
