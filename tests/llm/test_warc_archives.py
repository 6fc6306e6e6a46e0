"""WARC archives: awkward pages, records by place, damage, one parse."""

from __future__ import annotations

import hashlib
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quittance.llm import warc
from quittance.llm.tables import kept, noted

LONG = "".join(f"<p>{i} größe</p>" for i in range(200_000))
PAGES = [
    (1, "http://a.example/x", "same " * 300), (2, "http://a.example/x", "same " * 300), (2, "http://a.example/x", "same " * 300),
    (None, "http://b.example", "ohne Nummer " * 200), (None, None, None), (7, "http://b.example/\r\nQ", "kurz\r\n\r\nWARC/1.1"),
    (8, "http://c.example", LONG), (9, "http://c.example", LONG), (10, "http://[", ""),
]
SCHEMA = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, SCHEMA)


def test_awkward_pages(spark, pages):
    wide = pages.select("*", F.lit("x").alias("captured"), F.lit(1).alias("RUN"), F.lit(2).alias("offset"), F.lit(3).alias("payload_digest"))
    rows = warc.archived(wide).collect()
    assert len(rows) == len(PAGES)
    known = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows if r.page_id is not None)
    expected = []
    for page_id, _, html in PAGES:
        if page_id is not None:
            raw, last = (html or "").encode(), max(p for p, _, h in PAGES if p is not None and h == html)
            revisit = len(raw) >= 1000 and last != page_id
            expected.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    assert known == sorted(expected, key=lambda r: (r[0], r[1], r[2], r[3]))
    nameless = sorted((r.payload_bytes, r.record_type) for r in rows if r.page_id is None)
    assert nameless == [(0, "response"), (len("ohne Nummer " * 200), "response")]
    assert len(LONG.encode()) > 3_000_000


def test_records_by_place(spark, pages):
    folder = warc.write_archives(pages.repartition(3), records=2)
    history = warc.capture_history(kept(warc.sorted_runs(spark, folder), "runs")).withColumnRenamed("run", "archive")
    found = [(r.page_id, r.record_type, bytes(r.payload)) for r in warc.fetch(history, folder).collect()]
    types = {(r.page_id, r.payload_digest): r.record_type for r in history.collect()}
    expected = [(p, t := types[p, hashlib.sha1((h or "").encode()).hexdigest()], b"" if t == "revisit" else (h or "").encode()) for p, _, h in PAGES]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(found, key=key) == sorted(expected, key=key)
    one = history.filter("page_id = 9")
    assert [bytes(r.payload) for r in warc.fetch(one, folder).collect()] == [LONG.encode()]
    with pytest.raises(Exception, match="no record of"):
        warc.fetch(one.withColumn("length", F.col("length") + 1), folder).collect()


@pytest.mark.parametrize("damage", [lambda raw: raw[: len(raw) // 2], lambda raw: b"no gzip at all", lambda raw: raw[:40] + b"xxxxxxxx" + raw[48:]])
def test_a_damaged_archive_is_named(spark, pages, tmp_path, damage):
    folder = warc.write_archives(pages.filter("page_id < 8").coalesce(1), str(tmp_path / "w"))
    archive = next(Path(folder).glob("*.gz"))
    archive.write_bytes(damage(archive.read_bytes()))
    for check in Path(folder).glob(".*.crc"):
        check.unlink()
    with pytest.raises(Exception, match=re.escape(archive.name) + " is damaged"):
        warc.sorted_runs(spark, folder).collect()


def test_archives_are_parsed_once(spark, pages):
    with noted() as tables:
        found = warc.archived(pages)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert any("index-runs" in path for path in tables) and "binaryFile" not in plan and ".gz" not in plan


def test_ranges_follow_the_captures(spark, monkeypatch):
    monkeypatch.setattr(warc, "CAPTURES_PER_RANGE", 10)
    many = spark.range(95).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.example/"), "id").alias("url"), F.lit("x").alias("html"))
    rows = warc.archived(many)
    assert rows.select(F.spark_partition_id()).distinct().count() > 5
    keys = [(r.url_key, r.captured, r.page_id) for r in rows.collect()]
    assert keys == sorted(keys) and len(keys) == 95
    assert warc.archived(many.limit(0)).collect() == []
