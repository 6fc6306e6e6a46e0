"""Files in and out: listings with real names, and outputs that read back whole."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quittance.operators.manifest import category_from_path
from quittance.operators.reports import results_map
from quittance.sinks import files as sinks
from quittance.sources import files as sources


@pytest.fixture()
def root(tmp_path):
    for name in [
        "lose.pdf", "A b/1.pdf", "A b/2.PDF", "A b/3.pDf", "A b/x.txt", "A b/y.pdf.bak", "A b/tief/4.pdf", "k=v/5.pdf",
        "k=v/sub=1/6.pdf", "Bilder/a.png", "Bilder/b.jpg", "Bilder/c.jpeg", "Bilder/d.PNG", "Ü/ä%20ö.pdf",
    ]:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode())
    return tmp_path


def names(frame):
    return sorted(row.file_name for row in frame.collect())


def test_suffixes(spark, root):
    assert names(sources.scan_manifest(spark, f"{root}/A b")) == ["1.pdf", "2.PDF", "3.pDf"]
    assert names(sources.scan_manifest(spark, f"{root}/A b", case_sensitive=True)) == ["1.pdf"]
    assert names(sources.scan_images(spark, f"{root}/Bilder")) == ["a.png", "b.jpg", "c.jpeg"]


def test_depth(spark, root):
    assert names(sources.scan_manifest(spark, str(root))) == ["lose.pdf"]
    assert names(sources.scan_manifest(spark, f"{root}/*")) == ["1.pdf", "2.PDF", "3.pDf", "5.pdf", "ä%20ö.pdf"]
    assert len(names(sources.scan_manifest(spark, str(root), recursive=True))) == 8


def test_categories_of_a_scan(spark, root):
    listed = sources.scan_manifest(spark, str(root), recursive=True)
    rows = category_from_path(listed, str(root)).collect()
    assert sorted((r.category, r.file_name) for r in rows) == [
        ("A b", "1.pdf"), ("A b", "2.PDF"), ("A b", "3.pDf"), ("k=v", "5.pdf"), ("Ü", "ä%20ö.pdf"),
    ]
    assert category_from_path(listed, f"file://{root}").count() == 5


def test_bytes(spark, root):
    rows = sources.read_bytes(spark, f"{root}/*", "*.txt").collect()
    assert [bytes(row.content) for row in rows] == ["A b/x.txt".encode()]
    listed = sources.scan_manifest(spark, f"{root}/A b")
    read = sources.read_bytes(spark, f"{root}/A b", "*.pdf")
    joined = sources.bytes_of_manifest(listed, read)
    both = {row.path.rsplit("/")[-1]: row.content is None for row in joined.collect()}
    assert both == {"1.pdf": False, "2.PDF": True, "3.pDf": True}


def test_listing_does_not_read_contents(spark, root):
    plan = sources.scan_manifest(spark, str(root))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp,length:bigint>" in plan


def test_missing_folder_is_an_outcome(spark, root):
    found = sources.guarded_manifest(spark, f"{root}/A b")
    missing = sources.guarded_manifest(spark, f"{root}/fehlt")
    assert found.schema == missing.schema or found.columns == missing.columns
    assert [(r.file_name, r.outcome) for r in missing.collect()] == [("fehlt", "input_missing")]
    assert {r.outcome for r in found.union(missing).collect()} == {"listed", "input_missing"}


TEXTS = ['mit "Zitat"', "Zeile\nzwei", " Rand ", "a,b;c", "\\", "Größe €", "```json\n{}\n```", "x\r\ny", "'"]


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i % 2}", str(i), t) for i, t in enumerate(TEXTS)], "category string, Datei string, Text string")
    sinks.write_csv_by_category(rows, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["category=k0", "category=k1"]
    back = sinks.read_csv_by_category(spark, str(tmp_path / "out"), "Datei string, Text string, category string")
    assert {r.Datei: (r.category, r.Text) for r in back.collect()} == {str(i): (f"k{i % 2}", t) for i, t in enumerate(TEXTS)}
    header = next((tmp_path / "out" / "category=k0").glob("*.csv")).read_text().splitlines()[0]
    assert header == "Datei,Text"


def test_csv_overwrites(spark, tmp_path):
    for value in ("alt", "neu"):
        sinks.write_csv_by_category(spark.createDataFrame([("k", value)], "category string, v string"), str(tmp_path / "o"))
    assert [r.v for r in sinks.read_csv_by_category(spark, str(tmp_path / "o"), "v string, category string").collect()] == ["neu"]


def test_json_outputs(spark, tmp_path):
    rows = spark.createDataFrame([(f"p{i}", t) for i, t in enumerate(TEXTS)], "path string, text string")
    sinks.write_results_json(results_map(rows), str(tmp_path / "r"))
    merged = {}
    for part in (tmp_path / "r").glob("part-*"):
        for line in part.read_text(encoding="utf-8").split("\n"):
            merged.update(json.loads(line) if line else {})
    assert merged == {f"p{i}": t for i, t in enumerate(TEXTS)}
    sinks.write_json_sidecars(rows.select(F.col("path").alias("name"), F.col("text").alias("record")), str(tmp_path / "s"))
    back = spark.read.schema("name string, record string").json(str(tmp_path / "s"))
    assert {r.name: r.record for r in back.collect()} == {f"p{i}": t for i, t in enumerate(TEXTS)}


def test_report_table(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "category string, v int")
    sinks.write_report(rows, str(tmp_path / "t"))
    assert {(r.category, r.v) for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {("a", 1), ("b", 2)}


def test_a_sidecar_is_found_in_one_file(spark, tmp_path):
    rows = spark.range(500).select(F.concat("id", F.lit("ä.json")).alias("name"), F.concat(F.lit('{"n":'), "id", F.lit("}")).alias("record"))
    folder = str(tmp_path / "s")
    sinks.write_json_sidecars(rows, folder, buckets=10)
    assert len(list((tmp_path / "s").glob("of=10/bucket=*/part-*"))) == 10
    found = sinks.read_sidecars(spark, folder, ["123ä.json"])
    assert [tuple(r) for r in found.collect()] == [("123ä.json", '{"n":123}')]
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in scan.split("PartitionFilters: ", 1)[1].split("]", 1)[0]
    assert found.select(F.input_file_name()).distinct().count() == 1
    assert sorted(r.name for r in sinks.read_sidecars(spark, folder, ["1ä.json", "499ä.json", "fehlt"]).collect()) == ["1ä.json", "499ä.json"]
    assert sinks.read_sidecars(spark, folder, []).collect() == []
