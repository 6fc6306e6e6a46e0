"""Listings by the executors, contents of listed files, and manifests that grow."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F
from test_files import root  # noqa: F401 - a fixture

from quittance.operators import manifest as mf
from quittance.sources import files as sources, listing


def rows(frame):
    return sorted((r.path, r.file_name, r.length, r.modified) for r in frame.collect())


@pytest.mark.parametrize("pattern, depth", [("", 0), ("/*", 1)])
def test_equal_to_the_listing_of_the_driver(spark, root, pattern, depth):  # noqa: F811
    assert rows(listing.list_tree(spark, str(root), depth=depth)) == rows(sources.scan_manifest(spark, str(root) + pattern))


def test_all_depths(spark, root):  # noqa: F811
    assert rows(listing.list_tree(spark, str(root))) == rows(sources.scan_manifest(spark, str(root), recursive=True))
    assert rows(listing.list_tree(spark, f"file:{root}/")) == rows(sources.scan_manifest(spark, str(root), recursive=True))
    images = listing.list_tree(spark, str(root), [".png", ".jpg", ".jpeg"], case_sensitive=True)
    assert rows(images) == rows(sources.scan_images(spark, str(root), recursive=True))


def test_hidden_names_missing_folders_and_links(spark, root):  # noqa: F811
    for name in ("_a.pdf", ".b.pdf", "_c/d.pdf", "A b/_e.pdf"):
        path = root / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(b"x")
    os.symlink(root, root / "A b" / "loop")
    plain = listing.list_tree(spark, str(root))
    assert rows(plain) == rows(sources.scan_manifest(spark, str(root), recursive=True).filter(~F.col("path").contains("/loop/")))
    assert listing.list_tree(spark, str(root), hidden=True).count() == plain.count() + 4
    assert listing.list_tree(spark, f"{root}/keine").collect() == []
    assert listing.list_tree(spark, str(root), depth=7).collect() == []


def test_many_folders_are_listed_by_many_tasks(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"k{i}" / "sub").mkdir(parents=True)
        for k in range(3):
            (tmp_path / f"k{i}" / "sub" / f"{k}.pdf").write_bytes(b"x" * k)
    found = listing.list_tree(spark, str(tmp_path), tasks=6)
    assert found.count() == 180 and found.agg(F.sum("length")).first()[0] == 180
    assert found.select(F.spark_partition_id()).distinct().count() > 1


def test_contents_of_exactly_the_listed_files(spark, root):  # noqa: F811
    listed = sources.scan_manifest(spark, str(root), recursive=True)
    gone = spark.createDataFrame([(f"file:{root}/weg.pdf", "weg.pdf", 5, None)], listed.schema)
    read = listing.read_listed(listed.union(gone).union(listed), bytes_per_task=40)
    found = {r.path: (r.content and bytes(r.content), r.read_error) for r in read.collect()}
    assert read.count() == len(found) == listed.count() + 1
    for path, (content, error) in found.items():
        if path.endswith("weg.pdf"):
            assert content is None and "weg.pdf" in error
        else:
            assert error is None and path == f"file:{root}/{content.decode()}"
    assert listing.read_listed(listed.limit(0)).collect() == []


def test_lists_are_balanced_by_bytes(spark, tmp_path):
    for i in range(200):
        (tmp_path / f"{i:03}.pdf").write_bytes(b"x" * (20_000 if i < 10 else 1_000))
    read = listing.read_listed(listing.list_tree(spark, str(tmp_path)), bytes_per_task=40_000)
    sizes = [r.bytes for r in read.groupBy(F.spark_partition_id()).agg(F.sum("length").alias("bytes")).collect()]
    assert sum(sizes) == 390_000 and len(sizes) == 10 and max(sizes) <= 60_000


def test_contents_are_neither_shuffled_nor_copied(spark, root):  # noqa: F811
    plan = listing.read_listed(sources.scan_manifest(spark, str(root)))._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("MapInArrow", 1)
    assert "Exchange" not in above and "content" not in below.split("\n", 1)[1]


# ---------------------------------------------------------------- incremental manifest


def test_an_unchanged_folder_has_nothing_pending(spark, root, tmp_path_factory):  # noqa: F811
    folder = str(tmp_path_factory.mktemp("manifest") / "versions")

    def run() -> dict:
        changes = mf.manifest_changes(mf.known_manifest(spark, folder), listing.list_tree(spark, str(root))).cache()
        states = {r.file_name: r.state for r in changes.collect()}
        pending = sorted(r.file_name for r in mf.pending_files(changes).collect())
        assert pending == sorted(n for n, s in states.items() if s in ("new", "changed"))
        version = mf.commit_manifest(changes, folder)
        changes.unpersist()
        return {"states": states, "version": version}

    first = run()
    assert set(first["states"].values()) == {"new"} and first["version"] == 1
    second = run()
    assert set(second["states"].values()) == {"unchanged"} and second["version"] is None
    (root / "A b" / "1.pdf").write_bytes(b"longer than before")
    (root / "A b" / "2.PDF").unlink()
    (root / "neu.pdf").write_bytes(b"n")
    third = run()
    assert {n: s for n, s in third["states"].items() if s != "unchanged"} == {"1.pdf": "changed", "2.PDF": "gone", "neu.pdf": "new"}
    assert third["version"] == 2
    assert set(run()["states"].values()) == {"unchanged"}
    (root / "A b" / "2.PDF").write_bytes(b"back")
    assert {n for n, s in run()["states"].items() if s == "new"} == {"2.PDF"}


def test_an_uncommitted_run_leaves_its_files_pending(spark, root, tmp_path_factory):  # noqa: F811
    folder = str(tmp_path_factory.mktemp("manifest") / "versions")
    listed = listing.list_tree(spark, str(root))
    for _ in range(2):
        changes = mf.manifest_changes(mf.known_manifest(spark, folder), listed)
        assert mf.pending_files(changes).count() == listed.count()
