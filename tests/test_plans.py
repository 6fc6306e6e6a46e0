"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest
from conftest import SF_DIR

from quittance.plans.queries import QUERIES


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [n for n in sorted(QUERIES) if not n.startswith(("write_", "number_"))],
)
def test_no_single_partition_and_no_cross_join(spark, name):
    text = plan(spark, name)
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "name", ["build_prompt", "build_payload", "first_page", "explode_ocr_words", "base64_encode", "span_decode", "sidecar_filename"]
)
def test_row_by_row_operators_do_not_shuffle(spark, name):
    assert "hashpartitioning" not in plan(spark, name)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("otsu_threshold", {"l_quantity", "l_returnflag", "l_linenumber"}),
        ("main_vat", {"l_orderkey", "l_extendedprice", "l_tax"}),
        ("truncate_text", {"doc_id", "text"}),
        ("span_decode", {"vec_id", "embedding"}),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>(?:\n|$| )", plan(spark, name).replace("array<float>", "floats"))
    read = {part.split(":")[0] for schema in schemas for part in schema.split(",")}
    assert read == columns


@pytest.mark.parametrize("name", ["otsu_threshold", "mean_gate", "main_vat", "sum_vat", "batch_statistics", "column_width_profile"])
def test_rows_are_combined_before_the_shuffle(spark, name):
    assert "partial_" in plan(spark, name)


def test_images_stay_out_of_every_shuffle(spark):
    assert "Exchange" not in plan(spark, "process_images")


@pytest.mark.parametrize("name", ["outcome_policy_pf", "outcome_policy_mg", "outcome_policy_ba", "extract_json_direct_first", "write_csv_by_category"])
def test_generated_code_compiles(spark, name):
    """Without the fall-back, a method over 64 KB would end the query."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    huge = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", huge)


def test_contents_are_read_once(spark):
    """The listing of files does not open them; what was read is a table afterwards."""
    assert "binaryFile" not in "".join(
        line for line in plan(spark, "read_bytes").splitlines() if "content" in line
    )
