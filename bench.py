"""Headline queries on one machine; prints one JSON line.

Every query runs in full, twice, into a sink that discards the rows; the faster
run counts. The files that the file queries list are staged before the clock starts.
``fixture_answers`` is the derived input that most queries parse, without an operator:
the difference to it is the operator's share. Figures before the second round staged
the files within the first run.
"""

from __future__ import annotations

import json
import os
import time

from quittance.plans import derived
from quittance.plans.queries import QUERIES
from quittance.session import local_session

HEADLINE = [
    "category_totals", "scan_pdf_manifest", "category_from_path", "select_page", "concat_pages",
    "explode_ocr_words", "build_payload", "base64_encode", "apply_inference", "join_responses",
    "parse_envelope", "extract_json_strip_fence", "extract_json_direct_first", "extract_json_fenced_block",
    "project_fields", "parse_label_lines", "parse_label_positions", "sparse_record", "span_decode",
    "parse_german_float", "parse_german_date", "outcome_policy_pf", "outcome_policy_mg", "outcome_policy_ba",
    "number_files", "number_global", "batch_statistics", "column_width_profile", "report_columns",
    "otsu_threshold", "binarize", "main_vat", "write_csv_by_category",
]
# In the list since the second round; not part of the total, which stays comparable.
FURTHER = ["process_documents", "process_images", "two_pass_extract", "read_bytes"]


def seconds(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    derived.staged_files(spark, sf_dir)
    times, further = {}, {}
    for name in HEADLINE:
        times[name] = round(min(seconds(spark, QUERIES[name], sf_dir) for _ in range(2)), 3)
    for name, query in {"fixture_answers": derived.answers, **{name: QUERIES[name] for name in FURTHER}}.items():
        further[name] = round(min(seconds(spark, query, sf_dir) for _ in range(2)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "further": further, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
