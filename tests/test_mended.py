"""Cases that once went wrong: long bad answers, lost rows, odd numbers, repeated answers, folders."""

from __future__ import annotations

import json
import random
import re
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quittance.functions import json_text as jt, labels, scalars as sc
from quittance.operators import inference, invoice_math as im, numbering, outcomes, reports, requests as rq
from quittance.operators.answers import MARKED, TYPED
from quittance.session import shared_folder
from quittance.sources import files as sources

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMS = {
    "widest": (jt.widest_object, lambda t: m[0] if (m := re.search(r"\{[\s\S]*\}", t)) else ""),
    "fence": (jt.without_fence, lambda t: re.sub(r"\s*```$", "", re.sub(r"^```(?:json)?\s*", "", t))),
    "fenced": (jt.fenced_object, lambda t: m[1] if (m := re.search(r"```(?:json)?\s*(\{[\s\S]*?\})\s*```", t)) else ""),
    "product": (labels.regex_product, lambda t: m[1].strip()[:50] if (m := re.search(r"Produktbezeichnung:\s*(.*?)\n", t)) else None),
}


@pytest.mark.parametrize("form", sorted(FORMS))
def test_searches_equal_their_patterns(column, form):
    rnd = random.Random(form)
    parts = ["{", "}", "```", "json", " ", "\n", "a", '"', "Produktbezeichnung:", "\t", "```json\n{", "}\n```"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(4000)]
    spark, python = FORMS[form]
    assert column(spark, texts) == [python(text) for text in texts]


@pytest.mark.parametrize(
    "text", ['{"a":' * 200_000, "```" + " " * 1_000_000 + "x", "```json " * 120_000, "<s_a>" * 200_000, "Produktbezeichnung:" + " " * 1_000_000],
    ids=["braces", "blanks", "fences", "tags", "label"],
)
def test_long_bad_answers_take_linear_time(spark, text):
    value = F.col("x")
    frame = spark.createDataFrame([(text,)], "x string").select(
        jt.widest_object(value), jt.without_fence(value), jt.fenced_object(value), labels.tags_to_fields(value), labels.regex_product(value)
    )
    start = time.perf_counter()
    frame.collect()
    assert time.perf_counter() - start < 10


def test_tags(column):
    texts = ["<s_a>1</s_a><s_b> <x> </s_b><s_a>2</s_a>", "<s_d><s_a>1</s_a></s_d>", "<s_a>", "</s_a>", "<s_a>1<s_b>2</s_b></s_a>"]
    assert column(labels.tags_to_fields, texts) == [{"a": "2", "b": "<x>"}, {"a": "1"}, {}, {}, {"b": "2"}]


NUMBERS = [
    "1", "-3", "9223372036854775807", "9223372036854775808", "12345678901234567890123", "100.00", "1.5", "-0.25", "0.00001", "1.0e20", "1e5",
    "2.5E-7", "123456789.125", "1e16", "0.0001", "1234567.0",
]


@pytest.mark.parametrize("number", NUMBERS)
def test_json_numbers_as_python_shows_them(spark, number):
    frame = spark.createDataFrame([(f'{{"x":{number}}}',)], "t string")
    frame = jt.with_strict_json(frame, F.col("t"), "v").select(jt.field_kind(F.col("v"), "x").alias("k"), jt.field_text(F.col("v"), "x").alias("t"))
    assert frame.select(jt.shown_text(F.col("k"), F.col("t"))).first()[0] == str(json.loads(number))


def test_floats_as_python_shows_them(spark):
    values = [1e16, 1.5e16, 1e-5, 1.25e-7, 1e100, -1e-300, float("inf"), float("-inf"), float("nan"), 1e15, 0.0001, 123.0, -1e22]
    frame = spark.createDataFrame([(v,) for v in values], "v double").select(sc.float_text(F.col("v")).alias("t"))
    assert [row.t for row in frame.collect()] == [repr(v) for v in values]


def test_no_text_fakes_the_end_of_a_candidate(spark):
    texts = ['{"a":"#quittance-end-of-candidate#"}', '1,"x"]', "[1] [2]", '{"a":1}']
    frame = jt.with_strict_json(spark.createDataFrame([(t,) for t in texts], "t string"), F.col("t"), "v")
    assert [row[0] for row in frame.select(F.col("v").isNotNull()).collect()] == [True, False, False, True]


def test_files_without_category_are_numbered(spark, tmp_path):
    rows = [("a", "1.pdf"), (None, "2.pdf"), (None, "3.pdf"), ("b", "4.txt")]
    frame = spark.createDataFrame(rows, "category string, file_name string")
    found = {r.file_name: r.number for r in numbering.number_all_files(frame).collect()}
    assert found == {"1.pdf": 0, "2.pdf": 0, "3.pdf": 1, "4.txt": 0}
    own = numbering.number_rows(frame, ["file_name"], ["category"], folder=str(tmp_path / "placed"))
    assert {r.file_name: r.number for r in own.collect()} == found and (tmp_path / "placed").exists()


def test_points_without_image_keep_their_bit(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 9), (None, 2), (None, 8), (None, 8)], "image string, grey int")
    thresholds = reports.otsu_threshold(frame, "image", "grey")
    for salts in (1, 4):
        bits = sorted(((r.image or "", r.grey, r.bit) for r in reports.binarize(frame, thresholds, "image", "grey", salts).collect()))
        assert bits == [("", 2, 0), ("", 8, 255), ("", 8, 255), ("a", 1, 0), ("a", 9, 255)]
    gate = {r.image: r.mean for r in reports.mean_gate(frame, "image", "grey").collect()}
    assert gate == {"a": 5.0, None: 6.0}


def test_shared_folder_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_exactly_the_listed_files(spark, tmp_path):
    for name in ("a.pdf", "b.pdf", "c.pdf"):
        (tmp_path / name).write_bytes(name.encode())
    listed = sources.scan_manifest(spark, str(tmp_path)).filter("file_name <> 'b.pdf'")
    missing = listed.limit(1).select(F.concat("path", F.lit("x")).alias("path"), "file_name", "length", "modified")
    found = sources.bytes_of_manifest(listed.union(missing), sources.read_bytes(spark, str(tmp_path))).collect()
    assert sorted((r.path.rsplit("/")[-1], r.content and bytes(r.content)) for r in found) == [("a.pdf", b"a.pdf"), ("a.pdfx", None), ("c.pdf", b"c.pdf")]


def test_widths_of_failed_rows(spark):
    frame = spark.createDataFrame(
        [("k", None, None, "no_json")], "category string, invoice_date date, gross_amount double, outcome string"
    )
    widths = reports.column_width_profile(frame, [("invoice_date", "Datum"), ("gross_amount", "G"), ("category", "Roh")])
    assert {r.header: r.width for r in widths.collect()} == {"Datum": 8, "G": 8, "Roh": 5}


def test_one_answer_per_request(spark):
    asked = spark.createDataFrame([(1,), (2,), (3,)], "request_id int")
    given = spark.createDataFrame([(1, "b", 2), (1, "c", 1), (1, None, 0), (2, None, 1)], "request_id int, response string, attempt int")
    by_order = {r.request_id: (r.response, r.response_state) for r in inference.join_responses(asked, given, order="attempt").collect()}
    assert by_order == {1: ("c", "ok"), 2: (None, "ok"), 3: (None, "no_response")}
    by_text = {r.request_id: r.response for r in inference.join_responses(asked, given.drop("attempt")).collect()}
    assert by_text == {1: "b", 2: None, 3: None}


def _echo_http():
    def ask(prompt):
        if "bumm" in prompt:
            raise TimeoutError("zu spät")
        if "leer" in prompt:
            return None, None
        return (503, "weg") if "weg" in prompt else (200, json.dumps({"choices": [{"message": {"content": '{"Datum":"01.02.2024"}'}}]}))

    return ask


def test_calls_with_status_and_body(spark):
    schema = "path string, input_state string, input_error string, ocr_text string"
    rows = [("a", None, None, "x"), ("b", None, None, "bumm"), ("c", None, None, "weg"), ("d", "page_missing", None, None), ("e", None, None, "leer")]
    found = outcomes.process_documents(spark.createDataFrame(rows, schema), _echo_http, MARKED, http=True, page_no=4, parallel_calls=1)
    by_path = {r.path: (r.outcome, r.invoice_date, r.raw_response) for r in found.collect()}
    assert by_path["a"][:2] == ("missing_fields", "01.02.2024")
    assert by_path["b"][0] == by_path["e"][0] == "no_response"
    assert by_path["c"] == ("http_error", "FEHLER", "API-Anfragefehler: 503 Server Error")
    assert by_path["d"][2] == "PDF d hat keine Seite 4 oder konnte nicht gelesen werden."


def test_request_with_an_image(spark):
    frame = spark.range(1).select(rq.image_request(F.lit("QUJD"), F.lit('m"1'), F.lit("Lies\n"), F.lit("Du bist")).alias("r"))
    assert json.loads(frame.first().r) == {
        "model": 'm"1', "temperature": 0.1, "max_tokens": 2048, "stream": False,
        "messages": [
            {"role": "system", "content": "Du bist"},
            {"role": "user", "content": [
                {"type": "text", "text": "Lies\n"}, {"type": "image_url", "image_url": {"url": "data:image/png;base64,QUJD"}},
            ]},
        ],
    }


@pytest.mark.parametrize(
    ("content", "marked", "typed"),
    [
        (None, "'NoneType' object has no attribute 'strip'", "'NoneType' object is not subscriptable"),
        (5, "'int' object has no attribute 'strip'", "'int' object is not subscriptable"),
        (1.5, "'float' object has no attribute 'strip'", "'float' object is not subscriptable"),
        (False, "'bool' object has no attribute 'strip'", "'bool' object is not subscriptable"),
        ([], "'list' object has no attribute 'strip'", "Keine LLM Antwort"),
        (["x"], "'list' object has no attribute 'strip'", '["x"]'),
        ({"a": 1}, "'dict' object has no attribute 'strip'", "unhashable type: 'slice'"),
    ],
)
def test_contents_that_are_no_text(spark, content, marked, typed):
    body = json.dumps({"choices": [{"message": {"content": content}}]})
    schema = "path string, input_state string, input_error string, ocr_text string, status int, body string"
    frame = spark.createDataFrame([("p", None, None, "x", 200, body)], schema)
    for dialect, expected in ((MARKED, marked), (TYPED, typed)):
        row = outcomes.outcome_rows(frame, dialect).first()
        assert (row.outcome, row.invoice_no, row.raw_response) == ("bad_envelope", "FEHLER", expected)


def test_words_are_no_patterns(column):
    kinds = ["C.A.F.E. (Wien)", "cxaxfxe", "Cafe"]
    found = column(lambda c: im.describe_purchase(c, F.lit("Name"), F.lit("Ware"), ["c.a.f.e. (wien)"]), kinds)
    assert found == ["Name", "Ware", "Ware"]
