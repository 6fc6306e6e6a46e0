"""One row per document in every situation, per dialect."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quittance.operators.answers import MARKED, PLAIN, TYPED
from quittance.operators.outcomes import left_out, outcome_rows, report_skipped

SCHEMA = (
    "file_name string, path string, input_state string, input_error string, ocr_text string, status int, body string"
)
FULL = {
    "Rechnungsnummer": "R1", "Datum": "05.12.2024", "Bezeichnung": "Maus", "MwSt-Satz": "19,00", "MwSt-Betrag": "1,90",
    "Gesamtbetrag": "11,90", "Nettobetrag": "10,00", "Lieferant": "A",
}


def body(content):
    return json.dumps({"choices": [{"message": {"content": content}}]})


def doc(name, state=None, error=None, text="Text", status=200, answer=None, raw=None):
    content = raw if raw is not None else (body(answer) if status is not None else None)
    return (f"{name}.pdf", f"/b/{name}.pdf", state, error, text, status, content)


ALL = json.dumps(FULL)
PART = json.dumps({k: v for k, v in FULL.items() if k != "Datum"})
DOCUMENTS = [
    doc("full", answer=ALL),
    doc("part", answer=PART),
    doc("prose", answer="nichts"),
    doc("empty", answer="{}"),
    doc("blank_answer", answer=""),
    doc("list", answer="[]"),
    doc("blank", text=" \n", answer=ALL),
    doc("render", "render_error", "kaputt", None, None),
    doc("page", "page_missing", None, None, None),
    doc("s500", status=500, raw="weg"),
    doc("s404", status=404, raw="wo"),
    doc("s202", status=202, answer=ALL),
    doc("shape", raw='{"error":"x"}'),
    doc("html", raw="<html>"),
    doc("number", answer=5),
    doc("none", status=None),
]
E, N = "FEHLER", "NICHT GEFUNDEN"
# outcome and invoice number; the raw text only where a column for it exists
EXPECTED = {
    "plain": {
        "full": ("ok", "R1"), "part": ("missing_fields", "R1"), "prose": ("no_json", ""), "empty": ("no_json", ""),
        "blank_answer": ("no_json", ""), "list": ("no_json", ""), "blank": ("ok", "R1"), "render": ("render_error", ""),
        "page": ("page_missing", ""), "s500": ("http_error", ""), "s404": ("http_error", ""), "s202": ("http_error", ""),
        "shape": ("bad_envelope", ""), "html": ("bad_envelope", ""), "number": ("bad_envelope", ""),
        "none": ("no_response", ""),
    },
    "marked": {
        "full": ("ok", "R1", ALL), "part": ("missing_fields", "R1", PART), "prose": ("no_json", N, "nichts"),
        "empty": ("no_json", N, "{}"), "blank_answer": ("no_json", N, ""),
        "list": ("not_object", E, "'list' object has no attribute 'get'"), "blank": ("empty_text", N, ""),
        "render": ("render_error", N, ""),
        "page": ("page_missing", E, "PDF /b/page.pdf hat keine Seite 0 oder konnte nicht gelesen werden."),
        "s500": ("http_error", E, "API-Anfragefehler: 500 Server Error"),
        "s404": ("http_error", E, "API-Anfragefehler: 404 Client Error"), "s202": ("ok", "R1", ALL),
        "shape": ("bad_envelope", N, "{}"), "html": ("bad_envelope", E, "API-Anfragefehler: unreadable body"),
        "number": ("bad_envelope", E, "'int' object has no attribute 'strip'"),
        "none": ("no_response", E, "API-Anfragefehler: no response"),
    },
    "typed": {
        "full": ("ok", "R1", ALL), "part": ("missing_fields", "R1", PART), "prose": ("no_json", E, "nichts"),
        "empty": ("no_json", E, "{}"), "blank_answer": ("no_json", E, "Keine LLM Antwort"), "list": ("no_json", E, "[]"),
        "blank": ("ok", "R1", ALL), "render": ("render_error", E, "kaputt"),
        "page": ("page_missing", E, "PDF /b/page.pdf hat keine Seite 0 oder konnte nicht gelesen werden."),
        "s500": ("http_error", E, "API-Anfragefehler: 500 Server Error"),
        "s404": ("http_error", E, "API-Anfragefehler: 404 Client Error"), "s202": ("ok", "R1", ALL),
        "shape": ("bad_envelope", E, "{}"), "html": ("bad_envelope", E, "API-Anfragefehler: unreadable body"),
        "number": ("bad_envelope", E, "'int' object is not subscriptable"),
        "none": ("no_response", E, "API-Anfragefehler: no response"),
    },
}


@pytest.mark.parametrize("dialect", [PLAIN, MARKED, TYPED], ids=lambda d: d.name)
def test_matrix(spark, dialect):
    rows = outcome_rows(spark.createDataFrame(DOCUMENTS, SCHEMA), dialect).collect()
    assert len(rows) == len(DOCUMENTS)
    found = {r.file_name[:-4]: (r.outcome, r.invoice_no, r.raw_response) for r in rows}
    expected = EXPECTED[dialect.name]
    assert {name: value[: len(expected[name])] for name, value in found.items()} == expected


def test_typed_values(spark):
    rows = outcome_rows(spark.createDataFrame(DOCUMENTS, SCHEMA), TYPED)
    by_name = {r.file_name: r for r in rows.collect()}
    full, part, bad = by_name["full.pdf"], by_name["part.pdf"], by_name["s500.pdf"]
    assert (str(full.invoice_date), full.vat_amount, full.gross_amount, full.net_amount) == ("2024-12-05", 1.9, 11.9, 10.0)
    assert (part.invoice_date, part.supplier) == (None, "A")
    assert (bad.invoice_date, bad.gross_amount, bad.supplier) == (None, None, "FEHLER")


def test_no_shuffle_and_one_parse_per_text(spark, tmp_path):
    spark.createDataFrame(DOCUMENTS, SCHEMA).write.parquet(str(tmp_path / "in"))
    plan = outcome_rows(spark.read.parquet(str(tmp_path / "in")), TYPED)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count(".parseJson(") == 2  # the body and the answer


def test_skipped(spark):
    frame = spark.createDataFrame(
        [("a", "t", "x"), ("b", "", "x"), ("c", "t", ""), ("d", "t", None), ("e", None, None)],
        "file_name string, text string, response string",
    )
    skipped = {row.file_name: row.reason for row in report_skipped(frame).collect()}
    assert skipped == {"b": "no_text", "c": "no_info", "d": "no_info", "e": "no_text"}
    assert {r.file_name for r in left_out(frame, frame.filter(F.col("file_name") < "c")).collect()} == {"c", "d", "e"}
