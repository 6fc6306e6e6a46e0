"""Labelled lines, patterns, tags and spans."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quittance.functions import labels


def fields(spark, function, text):
    columns = function(F.col("x"))
    return spark.createDataFrame([(text,)], "x string").select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


@pytest.mark.parametrize(
    "text, date, amount, vat, description",
    [
        ("Datum: 1.1.2024\nBetrag: 5,00\nMwSt: 19\nBeschreibung: Maus", "1.1.2024", "5,00", "19", "Maus"),
        ("Betrag: 1\nBetrag: 2 ", None, "2", None, None),
        ("Betrag: 5\nMwSt-Betrag: 2,00", None, "2,00", None, None),
        ("Datum der Beschreibung: x", "x", None, None, None),
        ("Beschreibung: Zeit: 12:30", None, None, None, "30"),
        ("Datum 3. Mai", "Datum 3. Mai", None, None, None),
        ("Datum:\nBetrag:", "", "", None, None),
        ("datum: klein", None, None, None, None),
        ("", None, None, None, None),
        ("\n\nMwSt: 7\n\n", None, None, "7", None),
    ],
)
def test_lines(spark, text, date, amount, vat, description):
    expected = {"date": date, "amount": amount, "vat": vat, "description": description}
    assert fields(spark, labels.parse_label_lines, text) == expected


def test_lines_of_a_long_text(spark):
    text = "\n".join(["Zeile ohne Marke " * 20] * 3000 + ["Betrag: 1", "x" * 100_000])
    assert fields(spark, labels.parse_label_lines, text)["amount"] == "1"


@pytest.mark.parametrize(
    "text, date, vat_amount, vat_percent, item",
    [
        ("Datum: 1\nMwSt. Betrag: 2\nMwSt. Prozent: 3\nKaufobjekt: 4", "1", "2", "3", "4"),
        ("Datum: 1 Kaufobjekt: 4", "1 Kaufobjekt: 4", None, None, "4"),
        ("Das Datum fehlt\nKaufobjekt: 4", None, None, None, None),
        ("MwSt. Betrag: 2\nDatum: 1", None, None, None, None),
        ("Datum: 1 Datum: 2", "1", None, None, None),
        ("Datum:", "", None, None, None),
        ("nichts", None, None, None, None),
        ("MwStX Betrag", None, None, None, None),
    ],
)
def test_positions(spark, text, date, vat_amount, vat_percent, item):
    expected = {"date": date, "vat_amount": vat_amount, "vat_percent": vat_percent, "item": item}
    assert fields(spark, labels.parse_label_positions, text) == expected


@pytest.mark.parametrize(
    "function, text, expected",
    [
        (labels.regex_amount, "Betrag: 12,50 €", "12,50 €"),
        (labels.regex_amount, "Betrag:1.234,56", "1"),
        (labels.regex_amount, "Betrag: 5 Euro, Betrag: 6", "5"),
        (labels.regex_amount, "Betrag: \n 7,1", "7,1"),
        (labels.regex_amount, "Betrag: keiner", None),
        (labels.regex_vat_rate, "MwSt: 19%", "19"),
        (labels.regex_vat_rate, "MwSt:  7,0 %", "7,0"),
        (labels.regex_vat_rate, "MwSt. 19", None),
        (labels.regex_product, "Produktbezeichnung: Maus \nx", "Maus"),
        (labels.regex_product, "Produktbezeichnung: Maus", None),
        (labels.regex_product, "Produktbezeichnung:\n\nMaus\n", "Maus"),
        (labels.regex_product, "Produktbezeichnung: \n\n", ""),
        (labels.regex_product, "Produktbezeichnung: " + "ä" * 60 + "\n", "ä" * 50),
        (labels.regex_filename, "Dateiname: maus.pdf.pdf x.pdf", "maus.pdf.pdf"),
        (labels.regex_filename, "Dateiname: a b.pdf", None),
        (labels.regex_date, "am 01.02.2024 und 03.04.2025", "01.02.2024"),
        (labels.regex_date, "x01.02.2024", None),
        (labels.regex_date, "1.2.2024", None),
        (labels.strip_first_tag, "<a>x <b>", "x <b>"),
        (labels.strip_first_tag, "<a\nb> x <c> y", "<a\nb> x  y"),
        (labels.strip_first_tag, " x ", "x"),
        (labels.strip_first_tag, "eins\n<t>\nzwei <u>", "eins\n\nzwei <u>"),
        (labels.remove_special_tokens, "a</s><pad>b<pad>", "ab"),
    ],
)
def test_patterns(column, function, text, expected):
    assert column(function, [text]) == [expected]


def test_sparse_record_has_only_found_keys(column):
    found = column(lambda c: labels.sparse_record(F.lit("quelle"), c), ["Betrag: 5 €\n", "nix"])
    assert [json.loads(text) for text in found] == [
        {"Betrag": "5 €", "extracted_text-1": "quelle", "response_content-2": "Betrag: 5 €\n"},
        {"extracted_text-1": "quelle", "response_content-2": "nix"},
    ]


def test_tags(column):
    texts = ["<s_a>1</s_a><s_b>\n2 </s_b>", "<s_a>1</s_a><s_a>3</s_a>", "<s_a>1</s_b>", ""]
    assert column(labels.tags_to_fields, texts) == [{"a": "1", "b": "2"}, {"a": "3"}, {}, {}]


@pytest.mark.parametrize(
    "start, end, expected",
    [
        ([0.1, 0.9, 0.2], [0.0, 0.1, 0.8], ["b", "c"]), ([0.9, 0.9, 0.2], [0.5, 0.5, 0.1], ["a"]),
        ([0.0, 0.0, 1.0], [1.0, 0.0, 0.0], []), ([0.0, 1.0, 0.0], [0.0, 1.0, 0.0], ["b"]),
    ],
)
def test_spans(spark, start, end, expected):
    frame = spark.createDataFrame([(start, end, ["a", "b", "c"])], "s array<float>, e array<float>, t array<string>")
    assert frame.select(labels.span_decode(F.col("s"), F.col("e"), F.col("t")).alias("x")).first().x == expected
