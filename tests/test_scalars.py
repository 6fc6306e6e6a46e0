"""Edge values; expectations from the standard library where it defines them."""

from __future__ import annotations

import base64
import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from quittance.functions import scalars as sc

NUMBERS = [
    "1.234,56", "19.00", " 7,5 ", "12,50 €", "", "1,2,3", "-5,00", "+3", "1e5", "1E-2", "1d", "1f", "0x1p3", "1,", ",5",
    ",", "1.234.56", "nan", "-NaN", "inf", "-Infinity", "infinit", "1_000", "1__0", "_1", "1_", " 7,5 ",
    "\t8\n", "--1", "1 2", "NICHT GEFUNDEN", None,
]


def as_python(text):
    try:
        return float(text.replace(".", "").replace(",", "."))
    except (ValueError, AttributeError):
        return None


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_german_floats(column):
    found = column(sc.parse_german_float, NUMBERS)
    wrong = [(t, f, as_python(t)) for t, f in zip(NUMBERS, found) if not same(f, as_python(t))]
    assert wrong == []


def test_random_german_floats(column):
    rng = random.Random(7)
    texts = ["".join(rng.choice("0123456789.,-+e_ ") for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    found = column(sc.parse_german_float, texts)
    wrong = [(t, f, as_python(t)) for t, f in zip(texts, found) if not same(f, as_python(t))]
    assert wrong == []


@pytest.mark.parametrize(
    "text, expected",
    [
        ("5.1.2024", datetime.date(2024, 1, 5)), ("05.12.2024", datetime.date(2024, 12, 5)),
        ("29.02.2024", datetime.date(2024, 2, 29)), ("31.02.2024", None), ("29.02.2023", None), ("005.1.2024", None),
        ("01.01.0000", None), ("01.01.24", None), ("01.01.2024 ", None), ("2024-01-05", None), ("", None), (None, None),
        ("00.01.2024", None), ("1.13.2024", None), ("01.01.1900", datetime.date(1900, 1, 1)),
    ],
)
def test_german_dates(column, text, expected):
    assert column(sc.parse_german_date, [text]) == [expected]


def test_random_german_dates(column):
    def as_date(text):
        try:
            return datetime.datetime.strptime(text, "%d.%m.%Y").date()
        except ValueError:
            return None

    rng = random.Random(11)
    texts = [
        rng.choice(["", "", "", " ", "  "]) + f"{rng.randint(0, 32):{rng.choice(['d', '02d'])}}"
        f".{rng.randint(0, 13):{rng.choice(['d', '02d'])}}.{rng.choice(['0000', '0999', '1900', '2023', '2024', '24'])}"
        + rng.choice(["", "", "", " ", "\n"])
        for _ in range(3000)
    ]
    found = column(sc.parse_german_date, texts)
    assert [(t, f, as_date(t)) for t, f in zip(texts, found) if f != as_date(t)] == []


def test_strip_is_unicode_strip(column):
    spaces = [chr(code) for code in range(0x3001) if chr(code).isspace()]
    texts = [space + "a b" + space * 2 for space in spaces] + ["", "  ", "a"]
    assert column(sc.strip, texts) == [text.strip() for text in texts]


def test_float_text_prints_as_python(spark):
    values = [0.0, 1.0, 1234.5, 1e7, 12345678.25, 1e15 + 0.5, 0.001, 0.00012, 99999.99, -5.25, 123456789.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(sc.float_text(F.col("v")).alias("t"))
    assert [row.t for row in rows.collect()] == [str(v) for v in values]


def test_base64_on_one_line(column):
    text = "Größe " * 200
    encoded = base64.b64encode(text.encode()).decode()
    assert column(lambda c: sc.base64_encode(F.encode(c, "UTF-8")), [text]) == [encoded]
    assert column(lambda c: F.decode(sc.base64_decode(c), "UTF-8"), [encoded]) == [text]


def test_amounts_and_dates_for_display(spark):
    row = spark.range(1).select(
        sc.format_amount(F.lit(1234567.891)).alias("a"), sc.format_german_amount(F.lit(1234567.891)).alias("g"),
        sc.format_german_date(F.lit(None).cast("date")).alias("d"),
    ).first()
    assert (row.a, row.g, row.d) == ("1,234,567.89", "1.234.567,89", "NICHT GEFUNDEN")


def test_names(column):
    assert column(sc.report_filename, ["Steuer Berater 24"]) == ["Extraktion_Steuer_Berater_24.xlsx"]
    assert column(sc.csv_filename, ["Bewirtung"]) == ["extraktion_Bewirtung.csv"]
    assert column(sc.sidecar_filename, ["a.pdf"]) == ["a.pdf.json"]
    assert column(sc.basename, ["x/y/a.pdf", "a.pdf", "x/"]) == ["a.pdf", "a.pdf", ""]


def test_sentinels(column):
    assert column(sc.null_prompt_sentinels, ["01.01.1900", "00,00", "NICHT GEFUNDEN", "0,00", None]) == [
        None, None, None, "0,00", None,
    ]
