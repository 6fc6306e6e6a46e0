"""Invoice rules on tables: VAT, net amount, names. Money is in integer cents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def derive_net(net: Column, gross: Column, vat: Column) -> Column:
    """The net amount, or gross minus VAT where it is not given."""
    return F.coalesce(net, gross - vat)


def sum_vat(lines: DataFrame, doc: str = "doc_id", vat: str = "vat_c") -> DataFrame:
    return lines.groupBy(doc).agg(F.sum(vat).alias("vat_c"))


def _per_rate(lines: DataFrame, doc: str, rate: str, vat: str) -> DataFrame:
    """One row per document and rate; combined before the shuffle."""
    return lines.groupBy(doc, rate).agg(F.count(F.lit(1)).alias("_n"), F.sum(vat).alias("_vat"))


def dominant_vat_rate(lines: DataFrame, doc: str = "doc_id", rate: str = "rate_pct", vat: str = "vat_c") -> DataFrame:
    """The most frequent rate of a document, the higher one on ties."""
    best = F.max_by(rate, F.struct("_n", rate))
    return _per_rate(lines, doc, rate, vat).groupBy(doc).agg(best.alias("main_rate"))


def main_vat(lines: DataFrame, doc: str = "doc_id", rate: str = "rate_pct", vat: str = "vat_c") -> DataFrame:
    """VAT of the most frequent rate, found together with that rate."""
    order = F.struct("_n", rate)
    return _per_rate(lines, doc, rate, vat).groupBy(doc).agg(
        F.max_by(rate, order).alias("main_rate"), F.max_by("_vat", order).alias("main_vat_c")
    )


RESTAURANT_WORDS = ["restaurant", "gasthaus", "gasthof", "cafe", "café"]
SUPERMARKET_WORDS = ["supermarkt", "markt", "lebensmittel"]
SUPERMARKET_DEFAULT = "Einkauf"


def _mentions(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(F.lower(text), F.lit(word))
    return found


def describe_purchase(
    kind: Column, name: Column, product: Column,
    restaurant_words: list[str] = RESTAURANT_WORDS, supermarket_words: list[str] = SUPERMARKET_WORDS,
) -> Column:
    """A restaurant's name; a supermarket's name or ``Einkauf``; else the product."""
    return (
        F.when(_mentions(kind, restaurant_words), F.coalesce(name, product))
        .when(_mentions(kind, supermarket_words), F.coalesce(name, F.lit(SUPERMARKET_DEFAULT)))
        .otherwise(product)
    )


def suggest_filename(product: Column, date: Column) -> Column:
    """``product_31_5_2024.pdf``; never with the word Rechnung."""
    words = F.regexp_replace(F.lower(product), "rechnung", " ")
    slug = F.btrim(F.regexp_replace(words, r"[^\p{L}\p{N}]+", "_"), F.lit("_"))
    return F.concat(F.concat_ws("_", F.nullif(slug, F.lit("")), F.date_format(date, "d_M_yyyy")), F.lit(".pdf"))

