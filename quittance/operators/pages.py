"""Pages of documents and words of pages.

A page row is ``(doc_id, page_no, text)`` with page numbers from 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quittance import fixed_values as fv
from quittance.operators.running import running_sums

SEGMENT_CHARS = 1 << 20
WORD_LISTS = ["text", "conf", "left", "top", "width", "height"]


def explode_pages(documents: DataFrame, pages: str = "pages", doc: str = "doc_id") -> DataFrame:
    """A list of pages per document -> one row per page."""
    return documents.select(doc, F.posexplode(pages).alias("page_no", "text"))


def select_page(documents: DataFrame, pages: DataFrame, page_no: int = 0, doc: str = "doc_id") -> DataFrame:
    """Page ``page_no`` of every document; ``page_missing`` where it does not exist.

    The page filter comes first: it reaches the scan, and what is joined holds
    at most one row per document.
    """
    wanted = pages.filter(F.col("page_no") == page_no).select(doc, "text", F.lit(True).alias("_found"))
    return documents.join(wanted, doc, "left").select(
        *documents.columns,
        F.col("text").alias("page_text"),
        F.when(F.col("_found"), "ok").otherwise("page_missing").alias("page_state"),
    )


def first_page(pages: DataFrame) -> DataFrame:
    """Page 0 of every document that has pages: a filter, no shuffle."""
    return pages.filter(F.col("page_no") == 0)


def concat_pages(pages: DataFrame, doc: str = "doc_id") -> DataFrame:
    """All pages of a document in page order, joined without a separator.

    The group is one document's text, which has to fit one cell in any case.
    """
    ordered = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    return pages.groupBy(doc).agg(F.array_join(ordered["text"], "").alias("text"))


def page_segments(pages: DataFrame, doc: str = "doc_id", segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """``concat_pages`` for documents of any number of pages: (doc, segment_no, first_page, text).

    A segment holds whole pages, in order; a page belongs to the segment in which its
    first character lies, counted in stretches of ``segment_chars`` from 0. So no
    segment has more text than that and one page, and the segments of a document, by
    number, are its text. Numbers have a gap where a page is longer than a stretch. The characters before a page are running sums split over tasks, so
    that a document of any length is worked on by many. Page numbers are unique within a document;
    a NULL text has no characters, a NULL document is one like others.
    """
    measured = pages.select(doc, "page_no", "text", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("_chars"))
    sizes = running_sums(measured.drop("text"), [doc], ["page_no"], ["_chars"])
    place = F.floor((F.col("_chars_upto") - F.col("_chars")) / segment_chars).alias("segment_no")
    of = sizes.select(F.col(doc).alias("_doc"), F.col("page_no").alias("_page"), place)
    placed = measured.join(of, F.col(doc).eqNullSafe(F.col("_doc")) & (F.col("page_no") == F.col("_page")))
    ordered = F.array_sort(F.collect_list(F.struct("page_no", "text")))
    return placed.groupBy(doc, "segment_no").agg(F.min("page_no").alias("first_page"), F.array_join(ordered["text"], "").alias("text"))


def explode_ocr_words(scans: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Parallel lists per scan -> one row per word."""
    return scans.select(doc, F.inline(F.arrays_zip(*WORD_LISTS)))


def filter_confident_words(words: DataFrame, above: int = fv.MIN_WORD_CONFIDENCE) -> DataFrame:
    return words.filter(F.col("conf").cast("int") > above)


def word_boxes(words: DataFrame) -> DataFrame:
    """Position and size -> corner coordinates ``[x0, y0, x1, y1]``."""
    box = F.array("left", "top", F.col("left") + F.col("width"), F.col("top") + F.col("height"))
    return words.withColumn("box", box)
