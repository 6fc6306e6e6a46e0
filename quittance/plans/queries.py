"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quittance import fixed_values as fv
from quittance.functions import json_text as jt, labels, scalars as sc
from quittance.operators import (
    answers as an, inference, invoice_math as im, ledger, manifest as mf, numbering, outcomes, pages, reports,
    requests as rq, responses,
)
from quittance.plans import derived as d, sample_model
from quittance.session import new_folder
from quittance.sinks import files as sinks
from quittance.sources import files as sources, listing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- flagship


@query
def category_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Documents -> outcome rows -> typed amounts -> sums per category and outcome."""
    rows = outcomes.outcome_rows(d.document_cases(spark, sf), an.TYPED)
    return rows.groupBy("category", "outcome").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(d.cents(F.col("gross_amount"))).alias("gross_c"),
        F.sum(d.cents(F.col("vat_amount"))).alias("vat_c"),
        F.sum(d.cents(F.col("net_amount"))).alias("net_c"),
        F.min("invoice_date").alias("first_date"),
    )


# ---------------------------------------------------------------- sources


def _category(path: Column) -> Column:
    return F.regexp_extract(path, "/category=([^/]*)/", 1)


def _bytes_per_category(files: DataFrame) -> DataFrame:
    suffix = F.substring_index("file_name", ".", -1)
    return files.groupBy(_category(F.col("path")).alias("category"), suffix.alias("suffix")).agg(
        F.sum("length").alias("total_bytes")
    )


@query
def scan_pdf_manifest(spark, sf):
    return _bytes_per_category(sources.scan_manifest(spark, d.staged_files(spark, sf) + "/*"))


@query
def scan_pdf_manifest_cs(spark, sf):
    return _bytes_per_category(sources.scan_manifest(spark, d.staged_files(spark, sf) + "/*", case_sensitive=True))


@query
def scan_recursive(spark, sf):
    return _bytes_per_category(sources.scan_manifest(spark, d.staged_files(spark, sf), recursive=True))


@query
def list_tree(spark, sf):
    """The listing of ``scan_recursive``, made by the executors."""
    return _bytes_per_category(listing.list_tree(spark, d.staged_files(spark, sf)))


@query
def incremental_manifest(spark, sf):
    """A second listing against the first one: some files are new, some longer, some gone."""
    key = F.col("key")
    files = d.manifest(spark, sf).select(
        "path", "file_name", F.substring_index("file_name", "_", 1).cast("long").alias("key")
    ).withColumn("modified", F.timestamp_seconds(key))
    folder = new_folder(spark, "manifest")
    first = files.filter(key % 4 != 1).withColumn("length", key)
    mf.commit_manifest(mf.manifest_changes(mf.known_manifest(spark, folder), first), folder)
    second = files.filter(key % 4 != 2).withColumn("length", F.when(key % 3 == 0, key + 1).otherwise(key))
    changes = mf.manifest_changes(mf.known_manifest(spark, folder), second)
    return changes.select("path", "file_name", "length", "state")


@query
def scan_images(spark, sf):
    return _bytes_per_category(sources.scan_images(spark, d.staged_files(spark, sf) + "/*"))


@query
def read_bytes(spark, sf):
    """The order keys out of the bytes of all files."""
    root = d.staged_files(spark, sf)
    files = listing.read_listed(sources.scan_manifest(spark, root, [".pdf", ".txt", ".png"], recursive=True))
    lines = F.split(F.decode("content", "UTF-8"), "\n")
    return files.select(_category(F.col("path")).alias("category"), F.explode(lines).alias("line")).filter(
        "line <> ''"
    ).select("category", F.col("line").cast("bigint").alias("o_orderkey"))


@query
def path_exists_guard(spark, sf):
    root = d.staged_files(spark, sf)
    found = sources.guarded_manifest(spark, root, recursive=True)
    missing = sources.guarded_manifest(spark, root + "/keine Belege")
    return found.union(missing).groupBy("outcome").agg(F.sum("length").alias("total_bytes"))


@query
def filter_by_suffix(spark, sf):
    kept = mf.filter_by_suffix(d.manifest(spark, sf))
    return kept.withColumn("exact", sc.has_suffix(F.col("file_name"), case_sensitive=True))


@query
def category_from_path(spark, sf):
    return mf.category_from_path(d.manifest(spark, sf)).select("path", "category")


@query
def basename(spark, sf):
    return d.manifest(spark, sf).select("path", sc.basename(F.col("path")).alias("name"))


# ---------------------------------------------------------------- pages, words


@query
def select_page(spark, sf):
    docs = d.documents(spark, sf).select("doc_id")
    return pages.select_page(docs, d.page_text(spark, sf), page_no=2)


@query
def first_page(spark, sf):
    return pages.first_page(d.page_text(spark, sf)).select("doc_id", "text")


@query
def concat_pages(spark, sf):
    return pages.concat_pages(d.page_text(spark, sf))


@query
def page_segments(spark, sf):
    return pages.page_segments(d.page_text(spark, sf), segment_chars=500)


@query
def explode_pages(spark, sf):
    return pages.explode_pages(d.paged_documents(spark, sf))


@query
def explode_ocr_words(spark, sf):
    return pages.explode_ocr_words(d.ocr_scans(spark, sf))


@query
def filter_confident_words(spark, sf):
    return pages.filter_confident_words(d.ocr_words(spark, sf)).select("doc_id", "text", "conf")


@query
def word_boxes(spark, sf):
    boxed = pages.word_boxes(d.ocr_words(spark, sf))
    return boxed.select(
        "doc_id", "text", *[F.get("box", F.lit(i)).alias(name) for i, name in enumerate(["x0", "y0", "x1", "y1"])]
    )


# ---------------------------------------------------------------- requests


@query
def build_prompt(spark, sf):
    return d.documents(spark, sf).select("doc_id", rq.build_prompt(F.col("text")).alias("prompt"))


def _messages() -> dict[str, Column]:
    text = F.col("text")
    system = F.lit(rq.SYSTEM_TEXT)
    return {
        "user_only": rq.build_messages([text]),
        "system_user": rq.build_messages([text], system),
        "system_two_users": rq.build_messages([F.lit(rq.DATE_INSTRUCTION), text], system),
    }


@query
def build_messages(spark, sf):
    return d.documents(spark, sf).select(
        "doc_id", *[F.to_json(messages).alias(name) for name, messages in _messages().items()]
    )


def _image() -> Column:
    return sc.base64_encode(F.encode("text", "UTF-8"))


@query
def build_multimodal_message(spark, sf):
    prompt = F.col("lang")
    return d.documents(spark, sf).select(
        "doc_id",
        F.to_json(rq.build_multimodal_message(prompt, _image())).alias("text_first"),
        F.to_json(rq.build_multimodal_message(prompt, _image(), image_first=True)).alias("image_first"),
    )


@query
def build_payload(spark, sf):
    def payload(profile: str, messages: Column) -> Column:
        return rq.build_payload(messages, F.col("source"), *rq.request_parameters(profile)).alias(profile)

    messages = _messages()
    return d.documents(spark, sf).select(
        "doc_id",
        payload("plain", messages["user_only"]),
        payload("marked", messages["system_user"]),
        payload("two_field", messages["system_two_users"]),
        payload("file_name", messages["system_user"]),
    )


@query
def base64_encode(spark, sf):
    return d.documents(spark, sf).select("doc_id", _image().alias("encoded"))


@query
def base64_decode(spark, sf):
    return d.documents(spark, sf).select(
        "doc_id", F.decode(sc.base64_decode(F.base64(F.encode("text", "UTF-8"))), "UTF-8").alias("decoded")
    )


@query
def data_url(spark, sf):
    return d.documents(spark, sf).select("doc_id", sc.data_url(_image()).alias("url"))


@query
def inline_image_prompt(spark, sf):
    return d.documents(spark, sf).select("doc_id", sc.inline_image_prompt(_image(), F.col("lang")).alias("prompt"))


@query
def choose_template(spark, sf):
    doc = F.col("doc_id")
    kind = F.get(F.array(*[F.lit(name) for name in fv.FORMAT_TYPES]), (doc % 7).cast("int"))
    custom = F.when(doc % 10 == 0, F.concat(F.lit("Eigener Text "), doc))
    return d.documents(spark, sf).select(
        "doc_id", kind.alias("format_type"),
        rq.choose_template(kind, custom).alias("template"),
        rq.choose_template(kind, language=F.col("lang")).alias("with_language"),
    )


@query
def skip_empty_text(spark, sf):
    """Prompts for the receipts that have text, NULL for the others."""
    texts = d.receipt_texts(spark, sf).withColumn("prompt", rq.build_prompt(F.col("text"), "Lies: "))
    return rq.skip_empty_text(texts).select("doc_id", "prompt")


# ---------------------------------------------------------------- inference


def _receipt_requests(spark, sf):
    texts = d.receipt_texts(spark, sf).select("doc_id", "text")
    return rq.skip_empty_text(texts.withColumn("prompt", rq.build_prompt(F.col("text")))).select("doc_id", "prompt")


def _receipt_facts(answered):
    parsed = an.parse_answers(answered, an.MARKED)
    keys = [("Rechnungsnummer", "number"), ("Datum", "day"), ("Gesamtbetrag", "gross")]
    part = F.col
    return an.field_parts(parsed, keys).select(
        "doc_id", "error", part("_t_number").alias("number"),
        jt.date_of(part("_k_day"), part("_t_day")).alias("day"),
        jt.amount_of(part("_k_gross"), part("_t_gross")).alias("gross"),
    )


@query
def apply_inference(spark, sf):
    return _receipt_facts(inference.apply_inference(_receipt_requests(spark, sf), sample_model.json_reader, parallel_calls=1))


@query
def inference_time_limits(spark, sf):
    """Some calls take longer than the limit and cost their own row only."""
    return _receipt_facts(
        inference.apply_inference(_receipt_requests(spark, sf), sample_model.hanging_reader, parallel_calls=4, limit=sample_model.LIMIT, spread=True)
    )


@query
def resumed_inference(spark, sf):
    """Half of the requests are in the ledger when all of them are asked for."""
    requests, folder = _receipt_requests(spark, sf), new_folder(spark, "ledger")
    ledger.ask_open_prompts(requests.filter("doc_id % 2 = 0"), sample_model.json_reader, folder, parallel_calls=1)
    return _receipt_facts(ledger.apply_with_ledger(requests, sample_model.json_reader, folder, parallel_calls=1))


@query
def join_responses(spark, sf):
    asked = d.table(spark, sf, "orders").select(F.col("o_orderkey").alias("request_id"))
    return inference.join_responses(asked, d.stored_answers(spark, sf), order="attempt").drop("attempt")


@query
def two_pass_extract(spark, sf):
    texts = d.receipt_texts(spark, sf).select("doc_id", "text")
    first = rq.build_prompt(F.col("text"), sample_model.FIRST_INSTRUCTION)
    second = "Angaben:\n{text}\n" + rq.LINE_INSTRUCTION
    return inference.two_pass_extract(
        texts, sample_model.two_pass_reader, first, second, parallel_calls=1
    ).drop("text")


@query
def multi_prompt_fields(spark, sf):
    texts = d.receipt_texts(spark, sf).select("doc_id", "text")
    return inference.multi_prompt_fields(texts, sample_model.field_reader, parallel_calls=1).drop("text")


# ---------------------------------------------------------------- responses, JSON


@query
def check_status(spark, sf):
    given = d.http_responses(spark, sf).select("doc_id", "status", "body")
    strict = responses.check_status(given, only_200=True).withColumnRenamed("status_error", "strict_error")
    return responses.check_status(strict, only_200=False).drop("body")


@query
def parse_envelope(spark, sf):
    given = d.http_responses(spark, sf).select("doc_id", "body")
    return responses.parse_envelope(given).select("doc_id", "envelope_state", "content", "content_type", "content_json")


@query
def envelope_fallback(spark, sf):
    given = d.http_responses(spark, sf).select("doc_id", "body")
    content = F.col("content")
    return responses.parse_envelope(given).select(
        "doc_id",
        responses.envelope_fallback(content).alias("as_object"),
        responses.trimmed_content(content).alias("as_text"),
        responses.trimmed_content(content, fv.UNNAMED_DOCUMENT).alias("as_name"),
        F.coalesce(content, F.col("body")).alias("as_body"),
    )


def _extracted(spark: SparkSession, sf: str, dialect: an.Dialect) -> DataFrame:
    parsed = an.parse_answers(d.answers(spark, sf).select("doc_id", "response"), dialect)
    return an.shown_fields(parsed).select("doc_id", "answer_kind", *[name for _, name in fv.FIELDS])


@query
def extract_json_strip_fence(spark, sf):
    return _extracted(spark, sf, an.PLAIN)


@query
def extract_json_direct_first(spark, sf):
    return _extracted(spark, sf, an.MARKED)


@query
def extract_json_fenced_block(spark, sf):
    return _extracted(spark, sf, an.TYPED)


@query
def strict_json(spark, sf):
    """Which answers are one JSON value as they stand."""
    parsed = jt.with_strict_json(d.answers(spark, sf), sc.strip(F.col("response")), "value")
    return parsed.select(
        "doc_id", F.col("value").isNotNull().alias("is_json"),
        F.try_variant_get("value", "$.Rechnungsnummer", "string").alias("number"),
    )


@query
def project_fields(spark, sf):
    parsed = an.parse_answers(d.answers(spark, sf).select("doc_id", "response"), an.TYPED)
    return an.project_fields(parsed, an.TYPED).drop("response")


@query
def validate_schema(spark, sf):
    """Schema-bound answers, of which some do not fit."""
    key = F.col("doc_id")
    amount = F.when(key % 5 != 1, F.expr("gross_c div 100"))
    record = F.to_json(
        F.struct(
            F.when(key % 5 == 2, F.col("day_text")).otherwise(F.col("day").cast("string")).alias("date"),
            amount.alias("amount"),
            F.when(key % 5 == 3, F.lit(7.5)).otherwise(F.col("rate_pct").cast("double")).alias("vat"),
            F.col("product").alias("description"),
            F.concat(F.col("number"), F.lit(".pdf")).alias("filename"),
        )
    )
    given = jt.with_strict_json(d.invoice(spark, sf), record, "answer").select("doc_id", "answer")
    return an.validate_schema(given)


# ---------------------------------------------------------------- labelled text


@query
def parse_label_lines(spark, sf):
    fields = labels.parse_label_lines(F.col("response"))
    return d.label_answers(spark, sf).select("doc_id", *[c.alias(name) for name, c in fields.items()])


@query
def label_record(spark, sf):
    """The sidecar record of labelled answers, with a suggested file name."""
    name = F.concat("number", F.lit(".pdf"))
    suggested = im.suggest_filename(F.col("issuer"), F.col("day"))
    return d.label_answers(spark, sf).select(
        sc.sidecar_filename(name).alias("name"), labels.label_record(name, F.col("response"), suggested).alias("record")
    )


@query
def parse_label_positions(spark, sf):
    fields = labels.parse_label_positions(F.col("response"))
    return d.position_answers(spark, sf).select("doc_id", *[c.alias(name) for name, c in fields.items()])


def _regex(name: str, column: Callable[[Column], Column]) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return d.regex_answers(spark, sf).select("doc_id", column(F.col("response")).alias("value"))

    QUERIES[name] = run


for _name in ("regex_amount", "regex_vat_rate", "regex_product", "regex_filename", "regex_date"):
    _regex(_name, getattr(labels, _name))


@query
def sparse_record(spark, sf):
    return d.regex_answers(spark, sf).select(
        "doc_id", labels.sparse_record(F.col("number"), F.col("response")).alias("record")
    )


def _tagged() -> Column:
    return F.concat(
        F.lit("<s_docvqa><s_number>"), F.col("number"), F.lit("</s_number>\n<s_day> "), F.col("day_text"),
        F.lit("</s_day><s_number>"), F.col("doc_id"), F.lit("</s_number></s><pad><pad>"),
    )


@query
def remove_special_tokens(spark, sf):
    return d.invoice(spark, sf).select("doc_id", labels.remove_special_tokens(_tagged()).alias("sequence"))


@query
def strip_first_tag(spark, sf):
    return d.invoice(spark, sf).select("doc_id", labels.strip_first_tag(_tagged()).alias("sequence"))


@query
def tags_to_fields(spark, sf):
    fields = labels.tags_to_fields(_tagged())
    return d.invoice(spark, sf).select(
        "doc_id", F.element_at(fields, "number").alias("number"), F.element_at(fields, "day").alias("day"),
        F.size(fields).alias("fields"),
    )


@query
def span_decode(spark, sf):
    span = labels.span_decode(F.col("start_logits"), F.col("end_logits"), F.col("tokens"))
    return d.logits(spark, sf).select("vec_id", F.array_join(span, " ").alias("span"))


# ---------------------------------------------------------------- scalars


@query
def parse_german_float(spark, sf):
    amounts = {"gross": d.german("gross_c"), "dotted": d.dotted("gross_c"), "unit": F.concat(d.german("vat_c"), F.lit(" €"))}
    return d.invoice(spark, sf).select(
        "doc_id", *[sc.parse_german_float(text).alias(name) for name, text in amounts.items()]
    )


@query
def parse_german_date(spark, sf):
    short = F.date_format("day", "d.M.yyyy")
    bent = F.regexp_replace("day_text", r"^\d\d", "31")
    two_digits = F.date_format("day", "dd.MM.yy")
    return d.invoice(spark, sf).select(
        "doc_id", *[
            sc.parse_german_date(text).alias(name)
            for name, text in {"full": F.col("day_text"), "short": short, "bent": bent, "two_digits": two_digits}.items()
        ],
    )


@query
def format_german_date(spark, sf):
    day = F.when(F.col("doc_id") % 10 != 0, F.col("day"))
    return d.invoice(spark, sf).select("doc_id", sc.format_german_date(day).alias("shown"))


@query
def format_amount(spark, sf):
    return d.invoice(spark, sf).select(
        "doc_id", sc.format_amount(d.euros("gross_c")).alias("shown"),
        sc.format_german_amount(d.euros("gross_c")).alias("german"),
    )


@query
def format_date_display(spark, sf):
    return d.invoice(spark, sf).select("doc_id", sc.format_date_display(F.col("day")).alias("shown"))


@query
def truncate_text(spark, sf):
    text = F.col("text")
    return d.documents(spark, sf).select(
        "doc_id", sc.truncate_text(text).alias("preview"),
        sc.truncate_text(text, fv.LONG_PREVIEW_LENGTH).alias("long_preview"),
    )


@query
def null_prompt_sentinels(spark, sf):
    key = F.col("doc_id")
    date = F.when(key % 4 == 0, fv.DATE_SENTINEL).otherwise(F.col("day_text"))
    amount = F.when(key % 4 == 1, fv.AMOUNT_SENTINEL).when(key % 4 == 2, fv.NOT_FOUND).otherwise(d.german("gross_c"))
    return d.invoice(spark, sf).select(
        "doc_id", sc.parse_german_date(sc.null_prompt_sentinels(date)).alias("day"),
        sc.parse_german_float(sc.null_prompt_sentinels(amount)).alias("gross"),
    )


# ---------------------------------------------------------------- outcomes


def _outcome_rows(spark: SparkSession, sf: str, dialect: an.Dialect) -> DataFrame:
    return outcomes.outcome_rows(d.document_cases(spark, sf), dialect)


@query
def outcome_policy_pf(spark, sf):
    return _outcome_rows(spark, sf, an.PLAIN).drop("path", "category", "ocr_text", "raw_response")


@query
def outcome_policy_mg(spark, sf):
    return _outcome_rows(spark, sf, an.MARKED).drop("path", "category")


@query
def outcome_policy_ba(spark, sf):
    return _outcome_rows(spark, sf, an.TYPED).drop("path", "category", "ocr_text")


@query
def process_documents(spark, sf):
    """Receipt texts through prompt, model and outcome rows."""
    key = F.col("doc_id")
    state = F.when(key % 13 == 5, "render_error").when(key % 13 == 6, "page_missing")
    texts = d.receipt_texts(spark, sf).select(
        "doc_id", F.concat("category", F.lit("/"), "number", F.lit(".pdf")).alias("path"), state.alias("input_state"),
        F.lit(None).cast("string").alias("input_error"), F.when(state.isNull(), F.col("text")).alias("ocr_text"),
    )
    rows = outcomes.process_documents(texts, sample_model.json_reader, an.MARKED, parallel_calls=1)
    return rows.select("doc_id", "outcome", "invoice_no", "invoice_date", "gross_amount", "supplier", "ocr_text")


@query
def process_images(spark, sf):
    """Page images through request, model over HTTP and typed outcome rows."""
    request = rq.image_request(F.col("image"), F.lit("m"), F.lit(rq.field_instruction()), F.lit(rq.SYSTEM_TEXT))
    rows = outcomes.process_documents(
        d.page_images(spark, sf), sample_model.image_reader, an.TYPED, request=request, http=True, page_no=2, parallel_calls=1
    )
    return rows.select("doc_id", "outcome", "invoice_no", "invoice_date", "gross_amount", "supplier", "raw_response")


@query
def labelled_sidecars(spark, sf):
    """Receipt texts through two calls on the same text to sidecar records."""
    texts = d.receipt_texts(spark, sf).select(F.concat("number", F.lit(".pdf")).alias("file_name"), "text")
    prompt = rq.build_prompt(F.col("text"), rq.LINE_INSTRUCTION)
    return inference.labelled_sidecars(texts, sample_model.label_reader, sample_model.name_reader, prompt, prompt, parallel_calls=1)


@query
def two_pass_sidecars(spark, sf):
    """Receipt texts through two passes to sparse sidecar records."""
    texts = d.receipt_texts(spark, sf).select(F.concat("number", F.lit(".pdf")).alias("file_name"), "text")
    first = rq.build_prompt(F.col("text"), sample_model.FIRST_INSTRUCTION)
    second = "Angaben:\n{text}\n" + rq.LINE_INSTRUCTION
    return inference.two_pass_sidecars(
        inference.two_pass_extract(texts, sample_model.two_pass_reader, first, second, parallel_calls=1)
    )


@query
def report_skipped(spark, sf):
    key = F.col("doc_id")
    texts = d.receipt_texts(spark, sf).select(
        "doc_id", F.when(key % 6 == 1, "").otherwise(F.col("text")).alias("text"),
        F.when(key % 4 == 3, "").when(key % 4 == 2, F.lit(None)).otherwise(F.col("number")).alias("response"),
    )
    return outcomes.report_skipped(texts).select("doc_id", "reason")


# ---------------------------------------------------------------- order, numbers, names


@query
def sort_by_name(spark, sf):
    return numbering.sort_by_name(mf.filter_by_suffix(d.manifest(spark, sf)))


def _categorised(spark: SparkSession, sf: str) -> DataFrame:
    return mf.category_from_path(d.manifest(spark, sf)).select("category", "file_name")


def _partly_categorised(spark: SparkSession, sf: str) -> DataFrame:
    """The same with some files of no known category."""
    category = F.when(~F.endswith("file_name", F.lit(".PDF")), F.col("category"))
    return _categorised(spark, sf).withColumn("category", category)


@query
def number_files(spark, sf):
    return numbering.number_files(_partly_categorised(spark, sf))


@query
def number_all_files(spark, sf):
    return numbering.number_all_files(_partly_categorised(spark, sf))


@query
def number_global(spark, sf):
    return numbering.number_global(d.manifest(spark, sf))


@query
def report_filename(spark, sf):
    category = F.col("category")
    return _categorised(spark, sf).groupBy("category").agg(F.count(F.lit(1)).alias("files")).select(
        "files", sc.report_filename(category).alias("sheet"), sc.csv_filename(category).alias("csv"),
        sc.csv_filename(category, "").alias("plain_csv"),
    )


@query
def sidecar_filename(spark, sf):
    return d.manifest(spark, sf).select("path", sc.sidecar_filename(F.col("file_name")).alias("sidecar"))


# ---------------------------------------------------------------- reports


@query
def batch_statistics(spark, sf):
    return reports.batch_statistics(_outcome_rows(spark, sf, an.MARKED), ["category"])


@query
def results_map(spark, sf):
    return reports.results_map(d.manifest(spark, sf), "path", "file_name")


def _report_names() -> list[tuple[str, str]]:
    return [("file_name", fv.FILE_HEADER), *[(n, k) for k, n in fv.FIELDS], ("raw_response", fv.RAW_HEADER)]


@query
def column_width_profile(spark, sf):
    return reports.column_width_profile(_outcome_rows(spark, sf, an.TYPED), _report_names())


@query
def report_columns(spark, sf):
    return reports.report_columns(_outcome_rows(spark, sf, an.TYPED), dialect_typed=True)


@query
def two_field_report(spark, sf):
    texts = d.receipt_texts(spark, sf).select(F.concat("number", F.lit(".pdf")).alias("file_name"), "text")
    return reports.two_field_columns(inference.multi_prompt_fields(texts, sample_model.field_reader))


@query
def mean_gate(spark, sf):
    return reports.mean_gate(d.grey_points(spark, sf), "image", "grey")


@query
def otsu_threshold(spark, sf):
    return reports.otsu_threshold(d.grey_points(spark, sf), "image", "grey")


@query
def otsu_threshold_wide(spark, sf):
    """Prices in cents as values: histograms as long as their groups."""
    return reports.otsu_threshold(d.price_points(spark, sf), "image", "price", wide=True)


@query
def binarize(spark, sf):
    points = d.grey_points(spark, sf)
    return reports.binarize(points, reports.otsu_threshold(points, "image", "grey"), "image", "grey")


# ---------------------------------------------------------------- invoice rules


@query
def derive_net(spark, sf):
    key = F.col("doc_id")
    given = F.when(key % 3 == 1, F.col("net_c") + 100).when(key % 3 == 2, F.col("net_c"))
    return d.invoice(spark, sf).select(
        "doc_id", im.derive_net(given, F.col("gross_c"), F.col("vat_c")).alias("net_c")
    )


@query
def sum_vat(spark, sf):
    return im.sum_vat(d.vat_lines(spark, sf))


@query
def main_vat(spark, sf):
    return im.main_vat(d.vat_lines(spark, sf))


@query
def dominant_vat_rate(spark, sf):
    return im.dominant_vat_rate(d.vat_lines(spark, sf))


@query
def describe_purchase(spark, sf):
    key = F.col("doc_id")
    kind = F.when(key % 4 == 0, "Restaurant-Rechnung").when(key % 4 == 1, "SUPERMARKT").otherwise("Bürobedarf")
    name = F.when(key % 3 != 0, F.col("issuer"))
    return d.invoice(spark, sf).select("doc_id", im.describe_purchase(kind, name, F.col("product")).alias("description"))


@query
def suggest_filename(spark, sf):
    product = F.concat(F.lit("Rechnung "), F.col("issuer"))
    return d.invoice(spark, sf).select("doc_id", im.suggest_filename(product, F.col("day")).alias("name"))


@query
def limit_description(spark, sf):
    long = F.concat("product", F.lit(" von "), "issuer", F.lit(" bestellt, geliefert und bezahlt"))
    return d.invoice(spark, sf).select(
        "doc_id", sc.limit_description(long).alias("short"),
        sc.limit_description(long, fv.LONG_DESCRIPTION).alias("long"),
    )


# ---------------------------------------------------------------- sinks


@query
def write_csv_by_category(spark, sf):
    """Write the CSV tables, then read them back."""
    rows = reports.report_columns(_outcome_rows(spark, sf, an.MARKED), dialect_typed=False, with_ocr=True)
    folder = new_folder(spark, "csv")
    sinks.write_csv_by_category(rows, folder)
    columns = [c for c in rows.columns if c != "category"]
    schema = ", ".join(f"`{c}` string" for c in [*columns, "category"])
    return sinks.read_csv_by_category(spark, folder, schema)


@query
def write_json_sidecars(spark, sf):
    rows = d.regex_answers(spark, sf)
    records = rows.select(
        sc.sidecar_filename(F.concat("number", F.lit(".pdf"))).alias("name"),
        labels.sparse_record(F.col("number"), F.col("response")).alias("record"),
    )
    folder = new_folder(spark, "sidecars")
    sinks.write_json_sidecars(records, folder)
    return spark.read.schema("name string, record string").json(folder)


@query
def write_json_sidecars_bucketed(spark, sf):
    """The same, dealt to files by name; read back with the number of files that hold a name."""
    records = d.regex_answers(spark, sf).select(
        sc.sidecar_filename(F.concat("number", F.lit(".pdf"))).alias("name"), labels.sparse_record(F.col("number"), F.col("response")).alias("record")
    )
    folder = new_folder(spark, "sidecars")
    sinks.write_json_sidecars(records, folder, buckets=16)
    rows = spark.read.schema("name string, record string, bucket int").json(folder)
    return rows.groupBy("name").agg(F.min("record").alias("record"), F.count_distinct("bucket").alias("files"))


@query
def write_results_json(spark, sf):
    folder = new_folder(spark, "results")
    sinks.write_results_json(reports.results_map(d.manifest(spark, sf), "path", "file_name"), folder)
    return spark.read.text(folder).withColumnRenamed("value", "entry")
