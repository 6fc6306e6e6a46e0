"""One row per document, whatever happened to it.

Input rows carry ``file_name, path, input_state, input_error, ocr_text`` and
either an HTTP response (``status, body``, NULL where none came back) or a plain
answer (``response, error``). ``input_state`` is NULL, ``render_error`` or
``page_missing``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from quittance import fixed_values as fv
from quittance.functions.scalars import strip
from quittance.operators.answers import Dialect, parse_answers, project_fields
from quittance.operators.inference import Ask, AskHttp, apply_http, apply_inference
from quittance.operators.ledger import apply_with_ledger
from quittance.operators.requests import build_prompt, skip_empty_text
from quittance.operators.responses import http_message, parse_envelope, request_message, status_failed

INPUT_COLUMNS = ["input_state", "input_error", "ocr_text", "status", "body", "response", "error"]


def outcome_rows(documents: DataFrame, dialect: Dialect, page_no: int = 0) -> DataFrame:
    """Eight fields, ``raw_response`` and ``outcome`` for every document with its HTTP response.

    Outcomes: ok, missing_fields, no_json, not_object, empty_text,
    render_error, page_missing, http_error, bad_envelope, no_response.
    No shuffle; the body and the answer are parsed once each.
    """
    status, state = F.col("status"), F.col("envelope_state")
    failed = status_failed(status, dialect.only_status_200)
    early = (
        _before_call(dialect)
        .when(status.isNull(), "no_response").when(failed, "http_error").when(state != "ok", "bad_envelope")
    )
    failure = (
        F.when(status.isNull(), request_message(F.lit("no response")))
        .when(failed, http_message(status, F.col("body"), dialect.only_status_200))
        .when(state == "no_content", fv.EMPTY_OBJECT)
        .when(state == "not_text", _content_message(dialect))
        .when(state != "ok", request_message(F.lit("unreadable body")))
    )
    opened = parse_envelope(documents).select("*", early.alias("_early"), failure.alias("_failure"))
    return _finish(opened.withColumnRenamed("content", "_content"), documents, dialect, page_no)


def answer_rows(documents: DataFrame, dialect: Dialect, page_no: int = 0) -> DataFrame:
    """The same for documents with a plain answer, or the error of the call."""
    no_answer = F.col("error").isNotNull() | F.col("response").isNull()
    early = _before_call(dialect).when(no_answer, "no_response")
    failure = request_message(F.coalesce("error", F.lit("no response")))
    opened = documents.select(
        *[c for c in documents.columns if c != "response"], F.col("response").alias("_content"),
        F.lit("ok").alias("envelope_state"), early.alias("_early"), failure.alias("_failure"),
    )
    return _finish(opened, documents, dialect, page_no)


def process_documents(
    documents: DataFrame, connect: Callable[[], Ask | AskHttp], dialect: Dialect, instruction: str | None = None,
    request: Column | None = None, http: bool = False, page_no: int = 0, ledger: str | None = None, **options,
) -> DataFrame:
    """Documents to outcome rows: request, one call per document, parse, fill.

    The request is a prompt with ``ocr_text``, or what ``request`` says, such as a
    payload with the page image (see ``requests.image_request``). With ``http`` the
    caller's function returns ``(status, body)``, whose failures become outcomes too;
    else it returns the answer. No call for documents without a page, nor for blank
    text where the dialect skips it. ``options`` go to ``apply_inference``; ``limit``, the
    seconds after which a call is given up, depends on the dialect otherwise, and ``seconds``
    names a column for how long the call took. With ``ledger`` answers are kept in that folder:
    the calls are made now, and a run after a failure asks only what is missing (not with ``http``).
    """
    if ledger and http:
        raise ValueError("a ledger holds answers, not HTTP responses")
    options = {"limit": fv.REQUEST_SECONDS[dialect.name]} | options
    text = build_prompt(F.coalesce("ocr_text", F.lit("")), instruction)
    asked = documents.withColumn("_prompt", F.when(F.col("input_state").isNull(), text if request is None else request))
    if not dialect.asks_blank_text and request is None:
        asked = skip_empty_text(asked, "ocr_text", "_prompt")
    if http:
        called = apply_http(asked, connect, "_prompt", **options).drop("_prompt", "error")
        return outcome_rows(called, dialect, page_no)
    call = partial(apply_with_ledger, ledger=ledger) if ledger else apply_inference
    return answer_rows(call(asked, connect, prompt="_prompt", **options).drop("_prompt"), dialect, page_no)


def _finish(opened: DataFrame, documents: DataFrame, dialect: Dialect, page_no: int) -> DataFrame:
    kept = [c for c in documents.columns if c not in INPUT_COLUMNS]
    response = F.when(F.col("_early").isNull(), F.col("_content"))
    asked = opened.select(
        *kept, "input_error", "ocr_text", "envelope_state", "_early", "_failure", response.alias("response")
    )
    parsed = project_fields(parse_answers(asked, dialect), dialect).withColumn("outcome", _outcome())
    # The same for all eight fields, so columns of their own.
    rows = parsed.select(
        "*",
        F.col("outcome").isin("ok", "missing_fields").alias("_usable"),
        F.when(F.col("outcome").isin(sorted(dialect.broken_outcomes)) | _broken_envelope(), dialect.broken).otherwise(dialect.absent).alias("_fill"),
        F.substring(strip(F.col("response")), 1, 1).alias("_first"),
    )
    filled = [_fill(name, dialect) for _, name in fv.FIELDS]
    texts = [F.coalesce("ocr_text", F.lit("")).alias("ocr_text"), _raw(dialect, page_no).alias("raw_response")]
    return rows.select(*kept, *filled, *texts, "outcome")


def _before_call(dialect: Dialect) -> Column:
    state = F.when(F.col("input_state").isNotNull(), F.col("input_state"))
    if not dialect.asks_blank_text:
        state = state.when(strip(F.coalesce("ocr_text", F.lit(""))) == "", "empty_text")
    return state


def _outcome() -> Column:
    kind = F.col("answer_kind")
    return (
        F.when(F.col("_early").isNotNull(), F.col("_early"))
        .when(kind.isin("none", "empty"), "no_json")
        .when(kind == "not_object", "not_object")
        .when(F.col("fields_missing"), "missing_fields")
        .otherwise("ok")
    )


def _broken_envelope() -> Column:
    """An unreadable body or content is an error; JSON of another shape counts as ``{}``."""
    return (F.col("outcome") == "bad_envelope") & (F.col("envelope_state") != "no_content")


def _content_message(dialect: Dialect) -> Column:
    """What becomes of a content that is JSON but no string: the error of its first use, a list as it is."""
    kind, shown = F.col("content_type"), F.col("content_json")

    def naming(message: str) -> Column:
        before, after = message.split("{type}")
        return F.concat(F.lit(before), kind, F.lit(after))

    if not dialect.typed:
        return naming(fv.NOT_TEXT_MESSAGE)
    whole_list = F.when(shown == "[]", fv.NO_ANSWER).otherwise(shown)
    return F.when(kind == "list", whole_list).when(kind == "dict", fv.DICT_SLICED_MESSAGE).otherwise(naming(fv.NOT_SLICED_MESSAGE))


def _fill(name: str, dialect: Dialect) -> Column:
    value = F.when(F.col("_usable"), F.col(name))
    if dialect.typed and (name == fv.DATE_FIELD or name in fv.AMOUNT_FIELDS):
        return value.alias(name)
    return value.otherwise(F.col("_fill")).alias(name)


def _raw(dialect: Dialect, page_no: int) -> Column:
    """The raw answer, or the message of the failure in its place."""
    outcome, response = F.col("outcome"), F.col("response")
    render = F.coalesce("input_error", F.lit("")) if dialect.asks_blank_text else F.lit("")
    raw = (
        F.when(outcome == "render_error", render)
        .when(outcome == "page_missing", _page_message(page_no))
        .when(outcome == "empty_text", "")
        .when(outcome.isin("http_error", "bad_envelope", "no_response"), F.col("_failure"))
    )
    if dialect.finder == "direct_first":
        raw = raw.when(outcome == "not_object", _not_object_message())
    if dialect.typed:
        raw = raw.when(response == "", fv.NO_ANSWER)
    return raw.otherwise(response)


def _page_message(page_no: int) -> Column:
    before, after = fv.PAGE_MESSAGE.replace("{page}", str(page_no)).split("{path}")
    return F.concat(F.lit(before), F.col("path"), F.lit(after))


def _not_object_message() -> Column:
    """Names the Python type the JSON value would have, seen from its first character."""
    first = F.col("_first")
    kind = (
        F.when(first == "[", "list")
        .when(first == '"', "str")
        .when(first.isin("t", "f"), "bool")
        .when(first == "n", "NoneType")
        .when(F.col("response").rlike("[.eE]"), "float")
        .otherwise("int")
    )
    before, after = fv.NOT_OBJECT_MESSAGE.split("{type}")
    return F.concat(F.lit(before), kind, F.lit(after))


def report_skipped(documents: DataFrame, text: str = "text", info: str = "response") -> DataFrame:
    """Documents that give no output at all, with the reason.

    ``documents`` already carries the answer (NULL where there is none), so
    this is a filter; against a separate result table use ``left_out``.
    """
    no_text = F.coalesce(F.col(text), F.lit("")) == ""
    no_info = F.coalesce(F.col(info), F.lit("")) == ""
    reason = F.when(no_text, "no_text").when(no_info, "no_info")
    return documents.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def left_out(manifest: DataFrame, results: DataFrame, key: str = "file_name") -> DataFrame:
    """Manifest rows without a result."""
    return manifest.join(results.select(key), key, "left_anti")
