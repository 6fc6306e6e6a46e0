"""HTTP responses of a chat model: status, envelope, fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quittance import fixed_values as fv
from quittance.functions.json_text import with_strict_json
from quittance.functions.scalars import strip


def status_failed(status: Column, only_200: bool) -> Column:
    """Either every status but 200 is an error, or only 4xx and 5xx."""
    return status != 200 if only_200 else status.between(400, 599)


def status_message(status: Column, body: Column) -> Column:
    before, between = fv.STATUS_MESSAGE.replace("{body}", "").split("{status}")
    return F.concat(F.lit(before), status.cast("string"), F.lit(between), body)


def request_message(reason: Column) -> Column:
    return F.concat(F.lit(fv.REQUEST_MESSAGE.replace("{reason}", "")), reason)


def http_message(status: Column, body: Column, only_200: bool) -> Column:
    """The message of a failed response."""
    if only_200:
        return status_message(status, body)
    side = F.when(status < 500, " Client Error").otherwise(" Server Error")
    return request_message(F.concat(status.cast("string"), side))


def check_status(responses: DataFrame, only_200: bool) -> DataFrame:
    """Add ``status_error``: the message of a failed response, else NULL."""
    status = F.col("status")
    message = http_message(status, F.col("body"), only_200)
    return responses.withColumn("status_error", F.when(status_failed(status, only_200), message))


def parse_envelope(responses: DataFrame, body: str = "body") -> DataFrame:
    """Add ``content`` (``choices[0].message.content``) and ``envelope_state``.

    States: ``ok``; ``no_content`` for JSON of another shape; ``invalid`` for a
    body that is not JSON, ``no_body`` for none; ``not_text`` for a content that is
    not a string, whose Python type and JSON text are in ``content_type`` and
    ``content_json``.
    """
    parsed = with_strict_json(responses, F.col(body), "_envelope").withColumn(
        "_content", F.try_variant_get("_envelope", "$.choices[0].message.content", "variant")
    )
    kind = F.schema_of_variant("_content")
    state = (
        F.when(F.col(body).isNull(), "no_body")
        .when(F.col("_envelope").isNull(), "invalid")
        .when(F.col("_content").isNull(), "no_content")
        .when(kind == "STRING", "ok")
        .otherwise("not_text")
    )
    shown = F.coalesce(F.to_json("_content"), F.lit("null"))
    named = (
        F.when(kind == "VOID", "NoneType").when(kind == "BOOLEAN", "bool").when(F.startswith(kind, F.lit("ARRAY")), "list")
        .when(F.startswith(kind, F.lit("OBJECT")), "dict").when(shown.rlike("[.eE]"), "float").otherwise("int")
    )
    not_text = F.col("envelope_state") == "not_text"
    return parsed.withColumn("envelope_state", state).select(
        *responses.columns,
        "envelope_state",
        F.when(F.col("envelope_state") == "ok", F.try_variant_get("_content", "$", "string")).alias("content"),
        F.when(not_text, named).alias("content_type"), F.when(not_text, shown).alias("content_json"),
    )


def envelope_fallback(content: Column, fallback: str = fv.EMPTY_OBJECT) -> Column:
    """A fixed text where the envelope held no content."""
    return F.coalesce(content, F.lit(fallback))


def trimmed_content(content: Column, fallback: str = "") -> Column:
    """The content without outer white space, or a fixed text."""
    return F.coalesce(strip(content), F.lit(fallback))
