"""The model call: a function supplied by the caller, or a table of answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from quittance import fixed_values as fv
from quittance.functions.labels import (
    label_record, regex_amount, regex_date, regex_filename, regex_product, regex_vat_rate, sparse_record,
)
from quittance.functions.scalars import sidecar_filename
from quittance.operators.calls import called_batches
from quittance.operators.requests import AMOUNT_INSTRUCTION, DATE_INSTRUCTION, build_prompt, fill_template, is_blank
from quittance.operators.responses import trimmed_content

Ask = Callable[[str], str]
AskHttp = Callable[[str], tuple[int | None, str | None]]

SHARES_PER_CORE = 4


def apply_inference(
    requests: DataFrame,
    connect: Callable[[], Ask],
    prompt: str = "prompt",
    answer: str = "response",
    error: str = "error",
    tasks: int | None = None,
    parallel_calls: int = fv.PARALLEL_CALLS,
    limit: float | None = None,
    seconds: str | None = None,
    spread: bool = False,
) -> DataFrame:
    """One call per row with a prompt; a failing call gives an error text, not a failure.

    ``connect`` runs once per task and returns the function that is called per
    prompt, up to ``parallel_calls`` at a time; a slow call holds up neither the others
    nor the next batches (see ``calls``). A call that takes longer than ``limit`` seconds
    gives an error. ``seconds`` names a column for how long each call took. Only the
    prompt column travels to Python; all others stay in the
    JVM. The call counts as non-deterministic, so Spark neither repeats it nor
    moves filters through it. ``tasks`` bounds how many tasks call at a time; it only
    merges input parts, so no row is moved. ``spread`` moves them all, with their columns, to give ``tasks``
    tasks, or else ``SHARES_PER_CORE`` per core, the same number of rows: where calls wait, parts
    of different length leave cores idle for long. Leave payloads with images out of such requests.
    Executors must be able to import what ``connect`` uses. Lost executors repeat their calls: write the result to a table before
    building on it, and attach that with ``join_responses``; or let ``ledger`` keep the answers.
    """
    called = _called(requests, connect, prompt, "answer string", tasks, parallel_calls, limit, spread)
    added = {answer: "answer", error: "error"} | ({seconds: "seconds"} if seconds else {})
    return called.select(
        *[c for c in requests.columns if c not in added], *[F.col(f"_call.{field}").alias(name) for name, field in added.items()]
    )


def apply_http(
    requests: DataFrame, connect: Callable[[], AskHttp], prompt: str = "prompt", tasks: int | None = None,
    parallel_calls: int = fv.PARALLEL_CALLS, limit: float | None = None, seconds: str | None = None, spread: bool = False,
) -> DataFrame:
    """The same for a function that returns ``(status, body)``; adds ``status``, ``body`` and ``error``.

    ``outcomes.outcome_rows`` reads the first two; a failed or late call has neither.
    """
    called = _called(requests, connect, prompt, "status int, body string", tasks, parallel_calls, limit, spread)
    added = {name: name for name in ("status", "body", "error")} | ({seconds: "seconds"} if seconds else {})
    return called.select(
        *[c for c in requests.columns if c not in added], *[F.col(f"_call.{field}").alias(name) for name, field in added.items()]
    )


def _called(
    requests: DataFrame, connect: Callable[[], Callable], prompt: str, schema: str, tasks: int | None, parallel_calls: int,
    limit: float | None, spread: bool,
) -> DataFrame:
    """Add ``_call``, a struct of what the function returned, the error text and the seconds that the call took."""
    width = len(schema.split(", "))
    names = [field.split()[0] for field in schema.split(", ")] + ["error", "seconds"]

    def row(called) -> tuple:
        if called is None:
            return (None,) * len(names)
        if called.error is not None:
            return (*(None,) * width, called.error, called.seconds)
        return (*(called.result if width > 1 else (called.result,)), None, called.seconds)

    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        prompts = (batch.astype(object).where(batch.notna(), None).tolist() for batch in batches)
        for found in called_batches(prompts, connect(), parallel_calls, limit):
            yield pd.DataFrame([row(called) for called in found], columns=names, dtype=object)

    call.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    udf = F.pandas_udf(call, f"{schema}, error string, seconds double").asNondeterministic()
    if spread:
        dealt = requests.repartition(tasks or SHARES_PER_CORE * requests.sparkSession.sparkContext.defaultParallelism)
    else:
        dealt = requests.coalesce(tasks) if tasks else requests
    return dealt.withColumn("_call", udf(F.col(prompt)))


def join_responses(
    requests: DataFrame, responses: DataFrame, key: str = "request_id", response: str = "response", order: str | None = None
) -> DataFrame:
    """Attach answers computed earlier; ``no_response`` marks requests without one.

    One row per request: of several answers to a key the first one counts, by
    ``order`` or else by their text; a stored answer that is NULL counts where there is no other.

    Both sides are shuffled on the key unless one is small: leave payloads with
    images out of ``requests``.
    """
    others = [c for c in responses.columns if c not in (key, response, order)]
    first = F.struct(F.col(response).isNull().alias("_none"), *([order] if order else []), response, *others)
    found = (
        responses.groupBy(key).agg(F.min(first).alias("_first"))
        .select(key, *[F.col("_first").getField(c).alias(c) for c in responses.columns if c != key], F.lit(True).alias("_found"))
    )
    state = F.when(F.col("_found"), "ok").otherwise("no_response")
    return requests.join(found, key, "left").withColumn("response_state", state).drop("_found")


def two_pass_extract(
    documents: DataFrame, connect: Callable[[], Ask], first_prompt: Column, second_template: str, **options
) -> DataFrame:
    """The first answer goes into the second prompt; fields come from the second answer.

    A failed first call sends ``[]`` on. A failed second call leaves the fields
    NULL and its message in ``second_error``.
    """
    first = apply_inference(
        documents.withColumn("_prompt", first_prompt), connect, "_prompt", "first_answer", "first_error", **options
    )
    passed_on = fill_template(second_template, F.coalesce("first_answer", F.lit("[]")))
    second = apply_inference(
        first.withColumn("_prompt", passed_on), connect, "_prompt", "second_answer", "second_error", **options
    )
    answer = F.col("second_answer")
    return second.drop("_prompt").select(
        "*",
        regex_amount(answer).alias("amount"), regex_vat_rate(answer).alias("vat_rate"),
        regex_product(answer).alias("product"), regex_filename(answer).alias("suggested_name"),
        regex_date(answer).alias("date"),
    )


def multi_prompt_fields(
    documents: DataFrame, connect: Callable[[], Ask], text: str = "text",
    date_instruction: str = DATE_INSTRUCTION, amount_instruction: str = AMOUNT_INSTRUCTION, **options,
) -> DataFrame:
    """One call per field on the same text, as two columns: no explode, no pivot.

    Answers lose their outer white space; a failed call gives an empty answer.
    """
    rows = documents
    for name, instruction in (("date", date_instruction), ("amount", amount_instruction)):
        asked = rows.withColumn("_prompt", build_prompt(F.col(text), instruction))
        rows = apply_inference(asked, connect, "_prompt", f"{name}_answer", f"{name}_error", **options).drop("_prompt")
    return rows.withColumns(
        {f"{name}_answer": trimmed_content(F.col(f"{name}_answer")) for name in ("date", "amount")}
    )


def labelled_sidecars(
    documents: DataFrame, connect_fields: Callable[[], Ask], connect_name: Callable[[], Ask], fields_prompt: Column,
    name_prompt: Column, text: str = "text", file_name: str = "file_name", **options,
) -> DataFrame:
    """Text to labelled fields to a file name from the same text: ``name`` and ``record`` of each sidecar.

    Documents without text, and those whose first call gives nothing, have no
    sidecar and no second call. A failed second call gives a fixed name. The
    first answers are asked for once, also where the result is filtered.
    """
    with_text = documents.withColumn("_prompt", F.when(~is_blank(F.col(text)), fields_prompt))
    first = apply_inference(with_text, connect_fields, "_prompt", "_info", "_info_error", **options)
    info = trimmed_content(F.col("_info"))
    second = first.withColumn("_info", info).withColumn("_prompt", F.when(F.col("_info") != "", name_prompt))
    named = apply_inference(second, connect_name, "_prompt", "_name", "_name_error", **options)
    generated = trimmed_content(F.col("_name"), fv.UNNAMED_DOCUMENT)
    return named.filter(F.col("_info") != "").select(
        sidecar_filename(F.col(file_name)).alias("name"), label_record(F.col(file_name), F.col("_info"), generated).alias("record")
    )


def two_pass_sidecars(extracted: DataFrame, file_name: str = "file_name") -> DataFrame:
    """``name`` and sparse ``record`` of the documents whose second call gave an answer, from ``two_pass_extract``."""
    first = F.coalesce("first_answer", F.lit("[]"))
    return extracted.filter(F.col("second_answer").isNotNull()).select(
        sidecar_filename(F.col(file_name)).alias("name"), sparse_record(first, F.col("second_answer")).alias("record")
    )
