"""From free-text answers to fields: three dialects as data.

A dialect says how the JSON object is found in an answer, what stands for an
absent key, how failed documents are filled, and whether fields are typed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field as data_field

from pyspark.sql import Column, DataFrame, functions as F

from quittance import fixed_values as fv
from quittance.functions import json_text as jt
from quittance.functions.scalars import strip

FAILURES = [
    "no_json", "not_object", "empty_text", "render_error", "page_missing",
    "http_error", "bad_envelope", "no_response",
]


@dataclass(frozen=True)
class Dialect:
    """``finder``: strip_fence, direct_first or fenced_block.

    ``absent`` fills rows and keys without a value, ``broken`` fills the rows
    of outcomes listed in ``broken_outcomes``.
    """

    name: str
    finder: str
    typed: bool
    only_status_200: bool
    asks_blank_text: bool
    absent: str
    broken: str
    broken_outcomes: frozenset[str] = data_field(default_factory=frozenset)


PLAIN = Dialect("plain", "strip_fence", False, True, True, "", "", frozenset(FAILURES))
MARKED = Dialect(
    "marked", "direct_first", False, False, False, fv.NOT_FOUND, fv.ERROR,
    frozenset({"not_object", "page_missing", "http_error", "no_response"}),
)
TYPED = Dialect("typed", "fenced_block", True, False, True, fv.NOT_FOUND, fv.ERROR, frozenset(FAILURES))
DIALECTS = {d.name: d for d in (PLAIN, MARKED, TYPED)}


def parse_answers(answers: DataFrame, dialect: Dialect, response: str = "response") -> DataFrame:
    """Add ``answer`` (VARIANT) and ``answer_kind``: object, empty, not_object or none.

    One parse per row; ``direct_first`` needs a second one only for answers
    that are not JSON as a whole.
    """
    text = F.col("_text")
    found = answers.withColumn("_text", strip(F.col(response)))
    if dialect.finder == "direct_first":
        whole = F.col("_whole")
        # Columns of their own: inside a branch of a CASE, Spark repeats the searches wherever their result is named.
        inner = jt.widest_object(jt.without_fence(F.col("_rest"), ignore_case=True))
        found = jt.with_strict_json(found, text, "_whole").withColumn("_rest", F.when(whole.isNull(), text))
        found = jt.with_strict_json(found.withColumn("_object", inner), F.col("_object"), "_inner")
        found = found.withColumn("answer", F.coalesce("_whole", "_inner")).withColumn(
            "_source", F.when(whole.isNotNull(), text).otherwise(F.col("_object"))
        )
    else:
        if dialect.finder == "strip_fence":
            found = found.withColumn("_source", jt.widest_object(jt.without_fence(text)))
        else:
            fenced = F.col("_fenced")
            found = found.withColumn("_fenced", jt.fenced_object(text)).withColumn(
                "_source", F.when(fenced == "", jt.widest_object(text)).otherwise(fenced)
            )
        found = jt.with_strict_json(found, F.col("_source"), "answer")
    source = F.col("_source")
    kind = (
        F.when(F.col("answer").isNull(), "none")
        .when(~jt.is_object_text(source), "not_object")
        .when(jt.is_empty_object_text(source), "empty")
        .otherwise("object")
    )
    return found.select(*answers.columns, "answer", kind.alias("answer_kind"))


def field_parts(parsed: DataFrame, keys: Sequence[tuple[str, str]] = tuple(fv.FIELDS)) -> DataFrame:
    """Replace ``answer`` by the kind and the text of each key, as ``_k_<name>``
    and ``_t_<name>``; each key is looked up once."""
    kept = [c for c in parsed.columns if c != "answer"]
    found = parsed.select(*kept, *[jt.field(F.col("answer"), key).alias(f"_v_{name}") for key, name in keys])
    return found.select(
        *kept,
        *[F.schema_of_variant(f"_v_{name}").alias(f"_k_{name}") for _, name in keys],
        *[F.try_variant_get(f"_v_{name}", "$", "string").alias(f"_t_{name}") for _, name in keys],
    )


def _each(names: Sequence[str], read: Callable[[Column, Column], Column]) -> Column:
    """One function over the kind and text of several fields, as an array.

    Written out field by field, the code of a row is longer than what the JVM compiles.
    """
    parts = F.array(*[F.struct(F.col(f"_k_{name}").alias("kind"), F.col(f"_t_{name}").alias("text")) for name in names])
    return F.transform(parts, lambda part: read(part["kind"], part["text"]))


def shown_fields(parsed: DataFrame) -> DataFrame:
    """The eight fields as text, NULL for absent keys."""
    kept, names = [c for c in parsed.columns if c != "answer"], [name for _, name in fv.FIELDS]
    read = field_parts(parsed).select(*kept, _each(names, jt.shown_text).alias("_texts"))
    return read.select(*kept, *[F.col("_texts")[i].alias(name) for i, name in enumerate(names)])


def project_fields(parsed: DataFrame, dialect: Dialect) -> DataFrame:
    """The eight fields as columns, with the dialect's default for absent keys.

    ``fields_missing`` says whether a key is absent. The defaults also fill
    rows without an object.
    """
    kept = [c for c in parsed.columns if c != "answer"]
    names = [name for _, name in fv.FIELDS]
    dates = [name for name in names if dialect.typed and name == fv.DATE_FIELD]
    amounts = [name for name in names if dialect.typed and name in fv.AMOUNT_FIELDS]
    texts = [name for name in names if name not in dates and name not in amounts]
    missing = F.array_contains(F.array(*[F.col(f"_k_{name}").isNull() for name in names]), True)
    groups = [("_texts", texts, lambda kind, text: jt.text_or(kind, text, dialect.absent)), ("_amounts", amounts, jt.amount_of), ("_dates", dates, jt.date_of)]
    read = field_parts(parsed).select(
        *kept, missing.alias("fields_missing"), *[_each(of, function).alias(group) for group, of, function in groups if of]
    )
    place = {name: F.col(group)[i].alias(name) for group, of, _ in groups for i, name in enumerate(of)}
    return read.select(*kept, *[place[name] for name in names], "fields_missing")


def validate_schema(parsed: DataFrame) -> DataFrame:
    """The typed record date, amount, vat, description, filename and whether it fits.

    ISO dates and whole numbers, as a schema-bound answer would give them.
    """
    value = F.col("answer")
    record = parsed.select(
        *[c for c in parsed.columns if c != "answer"],
        F.try_variant_get(value, "$.date", "string").try_cast("date").alias("date"),
        _whole_number(value, "amount").alias("amount"),
        _whole_number(value, "vat").alias("vat"),
        _string(value, "description").alias("description"),
        _string(value, "filename").alias("filename"),
    )
    valid = F.lit(True)
    for name in ("date", "amount", "vat", "description", "filename"):
        valid = valid & F.col(name).isNotNull()
    return record.withColumn("valid", valid)


def _whole_number(value: Column, key: str) -> Column:
    number = F.when(~jt.is_string(jt.field(value, key)), F.try_variant_get(value, f"$.{key}", "double"))
    return F.when(number == F.floor(number), number.try_cast("int"))


def _string(value: Column, key: str) -> Column:
    part = jt.field(value, key)
    return F.when(jt.is_string(part), F.try_variant_get(part, "$", "string"))
