"""JSON objects in free-text answers.

Three ways of finding the candidate text, one strict parser, and access to the
fields of the parsed VARIANT that keeps absent keys, JSON null, numbers and
strings apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quittance import fixed_values as fv
from quittance.functions.scalars import float_text, parse_german_date, parse_german_float
from quittance.session import use_last_duplicate_key

_JSON_SPACE, _JSON_FIRST = " \t\r\n", '{["-0123456789tfn'


def with_strict_json(rows: DataFrame, text: Column, name: str) -> DataFrame:
    """Add ``name``: the whole text as one JSON value (VARIANT), or NULL.

    Spark's parser stops after the first value and ignores what follows. The
    text is therefore parsed as the first element of an array whose second
    element is a known mark; any trailing text breaks or displaces the mark. The
    mark is a digest of the text, which no text can hold.

    Takes and gives a DataFrame because the parse needs a projection of its own:
    inside one CASE, Spark would parse for the condition and again for the value.
    Texts that begin like no JSON value are not given to the parser, whose errors are dear.
    """
    use_last_duplicate_key(rows.sparkSession)
    mark = F.sha2(text.cast("binary"), 256)
    first = F.substr(F.ltrim(text, F.lit(_JSON_SPACE)), F.lit(1), F.lit(1))
    wrapped = F.try_parse_json(F.when(first.isin(*_JSON_FIRST), F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]'))))
    marked = F.try_variant_get("_wrapped", "$[1]", "string") == mark
    value = F.when(marked, F.try_variant_get("_wrapped", "$[0]", "variant"))
    return rows.withColumn("_wrapped", wrapped).withColumn(name, value).drop("_wrapped")


def widest_object(text: Column) -> Column:
    """From the first ``{`` to the last ``}`` after it; empty without such a pair."""
    tail = F.substr(text, F.instr(text, "{"))
    behind = F.length(F.substring_index(tail, "}", -1))  # all of it if there is no }
    return F.when(F.contains(text, F.lit("{")), F.substr(tail, F.lit(1), F.length(tail) - behind)).otherwise(
        F.when(text.isNotNull(), "")
    )


def without_fence(text: Column, ignore_case: bool = False) -> Column:
    """Drop a leading fence (with or without ``json``) and a trailing one."""
    flags = "(?iU)" if ignore_case else "(?U)"
    opened = F.regexp_replace(text, flags + fv.OPENING_FENCE, "")
    fence = F.lit(fv.CLOSING_FENCE)

    def without(end: str) -> Column:
        inner = F.substr(opened, F.lit(1), F.length(opened) - len(fv.CLOSING_FENCE + end))
        return F.concat(F.rtrim(inner, F.lit(fv.WHITESPACE)), F.lit(end))

    return (
        F.when(F.endswith(opened, fence), without(""))
        .when(F.endswith(opened, F.lit(fv.CLOSING_FENCE + "\n")), without("\n"))
        .otherwise(opened)
    )


def fenced_object(text: Column) -> Column:
    """The first object that fills a whole fenced block; empty if there is none.

    The first opening in front of a brace decides: what closes a later one would
    close it too. The pattern never returns to it, so the search is linear.
    """
    return F.regexp_extract(text, fv.FENCED_OBJECT_PATTERN, 1)


def is_object_text(text: Column) -> Column:
    return F.startswith(text, F.lit("{"))


def is_empty_object_text(text: Column) -> Column:
    return text.rlike(r"^\{\s*\}$")


def field(value: Column, key: str) -> Column:
    """One key as VARIANT: SQL NULL if absent, a null VARIANT for JSON null."""
    return F.try_variant_get(value, f'$["{key}"]', "variant")


def field_text(value: Column, key: str) -> Column:
    """One key as text: numbers in plain form, nested values as JSON."""
    return F.try_variant_get(value, f'$["{key}"]', "string")


def field_kind(value: Column, key: str) -> Column:
    """The type name of one key: STRING, BIGINT, VOID for JSON null, ... or NULL if absent."""
    return F.schema_of_variant(field(value, key))


def is_string(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


# The functions below take the kind and the text of a field as columns of their
# own. Deriving both in each expression would make the generated code of a row
# with eight fields too long for the JVM to compile.


def shown_text(kind: Column, text: Column) -> Column:
    """A field as text, JSON numbers as Python prints them.

    Whole numbers of more than 64 bits are decimals too, with 19 digits or more
    and no scale; decimals with fewer digits come from a number with a point.
    """
    large_whole = kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$")
    decimal = F.startswith(kind, F.lit("DECIMAL")) | (kind == "DOUBLE")
    return (
        F.when(kind == "STRING", text)
        .when(large_whole, text)
        .when(decimal, float_text(text.try_cast("double")))
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def text_or(kind: Column, text: Column, missing: str) -> Column:
    """``missing`` only for an absent key; JSON null stays NULL."""
    return F.when(kind.isNull(), F.lit(missing)).otherwise(shown_text(kind, text))


def amount_of(kind: Column, text: Column) -> Column:
    """JSON numbers pass unchanged, strings are read as German numbers."""
    return (
        F.when(kind == "STRING", parse_german_float(text))
        .when(kind == "BOOLEAN", (text == "true").cast("double"))
        .otherwise(text.try_cast("double"))
    )


def date_of(kind: Column, text: Column) -> Column:
    """Only strings can be dates."""
    return F.when(kind == "STRING", parse_german_date(text))
