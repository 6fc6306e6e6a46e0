"""German numbers and dates, and small string helpers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quittance import fixed_values as fv

# A number as Python's float() reads it: single underscores between digits are
# allowed, letter suffixes and hexadecimal forms (which a Spark cast takes) not.
# The sign of "nan" stays outside the match, because a Spark cast refuses it.
_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = (
    rf"(?i)^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?$"
    r"|^[+-]?(?:inf|infinity)$|(?<=^[+-]?)nan$"
)
_GERMAN_DATE = r"^(?: [1-9]|\d{1,2})\.\d{1,2}\.(?!0000)\d{4}$"


def strip(text: Column) -> Column:
    """Remove white space at both ends, Unicode spaces included."""
    return F.btrim(text, F.lit(fv.WHITESPACE))


def parse_german_float(text: Column) -> Column:
    """``1.234,56`` -> 1234.56; NULL where the text is not a number.

    Every dot counts as a thousands separator, so ``19.00`` is 1900.
    """
    plain = strip(F.translate(text, ",.", "."))  # the comma becomes a dot, dots go
    number = F.regexp_extract(plain, _NUMBER, 0)  # empty if it is no number, and so NULL
    return F.replace(number, F.lit("_"), F.lit("")).try_cast("double")


def parse_german_date(text: Column) -> Column:
    """``05.12.2024`` or ``5.1.2024`` -> DATE; NULL for anything else."""
    return F.when(text.rlike(_GERMAN_DATE), F.try_to_timestamp(F.ltrim(text), F.lit("d.M.yyyy")).cast("date"))


def format_german_date(date: Column, missing: str = fv.NOT_FOUND) -> Column:
    return F.coalesce(format_date_display(date), F.lit(missing))


def format_date_display(date: Column) -> Column:
    return F.date_format(date, "dd.MM.yyyy")


def format_amount(amount: Column) -> Column:
    """Display form ``#,##0.00``."""
    return F.format_number(amount, 2)


def format_german_amount(amount: Column) -> Column:
    """Display form ``#.##0,00``."""
    return F.translate(F.format_number(amount, 2), ",.", ".,")


def truncate_text(text: Column, length: int = fv.PREVIEW_LENGTH) -> Column:
    return F.substring(text, 1, length)


def limit_description(text: Column, length: int = fv.SHORT_DESCRIPTION) -> Column:
    return F.substring(text, 1, length)


def null_prompt_sentinels(text: Column) -> Column:
    """NULL for the values the prompts ask for when nothing was found."""
    return F.when(~text.isin(fv.DATE_SENTINEL, fv.AMOUNT_SENTINEL, fv.NOT_FOUND), text)


def float_text(number: Column) -> Column:
    """A DOUBLE as Python prints it: no exponent between 1e-4 and 1e16, else one of two digits and a sign."""
    text = number.cast("string")
    fixed = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    size = F.abs(number)
    digits, power = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", ""), F.substring_index(text, "E", -1)
    sign, places = F.when(F.startswith(power, F.lit("-")), "-").otherwise("+"), F.ltrim(power, F.lit("-"))
    short = F.when(F.length(places) < 2, F.concat(F.lit("0"), places)).otherwise(places)
    return (
        F.when(F.isnan(number), "nan")
        .when(size == float("inf"), F.when(number > 0, "inf").otherwise("-inf"))
        .when(((size >= 1e7) & (size < 1e16)) | ((size >= 1e-4) & (size < 1e-3)), fixed)
        .when(F.contains(text, F.lit("E")), F.concat(digits, F.lit("e"), sign, short))
        .otherwise(text)
    )


def base64_encode(content: Column) -> Column:
    """Base64 on one line (Spark breaks lines after 76 characters)."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def base64_decode(text: Column) -> Column:
    return F.unbase64(text)


def data_url(base64_text: Column) -> Column:
    return F.concat(F.lit(fv.DATA_URL_PREFIX), base64_text)


def inline_image_prompt(base64_text: Column, prompt: Column) -> Column:
    return F.concat(F.lit("<image>"), base64_text, F.lit("</image>\n"), prompt)


def local_path(path: Column) -> Column:
    """A path without scheme and host, as in ``file:/a`` or ``hdfs://host/a``."""
    return F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")


def slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def has_suffix(name: Column, suffix: str = fv.PDF_SUFFIX, case_sensitive: bool = False) -> Column:
    return F.endswith(name if case_sensitive else F.lower(name), F.lit(suffix))


def report_filename(category: Column) -> Column:
    return F.concat(
        F.lit(fv.SHEET_PREFIX), F.replace(category, F.lit(" "), F.lit("_")), F.lit(fv.SHEET_SUFFIX)
    )


def csv_filename(category: Column, prefix: str = fv.CSV_PREFIX) -> Column:
    return F.concat(F.lit(prefix), category, F.lit(fv.CSV_SUFFIX))


def sidecar_filename(name: Column) -> Column:
    return F.concat(name, F.lit(fv.SIDECAR_SUFFIX))
