"""Fields in labelled lines, tagged sequences and logit vectors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quittance import fixed_values as fv
from quittance.functions.scalars import limit_description, strip


def parse_label_lines(text: Column) -> dict[str, Column]:
    """Per field: the last line that belongs to it, after its last colon.

    A line belongs to the first label it contains, in the order of the label
    list. Row by row, without exploding the lines: the greedy prefix of the
    pattern walks from the last line upwards.
    """
    columns, earlier = {}, []
    for label, name in fv.LINE_LABELS:
        ahead = "".join(rf"(?![^\n]*{word})" for word in earlier)
        line = F.regexp_extract(text, rf"(?s)^(?:.*\n)?{ahead}([^\n]*{label}[^\n]*)", 1)
        columns[name] = strip(F.substring_index(F.nullif(line, F.lit("")), ":", -1))
        earlier.append(label)
    return columns


def label_record(file_name: Column, text: Column, generated_name: Column) -> Column:
    """JSON text with the file, the labelled fields and a generated name; NULL fields stay."""
    fields = [column.alias(name) for name, column in parse_label_lines(text).items()]
    info = F.struct(*fields, generated_name.alias("generated_filename"))
    return F.to_json(
        F.struct(file_name.alias("file"), info.alias("extracted_info")), {"ignoreNullFields": "false"}
    )


def _after_first(text: Column, label: str) -> Column:
    """Text behind the first label, up to the next one or the end of the line."""
    rest = F.substr(text, F.instr(text, label) + F.lit(len(label)))
    return strip(F.substring_index(F.substring_index(rest, label, 1), "\n", 1))


def parse_label_positions(text: Column) -> dict[str, Column]:
    """Text behind fixed labels; all fields NULL if a cue lacks its label."""
    usable = F.lit(True)
    for cue, labels in fv.POSITION_LABELS:
        for label, _ in labels:
            usable = usable & (~F.contains(text, F.lit(cue)) | F.contains(text, F.lit(label)))
    return {
        name: F.when(usable & F.contains(text, F.lit(cue)), _after_first(text, label))
        for cue, labels in fv.POSITION_LABELS
        for label, name in labels
    }


def _first_match(text: Column, pattern: str) -> Column:
    """For patterns that cannot match the empty text."""
    return strip(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")))


def regex_amount(text: Column) -> Column:
    return _first_match(text, fv.AMOUNT_PATTERN)


def regex_vat_rate(text: Column) -> Column:
    return _first_match(text, fv.VAT_RATE_PATTERN)


def regex_product(text: Column) -> Column:
    """The first line with text behind the label; it has to end with a line feed."""
    behind = F.substr(text, F.instr(text, fv.PRODUCT_LABEL) + F.lit(len(fv.PRODUCT_LABEL)))
    line = F.ltrim(behind, F.lit(fv.WHITESPACE))
    ended = F.lit("\n")
    found = F.when(F.contains(line, ended), strip(F.substring_index(line, "\n", 1))).when(F.contains(behind, ended), "")
    return limit_description(F.when(F.contains(text, F.lit(fv.PRODUCT_LABEL)), found))


def regex_filename(text: Column) -> Column:
    return _first_match(text, fv.FILE_NAME_PATTERN)


def regex_date(text: Column) -> Column:
    return _first_match(text, fv.DATE_PATTERN)


def sparse_record(source: Column, answer: Column) -> Column:
    """JSON text with only the keys that matched, then both source texts."""
    found = [
        regex_amount(answer),
        regex_vat_rate(answer),
        regex_product(answer),
        regex_filename(answer),
        regex_date(answer),
    ]
    named = [value.alias(key) for key, value in zip(fv.SPARSE_KEYS, found)]
    return F.to_json(
        F.struct(*named, source.alias(fv.SPARSE_SOURCE_KEY), answer.alias(fv.SPARSE_ANSWER_KEY))
    )


def remove_special_tokens(text: Column, eos: str = fv.EOS_TOKEN, pad: str = fv.PAD_TOKEN) -> Column:
    return F.replace(F.replace(text, F.lit(eos), F.lit("")), F.lit(pad), F.lit(""))


def strip_first_tag(text: Column) -> Column:
    """Remove the first tag that lies within one line, then outer white space."""
    return strip(F.regexp_replace(text, r"(?s)^(.*?)<[^>\n]*>", "$1"))


def tags_to_fields(text: Column) -> Column:
    """``<s_key>value</s_key>`` pairs as a map; a repeated key keeps its last value.

    A value ends at the next tag, so that tags without an end cost no search.
    """
    pattern = F.lit(r"(?s)<s_([^<>]+)>(?:[^<]|<(?!/?s_))*+</s_\1>")
    pairs = F.reverse(F.regexp_extract_all(text, pattern, F.lit(0)))
    key_of = lambda pair: F.substring_index(F.substr(pair, F.lit(4)), ">", 1)
    keys = F.transform(pairs, key_of)
    names = F.array_distinct(keys)

    def value(name: Column) -> Column:
        pair = F.get(pairs, F.array_position(keys, name).cast("int") - 1)
        begin = F.length(name) + 5  # behind <s_name>
        return strip(F.substr(pair, begin, F.length(pair) - begin + 1 - (F.length(name) + 5)))

    return F.map_from_arrays(names, F.transform(names, value))


def span_decode(start: Column, end: Column, tokens: Column) -> Column:
    """Tokens from the best start to the best end, both included; empty if reversed."""
    first = F.array_position(start, F.array_max(start))
    last = F.array_position(end, F.array_max(end))
    return F.slice(tokens, first.cast("int"), F.greatest(F.lit(0), last - first + 1).cast("int"))
