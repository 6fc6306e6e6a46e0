"""Requests to a chat model: prompts, messages, payloads.

Everything here is a row-by-row projection. The wording of the instructions is
this library's own; the field names, formats and sentinels in it are fixed
values. Every function takes other wording as an argument.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quittance import fixed_values as fv
from quittance.functions.scalars import data_url, strip

_FIELD_HINTS = {
    "Datum": "im Format TT.MM.JJJJ",
    "Bezeichnung": "bei Gaststätten deren Name, bei Supermärkten deren Name oder 'Einkauf'",
    "MwSt-Satz": "Prozentwert als reine Zahl; bei mehreren Sätzen der häufigste",
    "MwSt-Betrag": "reine Zahl; bei mehreren Beträgen deren Summe",
    "Gesamtbetrag": "reine Zahl, brutto",
    "Nettobetrag": "reine Zahl; nötigenfalls Gesamtbetrag minus MwSt-Betrag",
    "Lieferant": "Name des Ausstellers",
}

SYSTEM_TEXT = (
    "Du liest Belege aus und antwortest nur mit einem JSON-Objekt. "
    f"Fehlt eine Angabe, steht dort \"{fv.NOT_FOUND}\"."
)

DATE_INSTRUCTION = (
    f"Nenne nur das Datum des Belegs (TT.MM.JJJJ), ohne Angabe {fv.DATE_SENTINEL}.\n"
)
AMOUNT_INSTRUCTION = (
    f"Nenne nur den bezahlten Gesamtbetrag (xx,xx), ohne Angabe {fv.AMOUNT_SENTINEL}.\n"
)

LINE_INSTRUCTION = "Gib je eine Zeile zurück:\n" + "".join(
    f"{key}: <{key}>\n" for key in fv.SPARSE_KEYS
)

TEMPLATES = dict(
    zip(
        fv.FORMAT_TYPES,
        [
            "Gib den gesamten Text als Markdown wieder.",
            "Gib den gesamten Text ohne Auszeichnung wieder.",
            "Gib alle Angaben als JSON-Objekt wieder.",
            "Gib die Angaben nach Abschnitten gegliedert wieder.",
            "Gib die Angaben zeilenweise als Name: Wert wieder.",
            "Gib alle Tabellen zeilenweise wieder.",
        ],
    )
)


def field_instruction() -> str:
    """The instruction for the eight invoice fields, built from the field list."""
    lines = [
        f"- {key}" + (f" ({_FIELD_HINTS[key]})" if key in _FIELD_HINTS else "") for key, _ in fv.FIELDS
    ]
    return (
        "Lies diese Felder aus dem Beleg:\n" + "\n".join(lines) + "\n"
        "Zahlen stehen mit Dezimalkomma und ohne Einheit. "
        f"Fehlt ein Wert, schreibe \"{fv.NOT_FOUND}\". "
        "Antworte nur mit einem JSON-Objekt mit genau diesen Schlüsseln.\n\nText:\n"
    )


def build_prompt(text: Column, instruction: str | None = None) -> Column:
    """Instruction followed by the document text."""
    return F.concat(F.lit(field_instruction() if instruction is None else instruction), text)


def fill_template(template: str, text: Column, slot: str = "{text}") -> Column:
    """A template with the text inside; braces in the text are left alone."""
    before, _, after = template.partition(slot)
    return F.concat(F.lit(before), text, F.lit(after))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def build_messages(user_texts: Sequence[Column], system: Column | None = None) -> Column:
    """``[{role, content}]`` in order: an optional system text, then the user texts."""
    first = [] if system is None else [message("system", system)]
    return F.array(*first, *[message("user", text) for text in user_texts])


def multimodal_content(prompt: Column, base64_image: Column, image_first: bool = False) -> Column:
    """A text part and an image part, in either order."""
    none = F.lit(None)
    text = F.struct(
        F.lit("text").alias("type"), prompt.alias("text"),
        none.cast("struct<url:string>").alias("image_url"),
    )
    image = F.struct(
        F.lit("image_url").alias("type"), none.cast("string").alias("text"),
        F.struct(data_url(base64_image).alias("url")).alias("image_url"),
    )
    return F.array(image, text) if image_first else F.array(text, image)


def build_multimodal_message(prompt: Column, base64_image: Column, image_first: bool = False) -> Column:
    return message("user", multimodal_content(prompt, base64_image, image_first))


def request_parameters(profile: str) -> tuple[float, int]:
    return next((t, n) for name, t, n in fv.REQUEST_PARAMETERS if name == profile)


def build_payload(messages: Column, model: Column, temperature: float, max_tokens: int) -> Column:
    """The request body as JSON text; parts that are NULL are left out."""
    return F.to_json(
        F.struct(
            model.alias("model"), messages.alias("messages"), F.lit(temperature).alias("temperature"),
            F.lit(max_tokens).alias("max_tokens"), F.lit(False).alias("stream"),
        )
    )


def image_request(base64_image: Column, model: Column, prompt: Column, system: Column | None = None, profile: str = "typed") -> Column:
    """The request body for one page image: optional system text, then prompt and image.

    A message holds text or parts, and JSON has no column type for either, so the
    two messages are put together as JSON text.
    """
    messages = [F.to_json(message("system", system))] if system is not None else []
    messages.append(F.to_json(build_multimodal_message(prompt, base64_image)))
    temperature, max_tokens = request_parameters(profile)
    rest = F.to_json(
        F.struct(F.lit(temperature).alias("temperature"), F.lit(max_tokens).alias("max_tokens"), F.lit(False).alias("stream"))
    )
    return F.concat(
        F.regexp_replace(F.to_json(F.struct(model.alias("model"))), r"\}$", ""), F.lit(',"messages":['), F.concat_ws(",", *messages), F.lit("],"),
        F.substr(rest, F.lit(2)),
    )


def choose_template(format_type: Column, custom: Column | None = None, language: Column | None = None) -> Column:
    """The template of an output format; a custom prompt replaces it.

    The formats are a fixed handful, so they become a CASE, not a join.
    """
    chosen = None
    for name, template in TEMPLATES.items():
        hit = format_type == name
        chosen = F.when(hit, template) if chosen is None else chosen.when(hit, template)
    if language is not None:
        chosen = F.concat(chosen, F.coalesce(F.concat(F.lit(" Sprache: "), language, F.lit(".")), F.lit("")))
    return chosen if custom is None else F.coalesce(custom, chosen)


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text) == "", F.lit(True))


def skip_empty_text(documents: DataFrame, text: str = "text", prompt: str = "prompt") -> DataFrame:
    """Set the prompt of documents without text to NULL.

    ``apply_inference`` makes no call for a NULL prompt, so the row stays and
    needs no join to come back.
    """
    return documents.withColumn(prompt, F.when(~is_blank(F.col(text)), F.col(prompt)))
