"""Values the results depend on.

FIXED VALUES: field names, sentinels, label words, patterns, request
parameters and file-name forms.  They are part of the data contract (the
answers, tables and files people already hold use them), so they are kept
together here as plain text and nothing else in the package repeats them.
"""

# -- the eight invoice fields, in column order: key in the answer, our column --
FIELDS = [
    ("Rechnungsnummer", "invoice_no"),
    ("Datum", "invoice_date"),
    ("Bezeichnung", "description"),
    ("MwSt-Satz", "vat_rate"),
    ("MwSt-Betrag", "vat_amount"),
    ("Gesamtbetrag", "gross_amount"),
    ("Nettobetrag", "net_amount"),
    ("Lieferant", "supplier"),
]
DATE_FIELD = "invoice_date"
AMOUNT_FIELDS = ["vat_amount", "gross_amount", "net_amount"]

# -- output headers around the eight fields --
FILE_HEADER = "Datei"
OCR_HEADER = "Roher_OCR_Text"
RAW_HEADER = "Rohe_LLM_Antwort"
TWO_FIELD_HEADERS = ["Dateiname", "Datum", "Betrag", "datum-Kommentar", "betrag-Kommentar"]

# -- sentinels --
NOT_FOUND = "NICHT GEFUNDEN"
ERROR = "FEHLER"
NO_ANSWER = "Keine LLM Antwort"
UNNAMED_DOCUMENT = "unbekanntes_dokument"
EMPTY_OBJECT = "{}"
DATE_SENTINEL = "01.01.1900"
AMOUNT_SENTINEL = "00,00"

# -- messages kept in the raw-answer column of failed rows --
STATUS_MESSAGE = "Fehler: {status} - {body}"
REQUEST_MESSAGE = "API-Anfragefehler: {reason}"
PAGE_MESSAGE = "PDF {path} hat keine Seite {page} oder konnte nicht gelesen werden."
NOT_OBJECT_MESSAGE = "'{type}' object has no attribute 'get'"
NOT_TEXT_MESSAGE = "'{type}' object has no attribute 'strip'"
NOT_SLICED_MESSAGE = "'{type}' object is not subscriptable"
DICT_SLICED_MESSAGE = "unhashable type: 'slice'"

# -- fences around a JSON answer --
OPENING_FENCE = r"^```(?:json)?\s*"
CLOSING_FENCE = "```"
FENCED_OBJECT_PATTERN = r"(?sU)^(?>.*?```(?:json)?\s*+(?=\{))(\{.*?\})\s*+```"

# -- labelled lines, in the order in which a line is tested --
LINE_LABELS = [
    ("Datum", "date"),
    ("Betrag", "amount"),
    ("MwSt", "vat"),
    ("Beschreibung", "description"),
]
# cue word -> labels that must then be present, with their columns
POSITION_LABELS = [
    ("Datum", [("Datum:", "date")]),
    ("MwSt.", [("MwSt. Betrag:", "vat_amount"), ("MwSt. Prozent:", "vat_percent")]),
    ("Kaufobjekt", [("Kaufobjekt:", "item")]),
]

# -- field patterns of the regex parser (Unicode classes, "." stops at \n) --
AMOUNT_PATTERN = r"(?Ud)Betrag:\s*([\d,]+(?:\s?€)?)"
VAT_RATE_PATTERN = r"(?Ud)MwSt:\s*([\d,]+)%?"
PRODUCT_LABEL = "Produktbezeichnung:"
FILE_NAME_PATTERN = r"(?Ud)Dateiname:\s*(\S+\.pdf)"
DATE_PATTERN = r"(?Ud)\b(\d{2}\.\d{2}\.\d{4})\b"
SPARSE_KEYS = ["Betrag", "MwSt", "Produktbezeichnung", "Dateiname", "Datum"]
SPARSE_SOURCE_KEY = "extracted_text-1"
SPARSE_ANSWER_KEY = "response_content-2"

# -- text limits, page and word limits --
PREVIEW_LENGTH = 200
LONG_PREVIEW_LENGTH = 300
SHORT_DESCRIPTION = 50
LONG_DESCRIPTION = 60
MIN_WORD_CONFIDENCE = 60

# -- image statistics --
WHITE_MEAN = 250
DARK_FACTOR = 0.8
MIN_DARK_POINTS = 100

# -- column widths --
WIDTH_PADDING = 2
WIDTH_CAP = 50

# -- numbering, file names --
FIRST_PDF_NUMBER = 200
FIRST_FILE_NUMBER = 0
PDF_SUFFIX = ".pdf"
IMAGE_SUFFIXES = ["png", "jpg", "jpeg"]
SHEET_PREFIX = "Extraktion_"
SHEET_SUFFIX = ".xlsx"
CSV_PREFIX = "extraktion_"
CSV_SUFFIX = ".csv"
SIDECAR_SUFFIX = ".json"
DATA_URL_PREFIX = "data:image/png;base64,"

# -- special tokens of tagged sequences --
EOS_TOKEN = "</s>"
PAD_TOKEN = "<pad>"

# -- request parameters: profile, temperature, max_tokens --
REQUEST_PARAMETERS = [
    ("plain", 0.2, 1024),
    ("marked", 0.1, 1500),
    ("typed", 0.1, 2048),
    ("page_image", 0.2, 1024),
    ("two_field", 0.7, 120000),
    ("lines", 0.7, 512),
    ("file_name", 0.5, 50),
    ("first_image", 0.7, -1),
]
PARALLEL_CALLS = 6
# Seconds after which a request is given up, by dialect.
REQUEST_SECONDS = {"plain": 120, "marked": 180, "typed": 300}

# -- template names --
FORMAT_TYPES = ["markdown", "text", "json", "structured", "key_value", "table"]

# -- what str.strip() removes: Unicode white space and the four separators --
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
