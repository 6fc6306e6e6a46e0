"""The same results as SQL over the given tables, for checking.

The SQL works from the base columns: it never parses an answer, so it does not
repeat the work of the queries. It knows only which case gives which result.
"""

from __future__ import annotations

from quittance import fixed_values as fv
from quittance.operators import requests as rq
from quittance.plans.derived import LARGE_NUMBER, SMALL_NUMBER

_INVOICE = """
line AS (
  SELECT l_orderkey AS doc_id, CAST(round(l_extendedprice * 100) AS BIGINT) AS net_c,
         CAST(round(l_tax * 100) AS BIGINT) AS rate_pct
  FROM lineitem),
vat_line AS (SELECT *, (net_c * rate_pct) // 100 AS vat_c FROM line),
total AS (
  SELECT doc_id, CAST(sum(net_c) AS BIGINT) AS net_c, CAST(sum(vat_c) AS BIGINT) AS vat_c, max(rate_pct) AS rate_pct
  FROM vat_line GROUP BY doc_id),
invoice AS (
  SELECT doc_id, c_mktsegment AS category, CAST(o_orderdate AS DATE) AS day,
         o_orderpriority || ' für "' || o_orderstatus || '" Größe' AS product,
         c_name AS issuer, rate_pct, net_c, vat_c, net_c + vat_c AS gross_c,
         'R-' || doc_id AS number, strftime(CAST(o_orderdate AS DATE), '%d.%m.%Y') AS day_text,
         doc_id % 26 AS c, doc_id % 8 AS k
  FROM total JOIN orders ON doc_id = o_orderkey JOIN customer ON o_custkey = c_custkey)
"""

_MANIFEST = """
named AS (
  SELECT o_orderkey AS key, c_mktsegment || ' Belege/' AS folder,
         o_orderkey || '_' || c_name || CASE o_orderkey % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.PDF'
           WHEN 2 THEN '.Pdf' WHEN 3 THEN '.txt' ELSE '.pdf.bak' END AS file_name
  FROM orders JOIN customer ON o_custkey = c_custkey),
manifest AS (
  SELECT key, CASE WHEN key % 11 = 0 THEN '' WHEN key % 13 = 0 THEN folder || 'alt/' ELSE folder END || file_name AS path,
         file_name, key % 11 <> 0 AND key % 13 <> 0 AS direct, replace(folder, '/', '') AS category,
         key % 5 < 3 AS is_pdf
  FROM named)
"""

_STAGED = """
staged AS (
  SELECT o_orderpriority AS category, o_orderkey, length(CAST(o_orderkey AS VARCHAR)) + 1 AS bytes,
         o_orderkey % 7 = 0 AS deep,
         CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 5 < 2 THEN 'pdf' WHEN o_orderkey % 5 = 2 THEN 'PDF'
              WHEN o_orderkey % 5 = 3 THEN 'txt' ELSE 'png' END AS suffix
  FROM orders)
"""

_PAGE = """
page AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS page_no,
         unnest(string_split(text, chr(10))) AS text
  FROM documents)
"""

_WORD = """
word AS (
  SELECT doc_id, unnest(string_split(text, ' ')) AS text, unnest(range(len(string_split(text, ' ')))) AS pos
  FROM documents),
ocr AS (
  SELECT doc_id, text, CAST((pos * 37 + doc_id * 11) % 101 AS INTEGER) AS conf,
         CAST((pos % 10) * 80 AS INTEGER) AS "left", CAST((pos // 10) * 20 AS INTEGER) AS top,
         CAST(length(text) * 8 AS INTEGER) AS width, 16 AS height
  FROM word)
"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def german(cents: str) -> str:
    return f"translate(format('{{:,.2f}}', {cents} / 100.0), ',.', '.,')"


def plain_comma(cents: str) -> str:
    return f"replace(format('{{:.2f}}', {cents} / 100.0), '.', ',')"


def _python_number(cents: str) -> str:
    """Cents as Python prints the float: at least one and no needless decimals."""
    return (
        f"({cents} // 100) || '.' || CASE WHEN {cents} % 10 = 0 THEN CAST(({cents} % 100) // 10 AS VARCHAR) "
        f"ELSE lpad(CAST({cents} % 100 AS VARCHAR), 2, '0') END"
    )


# which cases of the answer fixture give an object, per dialect
_OBJECT = {
    "plain": "(c IN (0,1,2,3,4,5,8,9,10,11) OR c > 15)",
    "marked": "(c IN (0,1,2,3,4,5,8,9,10) OR c > 15)",
    "typed": "(c IN (0,1,2,3,4,5,8,9,10,11,15) OR c > 15)",
}
# outcome per case of the document fixture
_OUTCOME = {
    "plain": """CASE WHEN c IN (0,1,2,3,4,8,9,10,11,18) THEN 'ok' WHEN c = 5 THEN 'missing_fields'
      WHEN c = 16 THEN 'render_error' WHEN c = 17 THEN 'page_missing' WHEN c IN (19,20,25) THEN 'http_error'
      WHEN c = 22 THEN 'no_response' WHEN c IN (21,23,24) THEN 'bad_envelope' ELSE 'no_json' END""",
    "marked": """CASE WHEN c IN (0,1,2,3,4,8,9,10,25) THEN 'ok' WHEN c = 5 THEN 'missing_fields'
      WHEN c IN (11,12) THEN 'not_object' WHEN c = 18 THEN 'empty_text'
      WHEN c = 16 THEN 'render_error' WHEN c = 17 THEN 'page_missing' WHEN c IN (19,20) THEN 'http_error'
      WHEN c = 22 THEN 'no_response' WHEN c IN (21,23,24) THEN 'bad_envelope' ELSE 'no_json' END""",
    "typed": """CASE WHEN c IN (0,1,2,3,4,8,9,10,11,15,18,25) THEN 'ok' WHEN c = 5 THEN 'missing_fields'
      WHEN c = 16 THEN 'render_error' WHEN c = 17 THEN 'page_missing' WHEN c IN (19,20) THEN 'http_error'
      WHEN c = 22 THEN 'no_response' WHEN c IN (21,23,24) THEN 'bad_envelope' ELSE 'no_json' END""",
}
# rows filled with the error mark instead of the mark for absent values
_BROKEN = {
    "plain": "FALSE",
    "marked": "(c IN (11,12,17,19,20,22,23,24))",
    "typed": "TRUE",
}


def _texts(absent: str | None) -> dict[str, str]:
    """The eight fields of an answer that holds an object, as text."""
    nothing = "NULL" if absent is None else quoted(absent)
    not_found = quoted(fv.NOT_FOUND)
    return {
        "invoice_no": f"CASE c WHEN 16 THEN '{LARGE_NUMBER}' ELSE number END",
        "invoice_date": f"CASE c WHEN 8 THEN NULL WHEN 9 THEN {not_found} ELSE day_text END",
        "description": "product",
        "vat_rate": "CASE c WHEN 17 THEN '1e-05' ELSE CAST(rate_pct AS VARCHAR) END",
        "vat_amount": german("vat_c"),
        "gross_amount": f"CASE c WHEN 8 THEN NULL WHEN 4 THEN {_python_number('gross_c')} ELSE {german('gross_c')} END",
        "net_amount": f"CASE c WHEN 5 THEN {nothing} WHEN 9 THEN {not_found} ELSE {german('net_c')} END",
        "supplier": f"CASE c WHEN 9 THEN {not_found} ELSE issuer END",
    }


def _typed() -> dict[str, str]:
    """Date and amounts of an answer that holds an object, as values."""
    return {
        "invoice_date": "CASE WHEN c NOT IN (8, 9) THEN day END",
        "vat_amount": "vat_c / 100.0",
        "gross_amount": "CASE WHEN c <> 8 THEN gross_c / 100.0 END",
        "net_amount": "CASE WHEN c NOT IN (5, 9) THEN net_c / 100.0 END",
    }


def _columns(exprs: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in exprs.items())


def _rows(dialect: str) -> str:
    """Outcome rows of a dialect: CTE ``rows``."""
    absent = {"plain": "", "marked": fv.NOT_FOUND, "typed": fv.NOT_FOUND}[dialect]
    broken = {"plain": "", "marked": fv.ERROR, "typed": fv.ERROR}[dialect]
    fields = _texts(absent)
    usable = "outcome IN ('ok', 'missing_fields')"
    exprs = {
        name: f"CASE WHEN {usable} THEN {expr} WHEN {_BROKEN[dialect]} THEN {quoted(broken)} ELSE {quoted(absent)} END"
        for name, expr in fields.items()
    }
    if dialect == "typed":
        exprs.update({name: f"CASE WHEN {usable} THEN {expr} END" for name, expr in _typed().items()})
    return f"""
cased AS (SELECT *, {_OUTCOME[dialect]} AS outcome FROM invoice),
rows AS (
  SELECT doc_id, c, category, number || '.pdf' AS file_name, outcome, {_columns(exprs)},
         {_RAW[dialect]} AS raw_response,
         CASE WHEN c IN (16, 17) THEN '' WHEN c = 18 THEN ' ' || chr(10) || chr(9) ELSE 'Beleg ' || number END AS ocr_text
  FROM cased)
"""


def _json(text: str) -> str:
    return f"to_json({text})"


def _object(amount: str, drop_net: bool = False, not_found: bool = False, nulls: bool = False) -> str:
    def keep(value: str) -> str:
        return quoted(fv.NOT_FOUND) if not_found else value

    values = {
        "Rechnungsnummer": _json("number"), "Datum": "'null'" if nulls else _json(keep("day_text")),
        "Bezeichnung": _json("product"), "MwSt-Satz": _json("CAST(rate_pct AS VARCHAR)"),
        "MwSt-Betrag": _json(german("vat_c")), "Gesamtbetrag": "'null'" if nulls else amount,
        "Nettobetrag": _json(keep(german("net_c"))), "Lieferant": _json(keep("issuer")),
    }
    if drop_net:
        del values["Nettobetrag"]
    parts = [f"""'"{key}":' || {value}""" for key, value in values.items()]
    return "('{' || " + " || ',' || ".join(parts) + " || '}')"


_PLAIN_OBJECT = _object(_json(german("gross_c")))
_DOTTED = "(gross_c // 100) || '.' || lpad(CAST(gross_c % 100 AS VARCHAR), 2, '0')"
_NL = "chr(10)"
_FENCED = f"('```json' || {_NL} || {_PLAIN_OBJECT} || {_NL} || '```')"
RESPONSE = f"""CASE
  WHEN c = 0 THEN {_FENCED}
  WHEN c = 1 THEN '  ```' || {_NL} || {_PLAIN_OBJECT} || '```' || {_NL}
  WHEN c = 3 THEN 'Gerne! Hier ist das Ergebnis:' || {_NL} || '{{"Lieferant":"alt",' || substr({_PLAIN_OBJECT}, 2)
       || {_NL} || 'Viele Grüße'
  WHEN c = 4 THEN {_object(_DOTTED)}
  WHEN c = 5 THEN {_object(_json(german("gross_c")), drop_net=True)}
  WHEN c = 6 THEN 'Leider nichts gefunden zu ' || number
  WHEN c = 7 THEN substr({_PLAIN_OBJECT}, 1, 40) || '}}'
  WHEN c = 8 THEN {_object("'null'", nulls=True)}
  WHEN c = 9 THEN {_object(_json(german("gross_c")), not_found=True)}
  WHEN c = 10 THEN replace({_FENCED}, '```json', '```JSON')
  WHEN c = 11 THEN '[' || {_PLAIN_OBJECT} || ']'
  WHEN c = 12 THEN CAST(doc_id AS VARCHAR)
  WHEN c = 13 THEN {_PLAIN_OBJECT} || ' und ' || {_PLAIN_OBJECT}
  WHEN c = 14 THEN '{{ }}'
  WHEN c = 15 THEN {_FENCED} || {_NL} || {_FENCED}
  WHEN c = 16 THEN replace({_PLAIN_OBJECT}, '"Rechnungsnummer":' || to_json(number), '"Rechnungsnummer":{LARGE_NUMBER}')
  WHEN c = 17 THEN replace({_PLAIN_OBJECT}, '"MwSt-Satz":' || to_json(CAST(rate_pct AS VARCHAR)), '"MwSt-Satz":{SMALL_NUMBER}')
  ELSE {_PLAIN_OBJECT} END"""

_PAGE_TEXT = "'PDF ' || category || '/' || number || '.pdf hat keine Seite 0 oder konnte nicht gelesen werden.'"
_REQUEST = "'API-Anfragefehler: "
_FAILED = f"""WHEN c = 17 THEN {_PAGE_TEXT} WHEN c = 22 THEN {_REQUEST}no response'
  WHEN c = 19 THEN {_REQUEST}500 Server Error' WHEN c = 20 THEN {_REQUEST}404 Client Error'
  WHEN c = 21 THEN '{{}}' WHEN c = 23 THEN {_REQUEST}unreadable body'"""
_OTHER = "(doc_id // 26) % 4"
_OTHER_TYPE = f"(CASE {_OTHER} WHEN 0 THEN 'NoneType' WHEN 1 THEN 'int' WHEN 2 THEN 'list' ELSE 'bool' END)"
_OTHER_JSON = f"(CASE {_OTHER} WHEN 0 THEN 'null' WHEN 1 THEN '5' WHEN 2 THEN '[\"x\"]' ELSE 'true' END)"
_RAW = {
    "plain": "NULL",
    "marked": f"""CASE WHEN c = 16 OR c = 18 THEN '' {_FAILED}
      WHEN c = 24 THEN chr(39) || {_OTHER_TYPE} || chr(39) || ' object has no attribute ' || chr(39) || 'strip' || chr(39)
      WHEN c = 11 THEN '''list'' object has no attribute ''get'''
      WHEN c = 12 THEN '''int'' object has no attribute ''get''' ELSE {RESPONSE} END""",
    "typed": f"""CASE WHEN c = 16 THEN 'Bild nicht lesbar' {_FAILED} WHEN c = 24 AND {_OTHER} = 2 THEN {_OTHER_JSON}
      WHEN c = 24 THEN chr(39) || {_OTHER_TYPE} || chr(39) || ' object is not subscriptable' ELSE {RESPONSE} END""",
}

_BODY = f"""CASE WHEN c IN (19, 20) THEN 'Störung ' || number WHEN c = 21 THEN '{{"choices":[]}}'
  WHEN c = 23 THEN '<html>Wartung</html>'
  WHEN c = 22 THEN NULL
  WHEN c = 24 THEN '{{"choices":[{{"message":{{"role":"assistant","content":' || {_OTHER_JSON} || '}}}}]}}'
  ELSE '{{"choices":[{{"message":{{"role":"assistant","content":' || to_json({RESPONSE}) || '}}}}]}}' END"""
_STATUS = "CASE c WHEN 19 THEN 500 WHEN 20 THEN 404 WHEN 25 THEN 202 WHEN 22 THEN NULL ELSE 200 END"

_SQL_STRIP = "trim({0}, ' ' || chr(9) || chr(10))"


def _extracted(dialect: str) -> str:
    found = _OBJECT[dialect]
    fields = {name: f"CASE WHEN {found} THEN {expr} END" for name, expr in _texts(None).items()}
    not_object = "(c IN (11, 12))" if dialect == "marked" else "FALSE"
    return f"""WITH {_INVOICE}
SELECT doc_id, CASE WHEN {found} THEN 'object' WHEN c = 14 THEN 'empty' WHEN {not_object} THEN 'not_object'
  ELSE 'none' END AS answer_kind, {_columns(fields)} FROM invoice"""


def _scan(condition: str) -> str:
    return f"""WITH {_STAGED}
SELECT category, suffix, CAST(sum(bytes) AS BIGINT) AS total_bytes FROM staged WHERE {condition} GROUP BY ALL"""


def _numbered(condition: str, start: int) -> str:
    return f"""WITH {_MANIFEST}, numbered AS (
  SELECT category, file_name, {start} - 1 + row_number() OVER (PARTITION BY category ORDER BY file_name) AS number
  FROM (SELECT * REPLACE (CASE WHEN key % 5 <> 1 THEN category END AS category) FROM manifest) WHERE direct AND {condition})
SELECT *, number || '_' || file_name AS new_name FROM numbered"""


def _documents(exprs: str) -> str:
    return f"SELECT doc_id, {exprs} FROM documents"


def _invoices(exprs: str) -> str:
    return f"WITH {_INVOICE} SELECT doc_id, {exprs} FROM invoice"


_ENCODED = "base64(encode(text))"
_SYSTEM_JSON = "'{\"role\":\"system\",\"content\":' || to_json(" + quoted(rq.SYSTEM_TEXT) + ") || '}'"


def _user_json(text: str) -> str:
    return "'{\"role\":\"user\",\"content\":' || to_json(" + text + ") || '}'"


_MESSAGES = {
    "user_only": f"'[' || {_user_json('text')} || ']'",
    "system_user": f"'[' || {_SYSTEM_JSON} || ',' || {_user_json('text')} || ']'",
    "system_two_users": (
        f"'[' || {_SYSTEM_JSON} || ',' || {_user_json(quoted(rq.DATE_INSTRUCTION))} || ',' || {_user_json('text')} || ']'"
    ),
}


def _payload(profile: str, messages: str, temperature: str, tokens: int) -> str:
    return (
        f"""'{{"model":' || to_json(source) || ',"messages":' || {_MESSAGES[messages]} || """
        f"""',"temperature":{temperature},"max_tokens":{tokens},"stream":false}}' AS {profile}"""
    )


_TEXT_PART = """'{"type":"text","text":' || to_json(lang) || '}'"""
_IMAGE_PART = f"""'{{"type":"image_url","image_url":{{"url":"data:image/png;base64,' || {_ENCODED} || '"}}}}'"""

# receipts of the inference queries: blank for doc_id % 9 = 8, the model fails for doc_id % 7 = 3
_BLANK = "doc_id % 9 = 8"
_FAILS = "doc_id % 7 = 3"
_HANGS = "doc_id % 700 = 5"
_RECEIPT = (
    f"CASE WHEN {_BLANK} THEN '  ' || chr(10) ELSE 'Beleg ' || number || ' vom ' || day_text || ' über ' || "
    f"{german('gross_c')} || ' Euro, MwSt ' || rate_pct || ' %' END"
)
_TIMEOUT = "Zeitüberschreitung"
_NO_RECEIPT = "kein Beleg im Text"
_CALL_ERROR = f"CASE WHEN {_BLANK} THEN '{_NO_RECEIPT}' WHEN {_FAILS} THEN '{_TIMEOUT}' END"
_ANSWERED = f"NOT ({_BLANK}) AND NOT ({_FAILS})"

# cases of the regex answers
_CUT_AMOUNT = (
    f"CASE WHEN gross_c >= 100000 THEN split_part({german('gross_c')}, '.', 1) ELSE {german('gross_c')} END"
)
_FULL = "k IN (0, 1, 2, 7)"
_REGEX = {
    "Betrag": f"""CASE WHEN k IN (0, 4, 7) THEN {plain_comma('gross_c')} WHEN k = 1 THEN {plain_comma('gross_c')} || ' €'
      WHEN k = 2 THEN {_CUT_AMOUNT} END""",
    "MwSt": f"CASE WHEN {_FULL} THEN CAST(rate_pct AS VARCHAR) WHEN k = 4 THEN '19,5' END",
    "Produktbezeichnung": f"""CASE WHEN {_FULL} THEN
      substr(product || ' in sehr langer Ausführung für ' || issuer, 1, 50) END""",
    "Dateiname": f"CASE WHEN {_FULL} THEN number || '.pdf' END",
    "Datum": f"CASE WHEN {_FULL} THEN day_text END",
}
_REGEX_BODY = f""" || '%' || {_NL} || 'Produktbezeichnung: ' || product || ' in sehr langer Ausführung für ' || issuer
  || ' ' || {_NL} || 'Dateiname: ' || number || '.pdf und R.pdfx' || {_NL}"""


def _regex_body(amount: str, tail: str) -> str:
    return f"'Betrag: ' || {amount} || '{tail}' || {_NL} || 'MwSt:' || rate_pct {_REGEX_BODY}"


_REGEX_HEAD = f"'Rechnung vom ' || day_text || {_NL}"
_REGEX_TEXT = f"""CASE k
  WHEN 1 THEN {_regex_body(plain_comma('gross_c'), ' €')} || {_REGEX_HEAD}
  WHEN 2 THEN {_REGEX_HEAD} || {_regex_body(german('gross_c'), ' Euro')}
  WHEN 3 THEN 'Produktbezeichnung: ' || product
  WHEN 4 THEN 'Betrag:' || {_NL} || {_NL} || {plain_comma('gross_c')} || {_NL} || 'MwSt: 19,5 %' || {_NL} || 'Datum 1.1.2020'
  WHEN 5 THEN 'Betrag: ' || number || {_NL} || 'Dateiname: a b.pdf'
  WHEN 6 THEN '**Betrag**: ' || {plain_comma('gross_c')} || {_NL} || 'x' || day_text || 'y'
  ELSE {_REGEX_HEAD} || {_regex_body(plain_comma('gross_c'), '')} END"""
_SPARSE = "'{' || " + " || ".join(
    f"""coalesce('"{key}":' || to_json({expr}) || ',', '')""" for key, expr in _REGEX.items()
) + f""" || '"extracted_text-1":' || to_json(number) || ',"response_content-2":' || to_json({_REGEX_TEXT}) || '}}'"""

_LABEL_FIELDS = {
    "date": f"""WHEN k IN (0,1,2,3,4) THEN day_text WHEN k = 5 THEN 'Datum ' || day_text
      WHEN k = 6 THEN {german('gross_c')}""",
    "amount": f"WHEN k IN (0,1,2,4) THEN {german('gross_c')} WHEN k = 3 THEN {german('vat_c')}",
    "vat": "WHEN k IN (0,1,2,3,4,6) THEN CAST(rate_pct AS VARCHAR) WHEN k = 5 THEN ''",
    "description": "WHEN k IN (0,1,3) THEN product WHEN k = 2 THEN 'zuletzt' WHEN k = 4 THEN '30'",
}
_SUGGESTED = """replace(lower(issuer), '#', '_') || '_' || day(day) || '_' || month(day) || '_' || year(day) || '.pdf'"""
_LABEL_RECORD = (
    """'{"file":"' || number || '.pdf","extracted_info":{' || """
    + " || ".join(
        f"""'"{name}":' || coalesce(to_json(CASE {expr} END), 'null') || ','""" for name, expr in _LABEL_FIELDS.items()
    )
    + f""" || '"generated_filename":"' || {_SUGGESTED} || '"}}}}'"""
)

_TAGGED = f"""'<s_number>' || number || '</s_number>' || {_NL} || '<s_day> ' || day_text || '</s_day><s_number>'
  || doc_id || '</s_number>'"""

_PER_RATE = f"""{_INVOICE}, per_rate AS (
  SELECT doc_id, rate_pct, count(*) AS n, CAST(sum(vat_c) AS BIGINT) AS vat_c FROM vat_line GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, rate_pct DESC) AS place FROM per_rate)"""

_OTSU = """
points AS (
  SELECT CASE WHEN l_linenumber <> 7 THEN l_returnflag || l_linenumber END AS image, CAST(floor(l_quantity) AS INTEGER) AS grey
  FROM lineitem),
counts AS (SELECT image, grey, count(*) AS n FROM points GROUP BY ALL),
sums AS (
  SELECT image, grey, CAST(sum(n) OVER upto AS DOUBLE) AS w0, CAST(sum(n * grey) OVER upto AS DOUBLE) AS s0,
         CAST(sum(n) OVER whole AS DOUBLE) AS w, CAST(sum(n * grey) OVER whole AS DOUBLE) AS s
  FROM counts
  WINDOW upto AS (PARTITION BY image ORDER BY grey ROWS UNBOUNDED PRECEDING), whole AS (PARTITION BY image)),
split AS (
  SELECT image, grey, CASE WHEN w > w0 THEN w0 * (w - w0) * power(s0 / w0 - (s - s0) / (w - w0), 2) ELSE 0 END AS variance
  FROM sums),
placed AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY variance DESC, grey) AS place FROM split),
otsu AS (SELECT image, grey AS threshold FROM placed WHERE place = 1)
"""


def _widths() -> str:
    shown = {"file_name": "file_name"}
    for _, name in fv.FIELDS:
        shown[name] = name
    for name in fv.AMOUNT_FIELDS:
        cents = f"CAST(round({name} * 100) AS BIGINT)"
        shown[name] = _python_number(cents)
    shown[fv.DATE_FIELD] = f"strftime({fv.DATE_FIELD}, '%Y-%m-%d %H:%M:%S')"
    shown["raw_response"] = "raw_response"
    headers = [fv.FILE_HEADER, *[key for key, _ in fv.FIELDS], fv.RAW_HEADER]
    parts = []
    for header, (name, expr) in zip(headers, shown.items()):
        text = f"coalesce({expr}, 'None')"
        if name == fv.DATE_FIELD or name in fv.AMOUNT_FIELDS:
            text = f"CASE WHEN outcome IN ('ok', 'missing_fields') THEN {text} ELSE {quoted(fv.ERROR)} END"
        width = f"greatest({len(header)}, max(length({text}))) + {fv.WIDTH_PADDING}"
        if header == fv.RAW_HEADER:
            width = f"least({width}, {fv.WIDTH_CAP})"
        parts.append(f"SELECT category, {quoted(header)} AS header, CAST({width} AS INTEGER) AS width FROM rows GROUP BY category")
    return f"WITH {_INVOICE}, {_rows('typed')} " + " UNION ALL ".join(parts)


def _report(dialect: str, with_ocr: bool) -> str:
    ok = "outcome IN ('ok', 'missing_fields')"
    columns = [f'file_name AS "{fv.FILE_HEADER}"']
    for key, name in fv.FIELDS:
        expr = name
        if dialect == "typed" and name == fv.DATE_FIELD:
            expr = f"CASE WHEN {ok} THEN strftime({name}, '%d.%m.%Y') ELSE {quoted(fv.ERROR)} END"
        elif dialect == "typed" and name in fv.AMOUNT_FIELDS:
            expr = f"CASE WHEN {ok} THEN format('{{:,.2f}}', {name}) ELSE {quoted(fv.ERROR)} END"
        columns.append(f'{expr} AS "{key}"')
    if with_ocr:
        columns.append(f'nullif(ocr_text, \'\') AS "{fv.OCR_HEADER}"')
        columns.append(f'nullif(raw_response, \'\') AS "{fv.RAW_HEADER}"')
    else:
        columns.append(f'raw_response AS "{fv.RAW_HEADER}"')
    return f"WITH {_INVOICE}, {_rows(dialect)} SELECT category, {', '.join(columns)} FROM rows"


def _label(values: dict[str, str]) -> str:
    return _invoices(", ".join(f"CASE {expr} END AS {name}" for name, expr in values.items()))


def oracle_queries() -> dict[str, str]:
    fallback = f"CASE WHEN c IN (19, 20, 21, 22, 23, 24) THEN NULL ELSE {RESPONSE} END"
    envelope_state = """CASE WHEN c = 21 THEN 'no_content' WHEN c IN (19, 20, 23) THEN 'invalid' WHEN c = 22 THEN 'no_body'
      WHEN c = 24 THEN 'not_text' ELSE 'ok' END"""
    long = "product || ' von ' || issuer || ' bestellt, geliefert und bezahlt'"
    field_columns = ", ".join(name for _, name in fv.FIELDS)
    template = "CASE doc_id % 7 " + " ".join(
        f"WHEN {i} THEN {quoted(rq.TEMPLATES[name])}" for i, name in enumerate(fv.FORMAT_TYPES)
    ) + " END"
    format_type = "CASE doc_id % 7 " + " ".join(
        f"WHEN {i} THEN '{name}'" for i, name in enumerate(fv.FORMAT_TYPES)
    ) + " END"
    typed_fields = _texts(fv.NOT_FOUND) | _typed()
    projected = {
        name: f"CASE WHEN {_OBJECT['typed']} THEN {expr} "
        + ("" if name in _typed() else f"ELSE {quoted(fv.NOT_FOUND)} ") + "END"
        for name, expr in typed_fields.items()
    }
    return {
        "category_totals": f"""WITH {_INVOICE}, {_rows('typed')}
SELECT category, outcome, count(*) AS documents,
  CAST(sum(CAST(round(gross_amount * 100) AS BIGINT)) AS BIGINT) AS gross_c,
  CAST(sum(CAST(round(vat_amount * 100) AS BIGINT)) AS BIGINT) AS vat_c,
  CAST(sum(CAST(round(net_amount * 100) AS BIGINT)) AS BIGINT) AS net_c, min(invoice_date) AS first_date
FROM rows GROUP BY category, outcome""",
        # sources
        "scan_pdf_manifest": _scan("NOT deep AND suffix IN ('pdf', 'PDF')"),
        "scan_pdf_manifest_cs": _scan("NOT deep AND suffix = 'pdf'"),
        "scan_recursive": _scan("suffix IN ('pdf', 'PDF')"),
        "list_tree": _scan("suffix IN ('pdf', 'PDF')"),
        "incremental_manifest": f"""WITH {_MANIFEST}
SELECT path, file_name, CAST(CASE WHEN key % 4 <> 2 AND key % 3 = 0 THEN key + 1 ELSE key END AS BIGINT) AS length,
  CASE WHEN key % 4 = 1 THEN 'new' WHEN key % 4 = 2 THEN 'gone' WHEN key % 3 = 0 THEN 'changed' ELSE 'unchanged' END AS state
FROM manifest""",
        "scan_images": _scan("NOT deep AND suffix = 'png'"),
        "read_bytes": f"WITH {_STAGED} SELECT category, o_orderkey FROM staged",
        "path_exists_guard": f"""WITH {_STAGED}
SELECT 'listed' AS outcome, CAST(sum(bytes) AS BIGINT) AS total_bytes FROM staged WHERE suffix IN ('pdf', 'PDF')
UNION ALL SELECT 'input_missing', NULL""",
        "filter_by_suffix": f"WITH {_MANIFEST} SELECT path, file_name, key % 5 = 0 AS exact FROM manifest WHERE is_pdf",
        "category_from_path": f"WITH {_MANIFEST} SELECT path, category FROM manifest WHERE direct",
        "basename": f"WITH {_MANIFEST} SELECT path, file_name AS name FROM manifest",
        # pages and words
        "select_page": """SELECT doc_id, string_split(text, chr(10))[3] AS page_text,
  CASE WHEN len(string_split(text, chr(10))) > 2 THEN 'ok' ELSE 'page_missing' END AS page_state FROM documents""",
        "first_page": "SELECT doc_id, string_split(text, chr(10))[1] AS text FROM documents",
        "concat_pages": "SELECT doc_id, replace(text, chr(10), '') AS text FROM documents",
        "page_segments": f"""WITH {_PAGE}, placed AS (
  SELECT doc_id, page_no, text, coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM page)
SELECT doc_id, CAST(before // 500 AS BIGINT) AS segment_no, CAST(min(page_no) AS INTEGER) AS first_page, string_agg(text, '' ORDER BY page_no) AS text
FROM placed GROUP BY ALL""",
        "explode_pages": f"WITH {_PAGE} SELECT doc_id, CAST(page_no AS INTEGER) AS page_no, text FROM page",
        "explode_ocr_words": f"WITH {_WORD} SELECT * FROM ocr",
        "filter_confident_words": f"WITH {_WORD} SELECT doc_id, text, conf FROM ocr WHERE conf > 60",
        "word_boxes": f"""WITH {_WORD}
SELECT doc_id, text, "left" AS x0, top AS y0, "left" + width AS x1, top + height AS y1 FROM ocr""",
        # requests
        "build_prompt": _documents(f"{quoted(rq.field_instruction())} || text AS prompt"),
        "build_messages": _documents(", ".join(f"{expr} AS {name}" for name, expr in _MESSAGES.items())),
        "build_multimodal_message": _documents(
            f"""'{{"role":"user","content":[' || {_TEXT_PART} || ',' || {_IMAGE_PART} || ']}}' AS text_first,
            '{{"role":"user","content":[' || {_IMAGE_PART} || ',' || {_TEXT_PART} || ']}}' AS image_first"""
        ),
        "build_payload": _documents(
            ", ".join(
                [
                    _payload("plain", "user_only", "0.2", 1024), _payload("marked", "system_user", "0.1", 1500),
                    _payload("two_field", "system_two_users", "0.7", 120000),
                    _payload("file_name", "system_user", "0.5", 50),
                ]
            )
        ),
        "base64_encode": _documents(f"{_ENCODED} AS encoded"),
        "base64_decode": _documents("text AS decoded"),
        "data_url": _documents(f"'data:image/png;base64,' || {_ENCODED} AS url"),
        "inline_image_prompt": _documents(f"'<image>' || {_ENCODED} || '</image>' || chr(10) || lang AS prompt"),
        "choose_template": _documents(
            f"""{format_type} AS format_type,
            CASE WHEN doc_id % 10 = 0 THEN 'Eigener Text ' || doc_id ELSE {template} END AS template,
            {template} || ' Sprache: ' || lang || '.' AS with_language"""
        ),
        "skip_empty_text": _invoices(f"CASE WHEN NOT ({_BLANK}) THEN 'Lies: ' || {_RECEIPT} END AS prompt"),
        # inference
        "apply_inference": _invoices(
            f"""CASE WHEN NOT ({_BLANK}) AND {_FAILS} THEN '{_TIMEOUT}' END AS error,
            CASE WHEN {_ANSWERED} THEN number END AS number, CASE WHEN {_ANSWERED} THEN day END AS day,
            CASE WHEN {_ANSWERED} THEN gross_c / 100.0 END AS gross"""
        ),
        "inference_time_limits": _invoices(
            f"""CASE WHEN {_BLANK} THEN NULL WHEN {_HANGS} THEN 'no answer within 1.5 s' WHEN {_FAILS} THEN '{_TIMEOUT}' END AS error,
            CASE WHEN {_ANSWERED} AND NOT ({_HANGS}) THEN number END AS number, CASE WHEN {_ANSWERED} AND NOT ({_HANGS}) THEN day END AS day,
            CASE WHEN {_ANSWERED} AND NOT ({_HANGS}) THEN gross_c / 100.0 END AS gross"""
        ),
        "resumed_inference": _invoices(
            f"""CASE WHEN NOT ({_BLANK}) AND {_FAILS} THEN '{_TIMEOUT}' END AS error,
            CASE WHEN {_ANSWERED} THEN number END AS number, CASE WHEN {_ANSWERED} THEN day END AS day,
            CASE WHEN {_ANSWERED} THEN gross_c / 100.0 END AS gross"""
        ),
        "join_responses": f"""WITH {_INVOICE}
SELECT o_orderkey AS request_id, CASE WHEN doc_id IS NOT NULL THEN {RESPONSE} END AS response,
  CASE WHEN doc_id IS NOT NULL THEN 'ok' ELSE 'no_response' END AS response_state
FROM orders LEFT JOIN invoice ON doc_id = o_orderkey""",
        "two_pass_extract": _invoices(
            f"""CASE WHEN {_ANSWERED} THEN 'Gefunden: ' || {_RECEIPT} END AS first_answer,
            {_CALL_ERROR} AS first_error,
            CASE WHEN {_ANSWERED} THEN 'Betrag: ' || {german('gross_c')} || {_NL} || 'MwSt: ' || rate_pct || {_NL}
              || 'Produktbezeichnung: ' || number || {_NL} || 'Dateiname: ' || number || '.pdf' || {_NL}
              || 'Datum: ' || day_text || {_NL} ELSE 'Keine Angaben' END AS second_answer,
            CAST(NULL AS VARCHAR) AS second_error,
            CASE WHEN {_ANSWERED} THEN {_CUT_AMOUNT} END AS amount,
            CASE WHEN {_ANSWERED} THEN CAST(rate_pct AS VARCHAR) END AS vat_rate,
            CASE WHEN {_ANSWERED} THEN number END AS product,
            CASE WHEN {_ANSWERED} THEN number || '.pdf' END AS suggested_name,
            CASE WHEN {_ANSWERED} THEN day_text END AS date"""
        ),
        "multi_prompt_fields": _invoices(
            f"""CASE WHEN {_ANSWERED} THEN day_text ELSE '' END AS date_answer, {_CALL_ERROR} AS date_error,
            CASE WHEN {_ANSWERED} THEN {german('gross_c')} ELSE '' END AS amount_answer, {_CALL_ERROR} AS amount_error"""
        ),
        # responses and JSON
        "check_status": _invoices(
            f"""{_STATUS} AS status,
            CASE c WHEN 19 THEN 'Fehler: 500 - Störung ' || number WHEN 20 THEN 'Fehler: 404 - Störung ' || number
              WHEN 25 THEN 'Fehler: 202 - ' || {_BODY} END AS strict_error,
            CASE c WHEN 19 THEN {_REQUEST}500 Server Error' WHEN 20 THEN {_REQUEST}404 Client Error' END AS status_error"""
        ),
        "parse_envelope": _invoices(
            f"""{envelope_state} AS envelope_state, {fallback} AS content,
            CASE WHEN c = 24 THEN {_OTHER_TYPE} END AS content_type, CASE WHEN c = 24 THEN {_OTHER_JSON} END AS content_json"""
        ),
        "envelope_fallback": _invoices(
            f"""coalesce({fallback}, '{{}}') AS as_object, coalesce({_SQL_STRIP.format(fallback)}, '') AS as_text,
            coalesce({_SQL_STRIP.format(fallback)}, {quoted(fv.UNNAMED_DOCUMENT)}) AS as_name,
            coalesce({fallback}, {_BODY}) AS as_body"""
        ),
        "extract_json_strip_fence": _extracted("plain"),
        "extract_json_direct_first": _extracted("marked"),
        "extract_json_fenced_block": _extracted("typed"),
        "strict_json": _invoices(
            f"""(c IN (2,4,5,8,9,11,12,14) OR c > 15) AS is_json,
            CASE WHEN c = 16 THEN '{LARGE_NUMBER}' WHEN c IN (2,4,5,8,9) OR c > 15 THEN number END AS number"""
        ),
        "project_fields": f"""WITH {_INVOICE}
SELECT doc_id, CASE WHEN {_OBJECT['typed']} THEN 'object' WHEN c = 14 THEN 'empty' ELSE 'none' END AS answer_kind,
  {_columns(projected)}, NOT {_OBJECT['typed']} OR c = 5 AS fields_missing FROM invoice""",
        "validate_schema": _invoices(
            """CASE WHEN doc_id % 5 <> 2 THEN day END AS date,
            CASE WHEN doc_id % 5 <> 1 THEN CAST(gross_c // 100 AS INTEGER) END AS amount,
            CASE WHEN doc_id % 5 <> 3 THEN CAST(rate_pct AS INTEGER) END AS vat, product AS description,
            number || '.pdf' AS filename, doc_id % 5 NOT IN (1, 2, 3) AS valid"""
        ),
        # labelled text
        "parse_label_lines": _label(_LABEL_FIELDS),
        "label_record": f"WITH {_INVOICE} SELECT number || '.pdf.json' AS name, {_LABEL_RECORD} AS record FROM invoice",
        "parse_label_positions": _label(
            {
                "date": "WHEN k IN (0,1,4,6,7) THEN day_text",
                "vat_amount": f"WHEN k IN (0,6,7) THEN {german('vat_c')}",
                "vat_percent": "WHEN k IN (0,6,7) THEN CAST(rate_pct AS VARCHAR)",
                "item": "WHEN k IN (0,4,6,7) THEN product",
            }
        ),
        "regex_amount": _invoices(f"{_REGEX['Betrag']} AS value"),
        "regex_vat_rate": _invoices(f"{_REGEX['MwSt']} AS value"),
        "regex_product": _invoices(f"{_REGEX['Produktbezeichnung']} AS value"),
        "regex_filename": _invoices(f"{_REGEX['Dateiname']} AS value"),
        "regex_date": _invoices(f"{_REGEX['Datum']} AS value"),
        "sparse_record": _invoices(f"{_SPARSE} AS record"),
        "remove_special_tokens": _invoices(f"'<s_docvqa>' || {_TAGGED} AS sequence"),
        "strip_first_tag": _invoices(f"{_TAGGED} || '</s><pad><pad>' AS sequence"),
        "tags_to_fields": _invoices("CAST(doc_id AS VARCHAR) AS number, day_text AS day, 2 AS fields"),
        "span_decode": """WITH best AS (
  SELECT vec_id, list_position(embedding, list_max(embedding)) AS first,
         list_position(list_reverse(embedding), list_max(embedding)) AS last FROM embeddings)
SELECT vec_id, coalesce((SELECT string_agg('t' || (i - 1), ' ' ORDER BY i) FROM unnest(range(first, last + 1)) AS u(i)), '')
  AS span FROM best""",
        # scalars
        "parse_german_float": _invoices(
            "gross_c / 100.0 AS gross, CAST(gross_c AS DOUBLE) AS dotted, CAST(NULL AS DOUBLE) AS unit"
        ),
        "parse_german_date": _invoices(
            """day AS "full", day AS short,
            CASE WHEN month(day) IN (1,3,5,7,8,10,12) THEN make_date(year(day), month(day), 31) END AS bent,
            CAST(NULL AS DATE) AS two_digits"""
        ),
        "format_german_date": _invoices(
            f"CASE WHEN doc_id % 10 <> 0 THEN day_text ELSE {quoted(fv.NOT_FOUND)} END AS shown"
        ),
        "format_amount": _invoices(f"format('{{:,.2f}}', gross_c / 100.0) AS shown, {german('gross_c')} AS german"),
        "format_date_display": _invoices("day_text AS shown"),
        "truncate_text": _documents("substr(text, 1, 200) AS preview, substr(text, 1, 300) AS long_preview"),
        "null_prompt_sentinels": _invoices(
            """CASE WHEN doc_id % 4 <> 0 THEN day END AS day,
            CASE WHEN doc_id % 4 NOT IN (1, 2) THEN gross_c / 100.0 END AS gross"""
        ),
        # outcomes
        "outcome_policy_pf": f"""WITH {_INVOICE}, {_rows('plain')}
SELECT doc_id, file_name, outcome, {field_columns} FROM rows""",
        "outcome_policy_mg": f"""WITH {_INVOICE}, {_rows('marked')}
SELECT doc_id, file_name, outcome, {field_columns}, ocr_text, raw_response FROM rows""",
        "outcome_policy_ba": f"""WITH {_INVOICE}, {_rows('typed')}
SELECT doc_id, file_name, outcome, {field_columns}, raw_response FROM rows""",
        "process_documents": f"""WITH {_INVOICE}, called AS (
  SELECT *, CASE WHEN doc_id % 13 = 5 THEN 'render_error' WHEN doc_id % 13 = 6 THEN 'page_missing'
    WHEN {_BLANK} THEN 'empty_text' WHEN {_FAILS} THEN 'no_response' ELSE 'missing_fields' END AS outcome
  FROM invoice)
SELECT doc_id, outcome, {_columns({name: f"""CASE WHEN outcome = 'missing_fields' THEN {expr}
    WHEN outcome IN ('page_missing', 'no_response') THEN {quoted(fv.ERROR)} ELSE {quoted(fv.NOT_FOUND)} END"""
    for name, expr in {'invoice_no': 'number', 'invoice_date': 'day_text', 'gross_amount': german('gross_c'),
                       'supplier': quoted(fv.NOT_FOUND)}.items()})},
  CASE WHEN doc_id % 13 IN (5, 6) THEN '' ELSE {_RECEIPT} END AS ocr_text FROM called""",
        "process_images": f"""WITH sized AS (SELECT doc_id, source, strlen(text) AS n FROM documents), called AS (
  SELECT *, CASE WHEN doc_id % 13 = 5 THEN 'render_error' WHEN doc_id % 13 = 6 THEN 'page_missing' WHEN n % 7 = 3 THEN 'http_error'
    WHEN n % 7 IN (4, 5) THEN 'bad_envelope' ELSE 'missing_fields' END AS outcome FROM sized)
SELECT doc_id, outcome, CASE outcome WHEN 'missing_fields' THEN 'D-' || n ELSE {quoted(fv.ERROR)} END AS invoice_no,
  CASE outcome WHEN 'missing_fields' THEN DATE '2024-12-05' END AS invoice_date,
  CASE outcome WHEN 'missing_fields' THEN CAST(n AS DOUBLE) END AS gross_amount,
  CASE outcome WHEN 'missing_fields' THEN {quoted(fv.NOT_FOUND)} ELSE {quoted(fv.ERROR)} END AS supplier,
  CASE WHEN outcome = 'render_error' THEN 'Bild nicht lesbar'
    WHEN outcome = 'page_missing' THEN 'PDF ' || source || '/D-' || doc_id || '.pdf hat keine Seite 2 oder konnte nicht gelesen werden.'
    WHEN outcome = 'http_error' THEN {_REQUEST}500 Server Error' WHEN n % 7 = 4 THEN {_REQUEST}unreadable body'
    WHEN n % 7 = 5 THEN chr(39) || 'NoneType' || chr(39) || ' object is not subscriptable'
    ELSE '```json' || {_NL} || '{{"Rechnungsnummer": "D-' || n || '", "Datum": "05.12.2024", "Gesamtbetrag": "' || n || ',00"}}'
      || {_NL} || '```' END AS raw_response
FROM called""",
        "labelled_sidecars": f"""WITH {_INVOICE}
SELECT number || '.pdf.json' AS name,
  '{{"file":"' || number || '.pdf","extracted_info":{{"date":"' || day_text || '","amount":"' || {german('gross_c')}
  || '","vat":"' || rate_pct || '","description":"' || number || '","generated_filename":"'
  || CASE WHEN doc_id % 5 = 1 THEN {quoted(fv.UNNAMED_DOCUMENT)} ELSE 'beleg_' || doc_id || '_' || day_text END || '"}}}}' AS record
FROM invoice WHERE {_ANSWERED}""",
        "two_pass_sidecars": f"""WITH {_INVOICE}
SELECT number || '.pdf.json' AS name, CASE WHEN {_ANSWERED} THEN
  '{{"Betrag":"' || {_CUT_AMOUNT} || '","MwSt":"' || rate_pct || '","Produktbezeichnung":"' || number || '","Dateiname":"' || number
  || '.pdf","Datum":"' || day_text || '","extracted_text-1":' || to_json('Gefunden: ' || {_RECEIPT}) || ',"response_content-2":'
  || to_json('Betrag: ' || {german('gross_c')} || {_NL} || 'MwSt: ' || rate_pct || {_NL} || 'Produktbezeichnung: ' || number || {_NL}
    || 'Dateiname: ' || number || '.pdf' || {_NL} || 'Datum: ' || day_text || {_NL}) || '}}'
  ELSE '{{"extracted_text-1":"[]","response_content-2":"Keine Angaben"}}' END AS record
FROM invoice""",
        "report_skipped": f"""WITH {_INVOICE}
SELECT doc_id, CASE WHEN doc_id % 6 = 1 THEN 'no_text' ELSE 'no_info' END AS reason FROM invoice
WHERE doc_id % 6 = 1 OR doc_id % 4 IN (2, 3)""",
        # order, numbers, names
        "sort_by_name": f"WITH {_MANIFEST} SELECT path, file_name FROM manifest WHERE is_pdf ORDER BY file_name",
        "number_files": _numbered("is_pdf", 200),
        "number_all_files": _numbered("TRUE", 0),
        "number_global": f"""WITH {_MANIFEST}, numbered AS (
  SELECT path, file_name, row_number() OVER (ORDER BY path) - 1 AS number FROM manifest)
SELECT *, number || '_' || file_name AS new_name FROM numbered""",
        "report_filename": f"""WITH {_MANIFEST}
SELECT count(*) AS files, 'Extraktion_' || replace(category, ' ', '_') || '.xlsx' AS sheet,
  'extraktion_' || category || '.csv' AS csv, category || '.csv' AS plain_csv
FROM manifest WHERE direct GROUP BY category""",
        "sidecar_filename": f"WITH {_MANIFEST} SELECT path, file_name || '.json' AS sidecar FROM manifest",
        # reports
        "batch_statistics": f"""WITH {_INVOICE}, {_rows('marked')}
SELECT category, count(*) AS total, count(*) FILTER (outcome IN ('ok', 'missing_fields')) AS successful,
  count(*) FILTER (outcome NOT IN ('ok', 'missing_fields')) AS failed FROM rows GROUP BY category""",
        "results_map": f"""WITH {_MANIFEST}
SELECT path, '{{' || to_json(path) || ':' || to_json(file_name) || '}}' AS entry FROM manifest""",
        "column_width_profile": _widths(),
        "report_columns": _report("typed", with_ocr=False),
        "two_field_report": f"""WITH {_INVOICE}
SELECT number || '.pdf' AS "Dateiname", CASE WHEN {_ANSWERED} THEN day_text ELSE '' END AS "Datum",
  CASE WHEN {_ANSWERED} THEN {german('gross_c')} ELSE '' END AS "Betrag",
  CAST(NULL AS VARCHAR) AS "datum-Kommentar", CAST(NULL AS VARCHAR) AS "betrag-Kommentar" FROM invoice""",
        "mean_gate": f"""WITH {_OTSU}, means AS (SELECT image, avg(grey) AS mean FROM points GROUP BY image),
dark AS (
  SELECT means.image, mean, count(*) FILTER (grey < mean * 0.8) AS dark_points
  FROM points JOIN means ON points.image IS NOT DISTINCT FROM means.image GROUP BY means.image, mean)
SELECT *, mean < 250 AND dark_points > 100 AS act FROM dark""",
        "otsu_threshold": f"WITH {_OTSU} SELECT image, threshold FROM otsu",
        "otsu_threshold_wide": """WITH counts AS (
  SELECT CASE WHEN l_linenumber <> 7 THEN l_returnflag END AS image, CAST(round(l_extendedprice * 100) AS BIGINT) AS price, count(*) AS n
  FROM lineitem GROUP BY ALL),
sums AS (
  SELECT image, price, CAST(sum(n) OVER upto AS DOUBLE) AS w0, CAST(sum(n * price) OVER upto AS DOUBLE) AS s0,
         CAST(sum(n) OVER whole - sum(n) OVER upto AS DOUBLE) AS w1, CAST(sum(n * price) OVER whole - sum(n * price) OVER upto AS DOUBLE) AS s1
  FROM counts
  WINDOW upto AS (PARTITION BY image ORDER BY price ROWS UNBOUNDED PRECEDING), whole AS (PARTITION BY image)),
split AS (
  SELECT image, price, CASE WHEN w1 > 0 THEN w0 * w1 * (s0 / w0 - s1 / w1) * (s0 / w0 - s1 / w1) ELSE 0 END AS variance FROM sums),
placed AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY variance DESC, price) AS place FROM split)
SELECT image, price AS threshold FROM placed WHERE place = 1""",
        "binarize": f"""WITH {_OTSU}
SELECT points.image, grey, CASE WHEN grey > threshold THEN 255 ELSE 0 END AS bit
FROM points JOIN otsu ON points.image IS NOT DISTINCT FROM otsu.image""",
        # invoice rules
        "derive_net": _invoices("CASE WHEN doc_id % 3 = 1 THEN net_c + 100 ELSE net_c END AS net_c"),
        "sum_vat": f"WITH {_INVOICE} SELECT doc_id, vat_c FROM total",
        "main_vat": f"WITH {_PER_RATE} SELECT doc_id, rate_pct AS main_rate, vat_c AS main_vat_c FROM best WHERE place = 1",
        "dominant_vat_rate": f"WITH {_PER_RATE} SELECT doc_id, rate_pct AS main_rate FROM best WHERE place = 1",
        "describe_purchase": _invoices(
            """CASE WHEN doc_id % 4 = 0 THEN CASE WHEN doc_id % 3 <> 0 THEN issuer ELSE product END
              WHEN doc_id % 4 = 1 THEN CASE WHEN doc_id % 3 <> 0 THEN issuer ELSE 'Einkauf' END
              ELSE product END AS description"""
        ),
        "suggest_filename": _invoices(f"{_SUGGESTED} AS name"),
        "limit_description": _invoices(f'substr({long}, 1, 50) AS short, substr({long}, 1, 60) AS "long"'),
        # sinks
        "write_csv_by_category": _report("marked", with_ocr=True),
        "write_json_sidecars": f"WITH {_INVOICE} SELECT number || '.pdf.json' AS name, {_SPARSE} AS record FROM invoice",
        "write_json_sidecars_bucketed": f"WITH {_INVOICE} SELECT number || '.pdf.json' AS name, {_SPARSE} AS record, 1 AS files FROM invoice",
        "write_results_json": f"""WITH {_MANIFEST}
SELECT '{{' || to_json(path) || ':' || to_json(file_name) || '}}' AS entry FROM manifest""",
    }


