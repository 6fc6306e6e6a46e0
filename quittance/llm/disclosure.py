"""Personal data by patterns, and words that give it away by information-theoretic sanitisation.

Base spans are e-mail addresses, IP addresses, card and phone numbers, found by pattern
in whole texts.  The values found are the protected entities.  A word close to a mention
of an entity may reveal it: where the word stands, the entity is likely.  The corpus
tells how strongly.  With N documents, n(c) that mention entity c, n(t) with word t and
n(c, t) with t close to a mention of c, the pointwise mutual information of c and t as a
share of the information of c is

    log(n(c, t) N / (n(c) n(t))) / log(N / n(c)).

A word discloses an entity if this share is at least ``DISCLOSURE`` and the word is close
to the entity in at least ``MIN_CONTEXTS`` different contexts, so that one text and its
copies prove nothing.  An entity that every document mentions has no information to give
away.  Disclosing words are marked wherever they stand, as spans of kind ``term``, but for
those that touch a base span.  ``sanitised`` generalises them: a word becomes its kind (a
number, a word), unless the kind discloses the entity as well; then it is removed.

Close to a mention are the ``CONTEXT_WORDS`` nearest words on either side, as far as they
lie in the ``CONTEXT_CHARS`` characters next to it and no mention of the same kind comes
between; what matches a base pattern is no word.  Words are runs of letters, digits and
characters beyond ASCII, A-Z lower-cased.  Entities are compared in lower case, numbers by
their digits (addresses: and dots).

Everything is columns and joins.  Only what is next to mentions is paired with entities,
so pairs grow with the mentions.  Joins and groups are by word or by entity and word, and
words are counted within tasks before they move.

Null texts are empty and have no spans.  Null and repeated ids are carried through, and
every row is a document of its own.  An empty table gives no rows.  Only ``doc_id`` and
``text`` are read, so further columns never clash (``sanitised`` keeps them all).  Texts are worked on
whole; patterns never go back over what they have seen, and positions are added up in
chunks, so that the work on a very long text grows with its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from quittance.llm.tables import free_name, kept

KINDS = ("email", "ip", "card", "phone")
CONTEXT_WORDS = 6
CONTEXT_CHARS = 200
MIN_CONTEXTS = 3
DISCLOSURE = 0.75
NUMBER, WORD = "#number", "#word"  # kinds of words; no word holds the sign

# The patterns find what the plain ones find, without going back: a run of characters
# that leads to no match from its start leads to none from its middle, unless the match
# before ends there (\G).
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Texts without these hold no match; a cheap look saves the search.
_NEEDED = {"email": "@", "ip": "[0-9][.][0-9]", "card": "(?:[0-9][ -]?){15}", "phone": "[+][0-9]"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_ANY = rf"{_LOCAL}+@{_LABEL}+(\.{_LABEL}+)+|[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)|\+[0-9][\x20().0-9-]+[0-9]|[0-9]([\x20-]?[0-9])+"
_IN_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CHUNK = 256
_SPAN = "array<struct<start:int,end:int,value:string,left:string,right:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also inside the functions of arrays."""
    return F.transform(F.array(value), use)[0]


def _upto(n: Column) -> Column:
    """0, 1, ..., n - 1"""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _running(sums: Column) -> Column:
    return F.aggregate(sums, F.array().cast("array<int>"), lambda seen, x: F.concat(seen, F.array(F.coalesce(F.try_element_at(seen, F.lit(-1)), F.lit(0)) + x)))


def running_sums(numbers: Column) -> Column:
    """The sums of the first 1, 2, ... numbers of an array, chunk by chunk."""

    def of(numbers: Column) -> Column:
        chunks = F.transform(_upto(F.ceil(F.size(numbers) / _CHUNK).cast("int")), lambda i: _running(F.slice(numbers, i * _CHUNK + 1, F.lit(_CHUNK))))
        return _let(chunks, lambda parts: _let(
            _running(F.transform(parts, lambda part: F.element_at(part, -1))),
            lambda ends: F.flatten(F.transform(parts, lambda part, i: F.transform(part, lambda x: x + F.when(i > 0, ends[i - 1]).otherwise(0)))),
        ))

    return _let(numbers, of)


def matches(text: Column, pattern: Column) -> Column:
    """All matches as (start, end, value, left, right): places in characters, and what lies between a match and the next ones."""

    def of(pieces: Column, values: Column) -> Column:
        ends = running_sums(F.transform(values, lambda value, i: F.length(pieces[i]) + F.length(value)))
        return _let(ends, lambda ends: F.transform(values, lambda value, i: F.struct(
            (ends[i] - F.length(value)).alias("start"), ends[i].alias("end"), value.alias("value"),
            F.right(pieces[i], F.lit(CONTEXT_CHARS)).alias("left"), F.left(pieces[i + 1], F.lit(CONTEXT_CHARS)).alias("right"),
        )))

    return _let(F.split(text, pattern, -1), lambda pieces: _let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda values: of(pieces, values))).cast(_SPAN)


def _digits(value: Column, more: str = "") -> Column:
    return F.regexp_replace(value, f"[^0-9{more}]", "")


def _luhn(value: Column) -> Column:
    """Whether every second digit doubled, from the last but one, adds up to a multiple of ten."""

    def total(digits: Column) -> Column:
        def worth(i: Column) -> Column:
            digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
            return F.when(i % 2 == 0, digit).when(digit > 4, 2 * digit - 9).otherwise(2 * digit)

        return F.aggregate(_upto(F.length(digits)), F.lit(0), lambda sum_, i: sum_ + worth(i))

    return _let(_digits(value), lambda digits: F.when(F.length(digits).between(16, 19), total(digits) % 10 == 0).otherwise(False))


_VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda value: F.lit(True),
    "ip": lambda value: value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
    "card": _luhn,
    "phone": lambda value: F.length(_digits(value)).between(8, 15),
}


def base_spans(text: Column, kind: str) -> Column:
    """The valid matches of a kind, by place.  Failing ones are dropped; nothing is looked for inside them."""
    needed = text.contains("@") if kind == "email" else text.rlike(_NEEDED[kind])
    found = F.when(needed, matches(text, F.lit(_PATTERNS[kind]))).otherwise(F.array().cast(_SPAN))
    return F.filter(found, lambda span: _VALID[kind](span["value"]))


def _folded(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def words(text: Column) -> Column:
    return F.regexp_extract_all(_folded(text), F.lit(f"{_IN_WORD}+"), F.lit(0))


def _entity(kind: str, value: Column) -> Column:
    plain = _folded(value) if kind == "email" else _digits(value, "." if kind == "ip" else "")
    return F.concat(F.lit(f"{kind} "), plain)


def _close(span: Column) -> tuple[Column, Column]:
    """The words next to a mention, on either side."""
    left, right = (words(F.regexp_replace(span[side], _ANY, " ")) for side in ("left", "right"))
    return F.reverse(F.slice(F.reverse(left), 1, CONTEXT_WORDS)), F.slice(right, 1, CONTEXT_WORDS)


def _shape(term: Column) -> Column:
    return F.when(term.rlike("^[0-9]+$"), NUMBER).otherwise(WORD)


def _with_shapes(terms: Column) -> Column:
    return _let(F.array_distinct(terms), lambda terms: F.concat(terms, F.array_distinct(F.transform(terms, _shape))))


def _content() -> tuple[Column, Column]:
    """Two hashes that find a row's text again in a later pass; rows with equal ones have equal results."""
    return F.xxhash64("doc_id", "text").alias("key_1"), F.xxhash64("text", F.lit(1), "doc_id").alias("key_2")


def based(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, content keys, and per kind an array of its base spans with what lies next to them."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long"), "text").select("doc_id", *_content(), text.alias("text"))
    return rows.select("doc_id", "key_1", "key_2", *[base_spans(F.col("text"), kind).alias(kind) for kind in KINDS])


def mentions(found: DataFrame) -> DataFrame:
    """(row, entity, context, terms) of every mention in ``based`` rows."""

    def of(kind: str) -> Column:
        return F.transform(F.col(kind), lambda span: F.struct(_entity(kind, span["value"]).alias("entity"), span["left"].alias("left"), span["right"].alias("right")))

    each = found.filter(" OR ".join(f"size({kind}) > 0" for kind in KINDS)).select(
        F.monotonically_increasing_id().alias("row"), F.inline(F.concat(*[of(kind) for kind in KINDS]))
    )
    left, right = _close({"left": F.col("left"), "right": F.col("right")})
    near = each.select("row", "entity", left.alias("before"), right.alias("after"))
    context = F.concat(F.concat_ws(" ", "before"), F.lit("|"), F.concat_ws(" ", "after"))
    return near.select("row", "entity", context.alias("context"), _with_shapes(F.concat("before", "after")).alias("terms"))


def disclosing_terms(documents: DataFrame, mentioned: DataFrame, disclosure: float = DISCLOSURE, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """(term, entity) for each word, or kind of words, that discloses an entity."""
    pairs = mentioned.select("row", "entity", "context", F.explode("terms").alias("term")).groupBy("entity", "term").agg(
        F.count_distinct("row").alias("n_both"), F.count_distinct("context").alias("contexts")
    )
    candidates = kept(pairs.filter(F.col("contexts") >= min_contexts).select("entity", "term", "n_both"), "disclosure-candidates")
    n_entity = mentioned.groupBy("entity").agg(F.count_distinct("row").alias("n_entity"))
    # Counted within the tasks first: what moves is a task's vocabulary, not its words.
    each = documents.select(F.explode(_with_shapes(words(F.col("text")))).alias("term"))
    n_term = each.groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    total = float(documents.count())
    share, known = F.col("n_both") / F.col("n_term"), F.col("n_entity") / F.lit(total)
    # The share of the information, solved for n(c, t) / n(t).
    tells = (known < 1) & (F.pow(share, F.lit(1 / (1 - disclosure))) >= known)
    return candidates.join(n_entity, "entity").join(n_term, "term").filter(tells).select("term", "entity")


def _term_spans(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(key_1, key_2, terms): the places of the given terms in each text that has any, touching base spans or not."""
    rows = documents.select(F.col("doc_id").cast("long"), "text").select(*_content(), "text")
    each = rows.select("key_1", "key_2", F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    # As a table its size is known, and texts only move if many have such terms.
    hits = kept(each.join(terms, "term").groupBy("key_1", "key_2").agg(F.sort_array(F.collect_set("term")).alias("hits")), "term-hits")
    pattern = F.concat(F.lit(f"(?<!{_IN_WORD})(?:"), F.concat_ws("|", "hits"), F.lit(f")(?!{_IN_WORD})"))
    placed = rows.join(hits, ["key_1", "key_2"]).select("key_1", "key_2", matches(_folded(F.col("text")), pattern).alias("terms"))
    return placed.dropDuplicates(["key_1", "key_2"]).withColumn("terms", F.transform("terms", lambda s: F.struct(s["start"], s["end"], s["value"])))


def _written(spans: dict[str, Column]) -> Column:
    def texts(kind: str, of: Column) -> Column:
        return F.transform(of, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    return F.concat_ws(",", F.concat(*[texts(kind, of) for kind, of in spans.items()]))


def _marked(documents: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    found = kept(based(documents), "base-spans")
    disclosing = kept(disclosing_terms(documents, kept(mentions(found), "mentions"), **options), "disclosing")
    terms = disclosing.select("term").filter(~F.col("term").isin(NUMBER, WORD)).distinct()
    spans = found.select("doc_id", "key_1", "key_2", *[F.transform(kind, lambda s: F.struct(s["start"], s["end"])).alias(kind) for kind in KINDS])
    joined = spans.join(kept(_term_spans(documents, terms), "term-spans"), ["key_1", "key_2"], "left")

    def free(span: Column) -> Column:
        return ~F.exists(F.concat(*KINDS), lambda base: (base["start"] < span["end"]) & (span["start"] < base["end"]))

    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return joined.withColumn("terms", F.when(F.col("terms").isNull(), empty).otherwise(F.filter("terms", free))), disclosing


def personal_data(documents: DataFrame, disclosure: float = DISCLOSURE, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """Per document: n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans (``kind:start:end`` by kind and place)."""
    marked, _ = _marked(documents, disclosure=disclosure, min_contexts=min_contexts)
    base = {kind: F.col(kind) for kind in KINDS}
    counts = [F.size(of).cast("long").alias(f"n_{kind}") for kind, of in (base | {"term": F.col("terms")}).items()]
    return marked.select(
        "doc_id", *counts, F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"), _written(base | {"term": F.col("terms")}).alias("spans")
    )


def sanitised(documents: DataFrame, disclosure: float = DISCLOSURE, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """The documents with all columns; in ``text``, base spans are named by kind, disclosing words generalised or removed.

    Of base spans that overlap, one stretch is made, named by the kind that starts first (then by the order of kinds).
    """
    key_1, key_2, edits, clean = (free_name(documents, name) for name in ("key_1", "key_2", "edits", "clean"))
    marked, disclosing = _marked(documents, disclosure=disclosure, min_contexts=min_contexts)
    # A kind that discloses an entity of the term is no way out.
    told = disclosing.filter(F.col("term").isin(NUMBER, WORD)).select(F.col("term").alias("shape"), "entity")
    shaped = disclosing.filter(~F.col("term").isin(NUMBER, WORD)).withColumn("shape", _shape(F.col("term")))
    removed = shaped.join(told, ["shape", "entity"]).select("term").distinct()
    terms = marked.select("key_1", "key_2", F.explode("terms").alias("span")).select("key_1", "key_2", "span.*")
    gone = removed.select(F.col("term").alias("value"), F.lit(True).alias("gone"))
    put = F.when(F.col("gone"), "").when(F.col("value").rlike("^[0-9]+$"), "[NUMBER]").otherwise("[WORD]")
    replaced = terms.join(gone, "value", "left").select("key_1", "key_2", "start", "end", put.alias("put"))
    for kind in KINDS:
        replaced = replaced.union(marked.select("key_1", "key_2", F.inline(kind)).withColumn("put", F.lit(f"[{kind.upper()}]")))
    by_text = replaced.distinct().groupBy("key_1", "key_2").agg(F.sort_array(F.collect_list(F.struct("start", "end", "put"))).alias(edits))
    keys = [column.alias(name) for column, name in zip(_content_of(documents), (key_1, key_2), strict=True)]
    joined = documents.select("*", *keys).join(by_text.withColumnsRenamed({"key_1": key_1, "key_2": key_2}), [key_1, key_2], "left")

    # (where the text goes on, the parts so far); an edit that starts inside the last one only makes it longer.
    def apply(done: Column, edit: Column) -> Column:
        fresh = F.array(F.substring(F.col("text"), done["at"] + 1, edit["start"] - done["at"]), edit["put"])
        return F.struct(
            F.greatest(done["at"], edit["end"]).alias("at"), F.when(edit["start"] >= done["at"], F.concat(done["parts"], fresh)).otherwise(done["parts"]).alias("parts")
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    text = F.aggregate(edits, start, apply, lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(F.col("text"), done["at"] + 1, F.length("text"))))
    rows = joined.withColumn(clean, F.when(F.col(edits).isNull(), F.col("text")).otherwise(text))
    return rows.select(*[F.col(clean).alias(c) if c == "text" else F.col(c) for c in documents.columns])


def _content_of(documents: DataFrame) -> tuple[Column, Column]:
    doc_id = F.col("doc_id").cast("long")
    return F.xxhash64(doc_id, "text"), F.xxhash64("text", F.lit(1), doc_id)
