"""Inputs derived from the given tables: invoices, answers, files, pages, words.

Everything is a Spark expression over the tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quittance import fixed_values as fv
from quittance.functions.scalars import base64_encode, format_german_amount
from quittance.session import new_folder

CASES = 26
LABEL_CASES = 8
# JSON numbers of cases 16 and 17: more than 64 bits, and less than Python shows without an exponent.
LARGE_NUMBER, SMALL_NUMBER = "12345678901234567890123", "0.00001"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def vat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net, rate and VAT of every invoice line."""
    line = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        cents(F.col("l_extendedprice")).alias("net_c"),
        cents(F.col("l_tax")).alias("rate_pct"),
    )
    return line.withColumn("vat_c", F.expr("(net_c * rate_pct) div 100"))


def invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with line items."""
    totals = vat_lines(spark, sf_dir).groupBy("doc_id").agg(
        F.sum("net_c").alias("net_c"), F.sum("vat_c").alias("vat_c"), F.max("rate_pct").alias("rate_pct")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"), "o_custkey", F.to_date("o_orderdate").alias("day"),
        F.format_string('%s für "%s" Größe', "o_orderpriority", "o_orderstatus").alias("product"),
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("issuer"),
        F.col("c_mktsegment").alias("category"),
    )
    return orders.join(totals, "doc_id").join(customer, "o_custkey").select(
        "doc_id", "category", "day", "product", "issuer", "rate_pct", "net_c", "vat_c",
        (F.col("net_c") + F.col("vat_c")).alias("gross_c"),
        F.concat(F.lit("R-"), F.col("doc_id")).alias("number"),
        F.date_format("day", "dd.MM.yyyy").alias("day_text"),
    )


def euros(name: str) -> Column:
    return F.col(name) / 100


def german(name: str) -> Column:
    return format_german_amount(euros(name))


def dotted(name: str) -> Column:
    """Cents as ``1234.56``."""
    return F.concat(
        F.expr(f"{name} div 100").cast("string"), F.lit("."), F.lpad((F.col(name) % 100).cast("string"), 2, "0")
    )


def _answer_values() -> list[Column]:
    case = F.col("case_no")

    def or_not_found(value: Column) -> Column:
        return F.when(case == 9, F.lit(fv.NOT_FOUND)).otherwise(value)

    net = F.when(case != 5, or_not_found(german("net_c")))
    return [
        F.col("number"), or_not_found(F.col("day_text")), F.col("product"), F.col("rate_pct").cast("string"),
        german("vat_c"), F.col("gross_text"), net, or_not_found(F.col("issuer")),
    ]


def _answer_shapes() -> Column:
    """The model answer around the plain object, in one of eighteen shapes."""
    case, plain = F.col("case_no"), F.col("plain_object")

    def swapped(text: Column, key: str, old: Column, new: Column) -> Column:
        return F.replace(text, F.concat(F.lit(f'"{key}":"'), old, F.lit('"')), F.concat(F.lit(f'"{key}":'), new))

    def around(before: str, text: Column, after: str) -> Column:
        return F.concat(F.lit(before), text, F.lit(after))

    gross, null = F.col("gross_text"), F.lit("null")
    nulls = swapped(swapped(plain, "Datum", F.col("day_text"), null), "Gesamtbetrag", gross, null)
    repeated = F.concat(F.lit('{"Lieferant":"alt",'), F.substr(plain, F.lit(2)))
    two_fences = F.concat(around("```json\n", plain, "\n```\n"), around("```json\n", plain, "\n```"))
    return (
        F.when(case == 0, around("```json\n", plain, "\n```"))
        .when(case == 1, around("  ```\n", plain, "```\n"))
        .when(case == 3, around("Gerne! Hier ist das Ergebnis:\n", repeated, "\nViele Grüße"))
        .when(case == 4, swapped(plain, "Gesamtbetrag", gross, dotted("gross_c")))
        .when(case == 6, F.concat(F.lit("Leider nichts gefunden zu "), F.col("number")))
        .when(case == 7, F.concat(F.substring(plain, 1, 40), F.lit("}")))
        .when(case == 8, nulls)
        .when(case == 10, around("```JSON\n", plain, "\n```"))
        .when(case == 11, around("[", plain, "]"))
        .when(case == 12, F.col("doc_id").cast("string"))
        .when(case == 13, F.concat(plain, F.lit(" und "), plain))
        .when(case == 14, F.lit("{ }"))
        .when(case == 15, two_fences)
        .when(case == 16, swapped(plain, "Rechnungsnummer", F.col("number"), F.lit(LARGE_NUMBER)))
        .when(case == 17, swapped(plain, "MwSt-Satz", F.col("rate_pct").cast("string"), F.lit(SMALL_NUMBER)))
        .otherwise(plain)
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices with ``case_no`` and ``response``; cases above 17 answer plainly."""
    named = [value.alias(key) for value, (key, _) in zip(_answer_values(), fv.FIELDS)]
    return (
        invoice(spark, sf_dir)
        .select("*", (F.col("doc_id") % CASES).alias("case_no"), german("gross_c").alias("gross_text"))
        .withColumn("plain_object", F.to_json(F.struct(*named)))
        .withColumn("response", _answer_shapes())
    )


def envelope(content: Column) -> Column:
    message = F.struct(F.lit("assistant").alias("role"), content.alias("content"))
    return F.to_json(F.struct(F.array(F.struct(message.alias("message"))).alias("choices")))


def http_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as HTTP status and body, with the failures of cases 19 to 25."""
    case = F.col("case_no")
    other = F.get(F.array(*[F.lit(text) for text in ("null", "5", '["x"]', "true")]), F.expr(f"cast(doc_id div {CASES} % 4 as int)"))
    status = (
        F.when(case == 19, 500).when(case == 20, 404).when(case == 25, 202)
        .when(case == 22, F.lit(None).cast("int")).otherwise(200)
    )
    body = (
        F.when(case.isin(19, 20), F.concat(F.lit("Störung "), F.col("number")))
        .when(case == 21, '{"choices":[]}')
        .when(case == 22, F.lit(None).cast("string"))
        .when(case == 23, "<html>Wartung</html>")
        .when(case == 24, F.concat(F.lit('{"choices":[{"message":{"role":"assistant","content":'), other, F.lit("}}]}")))
        .otherwise(envelope(F.col("response")))
    )
    return answers(spark, sf_dir).withColumn("status", status).withColumn("body", body)


def document_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTTP responses as documents, with the input failures of cases 16 to 18."""
    case = F.col("case_no")
    name = F.concat(F.col("number"), F.lit(".pdf"))
    state = F.when(case == 16, "render_error").when(case == 17, "page_missing")
    text = F.when(case == 18, " \n\t").otherwise(F.concat(F.lit("Beleg "), F.col("number")))
    return http_responses(spark, sf_dir).select(
        "doc_id", "category", name.alias("file_name"),
        F.concat(F.col("category"), F.lit("/"), name).alias("path"),
        state.alias("input_state"), F.when(case == 16, "Bild nicht lesbar").alias("input_error"),
        F.when(state.isNull(), text).alias("ocr_text"), "status", "body",
    )


def stored_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers by request and attempt. Every seventh request was asked twice; orders
    without line items have no answer."""
    attempts = F.when(F.col("doc_id") % 7 == 2, F.array(F.lit(2), F.lit(1))).otherwise(F.array(F.lit(1)))
    given = answers(spark, sf_dir).select(F.col("doc_id").alias("request_id"), "response", F.explode(attempts).alias("attempt"))
    return given.withColumn("response", F.when(F.col("attempt") == 2, "{}").otherwise(F.col("response")))


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as page images (their bytes in Base64), some without one."""
    key = F.col("doc_id")
    name = F.concat(F.lit("D-"), key, F.lit(".pdf"))
    state = F.when(key % 13 == 5, "render_error").when(key % 13 == 6, "page_missing")
    return documents(spark, sf_dir).select(
        "doc_id", name.alias("file_name"), F.concat("source", F.lit("/"), name).alias("path"), state.alias("input_state"),
        F.when(key % 13 == 5, "Bild nicht lesbar").alias("input_error"), F.lit(None).cast("string").alias("ocr_text"),
        F.when(state.isNull(), base64_encode(F.encode("text", "UTF-8"))).alias("image"),
    )


def label_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as labelled lines, in eight shapes."""
    case = F.col("doc_id") % LABEL_CASES
    date, amount = F.col("day_text"), german("gross_c")
    rate, product = F.col("rate_pct").cast("string"), F.col("product")

    def lines(*parts: tuple[str, Column]) -> Column:
        return F.concat_ws("\n", *[F.concat(F.lit(label), value) for label, value in parts])

    usual = [("Datum: ", date), ("Betrag: ", amount), ("MwSt: ", rate), ("Beschreibung: ", product)]
    text = (
        F.when(case == 0, lines(*usual))
        .when(case == 1, lines(*reversed(usual)))
        .when(case == 2, lines(("Betrag: ", F.lit("0,01")), *usual, ("Beschreibung:   ", F.lit("zuletzt "))))
        .when(case == 3, lines(*usual, ("MwSt-Betrag: ", german("vat_c"))))
        .when(case == 4, lines(*usual[:3], ("Beschreibung: Zeit: 12:", F.lit("30"))))
        .when(case == 5, lines(("Datum ", date), ("MwSt:", F.lit(""))))
        .when(case == 6, lines(("Datum und Betrag: ", amount), ("MwSt:\t", rate)))
        .otherwise(F.concat(F.lit("Keine Angaben zu "), F.col("number")))
    )
    return invoice(spark, sf_dir).select("*", text.alias("response"))


def position_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with fixed label positions, in eight shapes."""
    case = F.col("doc_id") % LABEL_CASES
    date, vat = F.col("day_text"), german("vat_c")
    full = F.concat(
        F.lit("Datum: "), date, F.lit("\nMwSt. Betrag: "), vat, F.lit("\nMwSt. Prozent: "),
        F.col("rate_pct"), F.lit("\nKaufobjekt: "), F.col("product"), F.lit("\nEnde"),
    )
    text = (
        F.when(case == 1, F.concat(F.lit("Datum: "), date))
        .when(case == 2, F.concat(F.lit("Das Datum fehlt.\nKaufobjekt: "), F.col("product")))
        .when(case == 3, F.concat(F.lit("Datum: "), date, F.lit("\nMwSt. Betrag: "), vat))
        .when(case == 4, F.concat(F.lit("Datum: "), date, F.lit(" Datum: 1.1.1900\nKaufobjekt:"), F.col("product")))
        .when(case == 5, F.lit("Nichts erkannt"))
        .otherwise(full)
    )
    return invoice(spark, sf_dir).select("*", text.alias("response"))


def regex_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers for the regex parser, in eight shapes."""
    case = F.col("doc_id") % LABEL_CASES
    plain = F.replace(german("gross_c"), F.lit("."), F.lit(""))
    head = F.concat(F.lit("Rechnung vom "), F.col("day_text"), F.lit("\n"))

    def body(amount: Column, tail: str) -> Column:
        return F.concat(
            F.lit("Betrag: "), amount, F.lit(f"{tail}\nMwSt:"), F.col("rate_pct"), F.lit("%\nProduktbezeichnung: "),
            F.col("product"), F.lit(" in sehr langer Ausführung für "), F.col("issuer"),
            F.lit(" \nDateiname: "), F.col("number"), F.lit(".pdf und R.pdfx\n"),
        )

    text = (
        F.when(case == 1, F.concat(body(plain, " €"), head))
        .when(case == 2, F.concat(head, body(german("gross_c"), " Euro")))
        .when(case == 3, F.concat(F.lit("Produktbezeichnung: "), F.col("product")))
        .when(case == 4, F.concat(F.lit("Betrag:\n\n"), plain, F.lit("\nMwSt: 19,5 %"), F.lit("\nDatum 1.1.2020")))
        .when(case == 5, F.concat(F.lit("Betrag: "), F.col("number"), F.lit("\nDateiname: a b.pdf")))
        .when(case == 6, F.concat(F.lit("**Betrag**: "), plain, F.lit("\nx"), F.col("day_text"), F.lit("y")))
        .otherwise(F.concat(head, body(plain, "")))
    )
    return invoice(spark, sf_dir).select("*", text.alias("response"))


def receipt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short receipt text per invoice, blank for every ninth one."""
    text = F.concat(
        F.lit("Beleg "), F.col("number"), F.lit(" vom "), F.col("day_text"), F.lit(" über "), german("gross_c"),
        F.lit(" Euro, MwSt "), F.col("rate_pct"), F.lit(" %"),
    )
    blank = F.col("doc_id") % 9 == 8
    return invoice(spark, sf_dir).select("*", F.when(blank, "  \n").otherwise(text).alias("text"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative paths with mixed suffixes; some loose in the root, some one level deeper."""
    key = F.col("o_orderkey")
    suffix = (
        F.when(key % 5 == 0, ".pdf").when(key % 5 == 1, ".PDF").when(key % 5 == 2, ".Pdf")
        .when(key % 5 == 3, ".txt").otherwise(".pdf.bak")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    named = orders.join(table(spark, sf_dir, "customer"), "c_custkey").select(
        "o_orderkey", "c_mktsegment",
        F.concat(key.cast("string"), F.lit("_"), F.col("c_name"), suffix).alias("file_name"),
    )
    folder = F.concat(F.col("c_mktsegment"), F.lit(" Belege/"))
    path = (
        F.when(key % 11 == 0, F.col("file_name"))
        .when(key % 13 == 0, F.concat(folder, F.lit("alt/"), F.col("file_name")))
        .otherwise(F.concat(folder, F.col("file_name")))
    )
    return named.select(path.alias("path"), "file_name")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def paged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose lines are taken as pages."""
    return documents(spark, sf_dir).select("doc_id", F.split("text", "\n").alias("pages"))


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paged_documents(spark, sf_dir).select("doc_id", F.posexplode("pages").alias("page_no", "text"))


def ocr_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel lists of words, confidences and positions per document."""
    doc = F.col("doc_id").cast("int")
    words = documents(spark, sf_dir).select("doc_id", F.split("text", " ").alias("text"))
    return words.select(
        "doc_id", "text",
        F.transform("text", lambda w, i: (i * 37 + doc * 11) % 101).alias("conf"),
        F.transform("text", lambda w, i: (i % 10) * 80).alias("left"),
        F.transform("text", lambda w, i: (F.floor(i / 10) * 20).cast("int")).alias("top"),
        F.transform("text", lambda w, i: F.length(w) * 8).alias("width"),
        F.transform("text", lambda w, i: F.lit(16)).alias("height"),
    )


def ocr_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same words as rows, without passing through lists."""
    words = documents(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "text"))
    pos = F.col("pos")
    return words.select(
        "doc_id", "text", ((pos * 37 + F.col("doc_id").cast("int") * 11) % 101).alias("conf"),
        ((pos % 10) * 80).alias("left"), F.expr("cast((pos div 10) * 20 as int)").alias("top"),
        (F.length("text") * 8).alias("width"), F.lit(16).alias("height"),
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(
        "vec_id", F.col("embedding").alias("start_logits"), F.reverse("embedding").alias("end_logits"),
        F.transform("embedding", lambda x, i: F.concat(F.lit("t"), i.cast("string"))).alias("tokens"),
    )


def grey_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of images named by flag and line number; the image of seventh lines is not known."""
    named = F.concat("l_returnflag", F.col("l_linenumber").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, named).alias("image"), F.floor("l_quantity").cast("int").alias("grey")
    )


def price_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with prices in cents, in few groups."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_returnflag")).alias("image"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("price")
    )


_staged: dict[tuple[str, str], str] = {}


def staged_files(spark: SparkSession, sf_dir: str) -> str:
    """Write the order keys as files below the shared folder, once per application.

    One subfolder per priority with .pdf, .PDF, .txt and .png files, and one
    level deeper per status for every seventh order. Spark writes the files, one
    line per order.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _staged:
        root = new_folder(spark, "files")
        order = F.col("o_orderkey")
        rows = table(spark, sf_dir, "orders").select(
            F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("sub"),
            order.cast("string").alias("line"), (order % 5).alias("kind"), (order % 7 == 0).alias("deep"),
        )

        def write(part: DataFrame, suffix: str, *folders: str) -> None:
            part.select(*folders, "line").write.mode("append").partitionBy(*folders).option(
                "extension", suffix
            ).csv(root)

        flat = rows.filter(~F.col("deep"))
        write(flat.filter("kind < 2"), "pdf", "category")
        write(flat.filter("kind = 2"), "PDF", "category")
        write(flat.filter("kind = 3"), "txt", "category")
        write(flat.filter("kind = 4"), "png", "category")
        write(rows.filter("deep"), "pdf", "category", "sub")
        _staged[key] = root
    return _staged[key]
