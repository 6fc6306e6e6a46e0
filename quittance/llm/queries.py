"""One query per operator over the given tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quittance.llm import (
    bpe, decontaminate, disclosure, exact_dedup, filter_audit, line_dedup, near_dedup, quality, suffix_dedup, superkmer, token_alignment, toxicity, warc,
)
from quittance.llm.tables import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: merges by rank are iterative.  Tested against the public tokenizer library."""
    return bpe.round_trip_digests(load(spark, sf_dir, "documents"), bpe.default_ranks())


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
    return found.drop("items", "spans")


ORACLE_SQL["op5_decontaminate"] = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), pattern AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM item WHERE len(w) > 0)
), place AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
    FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc, (SELECT DISTINCT n FROM pattern) WHERE len(w) >= n
    )
), hit AS (
    SELECT doc_id, item_id, i, n FROM place JOIN pattern USING (n, words)
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(load(spark, sf_dir, "documents"))


ORACLE_SQL["op6_exact_dedup"] = r"""
WITH normal AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_chars,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM normal
WINDOW best AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id)
"""


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: a trained model.  Tested by held-out accuracy."""
    return toxicity.scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: a trained model.  Tested by held-out accuracy."""
    return quality.scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL["op10_line_dedup"] = r"""
WITH line AS (
    SELECT doc_id, i, s[i] AS line,
           regexp_replace(
               translate(s[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS key
    FROM (
        SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)
    )
), frequent AS (
    SELECT key FROM line WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(frequent.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE frequent.key IS NULL), '')) AS kept_sha256
FROM line LEFT JOIN frequent USING (key) GROUP BY doc_id
"""


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.archived(load(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL["op8_warc"] = r"""
WITH page AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), best AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM page
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND first_id <> page_id THEN first_id END AS refers_to
FROM best
"""


@query
def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: signatures are random.  Tested against all pairs by brute force."""
    return near_dedup.groups(load(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: every byte of the corpus starts a string.  Tested against brute force."""
    found = suffix_dedup.repeated_strings(load(spark, sf_dir, "documents")).per_document()
    return found.select(
        "doc_id", F.col("n_tokens").alias("n_bytes"), "n_removed", F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "kept_sha256"
    )


@query
def op4_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = superkmer.repeated_windows(load(spark, sf_dir, "documents")).per_document()
    return found.select("doc_id", F.col("n_tokens").alias("n_words"), "n_removed", "kept_sha256")


ORACLE_SQL["op4_superkmer_dedup"] = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), place AS (
    SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS words
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)
), first AS (
    SELECT words, min(doc_id) AS doc_id FROM place GROUP BY words
), gone AS (
    SELECT DISTINCT place.doc_id, unnest(range(i, i + 50)) AS p
    FROM place JOIN first USING (words) WHERE first.doc_id < place.doc_id
), word AS (
    SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM doc)
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), removed AS (
    SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


ORACLE_SQL["op11_filter_audit"] = r"""
WITH doc AS (
    SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), said AS (
    SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), cell AS (
    SELECT part, f, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
    FROM (
        SELECT part, doc_id, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
               + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT
               + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(first_id < doc_id, false)::INT AS f
        FROM doc
    ) LEFT JOIN said USING (doc_id)
    GROUP BY part, f
), letter AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
    FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
    SELECT filter_order, i::INT AS step, (1 << (ascii(filter_order[i]) - 65)) AS bit,
           coalesce(list_sum(list_transform(range(1, i), lambda j: 1 << (ascii(filter_order[j]) - 65))), 0)::BIGINT AS before
    FROM orders, unnest(range(1, 6)) AS place(i)
), effect AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN f & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN f & before = 0 AND f & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN f & before <> 0 AND f & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN f = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN f & before = 0 AND f & bit <> 0 THEN n_good ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN f & before = 0 AND f & bit <> 0 THEN n_toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM cell, steps
    GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM effect
"""


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL: tokenizers are iterative.  Tested against the public libraries and a plain count of links."""
    return token_alignment.alignment(load(spark, sf_dir, "documents"))


@query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.personal_data(load(spark, sf_dir, "documents"))


ORACLE_SQL["op13_personal_data"] = r"""
WITH doc AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS ft
    FROM documents
), pattern AS (
    SELECT * FROM (VALUES
        (1, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'),
        (2, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
        (3, 'card', '[0-9]([\x20-]?[0-9])+'),
        (4, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')
    ) AS p(k, kind, p)
), found AS (
    SELECT row, 1 AS k, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS m,
           string_split_regex(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS s FROM doc
    UNION ALL
    SELECT row, 2, regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), string_split_regex(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') FROM doc
    UNION ALL
    SELECT row, 3, regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+'), string_split_regex(t, '[0-9]([\x20-]?[0-9])+') FROM doc
    UNION ALL
    SELECT row, 4, regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), string_split_regex(t, '\+[0-9][\x20().0-9-]+[0-9]') FROM doc
), each AS (
    SELECT row, k, kind, m[i] AS v, regexp_replace(m[i], '[^0-9]', '', 'g') AS d, right(s[i], 200) AS l, left(s[i + 1], 200) AS r,
           list_sum(list_transform(s[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM found) JOIN pattern USING (k)
), base AS (
    SELECT *, (start + length(v)) AS stop,
           kind || ' ' || CASE k WHEN 1 THEN translate(v, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                                 WHEN 2 THEN v ELSE d END AS entity
    FROM each
    WHERE CASE k
        WHEN 1 THEN true
        WHEN 2 THEN regexp_full_match(v, '0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}')
        WHEN 3 THEN length(d) BETWEEN 16 AND 19 AND list_sum(list_transform(range(0, length(d)), lambda j:
            CASE WHEN j % 2 = 0 THEN substr(d, length(d) - j, 1)::INT
                 WHEN substr(d, length(d) - j, 1)::INT > 4 THEN 2 * substr(d, length(d) - j, 1)::INT - 9
                 ELSE 2 * substr(d, length(d) - j, 1)::INT END)) % 10 = 0
        ELSE length(d) BETWEEN 8 AND 15 END
), near AS (
    SELECT row, entity, lw[-6:] AS lw, rw[:6] AS rw
    FROM (
        SELECT row, entity, regexp_extract_all(translate(regexp_replace(l, any_base, ' ', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), word) AS lw,
               regexp_extract_all(translate(regexp_replace(r, any_base, ' ', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), word) AS rw
        FROM (SELECT *, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+|[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)|\+[0-9][\x20().0-9-]+[0-9]|[0-9]([\x20-]?[0-9])+' AS any_base,
                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+' AS word FROM base)
    )
), pair AS (
    SELECT entity, term, count(DISTINCT row) AS n_both
    FROM (SELECT row, entity, array_to_string(lw, ' ') || '|' || array_to_string(rw, ' ') AS context, unnest(list_distinct(lw || rw)) AS term FROM near)
    GROUP BY entity, term HAVING count(DISTINCT context) >= 3
), entities AS (
    SELECT entity, count(DISTINCT row) AS n_entity FROM near GROUP BY entity
), place AS (
    SELECT row, term, sum(length(before) + length(term)) OVER (PARTITION BY row ORDER BY i) AS stop
    FROM (SELECT row, unnest(m) AS term, unnest(s[:len(m)]) AS before, unnest(range(len(m))) AS i FROM (
        SELECT row, regexp_extract_all(ft, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS m,
               string_split_regex(ft, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS s FROM doc))
), terms AS (
    SELECT term, count(DISTINCT row) AS n_term FROM place WHERE term IN (SELECT term FROM pair) GROUP BY term
), disclosing AS (
    SELECT DISTINCT term
    FROM pair JOIN entities USING (entity) JOIN terms USING (term), (SELECT count(*) AS n FROM doc)
    WHERE n_entity < n AND pow(n_both / n_term, 4) >= n_entity / n
), spans AS (
    SELECT row, k, kind, start, stop FROM base
    UNION ALL
    SELECT row, 5, 'term', stop - length(term) AS start, stop
    FROM place SEMI JOIN disclosing USING (term)
    WHERE NOT EXISTS (
        SELECT 1 FROM base WHERE base.row = place.row AND base.start < place.stop AND place.stop - length(place.term) < base.stop
    )
), written AS (
    SELECT row, count(*) FILTER (k = 1) AS n_email, count(*) FILTER (k = 2) AS n_ip, count(*) FILTER (k = 3) AS n_card,
           count(*) FILTER (k = 4) AS n_phone, count(*) FILTER (k = 5) AS n_term,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) FILTER (k < 5) AS base,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY k, start) AS spans
    FROM spans GROUP BY row
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       coalesce(n_term, 0) AS n_term, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN written USING (row)
"""
