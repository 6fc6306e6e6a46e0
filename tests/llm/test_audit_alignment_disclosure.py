"""Filter audit, tokenizer alignment and personal data against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from itertools import permutations

import pytest
import test_operators as brute
from pyspark.sql import functions as F

from quittance.llm import disclosure, filter_audit, token_alignment

documents, clashing, none = brute.documents, brute.clashing, brute.none  # fixtures
BLANKS = brute.BLANKS

# ---------------------------------------------------------------- filter audit


def _fails(text: str, doc_id, first) -> set[str]:
    found = re.findall(rf"[^{BLANKS}]+", text)
    tests = {
        "A": len(found) < 50, "B": 100 * len(set(found)) < 65 * len(found),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in text for c in "#$%&*|"),
        "E": doc_id is not None and first is not None and first < doc_id,
    }
    return {name for name, failed in tests.items() if failed}


def _audited(rows, labels):
    """Applies the filters one by one, in every order."""
    first: dict[str, int] = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    parts: dict[str, list] = {}
    for doc_id, text, _, source, *_ in rows:
        parts.setdefault(source or "", []).append((doc_id, _fails(text or "", doc_id, first.get(text or ""))))
    for part, members in parts.items():
        found, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = members
            for step, name in enumerate(order, 1):
                gone = [m for m in left if name in m[1]]
                left = [m for m in left if name not in m[1]]
                shapley[name] += len(gone)
                failing = sum(name in fails for _, fails in members)
                found.append((
                    part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(fails == {name} for _, fails in members),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), name,
                ))
        yield from ((*row[:-1], shapley[row[-1]]) for row in found)


LABELS = [(0, 1, 0), (1, 1, 1), (1, 0, 0), (5, 0, 1), (6, 1, None), (7, None, 1), (None, 1, 1), (12, 1, 0), (99, 1, 1), (8, 2, 2)]


def _varied() -> list[tuple]:
    odd = [("A B " * 30, "s"), ("cost $5 & more", None), ("", ""), (brute.PASSAGE + " #", "t"), ("ab " * 200, "s"), ("ab " * 200, None)]
    more = [(50 + i, text, "en", source, 1) for i, (text, source) in enumerate(odd)]
    return brute._rows() + more + more[:2]


@pytest.mark.parametrize("tasks", [1, 7])
def test_filter_audit(spark, tasks):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(_varied(), brute.SCHEMA).repartition(tasks)
    assert brute._sorted(filter_audit.audit(frame, labels).collect()) == brute._sorted(_audited(_varied(), LABELS))


def test_filter_audit_of_nothing_and_clashing_names(spark, clashing, none):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert filter_audit.audit(none, labels).collect() == []
    names = {"part": "string", "good": "int", "digest": "string", "FAILED": "int"}
    wide = clashing.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in names.items()])
    assert brute._sorted(filter_audit.audit(wide, labels.limit(0)).collect()) == brute._sorted(_audited(brute._rows(), []))


def test_positional_popcounts():
    import numpy as np

    rnd = np.random.default_rng(4)
    for size, groups in ((0, 1), (1, 1), (5000, 1), (3000, 7), (400, 300)):
        words, group = rnd.integers(0, 1 << 32, size, dtype=np.uint32), np.sort(rnd.integers(0, groups, size))
        plain = np.zeros((groups, 32), np.int64)
        for word, of in zip(words.tolist(), group.tolist(), strict=True):
            plain[of] += [word >> k & 1 for k in range(32)]
        assert (filter_audit.positional_popcounts(words, group, groups) == plain).all()


def test_survival_words():
    for failed, word in enumerate(filter_audit.survival_words().tolist()):
        assert [word >> subset & 1 for subset in range(32)] == [int(failed & subset == 0) for subset in range(32)]


# ---------------------------------------------------------------- tokenizer alignment

ODD = ["▁ a", "  lead", "a\n\nb\t c", "\x00a", "<s> </s> <|endoftext|> <0x41> <unk>", "é�\U0001f600", "中文 ١٢ naïve\r\n", " ", "▁"]


@pytest.fixture(scope="module")
def libraries():
    tokenizers = pytest.importorskip("tokenizers")
    sentencepiece = pytest.importorskip("sentencepiece")
    paths = token_alignment.default_paths()
    a = tokenizers.Tokenizer.from_file(paths.a)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=paths.b)


def _token_bytes(libraries):
    a, b = libraries
    alphabet = {}
    others = iter(range(0x100, 0x200))
    for byte in range(256):
        printed = 0x21 <= byte <= 0x7E or 0xA1 <= byte <= 0xAC or byte >= 0xAE
        alphabet[chr(byte) if printed else chr(next(others))] = byte
    of_a = lambda i: bytes(alphabet[c] for c in a.id_to_token(i))

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()

    return of_a, of_b


def _aligned(rows, libraries):
    a, b = libraries
    of_a, of_b = _token_bytes(libraries)
    links, found = {}, []
    for doc_id, text, *_ in rows:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        raw = " ".encode() + (text or "").encode()
        if b"".join(map(of_a, ids_a)) != raw or b"".join(map(of_b, ids_b)) != raw:
            found.append((doc_id, 0, 0, "", []))
            continue
        ends = []
        for ids, of in ((ids_a, of_a), (ids_b, of_b)):
            at, here = 0, []
            for i in ids:
                at += len(of(i))
                here.append(at)
            ends.append(here)
        mine = [(x, y) for i, x in enumerate(ids_a) for j, y in enumerate(ids_b) if ends[0][i] == ends[1][j]] if len(ids_a) < 3000 else [
            (ids_a[ends[0].index(e)], ids_b[ends[1].index(e)]) for e in ends[0] if e in set(ends[1])
        ]
        groups, i, j = [], 0, 0
        for e in ends[0]:
            if e in ends[1]:
                p, q = ends[0].index(e) + 1, ends[1].index(e) + 1
                groups.append(",".join(map(str, ids_a[i:p])) + "|" + ",".join(map(str, ids_b[j:q])))
                i, j = p, q
        found.append((doc_id, len(ids_a), len(ids_b), ";".join(groups), mine))
        for pair in mine:
            links[pair] = links.get(pair, 0) + 1
    best: dict[int, int] = {}
    for (_, y), n in links.items():
        best[y] = max(best.get(y, 0), n)
    for doc_id, n_a, n_b, groups, mine in found:
        yield (
            doc_id, n_a, n_b, groups.count("|"), len(mine), sum(links[p] == best[p[1]] for p in mine), sum(links[p] for p in mine),
            hashlib.sha256(groups.encode()).hexdigest() if n_a else "",
        )


def test_alignment(spark, documents, clashing, libraries):
    for frame in (documents, clashing):
        assert brute._sorted(token_alignment.alignment(frame).collect()) == brute._sorted(_aligned(brute._rows(), libraries))
    rows = [(i, text) for i, text in enumerate(ODD)] + [(0, "twice"), (None, "twice"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert brute._sorted(token_alignment.alignment(frame).collect()) == brute._sorted(_aligned(rows, libraries))


def test_alignment_of_nothing(none):
    assert token_alignment.alignment(none).collect() == []


def test_both_libraries_give_the_ids_of_a(libraries):
    a, _ = libraries
    both = token_alignment.Tokenizers(token_alignment.default_paths())
    rnd = random.Random(2)
    parts = [*"abc  \n\t'srvemld éü中日12٣\u0085\xa0 \x1c,.!\U0001f600", "'ll", "'re", "   ", "''", "the", "\r\n", "<|endoftext|>"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    assert both.encode([" " + text for text in texts])[0] == [found.ids for found in a.encode_batch([" " + text for text in texts], add_special_tokens=False)]


def test_word_by_word_equals_whole_texts(libraries, monkeypatch):
    words, whole = (token_alignment.Tokenizers(token_alignment.default_paths()) for _ in range(2))
    assert words.by_words
    whole.by_words = False
    rnd = random.Random(5)
    parts = [*"abc   \n\t'srvemld éü中日12٣\u0085\xa0 \x1c\u2028,.!\U0001f600▁", "'ll", " the", " von", "\r\n", "  ", " x" * 40, "y" * 80, "\u2003"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(1500)] + ["plain words only", None, "", "a b"]
    expected = list(whole.align_texts(texts))
    assert list(words.align_texts(texts)) == expected
    monkeypatch.setattr(token_alignment, "REMEMBERED", 3)
    assert [found for i in range(0, len(texts), 50) for found in words.align_texts(texts[i : i + 50])] == expected
    assert sum(found.n_a > 0 for found in expected) > 500 and max(map(len, words.known)) <= token_alignment.LONGEST_REMEMBERED


def test_bound_of_pairs():
    assert token_alignment.most_pairs([b"a", b"ba", b"cba"], [b"a", b"xa", b"ba"]) == 7
    tokens = token_alignment.Tokenizers(token_alignment.default_paths())
    assert token_alignment.most_pairs(tokens.a_bytes, tokens.b_bytes) < 400_000


def test_long_text_alignment(spark, libraries):
    """Some MB in one cell: tokens are those of the libraries and all bytes lie in groups."""
    text = brute._words(9, 400_000)
    row = token_alignment.alignment(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(text) > 1_500_000 and row.n_b == len(libraries[1].encode(text))
    assert row.n_a == len(libraries[0].encode(" " + text, add_special_tokens=False).ids) and row.n_groups == row.n_links <= min(row.n_a, row.n_b)


# ---------------------------------------------------------------- personal data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _base(text: str):
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(p and int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and _luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                yield kind, m.start(), m.end(), m[0]


def _fold(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _private(rows):
    any_base = "|".join(f"(?:{PLAIN[k]})" for k in ("email", "ip", "phone", "card"))
    base = [list(_base(text or "")) for _, text, *_ in rows]
    n_entity, n_both, contexts, n_term = {}, {}, {}, {}
    for row, (_, text, *_) in enumerate(rows):
        text = text or ""
        for term in {m[0] for m in TERM.finditer(_fold(text))}:
            n_term[term] = n_term.get(term, 0) + 1
        edges = {kind: [(m.start(), m.end()) for m in re.finditer(PLAIN[kind], text)] for kind in PLAIN}
        for kind, start, end, value in base[row]:
            before = max([0, *[e for _, e in edges[kind] if e <= start]])
            after = min([len(text), *[s for s, _ in edges[kind] if s >= end]])
            left, right = text[before:start][-200:], text[end:after][:200]
            near = [TERM.findall(_fold(re.sub(any_base, " ", side))) for side in (left, right)]
            near = (tuple(near[0][-6:]), tuple(near[1][:6]))
            entity = kind, _fold(value) if kind == "email" else re.sub("[^0-9.]" if kind == "ip" else "[^0-9]", "", value)
            n_entity.setdefault(entity, set()).add(row)
            for term in {*near[0], *near[1]}:
                n_both.setdefault((entity, term), set()).add(row)
                contexts.setdefault((entity, term), set()).add(near)
    disclosing = set()
    for (entity, term), where in n_both.items():
        known = len(n_entity[entity]) / len(rows)
        if len(contexts[entity, term]) >= 3 and known < 1 and math.log(len(where) / n_term[term] / known) >= 0.75 * -math.log(known) - 1e-12:
            disclosing.add(term)
    for (doc_id, text, *_), mine in zip(rows, base, strict=True):
        terms = [
            ("term", m.start(), m.end()) for m in TERM.finditer(_fold(text or ""))
            if m[0] in disclosing and not any(s < m.end() and m.start() < e for _, s, e, _ in mine)
        ]
        written = [f"{k}:{s}:{e}" for k, s, e, *_ in [*mine, *terms]]
        counts = [sum(k == kind for k, *_ in mine) for kind in PLAIN]
        own = ",".join(written[: len(mine)])
        yield doc_id, *counts, len(terms), hashlib.sha256(own.encode()).hexdigest(), ",".join(written)


def _told() -> list[tuple]:
    """An address that a name goes with, in different words each time; a switchboard number that stands anywhere."""
    rnd = random.Random(6)
    fill = lambda n: " ".join(rnd.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(n))
    rows = [(i, f"{fill(8)} Müller-Lüdenscheid {fill(rnd.randint(0, 3))} <m.l@Haus.example> {fill(9)}") for i in range(6)]
    rows += [(10 + i, f"{fill(5)} m.l@haus.example {fill(8)}") for i in range(2)]
    rows += [(20 + i, f"{fill(20)} {rnd.choice(['+49 (30) 1234-567', '10.0.0.255', '4111 1111-11111111', ''])} {fill(20)}") for i in range(60)]
    rows += [(90, "Also lüdenscheid, alone: LüDENSCHEID müller."), (91, "visit 48213 +49 30 1234 567 room 48213"), (92, "48213 twice +49 30 1234567"), (93, "x 48213 (+49 (30) 1234567)")]
    return rows


CASES = [
    "Call Ann +1 (456) 555-2186 or x@a.b.c_d@e.f, 1.2.3.4.5.6.7.8 4111 1111 1111 1111 999.1.1.1", "x@a.b.@c.d @a.b y@c", "001.2.3.0255 1.2.3.4444 256.1.1.1",
    "4111-1111 1111-1111 4111--1111 5500000000000004 5500000000000005", "+1((((( +1 2 +12345678 +1234567890123456 +1 23-45.67(8", "é\U0001f600 a@b.c \U0001f600+1 23 45 67 89", "a@b.c" * 3,
    "1" * 500 + " " + "1.1.1.1 " * 700, "m@n.o " * 300, None, "", " \n",
]


def test_personal_data(spark, documents, clashing):
    rows = [(100 + i, text) for i, text in enumerate(CASES)] + _told() + [(3, "m.l@haus.example"), (None, "Lüdenscheid 1.2.3.4"), (100, CASES[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    expected = list(_private(rows))
    assert sum(row[5] for row in expected) > 10  # the name is found
    assert brute._sorted(disclosure.personal_data(frame).collect()) == brute._sorted(expected)
    for frame in (documents, clashing):
        assert brute._sorted(disclosure.personal_data(frame).collect()) == brute._sorted(_private(brute._rows()))


def test_copies_disclose_nothing(spark):
    rows = [(i, "ask Quentin at q@r.example soon") for i in range(50)] + [(100 + i, f"other text {i}") for i in range(100)]
    assert disclosure.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).filter("n_term > 0").isEmpty()


def test_random_base_spans(spark):
    rnd = random.Random(12)
    parts = [*"ab1290..@@+- ()é", "1.2.3.4", "a@b.c", "4111111111111111", "+1 234 567 89", "255", "\n"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60)))) for i in range(800)]
    found = disclosure.personal_data(spark.createDataFrame(rows, "doc_id long, text string"), min_contexts=10**6)
    expected = [(row[0], ",".join(f"{k}:{s}:{e}" for k, s, e, _ in _base(row[1]))) for row in rows]
    assert brute._sorted(found.select("doc_id", "spans").collect()) == brute._sorted(expected)


def test_sanitised(spark, clashing, none):
    rows = _told() + [(200, None), (201, "x@a.b and +49 30 1234567")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("KEY_1", F.lit(1)).withColumn("edits", F.lit("e"))
    clean = disclosure.sanitised(frame)
    assert clean.columns == frame.columns
    texts = {row.doc_id: row.text for row in clean.collect()}
    assert len(texts) == len(rows) and texts[200] is None and texts[201] == "[EMAIL] and [PHONE]"
    assert texts[90] == "Also [WORD], alone: [WORD] [WORD]."
    assert "@" not in "".join(filter(None, texts.values())) and "Müller" not in "".join(filter(None, texts.values()))
    assert disclosure.sanitised(clashing).columns == clashing.columns and disclosure.sanitised(clashing).count() == clashing.count()
    assert disclosure.sanitised(none).collect() == [] and disclosure.personal_data(none).collect() == []


def test_running_sums(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.randint(0, 9) for _ in range(n)]) for i, n in enumerate((0, 1, 255, 256, 257, 1000, 70_000))]
    found = spark.createDataFrame(rows, "i int, x array<int>").select("i", disclosure.running_sums(F.col("x")).alias("y")).collect()
    for (_, numbers), row in zip(rows, sorted(found), strict=True):
        total, sums = 0, []
        for number in numbers:
            total += number
            sums.append(total)
        assert row.y == sums


def test_personal_data_without_python(spark, documents):
    plan = disclosure.personal_data(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
