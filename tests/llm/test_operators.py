"""Every dealt operator against brute force on small rows with the awkward cases in them."""

from __future__ import annotations

import hashlib
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quittance.session import shared_folder
from quittance.llm import (
    bpe, decontaminate, exact_dedup, line_dedup, near_dedup, quality, suffix_dedup, superkmer, toxicity, warc, windows,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "row long, found string, score double, n_lines int, key_1 string, spans string"
BLANKS = " \t\n\x0b\x0c\r"


def _words(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdeéñ") for _ in range(rnd.randint(1, 7))) for _ in range(n))


PASSAGE, OTHER = _words(1, 90), _words(2, 130)
TEXTS = [
    None, "", " \n\t ", "a", "The  cat's 12 mats!\r\n  ok\n", PASSAGE, PASSAGE, f"{_words(3, 30)} {PASSAGE} {_words(4, 20)}",
    f"{OTHER}\n{OTHER}", OTHER, "x" * 450, "é" * 300, f"{PASSAGE} {OTHER}", PASSAGE.replace(" ", "\n"), _words(5, 3000),
    OTHER.upper(), "ab " * 200, "\U0001f600 ok \x00 zero", PASSAGE.replace(" ", "  ", 1), "".join(f"{w}\n" for w in "one two three".split()),
]


def _rows() -> list[tuple]:
    rows = [(i, text, "en", "s", None) for i, text in enumerate(TEXTS)]
    rows += [(5, PASSAGE, "en", "s", None), (None, PASSAGE, None, None, 1), (None, None, None, None, None), (7, "other text of an id", "de", None, 3)]
    return rows


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(_rows(), SCHEMA)


@pytest.fixture(scope="module")
def clashing(documents):
    """The same rows with further columns whose names the operators use themselves."""
    names = dict(part.split() for part in EXTRA.split(", "))
    return documents.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in names.items()])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def _sorted(rows) -> list[tuple]:
    return sorted((tuple(row) for row in rows), key=repr)


# ---------------------------------------------------------------- byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return bpe.default_ranks()


def test_bpe_equals_the_public_library(documents, ranks):
    tiktoken = pytest.importorskip("tiktoken")
    known = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for doc_id, text, *_ in _rows():
        ids = known.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), _sha(",".join(map(str, ids)).encode()), _sha((text or "").encode())))
    assert _sorted(bpe.round_trip_digests(documents, ranks).collect()) == _sorted(expected)


def test_bpe_random_texts(ranks):
    tiktoken = pytest.importorskip("tiktoken")
    known = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(3)
    parts = [*"abc  \n\t'srvemld éü中日12٣\u0085\xa0 \x1c,.!\U0001f600", "'ll", "'re", "   ", "''", "the", "\r\n"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    assert list(bpe.Encoder(ranks).encode_all(texts)) == [known.encode_ordinary(text) for text in texts]


def test_bpe_encode_then_decode(documents, ranks):
    encoded = bpe.encode_documents(documents, ranks)
    back = bpe.decode_documents(encoded, ranks)
    assert _sorted((row.doc_id, bytes(row.decoded)) for row in back.collect()) == _sorted((row[0], (row[1] or "").encode()) for row in _rows())


def test_bpe_own_vocabulary():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"aa": 259}
    encoder = bpe.Encoder(ranks)
    assert encoder.encode_piece(b"abc") == (258,)
    assert encoder.encode_piece(b"abcbc") == (258, 257)
    assert encoder.encode_piece(b"aaa") == (259, 97)


def test_bpe_empty(none, ranks):
    assert bpe.round_trip_digests(none, ranks).collect() == []


# ---------------------------------------------------------------- repeated strings and windows


def _covered(starts: list[int], length: int, n: int) -> bytearray:
    gone = bytearray(n)
    for start in starts:
        gone[start : start + length] = b"\1" * length
    return gone


def _suffix_expected(rows, length):
    seen: dict[bytes, int] = {}
    texts = [(doc_id, (text or "").encode()) for doc_id, text, *_ in rows]
    for _, raw in texts:
        for i in range(len(raw) - length + 1):
            seen[raw[i : i + length]] = seen.get(raw[i : i + length], 0) + 1
    for doc_id, raw in texts:
        gone = _covered([i for i in range(len(raw) - length + 1) if seen[raw[i : i + length]] > 1], length, len(raw))
        spans = sum(1 for i in range(len(raw)) if gone[i] and not (i and gone[i - 1]))
        yield doc_id, len(raw), gone.count(1), spans, _sha(bytes(b for b, g in zip(raw, gone) if not g))


@pytest.mark.parametrize("group", [windows.GROUP, 2])
def test_suffix_dedup(documents, clashing, monkeypatch, group):
    monkeypatch.setattr(windows, "GROUP", group)  # 2: nearly every minimiser is dealt to several groups
    expected = _sorted(_suffix_expected(_rows(), suffix_dedup.LENGTH))
    for frame in (documents, clashing):
        found = suffix_dedup.repeated_strings(frame).per_document()
        found = found.select("doc_id", "n_tokens", "n_removed", F.coalesce(F.size("spans"), F.lit(0)), "kept_sha256")
        assert _sorted(found.collect()) == expected


def test_short_lengths_of_random_bytes(spark):
    rnd = random.Random(8)
    rows = [(i, "".join(rnd.choice("ab\x00é") for _ in range(rnd.randint(0, 40)))) for i in range(60)]
    found = suffix_dedup.repeated_strings(spark.createDataFrame(rows, "doc_id long, text string"), length=9, seed=4).per_document()
    found = found.select("doc_id", "n_tokens", "n_removed", F.coalesce(F.size("spans"), F.lit(0)), "kept_sha256")
    assert _sorted(found.collect()) == _sorted(_suffix_expected(rows, 9))


def test_suffix_array_and_borders():
    import numpy as np

    rnd = random.Random(5)
    for _ in range(30):
        text = [rnd.randint(1, 3) for _ in range(rnd.randint(2, 60))] + [0]
        order = suffix_dedup.suffix_array(np.array(text, np.int16), 200)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        border = suffix_dedup.short_prefix_borders(np.array(text, np.int16), order, 5)
        for i in range(1, len(text)):
            a, b = text[order[i - 1] :], text[order[i] :]
            shared = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            if a[shared] or shared >= 5:  # the border behind a string that ends there stays open
                assert border[i] == (shared < 5)


def _window_expected(rows, n):
    words = [(doc_id, re.findall(rf"[^{BLANKS}]+", text or "")) for doc_id, text, *_ in rows]
    first: dict[tuple, float] = {}
    number = lambda doc_id: float("inf") if doc_id is None else doc_id
    for doc_id, found in words:
        for i in range(len(found) - n + 1):
            key = tuple(found[i : i + n])
            first[key] = min(first.get(key, float("inf")), number(doc_id))
    for doc_id, found in words:
        gone = _covered([i for i in range(len(found) - n + 1) if first[tuple(found[i : i + n])] < number(doc_id)], n, len(found))
        yield doc_id, len(found), gone.count(1), _sha(" ".join(w for w, g in zip(found, gone) if not g).encode())


@pytest.mark.parametrize("group", [windows.GROUP, 2])
def test_superkmer_dedup(documents, clashing, monkeypatch, group):
    monkeypatch.setattr(windows, "GROUP", group)
    expected = _sorted(_window_expected(_rows(), superkmer.WINDOW))
    for frame in (documents, clashing):
        found = superkmer.repeated_windows(frame).per_document().drop("spans")
        assert _sorted(found.collect()) == expected


def test_windows_of_nothing(none):
    assert superkmer.repeated_windows(none).per_document().collect() == []
    assert suffix_dedup.repeated_strings(none).per_document().collect() == []


# ---------------------------------------------------------------- decontamination

ITEMS = [(1, " ".join(PASSAGE.split()[5:40])), (2, "The CAT's"), (3, None), (4, "... "), (None, "zero"), (1, OTHER[:200]), (10, "ab " * 12)]


def _decontaminated(rows, items, n=10):
    normal = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    patterns = set()
    for item, text in items:
        found = normal(text)
        width = min(len(found), n)
        patterns |= {("null" if item is None else str(item), tuple(found[i : i + width])) for i in range(len(found) - width + 1) if width}
    for doc_id, text, *_ in rows:
        found = normal(text)
        gone, names = bytearray(len(found)), set()
        for name, pattern in patterns:
            for i in range(len(found) - len(pattern) + 1):
                if tuple(found[i : i + len(pattern)]) == pattern:
                    names.add(name)
                    gone[i : i + len(pattern)] = b"\1" * len(pattern)
        yield doc_id, len(found), gone.count(1), len(names), _sha(",".join(sorted(names)).encode()), gone.count(1) > 0


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 30])
def test_decontamination(spark, documents, clashing, block_words):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    expected = _sorted(_decontaminated(_rows(), ITEMS))
    found = decontaminate.contamination(documents, items, block_words=block_words)
    assert _sorted(found.drop("items", "spans").collect()) == expected
    clean = decontaminate.without_contaminated(clashing, items, block_words=block_words)
    assert clean.columns == clashing.columns
    assert clean.count() == sum(not row[-1] for row in expected)
    assert decontaminate.contamination(documents, items.limit(0)).filter("contaminated").count() == 0


def test_decontamination_spans(spark):
    items = spark.createDataFrame([(1, "größe zwei")], "item_id long, text string")
    text = "Ä GRößE,\n zwei; größe zwei drei größe"
    row = decontaminate.contamination(spark.createDataFrame([(1, text)], "doc_id long, text string"), items).first()
    assert [text[s.start : s.end] for s in row.spans] == ["GRößE,\n zwei; größe zwei"]


# ---------------------------------------------------------------- exact dedup


def _exact_expected(rows):
    groups: dict[bytes, list] = {}
    for place, (doc_id, text, *_) in enumerate(rows):
        normal = (text or "").encode().translate(None, BLANKS.encode())
        groups.setdefault(normal, []).append((-len(text or ""), doc_id is None, doc_id or 0, place, doc_id))
    for normal, members in groups.items():
        best = min(members)
        for member in members:
            yield member[4], best[4], len(members), member is best, _sha(normal)


@pytest.mark.parametrize("fan_in", [2, 8])
def test_exact_groups(spark, documents, clashing, fan_in):
    spread = spark.createDataFrame(_rows() * 3, SCHEMA).repartition(7)
    for frame, rows in ((documents, _rows()), (spread, _rows() * 3)):
        assert _sorted(exact_dedup.exact_groups(frame, fan_in).collect()) == _sorted(_exact_expected(rows))
    left = exact_dedup.without_copies(clashing, fan_in)
    assert left.columns == clashing.columns
    assert left.count() == sum(row[3] for row in _exact_expected(_rows()))


def test_exact_groups_of_nothing(none):
    assert exact_dedup.exact_groups(none).collect() == []
    assert exact_dedup.without_copies(none).collect() == []


# ---------------------------------------------------------------- near-duplicates


def _near_expected(rows):
    sets = []
    for _, text, *_ in rows:
        found = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
        sets.append({tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set())
    root = list(range(len(rows)))

    def top(i):
        return i if root[i] == i else top(root[i])

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    classes: dict[int, list] = {}
    for i in range(len(rows)):
        classes.setdefault(top(i), []).append((rows[i][0] is None, rows[i][0] or 0, i))
    for members in classes.values():
        best = min(members)
        for member in members:
            yield rows[member[2]][0], rows[best[2]][0], len(members)


def _edited(seed: int, share: float) -> str:
    rnd = random.Random(seed)
    return " ".join(w if rnd.random() > share else f"w{seed}{rnd.random():.6f}" for w in _words(77, 260).split())


def test_near_groups(spark, documents, clashing):
    rows = _rows() + [(100 + i, _edited(i, 0.001 * i), "en", "s", 1) for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = near_dedup.groups(frame)
    assert _sorted(found.select("doc_id", "class_id", "class_size").collect()) == _sorted(_near_expected(rows))
    assert found.filter("kept").count() == found.filter("class_size > 1").select("class_id", "class_size").distinct().count() + found.filter("class_size = 1").count()
    left = near_dedup.without_near_copies(clashing)
    assert left.columns == clashing.columns
    assert left.count() == near_dedup.groups(documents).filter("kept").count()


def _orphans(n: int, pairs: int) -> list[tuple]:
    """Variants at 0.7 to 0.75 to each other of a text that is not among them; some differ from it at the same places, and two of those are at 0.85."""
    rnd = random.Random(11)
    source = _words(78, 500).split()
    places = [rnd.sample(range(100), 8) for _ in range(n)]
    return [
        (i, " ".join(f"v{i}x{k}" if k % 5 == 0 and k // 5 in at else w for k, w in enumerate(source)), "en", "s", 1)
        for i, at in enumerate(places + places[:pairs])
    ]


@pytest.mark.parametrize("block", [1000, 40])
def test_near_groups_of_variants_without_their_source(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK_TEXTS", block, raising=False)
    rows = _orphans(300, 40)
    found = near_dedup.groups(spark.createDataFrame(rows, SCHEMA))
    assert _sorted(found.select("doc_id", "class_id", "class_size").collect()) == _sorted(_near_expected(rows))


def test_near_groups_of_looped_passages(spark):
    """Pairs at 0.8 or more of which one copy repeats a passage very often."""
    rows = []
    for i in range(60):
        text, n = _words(200 + i, 100).split(), 1 if i % 3 == 0 else 1000
        rows += [(2 * i, " ".join(text), "en", "s", 1), (2 * i + 1, " ".join([*text[:40], *text[10:40] * n, *text[40:]]), "en", "s", 1)]
    rows += [(1000 + i, " ".join([*(text := _words(200, 100).split())[:40], *text[10:40] * (i + 1), *text[40:]]), "en", "s", 1) for i in range(5)]
    found = near_dedup.groups(spark.createDataFrame(rows, SCHEMA))
    assert _sorted(found.select("doc_id", "class_id", "class_size").collect()) == _sorted(_near_expected(rows))


def test_near_groups_of_nothing(none):
    assert near_dedup.groups(none).collect() == []


def test_signatures_estimate_probability_jaccard():
    import numpy as np

    rng = np.random.default_rng(4)
    shared, only_a, only_b = (rng.integers(1, 1 << 62, n).astype(np.uint64) for n in (300, 100, 100))
    weights = {int(x): float(w) for x, w in zip(np.concatenate([shared, only_a, only_b]), rng.choice([1.0, 2.0, 4.0], 500))}
    a, b = (np.unique(np.concatenate([shared, only])) for only in (only_a, only_b))
    row = np.r_[np.zeros(len(a), int), np.ones(len(b), int)]
    both = np.concatenate([a, b])
    made = near_dedup.signatures(row, both, np.array([weights[int(x)] for x in both]), 2, 4096)
    x = {int(v): weights[int(v)] for v in a}
    y = {int(v): weights[int(v)] for v in b}
    exact = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in x.keys() & y.keys())
    assert abs((made[0] == made[1]).mean() - exact) < 0.03


# ---------------------------------------------------------------- line dedup


def _lines_expected(rows, least):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))
    texts = [(doc_id, (text or "").split("\n")) for doc_id, text, *_ in rows]
    counts: dict[str, int] = {}
    for _, lines in texts:
        for k in {key(line) for line in lines}:
            counts[k] = counts.get(k, 0) + 1
    for doc_id, lines in texts:
        stay = [line for line in lines if not key(line) or counts[key(line)] < least]
        yield doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)


LINES = [(i, f"Kopf {i}\n  GLEICH \nähnlich\n\n{'selten' if i < 3 else i}\r\ngleich\x0b", "de", "s", 1) for i in range(12)]


@pytest.mark.parametrize("wave", [line_dedup.WAVE_BYTES, 1])
def test_line_dedup(spark, clashing, monkeypatch, wave):
    monkeypatch.setattr(line_dedup, "WAVE_BYTES", wave)
    rows = _rows() + LINES
    for least in (2, 10):
        found = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA), least)
        assert _sorted(found.select("doc_id", "n_lines", "n_dropped", "text").collect()) == _sorted(_lines_expected(rows, least))


def test_line_dedup_can_be_undone(spark):
    base, more = spark.createDataFrame(LINES[:9], SCHEMA), spark.createDataFrame(LINES[9:], SCHEMA)
    state = line_dedup.insert(line_dedup.empty_state(spark), base)
    grown = line_dedup.insert(state, more)
    undone = line_dedup.delete(grown, more)
    dropped = lambda s: [row.n_dropped for row in line_dedup.clean(s, base).orderBy("doc_id").collect()]
    assert dropped(state) == dropped(undone) == [0] * 9
    assert dropped(grown) == [3] * 9
    assert _sorted(state.counts.collect()) == _sorted(undone.counts.collect())
    assert sum(row["keys"] for row in undone.filters.collect()) == 0


def test_line_dedup_of_nothing(none):
    assert line_dedup.dedup_lines(none).collect() == []


def test_cuckoo_filter():
    keys = [hashlib.blake2b(str(i).encode(), digest_size=16).digest() for i in range(3000)]
    made = line_dedup.CuckooFilter.of(keys[:2000])
    assert all(key in made for key in keys[:2000])
    assert sum(key in made for key in keys[2000:]) == 0
    for key in keys[:1000]:
        assert made.delete(key)
    back = line_dedup.CuckooFilter.from_bytes(made.to_bytes())
    assert not any(key in back for key in keys[:1000]) and all(key in back for key in keys[1000:2000])


# ---------------------------------------------------------------- WARC

BIG = "<p>größe</p>" * 100
PAGES = [
    (1, "http://www.Example.com/B?z=1&a=2#x", BIG), (2, "https://example.com/a", BIG), (3, None, BIG), (4, "http://example.com/a", ""),
    (5, "http://a.example.org/\r\nx", None), (6, "no url", "kurz"), (7, "http://a.example.org/y", "kurz"), (8, "http://[", "WARC/1.1\r\n\r\n" * 90),
    (9, "http://example.com:8080/a", BIG + "!"),
]


def test_warc(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("captured", F.lit("x"))
    found = warc.archived(pages)
    expected = []
    for page_id, _, html in PAGES:
        raw = (html or "").encode()
        same = max(p for p, _, h in PAGES if (h or "") == (html or ""))
        revisit = len(raw) >= 1000 and same != page_id
        expected.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", same if revisit else None))
    rows = found.collect()
    assert _sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == _sorted(expected)
    keys = [(r.url_key, r.captured, r.page_id) for r in rows]
    assert keys == sorted(keys) and len(set(keys)) == len(PAGES)
    assert warc.archived(pages.limit(0)).collect() == []


def test_url_key():
    assert warc.url_key("http://www.Example.com/B?z=1&a=2#x") == "com,example)/b?a=2&z=1"
    assert warc.url_key("https://example.com:443") == "com,example)/"
    assert warc.url_key(None) == warc.url_key("http://[") == ""


def test_loser_tree():
    rnd = random.Random(2)
    for n in range(9):
        runs = [sorted((rnd.randint(0, 20),) for _ in range(rnd.randint(0, 12))) for _ in range(n)]
        assert list(warc.LoserTree(runs, lambda entry: entry)) == sorted(e for run in runs for e in run)


# ---------------------------------------------------------------- classifiers


def _labelled(spark, n=400):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        poor, rude = rnd.random() < 0.3, rnd.random() < 0.3
        text = _words(1000 + i, rnd.randint(20, 120))
        if rude:
            text = f"{text} du {rnd.choice(['depp', 'trottel', 'lump'])} {_words(i, 5)}"
        if poor:
            text = text.replace(" ", "!! ").upper()
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(not poor), int(rude)))
    labels += [(None, 1, 1), (n + 5, None, None), (3, 1 - labels[3][1], 1 - labels[3][2])]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_without_labels_keeps_all(spark, documents):
    labels = spark.createDataFrame([(1, None), (10**9, 1)], "doc_id long, quality int")
    for table in (labels.limit(0), labels):
        left = quality.without_rejected(documents, table)
        assert left.columns == documents.columns and left.count() == documents.count()


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_on_held_out_rows(spark, documents, clashing, none, module, label):
    texts, labels = _labelled(spark)
    found = module.scores(texts, labels).join(labels, "doc_id").filter("held_out AND doc_id <> 3").toPandas()
    assert len(found) > 50
    assert (found["predicted"] == found[label]).mean() > 0.95
    rows = module.scores(documents, labels).collect()
    assert len(rows) == len(_rows()) and all(0 <= row.score <= 1 for row in rows)
    assert all(row.held_out for row in rows if row.doc_id is None)
    assert module.scores(none, labels).collect() == []
    assert len(module.scores(documents, labels.limit(0)).collect()) == len(_rows())
    drop = quality.without_rejected if module is quality else toxicity.without_toxic
    assert drop(clashing, labels).columns == clashing.columns


def test_scores_do_not_depend_on_other_columns(spark):
    texts, labels = _labelled(spark)
    other = texts.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.lit(0).cast("long"))
    for module in (quality, toxicity):
        a, b = (dict(module.scores(t, labels).select("doc_id", "score").collect()) for t in (texts, other))
        assert a == b


def test_factorisation_machine_pairs():
    import numpy as np

    rng = np.random.default_rng(1)
    x, w, v = rng.random((5, 7)), rng.random(7), rng.random((7, 3))
    model = quality.Model(np.zeros(1), np.ones(1), 0.5, w, v)
    slow = [0.5 + a @ w + sum(v[i] @ v[j] * a[i] * a[j] for i in range(7) for j in range(i)) for a in x]
    assert np.allclose(model.logits(x), slow)


def test_counterfactuals_lower_the_score_of_mentions(spark):
    """A group named mostly in toxic rows: neutral mentions score lower with the penalty than without."""
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        rude = i % 2 == 0
        named = rnd.random() < (0.7 if rude else 0.05)
        text = f"{_words(i, 30)} {'lump' if rude and rnd.random() < 0.8 else ''} {'muslims' if named else ''}"
        rows.append((i, text, "en", "s", 1))
        labels.append((i, 1, int(rude)))
    texts, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    neutral = spark.createDataFrame([(i, f"{_words(5000 + i, 30)} muslims", "en", "s", 1) for i in range(20)], SCHEMA)
    plain, fair = (
        toxicity.score(neutral, toxicity.fit(texts, known, penalty=penalty)).agg(F.avg("score")).first()[0] for penalty in (0.0, 20.0)
    )
    assert fair < plain - 0.1
    assert toxicity.counterfactual("Muslims live here. Men too!") == "jews live here. women too!"


def test_strings_of_windows_are_removed_once_used(spark):
    """The two tables of packed strings are the largest ones; only places and values are needed after them."""
    shared_folder(spark)
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    found = suffix_dedup.repeated_strings(spark.createDataFrame([(1, "ab" * 300), (2, "ab" * 200 + "c" * 250)], "doc_id long, text string"))
    assert found.per_document().filter("n_removed > 0").count() == 2
    left = {path.name.rsplit("-", 1)[0] for path in set(folder.iterdir()) - before}
    assert "quittance-texts" in left and not left & {"quittance-super-windows", "quittance-distinct-windows"}
