"""The toxicity model against plain loops; clashing names, several blocks of items, long texts."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import test_operators as brute
from pyspark.sql import functions as F

from quittance.llm import decontaminate, labelled, line_dedup, quality, toxicity
from quittance.llm.batches import blocks
from quittance.llm.tables import load, noted

documents, clashing, none = brute.documents, brute.clashing, brute.none  # fixtures
SF_DIR = "/root/testdata/sf0.01"


def _sample(seed, rows=40, n=12):
    rnd = random.Random(seed)
    seen = [np.array(sorted(rnd.sample(range(n), rnd.randint(0, 6))), np.int64) for _ in range(rows)]
    swapped = [x if rnd.random() < 0.6 else np.array(sorted(set(x.tolist()) ^ set(rnd.sample(range(n), 2))), np.int64) for x in seen]
    return seen, swapped, np.array([rnd.randint(0, 1) for _ in range(rows)], float)


def _loss(w, bias, penalty, seen, swapped, label):
    """Term by term, document by document."""
    total, changes = 0.0, []
    for x, y, is_toxic in zip(seen, swapped, label, strict=True):
        logit = bias + sum(w[i] for i in x)
        total += math.log(1 + math.exp(-logit if is_toxic else logit)) / len(label)
        if x.tolist() != y.tolist():
            changes.append(sum(w[i] for i in y) - sum(w[i] for i in x))
    return total + toxicity.L2 / 2 * sum(v * v for v in w) + (penalty * sum(c * c for c in changes) / len(changes) if changes else 0)


@pytest.mark.parametrize("penalty", [0.0, 4.0])
def test_gradient_of_the_penalised_loss(penalty):
    seen, swapped, label = _sample(1)
    rnd = np.random.default_rng(2)
    w, bias = rnd.normal(size=12), 0.3
    found = toxicity.Sample.of(seen, swapped, label).gradient(w, bias, penalty)
    for i in range(13):
        step = np.zeros(13)
        step[i] = 1e-5
        up, down = (_loss(w + s * step[:12], bias + s * step[12], penalty, seen, swapped, label) for s in (1, -1))
        assert abs((up - down) / 2e-5 - found[i]) < 1e-6


def test_training_lowers_the_loss_and_the_penalty_the_change():
    seen, swapped, label = _sample(3, 200)
    sample = toxicity.Sample.of(seen, swapped, label)

    def change(w):
        return sum((sum(w[i] for i in y) - sum(w[i] for i in x)) ** 2 for x, y in zip(seen, swapped, strict=True))

    free, held = (toxicity._train(sample, 12, penalty) for penalty in (0.0, 4.0))
    for (w, bias), penalty in ((free, 0.0), (held, 4.0)):
        base = _loss(np.zeros(12), math.log(label.mean() / (1 - label.mean())), penalty, seen, swapped, label)
        assert _loss(w, bias, penalty, seen, swapped, label) < base
        assert np.abs(sample.gradient(w, bias, penalty)).max() < 2e-3
    assert change(held[0]) < 0.5 * change(free[0])


def _plain_features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()
    words = re.findall(rb"[0-9a-z\x80-\xff]+", lower)
    return {("word", w) for w in words} | {(k, w[:k]) for w in words for k in (4, 5) if len(w) > k}


def test_scores_are_sums_over_the_sets_of_features():
    texts = [t for _, t, *_ in brute._rows()] + ["WOMEN and men", "womenfolk woman"]
    known: dict = {}
    for text in texts:
        if text is not None:
            mine, plain = toxicity.distinct_features(text), _plain_features(text)
            assert len(mine) == len(plain)
            known[text] = mine
    rnd = np.random.default_rng(4)
    every = np.unique(np.concatenate([x for x in known.values()])).view(np.uint64)
    chosen = np.sort(rnd.choice(every, len(every) // 2, replace=False))
    weights = rnd.normal(size=len(chosen))
    model = toxicity._model(chosen, weights, -0.4)
    of = dict(zip(chosen.view(np.int64).tolist(), weights.tolist(), strict=True))
    scores = np.concatenate([model.scores(block) for block in blocks(pa.array(texts))])
    for text, score in zip(texts, scores, strict=True):
        logit = -0.4 + sum(of.get(h, 0.0) for h in (known[text].tolist() if text is not None else ()))
        assert abs(score - 1 / (1 + math.exp(-min(30, max(-30, logit))))) < 1e-9


def test_choice_of_features_is_a_count(spark):
    docs, labels = load(spark, SF_DIR, "documents"), load(spark, SF_DIR, "labels")
    model = toxicity.fit(docs, labels)
    rows = labelled.sample(docs, labels, "toxic", toxicity.SAMPLE_ROWS).collect()
    sets = [(set(toxicity.distinct_features(r.text or "").tolist()), r.label) for r in rows]
    toxic = sum(is_toxic for _, is_toxic in sets)
    counts: dict[int, list[int]] = {}
    for found, is_toxic in sets:
        for feature in found:
            counts.setdefault(feature, [0, 0])[1 - is_toxic] += 1
    strong = []
    for feature, (yes, no) in counts.items():
        if yes + no >= toxicity.LEAST_DOCUMENTS:
            a, b = yes + 0.5, no + 0.5
            gap = (math.log(a / (toxic + 1)) - math.log(b / (len(sets) - toxic + 1))) / math.sqrt(1 / a + 1 / b)
            if abs(gap) >= 3:
                strong.append((-abs(gap), feature))
    expected = {feature for _, feature in sorted(strong)[: toxicity.MODEL_FEATURES]}
    assert set(model.hashes.view(np.int64).tolist()) == expected


def test_held_out_ranking(spark):
    docs, labels = load(spark, "/root/testdata/sf0.1", "documents"), load(spark, "/root/testdata/sf0.1", "labels")
    rows = toxicity.scores(docs, labels).filter("held_out").join(labels.filter("toxic IS NOT NULL"), "doc_id").select("score", "toxic", "predicted").collect()
    good, bad = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    auc = sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))
    assert len(good) > 20 and auc > 0.95


@pytest.mark.parametrize("label", [0, 1, None])
def test_labels_of_one_class_teach_nothing(spark, clashing, label):
    labels = spark.createDataFrame([(i, label) for i in range(20)], "doc_id long, toxic int")
    found = toxicity.scores(clashing, labels)
    assert found.filter("predicted = 1").isEmpty() and found.filter("score < 0 OR score > 0.01").isEmpty()
    left = toxicity.without_toxic(clashing, labels)
    assert left.columns == clashing.columns and left.count() == clashing.count()


def test_clashing_names(spark):
    frame = spark.createDataFrame([(i, "same line\nown %d" % i, 5, 7, 9.0) for i in range(12)], "doc_id long, text string, N_LINES int, n_dropped int, Score double")
    state = line_dedup.insert(line_dedup.empty_state(spark, 16, 10), frame.select("doc_id", "text"))
    clean = line_dedup.clean(state, frame, indexed=True)
    assert clean.columns == [*frame.columns, "n_lines_", "n_dropped_"]
    assert {(r.N_LINES, r.n_dropped, r.n_lines_, r.n_dropped_) for r in clean.collect()} == {(5, 7, 2, 1)}
    scored = toxicity.score(frame, toxicity._model(np.zeros(0, np.uint64), np.zeros(0), 0.0))
    assert scored.columns == [*frame.columns, "score_"] and {r["score_"] for r in scored.collect()} == {0.5}


def test_blocks_of_items_take_one_scan_each(spark, documents, clashing):
    items = spark.createDataFrame(brute.ITEMS, "item_id long, text string")
    expected = brute._sorted(decontaminate.contamination(documents, items).collect())
    with noted() as tables:
        found = decontaminate.contamination(documents, items, block_words=30)
    assert brute._sorted(found.collect()) == expected
    words = [len(decontaminate.normal_words(text)) for _, text in brute.ITEMS]
    n_blocks = sum("-block-hits-" in path for path in tables)
    assert 2 <= n_blocks <= len(words)  # a scan for each block, whatever the number of texts
    wide = clashing.select("*", F.lit(1).alias("RUNS"), F.lit(2).alias("key_2"))
    assert decontaminate.without_contaminated(wide, items, block_words=30).columns == wide.columns


def test_texts_of_some_megabytes(spark):
    """Line dedup and decontamination on one very long cell."""
    line = brute._words(31, 12)
    text = "\n".join(f"{line}\n{i} {brute._words(i, 6)}" for i in range(30_000))
    rows = [(0, text)] + [(1 + i, line) for i in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(text) > 2_000_000
    found = {r.doc_id: r for r in line_dedup.dedup_lines(frame).collect()}
    assert (found[0].n_lines, found[0].n_dropped) == (60_000, 30_000) and line not in found[0].text.split("\n")
    items = spark.createDataFrame([(5, line)], "item_id long, text string")
    hit = {r.doc_id: r.n_hit for r in decontaminate.contamination(frame, items).collect()}
    assert hit == {0: 12 * 30_000} | {1 + i: 12 for i in range(10)}
