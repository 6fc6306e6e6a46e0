"""Time limits, the window over batches, and the ledger of answers."""

from __future__ import annotations

import os
import sys
import threading
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quittance.operators import answers, inference, ledger, outcomes
from quittance.operators.calls import CallWindow, called_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_a_call_that_hangs_costs_its_row_only():
    hang = threading.Event()
    batches = [["a", "hang", None, "b"], ["c", "fail", "d"], [], ["e"]]

    def ask(prompt):
        if prompt == "hang":
            hang.wait()
        if prompt == "fail":
            raise RuntimeError("kaputt")
        return prompt.upper()

    start = time.monotonic()
    found = list(called_batches(iter(batches), ask, slots=2, limit=0.5))
    assert time.monotonic() - start < 3
    assert [[c and (c.result, c.error) for c in batch] for batch in found] == [
        [("A", None), (None, "no answer within 0.5 s"), None, ("B", None)], [("C", None), (None, "kaputt"), ("D", None)], [], [("E", None)],
    ]
    assert found[0][1].seconds == 0.5 and 0 <= found[0][0].seconds < 0.5
    hang.set()


@pytest.mark.parametrize("slots", [1, 3])
def test_order_and_outcomes_do_not_depend_on_slots(slots):
    batches = [[f"{i}-{k}" if (i + k) % 4 else None for k in range(i * 7 % 11)] for i in range(40)]
    found = list(called_batches(iter(batches), lambda p: p * 2, slots, limit=30))
    assert [[c and c.result for c in batch] for batch in found] == [[p and p * 2 for p in batch] for batch in batches]


def test_a_slow_call_does_not_hold_up_the_next_batches():
    """One slow call per batch: with the window they overlap, batch by batch they would add up."""
    batches = [["slow", *["x"] * 5] for _ in range(6)]
    start = time.monotonic()
    list(called_batches(iter(batches), lambda p: time.sleep(0.5 if p == "slow" else 0.001), slots=4))
    assert time.monotonic() - start < 6 * 0.5 * 0.7


def test_batches_in_memory_are_bounded():
    taken, gate = [], threading.Event()

    def batches():
        for i in range(20):
            taken.append(i)
            yield ["first" if i == 0 else "x"]

    threading.Timer(0.5, gate.set).start()
    seen = called_batches(batches(), lambda p: gate.wait() if p == "first" else p, slots=3, ahead=2)
    next(seen)
    assert len(taken) == 3  # the first and two ahead
    assert len(list(seen)) == 19


def test_threads_that_never_return_are_bounded():
    hang = threading.Event()
    before = threading.active_count()
    found = [c for batch in called_batches(iter([["x"] * 40]), lambda p: hang.wait(), slots=4, limit=0.05, most_stuck=6) for c in batch]
    errors = Counter(c.error for c in found)
    assert sum(errors.values()) == 40 and errors["no answer within 0.05 s"] <= 6 + 4 and threading.active_count() - before <= 6 + 4
    assert all(c.error for c in found)
    hang.set()


def test_slots_come_back():
    hang = threading.Event()
    window = CallWindow(lambda p: hang.wait() if p == "hang" else p, slots=1, limit=0.1)
    window.submit(1, "hang")
    assert window.full and window.next()[0] == 1 and not window.full and window.stuck == 1
    hang.set()
    window.submit(2, "x")
    assert window.next()[1].result == "x"


def test_limit_and_seconds_on_spark(spark):
    def connect():
        def ask(prompt):
            time.sleep(5 if prompt.endswith("7") else 0)
            return prompt

        return ask

    frame = spark.range(0, 100, 1, 4).select("id", F.concat(F.lit("p"), "id").alias("prompt"))
    rows = inference.apply_inference(frame, connect, limit=1, seconds="took").collect()
    assert len(rows) == 100
    for row in rows:
        late = row.prompt.endswith("7")
        assert (row.response, row.error) == ((None, "no answer within 1 s") if late else (row.prompt, None))
        assert row.took == 1 if late else row.took < 1
    http = inference.apply_http(frame, lambda: lambda p: (time.sleep(5), p) if p == "p7" else (200, p), limit=1, seconds="took").collect()
    assert {(r.status, r.error) for r in http} == {(200, None), (None, "no answer within 1 s")} and http[0].__fields__[-1] == "took"


# ---------------------------------------------------------------- ledger


def _logging(log: str, kill: str | None = None, fail: str | None = None):
    """A model that writes down every call; the executor's Python dies at one prompt."""

    def connect():
        def ask(prompt):
            with open(Path(log) / str(os.getpid()), "a") as file:
                file.write(f"{prompt}\n")
            if prompt == kill:
                os._exit(1)
            if prompt == fail:
                raise RuntimeError("kaputt")
            return prompt.upper()

        return ask

    return connect


def _calls(log: Path) -> Counter:
    return Counter(line for file in log.iterdir() for line in file.read_text().split("\n") if line)


@pytest.fixture
def log(tmp_path):
    (tmp_path / "log").mkdir()
    return tmp_path / "log"


def test_equal_prompts_are_asked_once(spark, tmp_path, log):
    frame = spark.range(300).select("id", F.when(F.col("id") % 10 != 9, F.concat(F.lit("p"), F.col("id") % 10)).alias("prompt")).repartition(6)
    for _ in range(2):
        rows = ledger.apply_with_ledger(frame, _logging(str(log)), str(tmp_path / "ledger"), seconds="took").collect()
        assert len(rows) == 300
        assert {(r.prompt, r.response, r.error) for r in rows} == {(f"p{i}", f"P{i}", None) for i in range(9)} | {(None, None, None)}
    assert _calls(log) == Counter(f"p{i}" for i in range(9))
    ledger.apply_with_ledger(frame, _logging(str(log)), str(tmp_path / "ledger"), model="other")
    assert _calls(log) == Counter({f"p{i}": 2 for i in range(9)})


def test_a_killed_batch_goes_on_where_it_stopped(spark, tmp_path, log):
    frame = spark.range(400).select("id", F.concat(F.lit("p"), "id").alias("prompt"))
    folder = str(tmp_path / "ledger")
    with pytest.raises(Exception, match="(?i)worker|abort"):
        ledger.apply_with_ledger(frame, _logging(str(log), kill="p123"), folder, calls_per_task=10, parallel_calls=1)
    first = _calls(log)
    known = {row.answer for row in ledger.answers(spark, folder).collect()}
    assert 10 <= len(known) < 400 and len(first) < 400  # finished tasks are in the ledger, though the job failed
    rows = ledger.apply_with_ledger(frame, _logging(str(log)), folder, calls_per_task=10, parallel_calls=1).collect()
    assert sorted((r.id, r.response, r.error) for r in rows) == [(i, f"P{i}", None) for i in range(400)]
    both = _calls(log)
    assert all(both[answer.lower()] == 1 for answer in known)  # none of them is asked again
    assert set(both) == {f"p{i}" for i in range(400)} and max(both.values()) <= 2


def test_errors_are_asked_again_or_kept(spark, tmp_path, log):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "id int, prompt string")
    folder = str(tmp_path / "ledger")
    failing = ledger.apply_with_ledger(frame, _logging(str(log), fail="b"), folder)
    assert sorted((r.id, r.response, r.error) for r in failing.collect()) == [(1, "A", None), (2, None, "kaputt")]
    ledger.apply_with_ledger(frame, _logging(str(log)), folder, ask_errors_again=False)
    assert _calls(log) == Counter("ab")
    good = ledger.apply_with_ledger(frame, _logging(str(log)), folder)
    assert sorted((r.id, r.response, r.error) for r in good.collect()) == [(1, "A", None), (2, "B", None)]
    assert _calls(log) == Counter("abb")


def test_ledger_of_no_requests(spark, tmp_path, log):
    frame = spark.createDataFrame([], "id int, prompt string")
    assert ledger.apply_with_ledger(frame, _logging(str(log)), str(tmp_path / "ledger")).collect() == []


def test_documents_through_a_ledger(spark, tmp_path, log):
    """Outcome rows twice, one call per text; with the seconds of each call."""
    schema = "file_name string, path string, input_state string, input_error string, ocr_text string"
    texts = [(f"{i}.pdf", f"a/{i}.pdf", "page_missing" if i == 4 else None, None, None if i == 4 else "" if i == 3 else f"Text {i % 2}") for i in range(8)]
    documents = spark.createDataFrame(texts, schema)
    found = [
        outcomes.process_documents(documents, _logging(str(log), fail=None), answers.MARKED, instruction="", ledger=str(tmp_path / "ledger"), seconds="took").collect()
        for _ in range(2)
    ]
    assert len(found[0]) == 8 and sorted(found[0], key=lambda r: r.file_name) == sorted(found[1], key=lambda r: r.file_name)
    assert {r.file_name: r.outcome for r in found[0]} == {
        f"{i}.pdf": "page_missing" if i == 4 else "empty_text" if i == 3 else "no_json" for i in range(8)
    }
    assert _calls(log) == Counter(["Text 0", "Text 1"])
    assert all((r.took is None) == (r.file_name in ("3.pdf", "4.pdf")) for r in found[0])
    with pytest.raises(ValueError):
        outcomes.process_documents(documents, _logging(str(log)), answers.MARKED, http=True, ledger="x")


def test_requests_are_worked_out_once_for_their_calls(spark, tmp_path, log):
    """Counting the open prompts must not work out the requests a second time."""
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            seen.add(1)
            yield row

    requests = spark.createDataFrame(spark.sparkContext.parallelize([(i, f"p{i}") for i in range(20)], 2).mapPartitions(count), "doc_id int, prompt string")
    ledger.ask_open_prompts(requests, lambda: str.upper, str(tmp_path / "ledger"), parallel_calls=1)
    assert seen.value == 20
    assert ledger.answers(spark, str(tmp_path / "ledger")).count() == 20
    assert not [path for path in (tmp_path / "ledger").iterdir() if path.name.startswith("_open")]
