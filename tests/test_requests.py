"""The ledger of questions: retries, timeouts, failures on record, no question answered twice."""

from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from rulelode.operators import requests
from rulelode.operators.requests import Terms
from rulelode.plans import models, pipeline

QUICK = Terms(attempts=3, timeout=5.0, rows=4, parallel=3, wait=0.01)


def noted(folder, batch):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{os.getpid()}-{time.time_ns()}", "w") as f:
        json.dump([q for _, q in batch], f)


def calls(folder):
    return [q for name in os.listdir(folder) for q in json.load(open(f"{folder}/{name}"))]


def questions(spark, n, extra=()):
    return spark.createDataFrame([(f"q{i}",) for i in range(n)] + [(x,) for x in extra], "question string")


def test_answers_and_faults():
    said = {"a": '{"x": 1}', "b": None, "c": "[1]", "d": "no", "e": '{"y": 2}', "f": '{"x": null}'}
    got = requests.answered(lambda batch: [said[k] for k, _ in batch], [(k, k) for k in said], Terms(attempts=2, wait=0.0), ("x",))
    assert {k: v["error"] for k, v in got.items()} == {"a": None, "b": "no answer", "c": "not a JSON object", "d": "not JSON", "e": "without x", "f": "without x"}
    assert got["a"]["attempts"] == 1 and got["b"]["attempts"] == 3


def test_pauses_grow_and_calls_time_out(monkeypatch):
    paused = []
    monkeypatch.setattr(requests.time, "sleep", paused.append)

    def broken(batch):
        raise OSError("down")

    got = requests.answered(broken, [("k", "q")], Terms(attempts=5, wait=1.0, longest=3.0))
    assert paused == [1.0, 2.0, 3.0, 3.0] and got["k"] == {"answer": None, "error": "OSError: down", "attempts": 5}
    monkeypatch.undo()
    began = time.time()
    slow = requests.answered(lambda batch: time.sleep(20), [("k", "q")], Terms(attempts=1, timeout=0.1))
    assert slow["k"]["error"].startswith("TimeoutError") and time.time() - began < 5


def test_flaky_service(spark, tmp_path):
    """Every question ends with an answer or on record; equal questions are one; a bad one takes no other along."""
    log, folder = str(tmp_path / "log"), str(tmp_path / "ledger")

    def flaky(batch):
        noted(log, batch)
        if any(q == "poison" for _, q in batch):
            raise ValueError("cannot")
        return [None if hash(q + str(time.time_ns())) % 3 == 0 else json.dumps({"said": q}) for _, q in batch]

    asked = questions(spark, 40, ["poison", "q1", "q2", None])
    answers, failures = requests.ask(asked, flaky, folder, Terms(8, 5.0, 4, 3, 0.0), ("said",))
    got = {json.loads(r.answer)["said"] for r in answers.collect()}
    lost = {r.question: r.error for r in failures.collect()}
    assert got | set(lost) == {f"q{i}" for i in range(40)} | {"poison"} and not got & set(lost)
    assert lost["poison"] == "ValueError: cannot" and len(lost) < 5
    assert not os.path.exists(f"{folder}/batches")
    # Another run asks only for what has no answer.
    before = len(calls(log))
    answers, failures = requests.ask(asked, lambda batch: [json.dumps({"said": q}) for _, q in batch], folder, QUICK)
    assert answers.count() == 41 and failures.count() == 0 and len(calls(log)) == before


def test_a_task_that_is_repeated_asks_nothing_twice(spark, tmp_path):
    """The run dies after some batches were answered; the next one takes these from their files."""
    log, folder, broken = str(tmp_path / "log"), str(tmp_path / "ledger"), str(tmp_path / "broken")
    open(broken, "w").close()
    terms = Terms(1, 5.0, 4, 2, 0.0)

    def call(batch):
        if os.path.exists(broken) and os.path.exists(f"{folder}/batches") and len(os.listdir(f"{folder}/batches")) >= 3:
            os._exit(1)
        noted(log, batch)
        return [json.dumps({"said": q}) for _, q in batch]

    with pytest.raises(Exception, match="worker"):
        requests.ask(questions(spark, 30), call, folder, terms)
    first = calls(log)
    assert 12 <= len(first) < 30
    os.remove(broken)
    answers, _ = requests.ask(questions(spark, 30), call, folder, terms)
    assert answers.count() == 30
    assert sorted(calls(log)) == sorted(f"q{i}" for i in range(30))


def test_embedding_in_batches(spark, tmp_path):
    log = str(tmp_path / "log")

    def lengths(texts):
        noted(log, [(t, t) for t in texts])
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([(i, "x" * i) for i in range(25)], "id long, text string").coalesce(1)
    got = models.embedding(lengths, rows=10)(df).collect()
    assert [(r.id, r.embedding) for r in got] == [(i, [float(i), 1.0]) for i in range(25)]
    assert sorted(len(json.load(open(f"{log}/{n}"))) for n in os.listdir(log)) == [5, 10, 10]


def test_pipeline_over_a_service(spark, tmp_path):
    """All steps through one function, with answers beyond their bounds; what fails is left for another run."""
    folder = str(tmp_path / "ledger")

    def service(batch):
        out = []
        for _, q in batch:
            if q.startswith("Rule text:"):
                out.append(json.dumps({"rule_text": "Short: " + q.split("\n")[0][11:], "rationale": "why"}))
            elif q.startswith("## Cluster Analysis"):
                out.append(json.dumps({"cluster_coherence": 0.9, "common_pattern": "p", "rules": [
                    {"text": "Use snake case", "reason": "r", "confidence": 0.8, "category": "naming", "scope": "global", "source_comment_ids": [1, 2]},
                    {"text": "Beyond", "reason": "r", "confidence": 7, "category": "naming", "scope": "global"}]}))
            elif "Thanks a lot" in q:
                out.append(json.dumps({"is_actionable": False, "rejection": {"reason": "made up", "explanation": "e"}}))
            elif "cannot" in q:
                out.append(None)
            elif q.startswith("## Rule to Place"):
                out.append(json.dumps({"placement_type": "agents_md_root", "rationale": "x", "confidence": 0.7}))
            else:
                out.append(json.dumps({"is_actionable": True, "changes": [{"change_description": "c", "file_path": "a/b.py"}], "potential_rules": [
                    {"generalization": "Use snake case for names", "motivation": "m", "scope": "global", "source_change_index": 0}]}))
        return out

    rows = [(i, 1, ("ann", "User"), body, "a/b.py", "diff", None, i) for i, body in enumerate(["Use snake case", "Use snake case here too", "Thanks a lot", "this cannot be answered"], 1)]
    raw = spark.createDataFrame(rows, "id long, pr_number long, user struct<login: string, type: string>, body string, path string, diff_hunk string, in_reply_to_id long, ord long")
    o = models.options(service, folder, QUICK, min_score=0.0)
    out = pipeline.run(raw, None, o)
    got = {r.comment_id: r for r in out["extract"].collect()}
    assert sorted(got) == [1, 2, 3] and (got[3].is_actionable, got[3].rejection_reason, got[3].changes) == (False, "unclear", [])
    assert [r.text for r in out["dedupe"].collect()] == ["Use snake case"] and o.rejected["analysed"].count() == 1
    assert out["place"].first().placement.placement_type == "agents_md_root"
    assert "Short: Use snake case" in out["generate"].first().text
    lost = spark.read.parquet(f"{folder}/extract/failures").where(F.col("question").contains("cannot")).first()
    assert lost.error == "no answer" and lost.attempts == 4
    again = pipeline.extract(raw, None, models.options(lambda batch: [None] * len(batch), folder, QUICK))
    assert sorted(r.comment_id for r in again.collect()) == [1, 2, 3]
