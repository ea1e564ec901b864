"""Questions to a model service: a ledger of answers, so that each question is answered once or known not to be.

A question's key is the SHA-256 of its text. The ledger is a folder of the shared file system: `answers` and `failures`
are tables; `batches` holds what is under way. Questions without an answer are dealt by key, in an order that does not
change, into batches; a task writes each batch's answers as one file, under a name made of its keys, before it goes on
to the next, and looks for that file first. So a task that is repeated, on whatever executor, or a run that was killed
and is started again, asks no batch twice that was answered; only the batch in the air may be asked again, with the
same keys, which a service can use to tell. When all tasks are done, answers are appended to the table and the batch
files go.

A batch is asked up to `attempts` times, with growing pauses, each time only for what is still open; a call that takes
over `timeout` seconds counts as failed. What remains is asked one by one once more, so that one bad question does not
take others along, and then goes to `failures` with its last error. A later run asks it anew.
"""

from __future__ import annotations

import hashlib
import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulelode.operators.annotate import Annotator
from rulelode.sources import files
from rulelode.sources.scratch import materialize

#: A call gets (key, question) pairs and gives as many answers, JSON objects as text; None stands for no answer.
Call = Callable[[list[tuple[str, str]]], list[str | None]]
_ROW = "key string, question string, answer string, error string, attempts int"


@dataclass(frozen=True)
class Terms:
    """How a service is asked. rows: questions a call; parallel: calls at a time; wait: seconds before the second
    attempt, twice as many before each further one, `longest` at most."""

    attempts: int = 3
    timeout: float = 60.0
    rows: int = 20
    parallel: int = 8
    wait: float = 0.5
    longest: float = 60.0


def timed(call: Call, batch: list[tuple[str, str]], timeout: float) -> list[str | None]:
    """What the call gives; TimeoutError after so many seconds, with the call left to itself."""
    out: list = []

    def run() -> None:
        try:
            out.append((True, call(batch)))
        except Exception as e:  # noqa: BLE001  # whatever a client raises is this batch's failure
            out.append((False, e))

    t = threading.Thread(target=run, daemon=True)
    t.start()
    t.join(timeout)
    if not out:
        raise TimeoutError(f"no answer within {timeout:g} s")
    if not out[0][0]:
        raise out[0][1]
    return out[0][1]


def fault(answer: str | None, needs: tuple[str, ...]) -> str | None:
    """What is wrong with an answer: it has to be a JSON object with some fields."""
    if answer is None:
        return "no answer"
    try:
        found = json.loads(answer)
    except ValueError:
        return "not JSON"
    if not isinstance(found, dict):
        return "not a JSON object"
    missing = [n for n in needs if found.get(n) is None]
    return f"without {', '.join(missing)}" if missing else None


def answered(call: Call, batch: list[tuple[str, str]], terms: Terms, needs: tuple[str, ...] = ()) -> dict[str, dict]:
    """key -> answer or error, and attempts, of a batch."""
    out = {k: {"answer": None, "error": "not asked", "attempts": 0} for k, _ in batch}

    def attempt(part: list[tuple[str, str]]) -> None:
        for k, _ in part:
            out[k]["attempts"] += 1
        try:
            got = timed(call, part, terms.timeout)
            if len(got) != len(part):
                raise ValueError(f"{len(got)} answers to {len(part)} questions")
        except Exception as e:  # noqa: BLE001
            for k, _ in part:
                out[k]["error"] = f"{type(e).__name__}: {e}"
            return
        for (k, _), a in zip(part, got, strict=True):
            out[k]["error"] = fault(a, needs)
            if out[k]["error"] is None:
                out[k]["answer"] = a

    def left() -> list[tuple[str, str]]:
        return [(k, q) for k, q in batch if out[k]["error"] is not None]

    for n in range(terms.attempts):
        if n and left():
            time.sleep(min(terms.wait * 2 ** (n - 1), terms.longest))
        if left():
            attempt(left())
    if len(batch) > 1:
        for one in left():
            attempt([one])
    return out


def _kept(folder: str, name: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(folder)
    return system, f"{path}/batches/{name}.json"


def _batch(call: Call, folder: str, batch: list[tuple[str, str]], terms: Terms, needs: tuple[str, ...]) -> dict[str, dict]:
    """The answers of a batch from its file, or from the service, which then stand in its file."""
    name = hashlib.sha256("".join(k for k, _ in batch).encode()).hexdigest()
    system, path = _kept(folder, name)
    if system.get_file_info(path).type == fs.FileType.File:
        with system.open_input_stream(path) as f:
            return json.loads(f.readall())
    out = answered(call, batch, terms, needs)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as f:
        f.write(json.dumps(out).encode())
    system.move(part, path)
    return out


def _table(spark, path: str, schema: str) -> DataFrame | None:  # noqa: ANN001
    return spark.read.schema(schema).parquet(path) if files.exists(spark, f"{path}/_SUCCESS") else None


def ask(questions: DataFrame, call: Call, folder: str, terms: Terms = Terms(), needs: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(answers: key, answer; failures: key, question, error, attempts) for the distinct texts of `question`.

    Answers are all of the ledger's; failures are those of this run. A null question is none.
    """
    spark = questions.sparkSession
    own = questions.where("question is not null").select(F.sha2("question", 256).alias("key"), "question").dropDuplicates(["key"])
    before = _table(spark, f"{folder}/answers", "key string, answer string, attempts int")
    if before is not None:
        own = own.join(before.select("key"), "key", "left_anti")
    # Written out, the questions and so their batches are the same for whoever repeats a task.
    own = materialize(own, "questions")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[str, str]] = []

        def rows() -> pd.DataFrame:
            out = _batch(call, folder, held, terms, needs)
            return pd.DataFrame([(k, q, out[k]["answer"], out[k]["error"], out[k]["attempts"]) for k, q in held], columns=["key", "question", "answer", "error", "attempts"])

        for pdf in batches:
            for pair in zip(pdf["key"], pdf["question"], strict=True):
                held.append(pair)
                if len(held) == terms.rows:
                    yield rows()
                    held = []
        if held:
            yield rows()

    done = materialize(own.repartition(terms.parallel, "key").sortWithinPartitions("key").mapInPandas(run, _ROW), "answered")
    done.where("error is null").select("key", "answer", "attempts").write.mode("append").parquet(f"{folder}/answers")
    failures = done.where("error is not null").select("key", "question", "error", "attempts")
    failures.write.mode("append").parquet(f"{folder}/failures")
    files.delete(spark, f"{folder}/batches")
    return spark.read.schema("key string, answer string, attempts int").parquet(f"{folder}/answers").dropDuplicates(["key"]).select("key", "answer"), failures


def annotator(call: Call, folder: str, question: str, schema: str, needs: tuple[str, ...] = (), terms: Terms = Terms()) -> Annotator:
    """Rows whose column `question` has an answer, with `told`, the answer as a struct of `schema`; others are not
    among them and can be asked again by a later run."""

    def annotate(df: DataFrame) -> DataFrame:
        answers, _ = ask(df.select(F.col(question).alias("question")), call, folder, terms, needs)
        told = answers.select(F.col("key").alias("_key"), F.from_json("answer", schema).alias("told"))
        return df.withColumn("_key", F.sha2(question, 256)).join(told, "_key").drop("_key")

    return annotate
