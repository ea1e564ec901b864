"""Changes of a repository and their five resources: a data source over a client, landing in files, typed tables.

`spark.read.format("changes")` reads from a client, any function that knows a review service; the option `client` names
it as module:function. It is called as client("list", since) for the listed changes, rows of (number, updated_at), and
as client(resource, number) for the text of one resource; it raises where there is none. A partition holds
`per_partition` changes, so fetching spreads over executors and a lost one costs its own partitions. A filter
updated_at >= is handed to the client, and one on `resource` keeps others from being fetched; `changes` sets
spark.sql.python.filterPushdown.enabled for the session, without which Spark does not let such a source be read.

`land` writes what is missing of each change below a folder, a file for each change and resource, as the readers of
this package expect them; a file comes into being whole or not at all. The typed tables read these folders with Spark.
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, In, InputPartition

from rulelode.operators import ledger
from rulelode.sources import files

SCHEMA = "number bigint, updated_at timestamp, resource string, text string, error string"
_USER = "user STRUCT<login: STRING, type: STRING>"
PULL = f"number BIGINT, title STRING, body STRING, state STRING, {_USER}, created_at TIMESTAMP, updated_at TIMESTAMP, merged_at TIMESTAMP, closed_at TIMESTAMP, additions BIGINT, deletions BIGINT, changed_files BIGINT"
REVIEW = f"id BIGINT, {_USER}, body STRING, state STRING, submitted_at TIMESTAMP, commit_id STRING"
ISSUE_COMMENT = f"id BIGINT, {_USER}, body STRING, created_at TIMESTAMP, updated_at TIMESTAMP"


def _client(name: str):  # noqa: ANN202
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


@dataclass
class Numbers(InputPartition):
    numbers: list[tuple[int, datetime | None]]


class ChangeReader(DataSourceReader):
    def __init__(self, client: str, per_partition: int) -> None:
        self.client, self.per_partition = client, per_partition
        self.since: datetime | None = None
        self.kinds = list(files.RESOURCES)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if isinstance(f, GreaterThanOrEqual) and f.attribute == ("updated_at",):
                self.since = f.value if self.since is None else max(self.since, f.value)
            elif isinstance(f, EqualTo) and f.attribute == ("resource",):
                self.kinds = [k for k in self.kinds if k == f.value]
            elif isinstance(f, In) and f.attribute == ("resource",):
                self.kinds = [k for k in self.kinds if k in f.value]
            # The client may round a time: Spark looks at the rows once more.
            if not (isinstance(f, (EqualTo, In)) and f.attribute == ("resource",)):
                yield f

    def partitions(self) -> list[InputPartition]:
        listed = sorted(_client(self.client)("list", self.since))
        return [Numbers(listed[i : i + self.per_partition]) for i in range(0, len(listed), self.per_partition)] or [Numbers([])]

    def read(self, partition: Numbers) -> Iterator[tuple]:
        ask = _client(self.client)
        for number, updated in partition.numbers:
            for kind in self.kinds:
                try:
                    yield number, updated, kind, ask(kind, number), None
                except Exception as e:  # noqa: BLE001  # one resource that fails is a row that says so
                    yield number, updated, kind, None, f"{type(e).__name__}: {e}"


class Changes(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ChangeReader:  # noqa: ANN001
        return ChangeReader(self.options["client"], int(self.options.get("per_partition", 1)))


def changes(spark: SparkSession, client: str, per_partition: int = 1) -> DataFrame:
    """(number, updated_at, resource, text, error) of what the client lists."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Changes)
    return spark.read.format("changes").option("client", client).option("per_partition", per_partition).load()


def land(spark: SparkSession, client: str, folder: str, since: str | None = None, per_partition: int = 20) -> DataFrame:
    """Fetch the resources that are not below folder yet; (number, resource, error) of what was tried, error null
    where the file is there now. Changes with all five files are not asked for again."""
    listed = _client(client)("list", None if since is None else datetime.fromisoformat(since).replace(tzinfo=UTC))
    files.write_text(spark, f"{folder}/pr_list.json", json.dumps([{"number": n, "updatedAt": None if t is None else t.isoformat()} for n, t in sorted(listed)]))
    have = files.resources(spark, folder)
    asked = spark.createDataFrame([(n,) for n, _ in listed], "pr_number long").dropDuplicates()
    asked = asked.join(ledger.complete(have), "pr_number", "left_anti").crossJoin(spark.createDataFrame(list(files.RESOURCES.items()), "resource string, ending string"))
    asked = asked.join(have, ["pr_number", "resource"], "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = _client(client)
        system, top = fs.FileSystem.from_uri(folder)
        for pdf in batches:
            out = []
            for number, kind, ending in zip(pdf["pr_number"], pdf["resource"], pdf["ending"], strict=True):
                error = None
                try:
                    text = ask(kind, int(number))
                    path = f"{top}/{kind}/{number}{ending}"
                    system.create_dir(f"{top}/{kind}", recursive=True)
                    part = f"{top}/{kind}/.{uuid.uuid4().hex}"
                    with system.open_output_stream(part) as f:
                        f.write(text.encode())
                    system.move(part, path)
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"
                out.append((number, kind, error))
            yield pd.DataFrame(out, columns=["number", "resource", "error"])

    parts = max(1, -(-len(listed) * len(files.RESOURCES) // max(per_partition, 1)))
    return asked.repartition(min(parts, 1000), "pr_number", "resource").mapInPandas(run, "number long, resource string, error string")


def _numbered(rows: DataFrame, ending: str) -> DataFrame:
    number = F.regexp_extract(F.col("_metadata.file_name"), rf"^(\d+)\{ending}$", 1).cast("long")
    return rows.select("*", number.alias("pr_number")).where("pr_number is not null")


def pulls(spark: SparkSession, folder: str) -> DataFrame:
    """The changes themselves, one JSON object a file."""
    return _numbered(spark.read.schema(PULL).json(f"{folder}/prs", multiLine=True), ".json")


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(spark.read.schema(REVIEW).json(f"{folder}/reviews", multiLine=True), ".json").where("id is not null")


def issue_comments(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(spark.read.schema(ISSUE_COMMENT).json(f"{folder}/issue_comments", multiLine=True), ".json").where("id is not null")


def diff_files(spark: SparkSession, folder: str) -> DataFrame:
    """(pr_number, path, old_path, added, removed, hunks, text) of each file in the diffs.

    A path is that of the file after the change, or before it where it is gone; lines of hunks count by their sign.
    """
    texts = _numbered(spark.read.text(f"{folder}/diffs", wholetext=True), ".diff")
    parts = texts.select("pr_number", F.explode(F.split("value", r"(?m)^(?=diff --git )")).alias("text")).where(F.col("text").startswith("diff --git "))
    header = F.regexp_extract("text", r"^diff --git (.*)", 1)
    named = lambda sign, side: F.regexp_extract("text", rf"(?m)^{sign} {side}/(.+?)\t?$", 1)
    old = F.coalesce(F.nullif(named("---", "a"), F.lit("")), F.nullif(F.regexp_extract("text", r"(?m)^rename from (.+)$", 1), F.lit("")))
    new = F.coalesce(
        F.nullif(named(r"\+\+\+", "b"), F.lit("")), F.nullif(F.regexp_extract("text", r"(?m)^rename to (.+)$", 1), F.lit("")), old,
        F.regexp_extract(header, r"^a/.* b/(.+)$", 1),
    )
    # Lines before the first hunk, such as +++ and ---, are no lines of the file.
    at = F.locate("\n@@ ", F.col("text"))
    body = F.when(at > 0, F.expr("substring(text, locate('\n@@ ', text) + 1)")).otherwise(F.lit(""))
    count = lambda sign: F.regexp_count(F.col("body"), F.lit(rf"(?m)^{sign}"))
    return parts.withColumn("body", body).select(
        "pr_number", new.alias("path"), old.alias("old_path"), count(r"\+").alias("added"), count("-").alias("removed"), count("@@ ").alias("hunks"), "text",
    )
