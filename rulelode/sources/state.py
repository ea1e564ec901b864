"""Tables and records of one repository, published together: new versions beside the old, and one pointer to switch.

Below the root, a table is a folder of versions, each written once, and `state.json` names the versions that count and
holds the records of the stages. `put` writes a version that nobody but this process sees; `commit` puts one new
state.json in place of the old by an atomic rename, and only then are versions deleted that it does not name. A process
that dies at any point leaves the state before or the state after, whole; what it had written is in the way of no one
and goes with the next commit. One writer at a time is assumed.
"""

from __future__ import annotations

import copy
import json
import time
import uuid
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from rulelode.operators import ledger
from rulelode.sources import files


class State:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str]) -> None:
        """tables: names and the folders they have below root."""
        self.spark, self.root, self.tables = spark, root, tables
        self.told = {"tables": {}, "records": {}}
        self.reload()

    def reload(self) -> None:
        """What is committed; what was put since is forgotten."""
        text = files.read_text(self.spark, f"{self.root}/state.json")
        self.told = json.loads(text) if text else {"tables": {}, "records": {}}

    def paths(self, table: str) -> list[str]:
        return [f"{self.root}/{self.tables[table]}/version={v}" for v in self.told["tables"].get(table, [])]

    def has(self, table: str) -> bool:
        return bool(self.told["tables"].get(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(*self.paths(table))

    def put(self, table: str, df: DataFrame, append: bool = False) -> None:
        """df as the table's rows, or as more of them."""
        version = f"{time.time_ns()}{uuid.uuid4().int % 1000:03d}"
        path = f"{self.root}/{self.tables[table]}/version={version}"
        df.write.parquet(path)
        rows = self.spark.read.parquet(path)
        self.told.setdefault("sums", {})[version] = [str(x) for x in ledger.row_sums(rows, *rows.columns).first()]
        self.told["tables"][table] = [*(self.told["tables"].get(table, []) if append else []), version]

    def digest(self, table: str) -> str | None:
        """The content hash of a table, from what its versions came to when they were written; None without it."""
        versions = self.told["tables"].get(table)
        return ledger.digest([tuple(int(x) for x in self.told["sums"][v]) for v in versions]) if versions else None

    def drop(self, table: str) -> None:
        self.told["tables"].pop(table, None)

    def record(self, stage: str) -> dict | None:
        found = self.told["records"].get(stage)
        return copy.deepcopy(found) if isinstance(found, dict) else None

    def cost(self, stage: str) -> Decimal:
        try:
            return Decimal((self.record(stage) or {}).get("cost", "0"))
        except ArithmeticError:
            return Decimal(0)

    def note(self, stage: str, input_hash: str | None, stats: dict, cost: Decimal, done: bool) -> None:
        """The record of a stage: the hash of what it read, its numbers, its cost, whether it ended, and when."""
        self.told["records"][stage] = {"input_hash": input_hash, "stats": stats, "cost": str(cost), "done": done, "at": time.time()}

    def commit(self) -> None:
        named = {v for versions in self.told["tables"].values() for v in versions}
        self.told["sums"] = {v: x for v, x in self.told.get("sums", {}).items() if v in named}
        files.replace_text(self.spark, f"{self.root}/state.json", json.dumps(self.told, indent=2, default=str))
        self.sweep()

    def sweep(self) -> None:
        """Delete the versions that the committed state does not name."""
        kept = {p.rpartition("/")[2] for t in self.told["tables"] for p in self.paths(t)}
        for folder in self.tables.values():
            for name in files.folders_in(self.spark, f"{self.root}/{folder}"):
                if name.startswith("version=") and name not in kept:
                    files.delete(self.spark, f"{self.root}/{folder}/{name}")
