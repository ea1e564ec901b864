"""Shared plumbing of the corpus operators: tables, columns, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelode.operators.graph import connected_components
from rulelode.sources.scratch import materialize, scratch_dir

__all__ = [
    "connected_components", "key_groups", "keyed", "local_table", "map_batches", "materialize", "only", "row_key", "scratch_dir", "shuffle_parts",
    "table",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, **columns: str) -> DataFrame:
    """Just the named columns, cast; whatever else the table holds cannot clash. A missing column reads as null."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()])


def local_table(spark: SparkSession, rows: list[tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    """A table of rows at hand, of known size: the planner broadcasts it where that is below its threshold."""
    return spark.createDataFrame(pa.table([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(columns.values())], names=list(columns)))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and rk: 128 bits of a SHA-256 of both, so that rows with one key are equal rows."""
    own = only(docs, doc_id="long", text="string")
    return own.withColumn("rk", row_key(F.col("doc_id"), F.col("text")))


def row_key(doc_id: Column, text: Column) -> Column:
    whole = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(F.concat(F.lit(":"), text), F.lit("")))
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 32))


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def key_groups(batches: Iterator[pa.RecordBatch], key: str, size: int) -> Iterator[pa.Table]:
    """Cut a stream sorted by key into tables of whole groups of about `size` bytes; a larger group comes alone."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        keys = batch.column(key).to_numpy()
        starts = np.flatnonzero(
            np.concatenate([[not held or held[-1].column(key)[-1].as_py() != keys[0]], keys[1:] != keys[:-1]])
        ) if len(keys) else []
        at = 0
        for s in starts:
            piece = batch.slice(at, s - at)
            if piece.num_rows:
                held.append(piece)
                total += piece.nbytes
            at = int(s)
            if total >= size:
                yield pa.Table.from_batches(held)
                held, total = [], 0
        if at < batch.num_rows:
            held.append(batch.slice(at))
            total += held[-1].nbytes
    if held:
        yield pa.Table.from_batches(held)
