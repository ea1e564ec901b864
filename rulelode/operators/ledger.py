"""The stage ledger: hashes, staleness, status, next stage, cost."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The stages in order.
STAGES = ("download", "extract", "synthesize", "dedupe", "place", "group", "generate")


def file_hash(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(input_hash): SHA-256 over the names, sizes and hashes of files by name, so moved bytes show too.

    Contents are hashed where they are read; only one line per file meets in one task.
    """
    files = spark.read.format("binaryFile").load(paths)
    name = F.element_at(F.split("path", "/"), -1)
    lines = files.select(name.alias("name"), F.concat_ws(" ", name, F.col("length").cast("string"), F.sha2("content", 256)).alias("line"))
    return lines.agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "line"))), lambda x: x["line"]), "\n"), 256).alias("input_hash")
    )


def joined_hash(spark: SparkSession, paths: list[str]) -> str:
    """SHA-256 of the bytes of all files, one after the other by name, as ledgers written elsewhere hold it.

    One hash over a sequence of bytes has to see them in turn: files stream through the driver one at a time. For
    large inputs `file_hash` reads them where they are.
    """
    h = hashlib.sha256()
    files = spark.read.format("binaryFile").load(paths).select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "content")
    for row in files.orderBy("name", "path").toLocalIterator():
        h.update(bytes(row["content"]))
    return h.hexdigest()


def row_sums(rows: DataFrame, *columns: str) -> DataFrame:
    """(a, b, n): sums of row hashes in two halves and the number of rows. Sums of parts add up to those of the whole."""
    h = F.sha2(F.to_json(F.struct(*columns)), 256)
    half = lambda at: F.coalesce(F.sum(F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")
    return rows.agg(half(1).alias("a"), half(16).alias("b"), F.count(F.lit(1)).alias("n"))


def content_hash(rows: DataFrame, *columns: str) -> DataFrame:
    """(input_hash, n): an order-free hash of a table, from its row_sums."""
    told = F.concat_ws(":", *[F.col(c).cast("string") for c in ("a", "b", "n")])
    return row_sums(rows, *columns).select(F.sha2(told, 256).alias("input_hash"), "n")


def digest(parts: list[tuple[int, int, int]]) -> str:
    """content_hash of a table from the row_sums of its parts."""
    return hashlib.sha256(":".join(str(sum(p[k] for p in parts)) for k in range(3)).encode()).hexdigest()


def is_stale(stored: Column, current: Column) -> Column:
    """Null where either hash is unknown."""
    return stored != current


def status(stages: DataFrame) -> DataFrame:
    """stage rows (ord, stage, n_out, n_expected, stored_hash, current_hash) with status.

    No output is 'missing', fewer rows than expected 'partial', another input hash 'stale', else 'done'.
    """
    stale = F.coalesce(is_stale(F.col("stored_hash"), F.col("current_hash")), F.lit(False))
    state = (
        F.when(F.coalesce("n_out", F.lit(0)) == 0, F.lit("missing")).when(F.col("n_out") < F.coalesce("n_expected", "n_out"), F.lit("partial"))
        .when(stale, F.lit("stale")).otherwise(F.lit("done"))
    )
    return stages.withColumn("status", state)


def next_stage(stages: DataFrame) -> DataFrame:
    return stages.where("status <> 'done'").agg(F.min_by("stage", "ord").alias("stage"))


def complete(resources: DataFrame, kinds: int = 5) -> DataFrame:
    """pr_number of changes with all kinds of resources landed."""
    return resources.groupBy("pr_number").agg(F.count_distinct("resource").alias("n")).where(F.col("n") >= kinds).select("pr_number")


def with_cost(ledger: DataFrame) -> DataFrame:
    """Cost per stage over all runs, and the running total, exactly."""
    per = ledger.groupBy("stage").agg(F.sum(F.col("cost").cast("decimal(18,6)")).cast("decimal(18,6)").alias("cost"), F.min("ord").alias("ord"))
    return per.withColumn("running", F.sum("cost").over(Window.orderBy("ord")).cast("decimal(18,6)"))


def total_cost(ledger: DataFrame) -> DataFrame:
    return ledger.agg(F.coalesce(F.sum(F.col("cost").cast("decimal(18,6)")), F.lit(0)).cast("decimal(18,6)").alias("cost"))
