"""Incremental ingest, an extension: new comment files stream in and are extracted batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rulelode.operators.annotate import Annotator, extract_offline
from rulelode.operators.comments import filter_bots, unprocessed, with_context
from rulelode.sources import files
from rulelode.sources.files import COMMENT
from rulelode.sources.scratch import materialize


def comment_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    rows = spark.readStream.schema(COMMENT).option("multiLine", "true").option("maxFilesPerTrigger", files_per_trigger).json(folder)
    return rows.select("*", F.regexp_extract("_metadata.file_name", r"^(\d+)\.json$", 1).cast("long").alias("pr_number"))


def extract_stream(comments: DataFrame, out: str, checkpoint: str, extract: Annotator = extract_offline) -> StreamingQuery:
    """Extract every batch into Parquet below out, in a folder named by the batch: a batch that runs twice after a
    failure overwrites itself, and comments found in earlier batches are left out. Threads are looked up among the
    comments of the batch and those kept from earlier ones, below out/seen: a reply knows what came before it."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = filter_bots(batch).dropDuplicates(["id"]).withColumn("ord", F.col("id"))
        earlier = [f"{out}/seen/batch={n}" for n in range(number) if files.exists(spark, f"{out}/seen/batch={n}/_SUCCESS")]
        loaded = rows.select("id", "in_reply_to_id", "user", "body")
        if earlier:
            known = spark.read.schema(loaded.schema).parquet(*earlier)
            rows = unprocessed(rows, known.select("id"), "id")
            loaded = unprocessed(loaded, known.select("id"), "id").unionByName(known)
        rows = materialize(rows, "batch")
        extract(with_context(rows, loaded)).write.mode("overwrite").parquet(f"{out}/batch={number}")
        rows.select("id", "in_reply_to_id", "user", "body").write.mode("overwrite").parquet(f"{out}/seen/batch={number}")

    return comments.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
