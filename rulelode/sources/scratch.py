"""Tables between steps: Parquet in the folder that all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
#: Writes under way, and the session's own setting before the first of them.
_BUSY: list[str | None] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a private one is set only where it is unset, in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        have = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = have.get() if have.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="rulelode-scratch-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet below the shared folder and read it back: lineage ends in files that every executor sees.

    The file schema is given on the read, so empty tables keep their columns.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    # With the table written, no later step reads this query's shuffle files: they need not wait for a collection.
    with _LOCK:
        _BUSY.append(spark.conf.get(_CLEAN, None) if not _BUSY else None)
        spark.conf.set(_CLEAN, "true")
    try:
        _WRITTEN.append(path)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        with _LOCK:
            # The setting is the session's: the last of several writes at a time puts back what the first one found.
            if len(_BUSY) == 1:
                spark.conf.unset(_CLEAN) if _BUSY[0] is None else spark.conf.set(_CLEAN, _BUSY[0])
                _BUSY.clear()
            else:
                _BUSY.pop()
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete the tables that this process wrote; call it once every result read from them is stored."""
    conf = spark._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)
