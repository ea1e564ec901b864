"""Consecutive numbers by an order, without a single task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulelode.sources.scratch import materialize


def with_numbers(rows: DataFrame, order: str, name: str) -> DataFrame:
    """rows with `name`, counting from 0 by the column `order`, whose values must differ.

    Rows are dealt by ranges and sorted inside them; numbers are the place in a range plus the sizes of the ranges
    before it. Only those sizes, one for each partition, reach the driver.
    """
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_at", F.monotonically_increasing_id())
    dealt = materialize(dealt, "numbered")
    part = F.shiftright("_at", 33)
    start, offsets = 0, []
    for r in dealt.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect():
        offsets.append((r["p"], start))
        start += r["n"]
    known = F.broadcast(spark.createDataFrame(offsets, "_p long, _start long"))
    number = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_start")
    return dealt.withColumn("_p", part).join(known, "_p").withColumn(name, number.cast("long")).drop("_p", "_start", "_at")
