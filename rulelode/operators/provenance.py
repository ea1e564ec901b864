"""Where rules come from: lookup, search, listing by location."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rulelode.functions import scalar


def rule_locations(rows: DataFrame) -> DataFrame:
    """(rule_id, location, topic_id): the first location of each rule; inline beats topics within a location."""
    w = Window.partitionBy("rule_id").orderBy("location", F.col("topic_id").isNotNull(), "topic_id")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").select("rule_id", "location", "topic_id")


def provenance(rules: DataFrame, placements: DataFrame, rows: DataFrame, comments: DataFrame, shown: int = 5, chars: int = 300) -> DataFrame:
    """One row per rule and each of its first `shown` source comments; a rule or comment that lacks a counterpart stays."""
    first = rules.select(
        "rule_id", "text", "category", "rule_score", F.posexplode_outer(F.slice("source_comments", 1, shown)).alias("n", "comment_id"),
    )
    told = comments.select(
        F.col("id").alias("comment_id"), "pr_number", F.col("user.login").alias("author"), "path",
        scalar.truncated(F.col("body"), chars).alias("body"), scalar.last_lines(F.col("diff_hunk"), 8).alias("diff"),
    )
    out = (
        first.join(placements.select("rule_id", F.col("placement.placement_type").alias("placement_type")), "rule_id", "left")
        .join(rule_locations(rows), "rule_id", "left")
    )
    return out.join(told, "comment_id", "left")


def search(rules: DataFrame, text: str, limit: int = 20) -> DataFrame:
    """Rules whose text holds the words in any case, the first `limit` in file order."""
    return rules.where(F.contains(F.lower("text"), F.lit(text.lower()))).orderBy("ord").limit(limit)


def by_location(rows: DataFrame) -> DataFrame:
    return rows.groupBy("location").agg(F.array_sort(F.collect_set("rule_id")).alias("rule_ids"))
