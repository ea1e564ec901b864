"""Connected components of undirected edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulelode.sources.scratch import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for undirected edges (src, dst) of longs; component is the smallest node reachable.

    Every round ends in a table of the shared folder, is a constant number of shuffles, and keeps at most the edges
    it was given; rounds go on until one changes nothing. Nothing is broadcast, as every table grows with the nodes.
    Centres of large stars are join keys of plain exchanges, which adaptive execution can split. Nodes with no edge do
    not appear; self loops name no node.
    """
    e = materialize(
        (
            edges.select(F.col("src").cast("long"), F.col("dst").cast("long")).dropna().where("src <> dst")
            .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
        ),
        "edges",
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    before = mark(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
        large = both.join(low.hint("merge"), "src").where("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst").distinct()
        large = materialize(large.select("src", "dst"), "large")
        low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = (
            large.join(low.hint("merge"), "src")
            .select(F.when(F.col("dst") == F.col("m"), F.col("src")).otherwise(F.col("dst")).alias("src"), F.col("m").alias("dst"))
            .where("src <> dst").distinct()
        )
        e = materialize(small, "small")
        after = mark(e)
        if after == before:
            break
        before = after
    return (
        e.select(F.col("src").alias("node"), F.col("dst").alias("component"))
        .unionByName(e.select(F.col("dst").alias("node"), F.col("dst").alias("component"))).distinct()
    )


def components_of(nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(key, component) of every node; one without an edge is its own component."""
    found = connected_components(edges).withColumnRenamed("node", key)
    return nodes.select(key).distinct().join(found, key, "left").select(key, F.coalesce("component", key).alias("component"))


def group_closure(groups: DataFrame, valid: DataFrame) -> DataFrame:
    """(rule_id, root) of overlapping groups merged transitively.

    groups holds arrays rule_ids; ids that are not in valid(rule_id) are dropped first, then repeats, and groups
    of fewer than two ids mean nothing.
    """
    own = groups.select(F.col("group_id") if "group_id" in groups.columns else F.monotonically_increasing_id().alias("group_id"), "rule_ids")
    flat = own.select(F.col("group_id").alias("g"), F.explode(F.array_distinct("rule_ids")).alias("rule_id"))
    # Read twice, so written: numbers, and lists that were collected from other tasks, may differ when worked out again.
    flat = materialize(flat.join(valid.select("rule_id").distinct(), "rule_id", "left_semi").select("g", "rule_id"), "groups")
    low = flat.groupBy("g").agg(F.min("rule_id").alias("dst"), F.count(F.lit(1)).alias("n")).where("n > 1")
    edges = flat.join(low, "g").select(F.col("rule_id").alias("src"), "dst")
    return connected_components(edges).select(F.col("node").alias("rule_id"), F.col("component").alias("root"))
