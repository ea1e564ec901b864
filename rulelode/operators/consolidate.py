"""Merging rules: attribution, unions of evidence, overrides, unique ids, and the three passes of deduplication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulelode.functions import prompts, scalar
from rulelode.operators.annotate import checked
from rulelode.operators.graph import group_closure
from rulelode.sources.scratch import materialize


def attributed(analysed: DataFrame, clusters: DataFrame) -> DataFrame:
    """analysed rules with source_comments, source_prs, unique_pr_count and rule_score.

    The comments named by a rule count if they are in its cluster; if none is, the whole cluster does. clusters has
    cluster_id and members, an array of (comment_id, pr_number).
    """
    joined = analysed.join(clusters.select("cluster_id", "members"), "cluster_id")
    named = F.filter("members", lambda m: F.array_contains("source_comment_ids", m["comment_id"]))
    used = F.when(F.coalesce(F.size(named), F.lit(0)) > 0, named).otherwise(F.col("members"))
    rows = joined.withColumn("_used", used)
    rows = (
        rows.withColumn("source_comments", F.array_sort(F.array_distinct(F.transform("_used", lambda m: m["comment_id"]))))
        .withColumn("source_prs", F.array_sort(F.array_distinct(F.transform("_used", lambda m: m["pr_number"]))))
    )
    rows = (
        rows.withColumn("unique_pr_count", F.size("source_prs"))
        .withColumn("rule_score", scalar.rule_score(F.col("confidence"), F.size("source_prs")))
    )
    return rows.drop("_used", "members")


def cluster_summary(items: DataFrame) -> DataFrame:
    """Per cluster_id: number of items, its comments and its changes, sorted, and how many changes."""
    return items.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("num_generalizations"), F.array_sort(F.collect_set("comment_id")).alias("comment_ids"),
        F.array_sort(F.collect_set("pr_number")).alias("pr_numbers"), F.count_distinct("pr_number").alias("unique_pr_count"),
    )


def pr_histogram(items: DataFrame) -> DataFrame:
    """cluster_id and histogram, an array of (pr_number, n) by number: how many items come from each change."""
    each = items.groupBy("cluster_id", "pr_number").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("pr_number", "n"))).alias("histogram"))


def synthesis_stats(clusters: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row with the mean coherence over all cluster records, a missing one being 0; counts by category and scope)."""
    return clusters.agg(
        F.count(F.lit(1)).alias("clusters"), F.avg(F.coalesce("coherence", F.lit(0.0))).alias("avg_coherence"),
    ), rules.groupBy("category", "scope").agg(F.count(F.lit(1)).alias("n"))


def _first(value: str, *order: str) -> Column:
    """The first non-empty value in order."""
    key = F.struct(*order)
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull() & (F.col(value) != ""), key))


def _best(value: str, score: Column, *order: str) -> Column:
    """The value of the row of highest score; of equals the first in order."""
    return F.min_by(F.col(value), F.struct((-score).alias("s"), *order))


def _union(column: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column))))


def merged(outputs: DataFrame, rules: DataFrame) -> DataFrame:
    """One rule per consolidated output over the rules that it names.

    outputs: group_id, out (its place in the group), text, reason, confidence, category, scope, source_rule_ids.
    Evidence is united and sorted; the first example in the order of the ids named is kept; cluster and pattern come
    from the best rule, the first of equals; an output that names no existing rule vanishes. Its id is the lowest of
    its sources that no earlier output of the group took, else the lowest.
    """
    named = outputs.select("group_id", "out", F.posexplode(F.array_distinct("source_rule_ids")).alias("pos", "rule_id"))
    source = rules.select(
        "rule_id", "cluster_id", scalar.first_score(F.col("rule_score")).alias("rule_score"), "example_bad", "example_good", "related_entities",
        "source_comments", "source_prs", "cluster_coherence", "common_pattern",
    )
    joined = named.join(source, "rule_id")
    agg = joined.groupBy("group_id", "out").agg(
        F.array_sort(F.collect_list("rule_id")).alias("merged_from"), _best("cluster_id", F.col("rule_score"), "pos").alias("cluster_id"),
        _best("common_pattern", F.col("rule_score"), "pos").alias("common_pattern"),
        _first("example_bad", "pos").alias("example_bad"), _first("example_good", "pos").alias("example_good"),
        _union("related_entities").alias("related_entities"), _union("source_comments").alias("source_comments"),
        _union("source_prs").alias("source_prs"), F.max(F.coalesce("cluster_coherence", F.lit(0.0))).alias("cluster_coherence"),
    )
    ids = allocated(agg.select("group_id", "out", "merged_from"))
    rows = outputs.drop("source_rule_ids").join(agg, ["group_id", "out"]).join(ids, ["group_id", "out"])
    return (
        rows.withColumn("unique_pr_count", F.size("source_prs"))
        .withColumn("rule_score", scalar.rule_score(F.col("confidence"), F.size("source_prs")))
    )


def allocated(sources: DataFrame) -> DataFrame:
    """(group_id, out, rule_id): outputs in turn take the lowest unused id of merged_from, the lowest one if all are
    used. A fold over the outputs of a group, which are as many as one answer of a model has."""
    outputs = F.array_sort(F.collect_list(F.struct(F.col("out").cast("int").alias("out"), F.array_sort(F.col("merged_from").cast("array<bigint>")).alias("ids"))))
    start = F.struct(F.array().cast("array<bigint>").alias("used"), F.array().cast("array<struct<out:int,rule_id:bigint>>").alias("got"))

    def take(a: Column, x: Column) -> Column:
        free = F.array_except(x["ids"], a["used"])
        one = F.when(F.size(free) > 0, F.get(free, F.lit(0))).otherwise(F.get(x["ids"], F.lit(0)))
        return F.struct(F.concat(a["used"], F.array(one)).alias("used"), F.concat(a["got"], F.array(F.struct(x["out"].alias("out"), one.alias("rule_id")))).alias("got"))

    lists = sources.groupBy(F.col("group_id").cast("long").alias("group_id")).agg(outputs.alias("outputs"))
    return lists.select("group_id", F.inline(F.aggregate("outputs", start, take)["got"]))


def overridden(rules: DataFrame, group: str = "group_id", zero_is_id: bool = True) -> DataFrame:
    """One rule per group that holds an override: the first override's words over the evidence of the others.

    rules: rule_id, ord, is_override, text, reason, confidence, category, scope, explicit_category, explicit_scope,
    example_bad, example_good, related_entities, source_comments, source_prs, unique_pr_count, rule_score,
    cluster_id, cluster_coherence. Further overrides of a group are dropped. Its changes count at least as many as
    the override claims. The id is the lowest extracted one (0 being one unless zero_is_id is false), else the
    override's. Category and scope are the override's where it states them, else those of the best extracted rule.
    """
    over = F.col("is_override")
    first_over = lambda c: F.min_by(F.col(c), F.when(over, F.col("ord")))
    best = lambda c: F.min_by(F.col(c), F.when(~over, F.struct((-scalar.first_score(F.col("rule_score"))).alias("s"), "ord")))
    mine = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.when(~over, F.col(c))))))
    example = lambda c: F.min_by(
        F.col(c), F.when(F.col(c).isNotNull() & (F.col(c) != ""), F.struct((~(over & (F.col("ord") == F.col("_lead")))).alias("late"), "ord")),
    )
    usable = F.col("rule_id") >= 0 if zero_is_id else F.col("rule_id") > 0
    lead = F.min(F.when(over, F.col("ord"))).over(Window.partitionBy(group))
    rows = rules.withColumn("_lead", lead).where("_lead is not null").where(~over | (F.col("ord") == F.col("_lead")))
    out = rows.groupBy(group).agg(
        F.coalesce(F.min(F.when(~over & usable, F.col("rule_id"))), first_over("rule_id")).alias("rule_id"),
        F.coalesce(F.min_by("cluster_id", F.when(~over, F.col("ord"))), first_over("cluster_id")).alias("cluster_id"),
        first_over("text").alias("text"), first_over("reason").alias("reason"), first_over("confidence").alias("confidence"),
        (
            F.when(first_over("explicit_category"), first_over("category")).otherwise(F.coalesce(best("category"), first_over("category")))
            .alias("category")
        ),
        F.when(first_over("explicit_scope"), first_over("scope")).otherwise(F.coalesce(best("scope"), first_over("scope"))).alias("scope"),
        example("example_bad").alias("example_bad"), example("example_good").alias("example_good"),
        mine("related_entities").alias("related_entities"), mine("source_comments").alias("source_comments"), mine("source_prs").alias("source_prs"),
        first_over("unique_pr_count").alias("_claimed"),
        F.coalesce(F.max(F.when(~over, F.coalesce("cluster_coherence", F.lit(0.0)))), F.lit(1.0)).alias("cluster_coherence"),
        F.array_sort(F.collect_list("rule_id")).alias("merged_from"),
    )
    out = out.withColumn("unique_pr_count", F.greatest(F.size("source_prs"), "_claimed")).drop("_claimed")
    return out.withColumn("rule_score", scalar.rule_score(F.col("confidence"), F.col("unique_pr_count"))).withColumn("override_applied", F.lit(True))


def first_of_id(rules: DataFrame, *keys: str, order: str = "ord") -> DataFrame:
    """Of rows with equal keys the first."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rules.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def kept_of_id(rows: DataFrame, *keys: str, order: str = "ord") -> DataFrame:
    """Of rows with equal keys the last, by one aggregation: later rows replace earlier ones."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def best_words(plain: DataFrame) -> DataFrame:
    """One output a group, with the words of its best rule, the first of equals."""
    return plain.groupBy("group_id").agg(
        F.lit(0).alias("out"),
        *[_best(c, scalar.first_score(F.col("rule_score")), "ord").alias(c) for c in ("text", "reason", "confidence", "category", "scope")],
        F.transform(F.array_sort(F.collect_list(F.struct("ord", "rule_id"))), lambda s: s["rule_id"]).alias("source_rule_ids"),
    )


def questions(plain: DataFrame) -> DataFrame:
    """(group_id, prompt): what a model is asked about each group of rules, for a function that gives `outputs`."""
    one = F.struct("ord", "rule_id", "text", "reason", "category", "scope", "confidence", "source_prs", "unique_pr_count")
    return (
        plain.groupBy("group_id").agg(F.array_sort(F.collect_list(one)).alias("rules"))
        .select("group_id", prompts.consolidation(F.col("rules")).alias("prompt"))
    )


def consolidate_pass(
    rules: DataFrame, groups: DataFrame, name: str, outputs: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rules after the pass, its merge log) for groups (group_id, rule_id) of two or more rules.

    Groups with an override take the override's words; for the others `outputs` turns the rules with their group_id
    into outputs (as in `merged`; several a group, if it likes), by default `best_words`. Outputs without a text or
    with a confidence beyond 0 and 1 count as not given. Rules in no group pass through, and so do rules that no
    output names.
    """
    grouped = rules.join(groups.select("group_id", "rule_id"), "rule_id")
    size = Window.partitionBy("group_id")
    grouped = (
        grouped.withColumn("_n", F.count(F.lit(1)).over(size)).withColumn("_over", F.max(F.col("is_override").cast("int")).over(size)).where("_n > 1")
    )
    forced = overridden(grouped.where("_over = 1").drop("_n", "_over"))
    plain = grouped.where("_over = 0")
    given = (outputs or best_words)(plain)
    if outputs is not None:
        given = materialize(checked(given, between={"confidence": (0.0, 1.0)}, filled=("text",))[0], "outputs")
    made = (
        merged(given, plain).withColumn("override_applied", F.lit(False))
        .unionByName(forced.withColumn("out", F.lit(0)).withColumn("common_pattern", F.lit("")))
    )
    made = materialize(made, "merged")
    taken = made.select(F.explode("merged_from").alias("rule_id")).unionByName(grouped.where("_over = 1").select("rule_id")).distinct()
    log = made.select(F.lit(name).alias("pass"), "group_id", "rule_id", "merged_from", "text")
    # A merged rule keeps the place of its first source; an override stays one, so no later pass rewrites it.
    place = (
        made.select("group_id", "out", F.explode("merged_from").alias("rule_id")).join(rules.select("rule_id", "ord"), "rule_id")
        .groupBy("group_id", "out").agg(F.min("ord").alias("ord"))
    )
    made = (
        made.join(place, ["group_id", "out"]).drop("group_id", "out").withColumn("is_override", F.col("override_applied"))
        .withColumn("explicit_category", F.col("override_applied")).withColumn("explicit_scope", F.col("override_applied"))
    )
    rest = (
        rules.join(taken, "rule_id", "left_anti")
        .withColumn("override_applied", F.coalesce(F.col("override_applied") if "override_applied" in rules.columns else F.lit(False), F.lit(False)))
    )
    return rest.unionByName(made, allowMissingColumns=True), log


def deduplicated(
    rules: DataFrame, components: DataFrame, review: Callable[[DataFrame], DataFrame] | None = None,
    outputs: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rules, merge log) after three passes: similar clusters, then review by category, then a second review of
    categories in which the first merged something and three rules or more remain.

    components: (rule_id, group_id) of similar rules. review(rules of categories with two or more) gives groups
    (rule_ids) to merge; by default rules with equal normalised text. outputs is what each pass asks for the words
    of merged rules, see `consolidate_pass`.
    """
    review = review or equal_texts
    rules, log = consolidate_pass(rules, components, "similarity", outputs)
    rules = materialize(rules, "pass1")
    for name, least in (("category", 2), ("category again", 3)):
        of = rules.where("category is not null").groupBy("category").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
        some = rules.join(of.select("category"), "category", "left_semi")
        if least == 3:
            again = log.where(F.col("pass") == "category").join(rules.select("rule_id", "category"), "rule_id").select("category").distinct()
            some = some.join(again, "category", "left_semi")
        closed = group_closure(review(some), some).withColumnRenamed("root", "group_id")
        rules, more = consolidate_pass(rules, closed, name, outputs)
        rules, log = materialize(rules, "pass"), materialize(log.unionByName(more), "log")
    return first_of_id(rules, "rule_id"), log


def equal_texts(rules: DataFrame) -> DataFrame:
    """Groups of one category whose texts are equal but for case, blanks and punctuation."""
    plain = F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]+", " "))
    return (
        rules.groupBy("category", plain.alias("plain")).agg(F.collect_list("rule_id").alias("rule_ids")).where(F.size("rule_ids") > 1)
        .select("rule_ids")
    )
