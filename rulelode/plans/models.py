"""Model steps over one service: the prompts of each step, its answers as JSON, and the bounds they are held to.

`options` makes the pipeline's steps from one function that answers questions. Each step has its own ledger below a
folder (see operators.requests), so that flaky services are asked again, no answered question is asked twice, and what
cannot be answered stays on record instead of failing a run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulelode.functions import prompts
from rulelode.operators import annotate, consolidate, organize, requests
from rulelode.operators.requests import Call, Terms
from rulelode.plans.pipeline import Options

EXTRACT = "is_actionable boolean, rejection struct<reason: string, explanation: string>, changes array<struct<change_description: string, file_path: string, code_context: string>>, potential_rules array<struct<generalization: string, motivation: string, scope: string, source_change_index: int>>"
ANALYSE = "cluster_coherence double, common_pattern string, rules array<struct<text: string, reason: string, confidence: double, category: string, scope: string, example_bad: string, example_good: string, related_entities: array<string>, source_comment_ids: array<bigint>>>"
CONSOLIDATE = "rules array<struct<text: string, reason: string, confidence: double, source_rule_ids: array<bigint>, category: string, scope: string>>"
PLACE = "placement_type string, directory string, file_path string, rationale string, confidence double"
TOPICS = "clusters array<struct<topic_id: string, rule_ids: array<bigint>>>"
REPHRASE = "rule_text string, rationale string"
#: What a reason beyond the list counts as.
OTHER_REASON = "unclear"


def extract(call: Call, folder: str, terms: Terms) -> annotate.Annotator:
    ask = requests.annotator(call, f"{folder}/extract", "question", EXTRACT, ("is_actionable",), terms)

    def run(comments: DataFrame) -> DataFrame:
        x = ask(comments.withColumn("question", prompts.comment(F.col("body"), F.col("path"), F.col("diff_hunk"), F.col("context"))))
        said = F.col("told.rejection.reason")
        reason = F.when(~F.col("told.is_actionable"), F.when(said.isin(*annotate.REASONS), said).otherwise(F.lit(OTHER_REASON)))
        empty = lambda c: F.coalesce(F.when(F.col("told.is_actionable"), F.col(f"told.{c}")), F.array().cast(x.schema["told"].dataType[c].dataType))
        return x.select(
            F.col("id").alias("comment_id"), "pr_number", F.col("user.login").alias("author"), "told.is_actionable", reason.alias("rejection_reason"),
            F.when(~F.col("told.is_actionable"), F.col("told.rejection.explanation")).alias("rejection_explanation"), empty("changes").alias("changes"),
            empty("potential_rules").alias("potential_rules"), F.struct("body", "path", "diff_hunk", F.col("context").alias("thread_context")).alias("source"), "ord",
        )

    return run


def analyse(call: Call, folder: str, terms: Terms) -> annotate.Annotator:
    ask = requests.annotator(call, f"{folder}/analyse", "prompt", ANALYSE, ("cluster_coherence",), terms)

    def run(clusters: DataFrame) -> DataFrame:
        x = ask(clusters).select("cluster_id", "told.cluster_coherence", F.coalesce("told.common_pattern", F.lit("")).alias("common_pattern"), F.explode("told.rules").alias("r"))
        return x.select(
            "cluster_id", *[F.col(f"r.{c}").alias(c) for c in ("text", "reason", "confidence", "category", "scope", "example_bad", "example_good")],
            F.coalesce("r.related_entities", F.array().cast("array<string>")).alias("related_entities"),
            F.coalesce("r.source_comment_ids", F.array().cast("array<bigint>")).alias("source_comment_ids"), "cluster_coherence", "common_pattern",
        )

    return run


def consolidation(call: Call, folder: str, terms: Terms) -> annotate.Annotator:
    ask = requests.annotator(call, f"{folder}/consolidate", "prompt", CONSOLIDATE, ("rules",), terms)

    def run(plain: DataFrame) -> DataFrame:
        x = ask(consolidate.questions(plain)).select("group_id", F.posexplode("told.rules").alias("out", "r"))
        return x.select("group_id", "out", *[F.col(f"r.{c}").alias(c) for c in ("text", "reason", "confidence", "category", "scope", "source_rule_ids")])

    return run


def place(call: Call, folder: str, terms: Terms):  # noqa: ANN201
    ask = requests.annotator(call, f"{folder}/place", "prompt", PLACE, ("placement_type", "confidence"), terms)

    def run(rules: DataFrame, evidence: DataFrame) -> DataFrame:
        told = ask(evidence.select("rule_id", "prompt")).select("rule_id", F.col("told").alias("placement"))
        return rules.join(told, "rule_id").select(
            "rule_id", F.col("text").alias("rule_text"), F.col("category").alias("rule_category"), "rule_score", "unique_pr_count", "placement", "ord",
        )

    return run


def topics(call: Call, folder: str, terms: Terms):  # noqa: ANN201
    ask = requests.annotator(call, f"{folder}/topics", "prompt", TOPICS, ("clusters",), terms)

    def run(rows: DataFrame, rules: DataFrame) -> DataFrame:
        asked = ask(organize.topic_questions(rows, rules.withColumn("rule_text", F.col("text"))))
        found = asked.select("location", F.explode("told.clusters").alias("t")).where("trim(t.topic_id) <> ''")
        # Ids that are not of the place mean nothing.
        found = found.select("location", F.trim("t.topic_id").alias("topic_id"), F.explode("t.rule_ids").alias("rule_id")).distinct()
        return found.join(rows.select("location", "rule_id").distinct(), ["location", "rule_id"]).select("location", "topic_id", "rule_id")

    return run


def rephrase(call: Call, folder: str, terms: Terms) -> annotate.Annotator:
    ask = requests.annotator(call, f"{folder}/rephrase", "question", REPHRASE, ("rule_text",), terms)

    def run(rules: DataFrame) -> DataFrame:
        return ask(rules).select("rule_id", "told.rule_text", F.coalesce("told.rationale", F.lit("")).alias("rationale"))

    return run


def embedding(fn: Callable[[list[str]], list[list[float]]], parallel: int | None = None, rows: int = 100) -> annotate.Annotator:
    """An `embed` step from a function over lists of texts, `rows` at most in a call."""

    def run(df: DataFrame) -> DataFrame:
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return annotate.batched(lambda pdf: pdf.assign(embedding=fn(pdf["text"].tolist())), f"{kinds}, embedding array<double>", parallel, rows)(df)

    return run


def options(call: Call, folder: str, terms: Terms = Terms(), **others) -> Options:  # noqa: ANN003
    """Options whose model steps ask `call`; others are Options' own, as embed=embedding(fn)."""
    steps = {"extract": extract, "analyse": analyse, "consolidate": consolidation, "place": place, "topics": topics, "rephrase": rephrase}
    return Options(**({name: make(call, folder, terms) for name, make in steps.items()} | others))
