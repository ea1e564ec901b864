"""Readers and writers of the domain's files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMENT = "id BIGINT, user STRUCT<login: STRING, type: STRING>, body STRING, path STRING, diff_hunk STRING, in_reply_to_id BIGINT"
EXTRACTION = "comment_id BIGINT, pr_number BIGINT, author STRING, is_actionable BOOLEAN, rejection_reason STRING, rejection_explanation STRING, changes ARRAY<STRUCT<change_description: STRING, file_path: STRING, code_context: STRING>>, potential_rules ARRAY<STRUCT<generalization: STRING, motivation: STRING, scope: STRING, source_change_index: INT>>, source STRUCT<body: STRING, path: STRING, diff_hunk: STRING, thread_context: STRING>"
RULE = "rule_id BIGINT, cluster_id BIGINT, text STRING, reason STRING, confidence DOUBLE, rule_score DOUBLE, category STRING, scope STRING, example_bad STRING, example_good STRING, related_entities ARRAY<STRING>, source_comments ARRAY<BIGINT>, source_prs ARRAY<BIGINT>, unique_pr_count INT, cluster_coherence DOUBLE, common_pattern STRING, merged_from ARRAY<BIGINT>, is_override BOOLEAN, override_applied BOOLEAN"
PLACEMENT = "rule_id BIGINT, rule_text STRING, rule_category STRING, original_scope STRING, rule_score DOUBLE, unique_pr_count INT, placement STRUCT<placement_type: STRING, directory: STRING, file_path: STRING, target_element: STRING, source_files: ARRAY<STRING>, target_files: ARRAY<STRING>, rationale: STRING, confidence: DOUBLE>, source_file_patterns ARRAY<STRING>, mentioned_entities ARRAY<STRING>, evidence_summary STRING"
OVERRIDE = "text STRING, reason STRING, category STRING, scope STRING, example_bad STRING, example_good STRING"
PR = "number BIGINT, title STRING, author STRUCT<login: STRING>, state STRING, createdAt TIMESTAMP, updatedAt TIMESTAMP, mergedAt TIMESTAMP, closedAt TIMESTAMP, baseRefName STRING, headRefName STRING, url STRING"
ORGANIZATION = "locations ARRAY<STRUCT<location: STRING, inline_rules: ARRAY<BIGINT>, topic_references: ARRAY<STRUCT<topic_id: STRING, topic_name: STRING, topic_description: STRING, trigger_description: STRING, rule_ids: ARRAY<BIGINT>>>>>"


def pr_list(spark: SparkSession, path: str, since: str | None = None, cap: int | None = 1000) -> DataFrame:
    """Changes updated since a time, the latest `cap` of them."""
    rows = spark.read.schema(PR).json(path, multiLine=True)
    if since is not None:
        rows = rows.where(F.col("updatedAt") >= F.lit(since).cast("timestamp"))
    return rows if cap is None else rows.orderBy(F.desc("updatedAt"), "number").limit(cap)


#: The resources of a change, as folder and ending of its files.
RESOURCES = {"prs": ".json", "reviews": ".json", "review_comments": ".json", "diffs": ".diff", "issue_comments": ".json"}


def resources(spark: SparkSession, folder: str) -> DataFrame:
    """(pr_number, resource) of the files that have landed below a download folder."""
    rows = [(int(name.removesuffix(end)), kind) for kind, end in RESOURCES.items() for name, _ in files_below(spark, f"{folder}/{kind}", end) if name.removesuffix(end).isdigit()]
    return spark.createDataFrame(rows, "pr_number long, resource string")


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """Comments of one JSON array a file, with pr_number from the file's name and ord: names as text, then place."""
    rows = spark.read.schema(COMMENT).json(f"{folder}/*.json", multiLine=True)
    name = F.col("_metadata.file_name")
    rows = rows.select("*", name.alias("_file"), F.monotonically_increasing_id().alias("_at"))
    return (
        rows.withColumn("pr_number", F.regexp_extract("_file", r"^(\d+)\.json$", 1).cast("long")).withColumn("ord", F.struct("_file", "_at"))
        .drop("_file", "_at")
    )


def lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON-lines files in their order as ord: by file, then by block, then within it, so that it does not
    matter how blocks are dealt to tasks; blank lines are skipped, a malformed one reads as nulls."""
    at = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"),
    )
    text = spark.read.text(path).select("value", at.alias("ord")).where(F.trim("value") != "")
    return text.select(F.from_json("value", schema).alias("r"), "ord").select("r.*", "ord")


def extractions(spark: SparkSession, path: str) -> DataFrame:
    return lines(spark, path, EXTRACTION).where("comment_id is not null")


def rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of a JSON-lines file; one without rule_score carries it as adjusted_confidence."""
    none = F.lit(False)
    rows = (
        lines(spark, path, f"{RULE}, adjusted_confidence DOUBLE, _is_override BOOLEAN, _override_applied BOOLEAN, _merged_from ARRAY<BIGINT>")
        .where("rule_id is not null")
    )
    rows = (
        rows.withColumn("rule_score", F.coalesce("rule_score", "adjusted_confidence", F.lit(0.0)))
        .withColumn("is_override", F.coalesce("is_override", "_is_override", none))
        .withColumn("override_applied", F.coalesce("override_applied", "_override_applied", none))
    )
    return (
        rows.withColumn("merged_from", F.coalesce("merged_from", "_merged_from")).withColumn("explicit_category", F.col("is_override"))
        .withColumn("explicit_scope", F.col("is_override")).drop("adjusted_confidence", "_is_override", "_override_applied", "_merged_from")
    )


def placements(spark: SparkSession, path: str) -> DataFrame:
    """Placements of a JSON-lines file, the score under either of its older names too."""
    rows = lines(spark, path, f"{PLACEMENT}, adjusted_confidence DOUBLE, signal_score DOUBLE").where("rule_id is not null")
    return (
        rows.withColumn("rule_score", F.coalesce("rule_score", "adjusted_confidence", "signal_score", F.lit(0.0)))
        .drop("adjusted_confidence", "signal_score")
    )


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """Manual rules of a JSON-lines file: ids -1, -2, ... by line (blank lines count), presence of category and scope kept."""
    one = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("at", "value")).where(F.trim("value") != "")
    r = one.select(
        "at", F.from_json("value", OVERRIDE).alias("r"), F.get_json_object("value", "$.category").isNotNull().alias("explicit_category"),
        F.get_json_object("value", "$.scope").isNotNull().alias("explicit_scope"),
    )
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    return r.where("r.text is not null").select(
        (-(F.col("at") + 1)).cast("long").alias("rule_id"), F.lit(-1).cast("long").alias("cluster_id"), "r.text",
        F.coalesce("r.reason", F.lit("")).alias("reason"), F.lit(0.95).alias("confidence"), F.lit(0.95).alias("rule_score"),
        F.coalesce("r.category", F.lit("general")).alias("category"), F.coalesce("r.scope", F.lit("global")).alias("scope"), "r.example_bad",
        "r.example_good", empty("string").alias("related_entities"), empty("bigint").alias("source_comments"), empty("bigint").alias("source_prs"),
        F.lit(5).alias("unique_pr_count"), F.lit(1.0).alias("cluster_coherence"), F.lit("").alias("common_pattern"), F.lit(True).alias("is_override"),
        "explicit_category", "explicit_scope", F.col("at").cast("long").alias("ord"),
    )


def organization(spark: SparkSession, path: str) -> DataFrame:
    """(location, rule_id, topic_id, ord) of an organization document."""
    loc = spark.read.schema(ORGANIZATION).json(path, multiLine=True).select(F.explode("locations").alias("l"))
    inline = loc.select("l.location", F.posexplode("l.inline_rules").alias("ord", "rule_id")).withColumn("topic_id", F.lit(None).cast("string"))
    topics = (
        loc.select("l.location", F.explode("l.topic_references").alias("t"))
        .select("location", F.col("t.topic_id").alias("topic_id"), F.posexplode("t.rule_ids").alias("ord", "rule_id"))
    )
    return inline.unionByName(topics)


def organization_document(rows: DataFrame, topics: DataFrame, stats: dict | None = None) -> DataFrame:
    """One row `value`: the organization as a JSON document, from (location, rule_id, topic_id, place) and topics
    (location, topic_id, topic_name, topic_description, trigger_description). It names every placed rule once a
    place, and is read as one document by whoever writes guideline files, so it is made in one task."""
    ids = lambda df, *key: df.groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "rule_id"))), lambda x: x["rule_id"]).alias("rule_ids")
    )
    inline = ids(rows.where("topic_id is null"), "location").withColumnRenamed("rule_ids", "inline_rules")
    told = ids(rows.where("topic_id is not null"), "location", "topic_id").join(topics, ["location", "topic_id"], "left")
    told = (
        told.groupBy("location")
        .agg(
            (
                F.array_sort(F.collect_list(F.struct("topic_id", "topic_name", "topic_description", "trigger_description", "rule_ids")))
                .alias("topic_references")
            )
        )
    )
    each = rows.select("location").distinct().join(inline, "location", "left").join(told, "location", "left")
    kind = told.schema["topic_references"].dataType
    each = each.select(
        (
            F.struct(
                "location", F.coalesce("inline_rules", F.array().cast("array<bigint>")).alias("inline_rules"),
                F.coalesce("topic_references", F.array().cast(kind)).alias("topic_references"),
            )
            .alias("l")
        )
    )
    parts = [F.array_sort(F.collect_list("l")).alias("locations")]
    if stats:
        parts.append(F.create_map(*[F.lit(str(x)) for pair in stats.items() for x in pair]).alias("stats"))
    return each.agg(F.to_json(F.struct(*parts)).alias("value"))


def count_items(spark: SparkSession, folder: str) -> DataFrame:
    """(file, n): elements of the JSON array in each file; a malformed file counts 0."""
    files = spark.read.text(f"{folder}/*.json", wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return files.select("file", F.coalesce(F.json_array_length("value"), F.lit(0)).cast("long").alias("n"))


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).agg(F.count_if(F.trim("value") != "").alias("n"))


def write_lines(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one folder; appending adds files, so earlier rows are never rewritten."""
    rows.write.mode(mode).json(path)


def _path(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, system = _path(spark, path)
    return system.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, system = _path(spark, path)
    system.delete(p, True)


def modified(spark: SparkSession, path: str) -> float | None:
    """Seconds since 1970 at which a file or table was last written; None without it."""
    p, system = _path(spark, path)
    return system.getFileStatus(p).getModificationTime() / 1000 if system.exists(p) else None


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file of the shared file system, whole."""
    if not exists(spark, path):
        return None
    return "".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, system = _path(spark, path)
    stream = system.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file put in the place of another in one step: readers see the old text or the new."""
    part = f"{path}.{uuid.uuid4().hex}"
    write_text(spark, part, text)
    hadoop = spark._jvm.org.apache.hadoop.fs
    kind = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    old, system = _path(spark, part)
    new = system.makeQualified(_path(spark, path)[0])
    hadoop.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration()).rename(system.makeQualified(old), new, how)


def folders_in(spark: SparkSession, folder: str) -> list[str]:
    p, system = _path(spark, folder)
    return [x.getPath().getName() for x in system.listStatus(p) if x.isDirectory()] if system.exists(p) else []


def files_below(spark: SparkSession, folder: str, ending: str) -> list[tuple[str, int]]:
    """(path below the folder, bytes) of the files of one ending, at any depth, by path."""
    top, system = _path(spark, folder)
    if not system.exists(top):
        return []
    root = system.makeQualified(top).toUri().getPath().rstrip("/") + "/"
    out, listed = [], system.listFiles(top, True)
    while listed.hasNext():
        one = listed.next()
        path = one.getPath().toUri().getPath()
        if path.endswith(ending):
            out.append((path.removeprefix(root), one.getLen()))
    return sorted(out)


def write_documents(documents: DataFrame, folder: str, dry_run: bool = False) -> list[tuple[str, int]]:
    """Write (path, text) rows below folder by the shared file system, path by path; returns (path, bytes).

    Documents are guideline files: as many as directories. They stream to the driver one partition at a time.
    Guideline files of an earlier run that this one does not write are deleted; other files stay.
    """
    spark = documents.sparkSession
    before = files_below(spark, folder, ".md")
    out = []
    for row in documents.orderBy("path").toLocalIterator():
        out.append((row["path"], len(row["text"].encode())))
        if not dry_run:
            write_text(spark, f"{folder}/{row['path']}", row["text"])
    if not dry_run:
        for path in {p for p, _ in before} - {p for p, _ in out}:
            delete(spark, f"{folder}/{path}")
    return out
