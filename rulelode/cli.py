"""python -m rulelode.cli COMMAND: run the stages over comment files, look rules up, show status and cost."""

from __future__ import annotations

import argparse
import time
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rulelode.functions import scalar
from rulelode.operators import annotate, consolidate, extraction, ledger, organize, placement, progress, provenance
from rulelode.plans import pipeline
from rulelode.sources import changes, files, scratch
from rulelode.sources.state import State

TABLES = {
    "extract": "extractions", "synthesize": "synthesized", "clusters": "clusters", "unclustered": "unclustered", "dedupe": "rules",
    "merge_log": "merge_log", "components": "components", "place": "placements", "group": "organized",
}
#: What each stage writes, and the table that its input hash is of.
OUTPUTS = {
    "extract": ("extract",), "synthesize": ("synthesize", "clusters", "unclustered"), "dedupe": ("dedupe", "merge_log"), "place": ("place",),
    "group": ("group",), "generate": (),
}
INPUT = {"synthesize": "extract", "dedupe": "synthesize", "place": "dedupe", "group": "place", "generate": "group"}
#: Options that a stage's result depends on; a run with others works on, but does not start anew.
MATTERS = {
    "extract": ("authors", "prs", "sample", "seed", "limit"), "synthesize": ("limit",), "dedupe": ("overrides",), "place": ("min_score", "limit"),
    "group": ("min_score", "max_rules"), "generate": (),
}
CACHES = {"embeddings": "embedding", "rephrased": "told"}
#: A cache of more versions than this is written anew as one.
COMPACT = 8
#: Files of the other layout, by stage.
LAYOUT = {
    "extract": "2-extract/extractions.jsonl", "synthesize": "3-synthesize/rules.jsonl", "dedupe": "4-dedupe/rules.jsonl",
    "place": "5-place/placements.jsonl", "group": "6-group/organized_rules.json",
}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="rulelode")
    p.add_argument("--data", required=True, help="folder of the repository's data, on any file system that Spark reads")
    p.add_argument("--repo", required=True, help="owner/name")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", *ledger.STAGES[1:]):
        c = sub.add_parser(name)
        c.add_argument("--comments", help="folder of review comment files, one JSON array a change")
        c.add_argument("--overrides")
        c.add_argument("--authors", default="all")
        c.add_argument("--prs")
        c.add_argument("--sample", type=int)
        c.add_argument("--limit", type=int)
        c.add_argument("--seed", type=int, default=42)
        c.add_argument("--min-score", type=float, default=0.5)
        c.add_argument("--max-rules", type=int)
        c.add_argument("--from", dest="start")
        c.add_argument("--skip", default="")
        c.add_argument("--fresh", action="store_true")
        c.add_argument("--preview", action="store_true")
        c.add_argument("--dry-run", action="store_true")
    find = sub.add_parser("lookup")
    find.add_argument("what", nargs="?", help="a rule id or words")
    sub.add_parser("status")
    get = sub.add_parser("download", help="fetch what is missing of a repository's changes")
    get.add_argument("--client", required=True, help="module:function that knows the service")
    get.add_argument("--since")
    for name, what in (("import", "read stage files of the JSON layout into tables"), ("export", "write tables as stage files of the JSON layout")):
        sub.add_parser(name, help=what).add_argument("folder")
    return p


class Run:
    """Stage outputs as versions of Parquet tables below data/repo; a stage that another's output feeds reads it from there.

    A record of each stage holds the hash of what it read, its numbers and its cost. A stage whose input has changed
    starts anew; else it goes on from where it is, and one that has ended with the same options does nothing.
    """

    def __init__(self, spark: SparkSession, a: argparse.Namespace) -> None:
        if "/" not in a.repo:
            raise SystemExit("--repo must be owner/name")
        self.spark, self.a, self.root = spark, a, f"{a.data}/{a.repo}"
        self.state = State(spark, self.root, TABLES | {c: c for c in CACHES})
        self.read, self.has = self.state.read, self.state.has

    def put(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        self.state.put(name, df, mode == "append")

    def input_hash(self, name: str) -> str | None:
        """Of what the stage reads now; None without it."""
        if name == "extract":
            folder = self.a.comments if "comments" in self.a and self.a.comments else (self.state.record("extract") or {}).get("stats", {}).get("comments")
            return ledger.file_hash(self.spark, [f"{folder}/*.json"]).first()[0] if folder and files.files_below(self.spark, folder, ".json") else None
        if not self.has(INPUT[name]):
            return None
        # The sums of each version stand in the state: no table is read.
        return self.state.digest(INPUT[name])

    def stage(self, name: str, o: pipeline.Options) -> None:
        current = self.input_hash(name)
        record = self.state.record(name) or {}
        before = record.get("stats", {})
        options = {k: getattr(self.a, k, None) for k in MATTERS[name]}
        same = record.get("input_hash") == current and not self.a.fresh
        if same and record.get("done") and before.get("options") == options and not self.a.preview and not self.a.dry_run:
            print(f"{name}: up to date")
            return
        if not same:
            for table in OUTPUTS[name]:
                self.state.drop(table)
        stats = progress.StageStats(cost=self.state.cost(name) if same else Decimal(0))
        o.caches |= {cache: self.read(cache) for cache in CACHES if self.has(cache)}
        known = dict(o.caches)
        done = getattr(self, f"_{name}")(o, stats)
        for cache, rows in o.caches.items():
            if rows is not known.get(cache):
                self.put(cache, annotate.new_entries(rows, known.get(cache)), "append")
                if len(self.state.paths(cache)) > COMPACT:
                    self.put(cache, self.read(cache))
        o.caches.clear()
        for rejected in o.rejected.values():
            stats.inc("rejected_outputs", rejected.count())
        o.rejected.clear()
        stats.set("options", options)
        if not self.a.dry_run and not self.a.preview:
            self.state.note(name, current, stats.values, stats.cost, done)
        # The stage's tables and its record come into being in one step.
        self.state.commit()
        print(f"{name}: {stats.detail or stats.summary()}")

    def _extract(self, o: pipeline.Options, stats: progress.StageStats) -> bool:
        done = self.read("extract") if self.has("extract") else None
        raw = files.comments(self.spark, self.a.comments)
        made = pipeline.extract(raw, done, o)
        stats.add_cost(progress.cost_of(made))
        self.put("extract", made, "overwrite" if done is None else "append")
        stats.values |= extraction.extraction_stats(self.read("extract")).first().asDict()
        available = files.count_items(self.spark, self.a.comments).agg(F.sum("n")).first()[0]
        stats.values |= {"available": available, "comments": self.a.comments}
        stats.detail = progress.extract_detail(stats.values, available)
        return o.limit is None

    def _synthesize(self, o: pipeline.Options, stats: progress.StageStats) -> bool:
        done = self.read("synthesize") if self.has("synthesize") else None
        extractions = self.read("extract")
        rules, clusters = pipeline.synthesize(extractions, o, done)
        stats.add_cost(progress.cost_of(rules))
        self.put("synthesize", rules, "overwrite" if done is None else "append")
        self.put("clusters", clusters)
        self.put("unclustered", o.unclustered)
        every = self.read("synthesize")
        progress.measured(self.read("clusters"), stats, total_clusters=F.count(F.lit(1)), _clustered=F.sum("num_generalizations"))
        progress.measured(every, stats, rules_extracted=F.count(F.lit(1)), _analysed=F.count_distinct("cluster_id"))
        mean = (
            consolidate.synthesis_stats(every.groupBy("cluster_id").agg(F.max("cluster_coherence").alias("coherence")), every)[0]
            .first()["avg_coherence"]
        )
        n = extraction.generalizations(extractions).count()
        stats.values |= {
            "total_generalizations": n, "unclustered": n - stats.values.pop("_clustered"), "avg_coherence": mean or 0.0,
            "similarity_threshold": o.similarity, "min_cluster_size": o.min_cluster,
        }
        stats.detail = progress.synthesize_detail(stats.values)
        return o.limit is None or stats.values["_analysed"] == stats.values["total_clusters"]

    def _dedupe(self, o: pipeline.Options, stats: progress.StageStats) -> bool:
        over = files.overrides(self.spark, self.a.overrides) if self.a.overrides else None
        before = self.read("synthesize")
        # Similar rules outlive a changed input: only what is new or has changed is compared again.
        o.components = scratch.materialize(self.read("components"), "components") if self.has("components") and not self.a.fresh else None
        rules, log = pipeline.dedupe(before, over, o)
        self.put("components", o.components)
        self.put("dedupe", rules)
        self.put("merge_log", log)
        stats.set("input_rules", before.count() + (over.count() if over is not None else 0))
        stats.set("output_rules", self.read("dedupe").count())
        stats.detail = progress.dedupe_detail(stats.values)
        return True

    def _place(self, o: pipeline.Options, stats: progress.StageStats) -> bool:
        done = self.read("place") if self.has("place") else None
        rules = self.read("dedupe")
        made = pipeline.place(rules, self.read("extract"), o, done)
        stats.add_cost(progress.cost_of(made))
        self.put("place", made, "overwrite" if done is None else "append")
        every = self.read("place")
        stats.values |= {"input_rules": placement.at_least(rules, o.min_score).count(), "placed": every.count(), "min_score": o.min_score}
        for r in placement.type_counts(every).collect():
            stats.set(f"type {r['placement_type']}", r["n"])
        stats.detail = progress.place_detail(stats.values)
        return o.limit is None or stats.values["placed"] >= stats.values["input_rules"]

    def _group(self, o: pipeline.Options, stats: progress.StageStats) -> bool:
        placements = self.read("place")
        if self.a.preview:
            placement.threshold_preview(placement.best_placement(placements)).show(truncate=False)
            return True
        self.put("group", pipeline.group(placements, self.read("dedupe"), o))
        totals = organize.location_totals(self.read("group"))
        progress.measured(totals, stats, locations=F.count(F.lit(1)), inline_rules=F.sum("n_inline"), topic_rules=F.sum("n_topic_rules"))
        stats.values |= {
            "total_placements": placements.count(),
            "filtered_placements": placement.at_least(placement.best_placement(placements), o.min_score).count(), "min_score": o.min_score,
        }
        stats.detail = progress.group_detail(stats.values)
        return True

    def _generate(self, o: pipeline.Options, stats: progress.StageStats) -> bool:
        docs = pipeline.generate(self.read("group"), self.read("dedupe"), self.read("place"), o)
        written = files.write_documents(docs, f"{self.root}/documents", self.a.dry_run)
        for path, size in written:
            print(f"{path}: {size} bytes")
        guides = [p for p, _ in written if not p.endswith("AGENTS.md")]
        places = ", ".join(p.removesuffix("/AGENTS.md") if "/" in p else "root" for p, _ in written if p.endswith("AGENTS.md"))
        stats.values |= {"agents_files": len(written) - len(guides), "topic_docs": len(guides), "bytes": sum(n for _, n in written), "places": places}
        stats.detail = progress.generate_detail(stats.values)
        return True

    def landed(self) -> tuple | None:
        """The row of the download, made by other means: how many of the listed changes have all their files."""
        folder = (self.state.record("extract") or {}).get("stats", {}).get("comments")
        folder = folder.rstrip("/").rpartition("/")[0] if folder else f"{self.root}/1-download"
        if not files.exists(self.spark, f"{folder}/pr_list.json"):
            return None
        listed = files.pr_list(self.spark, f"{folder}/pr_list.json", cap=None).select(F.col("number").alias("pr_number"))
        n = listed.count()
        whole = ledger.complete(files.resources(self.spark, folder)).join(listed, "pr_number", "left_semi").count()
        said = files.count_items(self.spark, f"{folder}/review_comments").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        diffs = len(files.files_below(self.spark, f"{folder}/diffs", ".diff"))
        detail = f"{progress.number(n)} PRs | {progress.number(said)} review comments, {progress.number(diffs)} diffs" if whole >= n else f"{progress.number(whole)}/{progress.number(n)} PRs downloaded | {progress.number(said)} review comments"
        written = files.modified(self.spark, f"{folder}/pr_list.json")
        return (0, "download", whole, n, None, None, detail, None if written is None else time.time() - written, "0")

    def states(self) -> DataFrame:
        """One row a stage: ord, stage, status, detail, age, cost; the table that `status` prints."""
        rows = [x for x in [self.landed()] if x]
        for i, name in enumerate(ledger.STAGES[1:], 1):
            record = self.state.record(name)
            done = bool(record) and (not OUTPUTS[name] or self.has(OUTPUTS[name][0]))
            s = (record or {}).get("stats", {})
            detail = "" if not done else progress.extract_detail(s, s.get("available")) if name == "extract" else progress.DETAILS[name](s) if record.get("done") else f"{self.read(OUTPUTS[name][0]).count()} rows so far" if OUTPUTS[name] else ""
            written = (record or {}).get("at")
            rows.append(
                (
                    i, name, 1 if done else 0, 1 if not record or record.get("done") else 2, (record or {}).get("input_hash"),
                    self.input_hash(name) if record else None, detail, None if written is None else time.time() - written,
                    str(self.state.cost(name)),
                )
            )
        known = self.spark.createDataFrame(
            rows,
            "ord int, stage string, n_out long, n_expected long, stored_hash string, current_hash string, detail string, seconds double, cost string",
        )
        age = F.when(F.col("seconds").isNotNull(), scalar.age_text(F.col("seconds")))
        return (
            ledger.status(known)
            .select(
                "ord", "stage", "status", "detail", age.alias("age"), scalar.cost_text(F.col("cost").cast("decimal(18,6)")).alias("cost"),
                F.col("cost").cast("decimal(18,6)").alias("spent"),
            )
        )

    def status(self) -> None:
        for name in TABLES:
            print(name, self.read(name).count() if self.has(name) else "missing")
        states = self.states()
        for r in states.orderBy("ord").collect():
            print(" | ".join(str(x) for x in (r["stage"], r["status"], r["detail"], r["age"] or "", r["cost"]) if x))
        total = ledger.total_cost(states.select(F.col("spent").alias("cost"))).select(scalar.cost_text(F.col("cost"))).first()[0]
        after = ledger.next_stage(states).first()["stage"]
        print(f"cost: {total or '$0'}", f"next: {after}" if after else "all stages done")
        if self.has("group"):
            organize.location_totals(self.read("group")).show(truncate=False)

    def take_in(self, folder: str) -> None:
        """Stage files of the JSON layout become tables; their stages count as done."""
        readers = {
            "extract": files.extractions, "synthesize": files.rules, "dedupe": files.rules, "place": files.placements, "group": files.organization,
        }
        for name, path in LAYOUT.items():
            if not files.exists(self.spark, f"{folder}/{path}"):
                continue
            rows = readers[name](self.spark, f"{folder}/{path}")
            if name == "group":
                # The document's order: rules inline before those in topics, as they stand.
                rows = rows.withColumn("place", F.struct(F.lit(0).alias("moved"), F.lit("").alias("_from"), F.col("ord"))).drop("ord")
            self.put(name, rows)
            n = self.read(name).count()
            lines = n if name == "group" else files.count_lines(self.spark, f"{folder}/{path}").first()["n"]
            print(f"{name}: {n} rows" + (f", {lines - n} lines unreadable" if lines > n else ""))
        for name in LAYOUT:
            if self.has(name):
                stats = {"options": {k: None for k in MATTERS[name]}}
                self.state.note(name, self.input_hash(name) if name != "extract" else None, stats, self.state.cost(name), True)
        self.state.commit()

    def give_out(self, folder: str) -> None:
        """Tables become stage files of the JSON layout: folders of JSON lines, and one organization document."""
        names = {"synthesize": files.RULE, "dedupe": files.RULE, "place": files.PLACEMENT, "extract": files.EXTRACTION}
        for name, schema in names.items():
            if self.has(name):
                rows = self.read(name)
                have = [f.name for f in StructType.fromDDL(schema).fields if f.name in rows.columns]
                files.write_lines(rows.orderBy("ord").select(*have), f"{folder}/{LAYOUT[name]}")
        if self.has("group"):
            rows = self.read("group")
            stats = {k: v for k, v in (self.state.record("group") or {}).get("stats", {}).items() if k != "options"}
            files.write_text(
                self.spark, f"{folder}/{LAYOUT['group']}", files.organization_document(rows, pipeline.topic_names(rows), stats).first()["value"],
            )


def main(argv: list[str] | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("rulelode").getOrCreate()
    r = Run(spark, a)
    if a.command == "lookup":
        if not r.has("group"):
            print("no organization yet")
            return
        rows = r.read("group").select("location", "rule_id", "topic_id")
        if a.what is None:
            provenance.by_location(rows).show(1000, truncate=False)
        elif a.what.lstrip("-").isdigit():
            rules = r.read("dedupe").where(F.col("rule_id") == int(a.what))
            provenance.provenance(rules, placement.last_placement(r.read("place")), rows, _comments(r)).show(truncate=False)
        else:
            provenance.search(r.read("dedupe"), a.what).select("rule_id", "text").show(truncate=False)
        return
    if a.command == "status":
        return r.status()
    if a.command == "download":
        tried = changes.land(spark, a.client, f"{r.root}/1-download", a.since).groupBy("resource").agg(F.count_if(F.col("error").isNull()).alias("n"), F.count("error").alias("failed"))
        for x in tried.orderBy("resource").collect():
            print(f"{x['resource']}: {x['n']} fetched" + (f", {x['failed']} failed" if x["failed"] else ""))
        return
    if a.command in ("import", "export"):
        return (r.take_in if a.command == "import" else r.give_out)(a.folder)
    o = pipeline.Options(
        authors=None if a.authors == "all" else a.authors, prs=a.prs, sample=a.sample, limit=a.limit, seed=a.seed, min_score=a.min_score,
        max_rules=a.max_rules,
    )
    names = pipeline.stages_from(a.start, a.skip) if a.command == "run" else [a.command]
    if "download" in names:
        print("download: a command of its own; files are read from --comments")
    for name in (n for n in names if n != "download"):
        r.stage(name, o)
        scratch.clear(spark)


def _comments(r: Run) -> DataFrame:
    """All comments where their files can be read, so that ones never extracted are found too; else the extracted."""
    folder = (r.state.record("extract") or {}).get("stats", {}).get("comments")
    if folder and files.files_below(r.spark, folder, ".json"):
        return files.comments(r.spark, folder)
    x = r.read("extract")
    return x.select(
        F.col("comment_id").alias("id"), "pr_number", F.struct(F.col("author").alias("login")).alias("user"), "source.path", "source.body",
        "source.diff_hunk",
    )


if __name__ == "__main__":
    main()
