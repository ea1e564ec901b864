"""What a stage counts while it runs, and the checks that tell from its record and tables how far it got."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class StageStats:
    """Named numbers and texts of a stage, in the order in which they came up, and its cost."""

    values: dict[str, int | float | str] = field(default_factory=dict)
    detail: str | None = None
    cost: Decimal = Decimal(0)

    def set(self, key: str, value: int | float | str) -> None:
        self.values[key] = value

    def inc(self, key: str, by: int = 1) -> None:
        self.values[key] = self.values.get(key, 0) + by

    def add_cost(self, cost: Decimal | None) -> None:
        self.cost += cost or Decimal(0)

    def summary(self) -> str:
        return " | ".join(f"{k}: {v}" for k, v in self.values.items())


def measured(rows: DataFrame, stats: StageStats, **counts) -> None:  # noqa: ANN003
    """Set several aggregates of a table in one pass; a sum over no rows is 0."""
    found = rows.agg(*[c.alias(k) for k, c in counts.items()]).first()
    for k in counts:
        stats.set(k, 0 if found[k] is None else found[k])


def cost_of(rows: DataFrame) -> Decimal:
    """The sum of the column `cost` that an annotator may add to its rows; 0 where there is none."""
    if "cost" not in rows.columns:
        return Decimal(0)
    return rows.agg(F.coalesce(F.sum(F.col("cost").cast("decimal(18,6)")), F.lit(0)).cast("decimal(18,6)")).first()[0]


def number(n: int) -> str:
    return f"{int(n):,}"


# What each stage's line of the status table says, from its numbers. None stands for a stage that has not
# finished.


def extract_detail(s: dict, available: int | None) -> str:
    done = s.get("total_processed", 0)
    of = f"{number(done)}/{number(available)}" if available and done < available else number(done)
    return f"{of} comments → {number(s.get('actionable', 0))} actionable, {number(s.get('non_actionable', 0))} rejected → {
        number(s.get('total_potential_rules', 0))
    } generalizations"


def synthesize_detail(s: dict) -> str:
    n, alone = s.get("total_generalizations", 0), s.get("unclustered", 0)
    how = f"(similarity ≥ {s.get('similarity_threshold')}, min cluster size {s.get('min_cluster_size')}, coherence: {s.get('avg_coherence', 0):.2f})"
    return f"{number(n)} generalizations → {number(n - alone)} in {number(s.get('total_clusters', 0))} clusters, {number(alone)} unclustered → {number(s.get('rules_extracted', 0))} rules {how}"


def dedupe_detail(s: dict) -> str:
    return f"{number(s.get('input_rules', 0))} → {number(s.get('output_rules', 0))} rules ({
        number(s.get('input_rules', 0) - s.get('output_rules', 0))
    } merged)"


def place_detail(s: dict) -> str:
    kinds = sorted((k.removeprefix("type "), n) for k, n in s.items() if k.startswith("type "))
    return f"{number(s.get('input_rules', 0))} → {number(s.get('placed', 0))} rules placed (score ≥ {s.get('min_score')}) | " + ", ".join(f"{k}: {n}" for k, n in sorted(kinds, key=lambda x: -x[1]))


def group_detail(s: dict) -> str:
    kept, every = s.get("filtered_placements", 0), s.get("total_placements", 0)
    of = number(every) if kept == every else f"{number(kept)}/{number(every)}"
    return f"{of} rules (score ≥ {s.get('min_score')}) → {number(s.get('locations', 0))} locations | {number(s.get('inline_rules', 0))} inline, {number(s.get('topic_rules', 0))} in topics"


def generate_detail(s: dict) -> str:
    guides = f", {s['topic_docs']} topic docs" if s.get("topic_docs") else ""
    return f"{s.get('agents_files', 0)} AGENTS.md files{guides} ({s.get('bytes', 0) / 1024:.0f} KB) | {s.get('places', '')}"


DETAILS = {"synthesize": synthesize_detail, "dedupe": dedupe_detail, "place": place_detail, "group": group_detail, "generate": generate_detail}
