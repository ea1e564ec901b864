"""Column functions: scores, keys, texts and formats. All are JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weight of a rule by the number of independent changes behind it; 4 and more, and 0, weigh 1.
SPREAD = {1: 0.6, 2: 0.85, 3: 0.95}
#: Headings of rule categories.
HEADINGS = {
    "api_design": "API Design", "code_style": "Code Style", "documentation": "Documentation", "error_handling": "Error Handling",
    "testing": "Testing",
    "typing": "Type System", "imports": "Imports", "naming": "Naming", "exports": "Exports", "deprecation": "Deprecation",
}


def spread_factor(changes: Column) -> Column:
    out = F.lit(1.0)
    for n, weight in SPREAD.items():
        out = F.when(changes == n, F.lit(weight)).otherwise(out)
    return out


def rule_score(confidence: Column, changes: Column) -> Column:
    """confidence times the spread factor, at most 1."""
    return F.least(F.lit(1.0), confidence * spread_factor(changes))


def first_score(*columns: Column) -> Column:
    """The first score present, else 0; older rows carry it under another name."""
    return F.coalesce(*columns, F.lit(0.0))


def is_bot(login: Column, kind: Column | None = None) -> Column:
    """Type Bot, or a login that ends in [bot]; unknown type and login are people."""
    named = F.coalesce(login, F.lit("")).endswith("[bot]")
    return named if kind is None else named | F.coalesce(kind == "Bot", F.lit(False))


def is_bot_author(author: Column, names: tuple[str, ...] = ("Copilot",)) -> Column:
    return is_bot(author) | F.coalesce(author.isin(*names), F.lit(False))


def location_key(kind: Column, directory: Column, file_path: Column) -> Column:
    """Where a placed rule lives; a null directory or path is 'unknown'."""
    return (
        F.when(kind.isin("agents_md_root", "cross_file"), F.lit("root"))
        .when(kind == "agents_md_dir", F.coalesce(directory, F.lit("unknown")))
        .when(kind == "file", F.concat(F.lit("file:"), F.coalesce(file_path, F.lit("unknown"))))
        .otherwise(F.lit("unknown"))
    )


def top_segment(path: Column) -> Column:
    return F.split(path, "/")[0]


def parent_directory(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(F.lit("root"))


def heading(category: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in HEADINGS.items() for x in pair])
    return F.coalesce(F.element_at(known, category), F.initcap(F.translate(category, "_", " ")))


#: The shape of a rule's line in a document, and what stands for a thread without comments.
RULE_LINE = ("<!-- rule:", " -->\n- ", " — ")
NO_THREAD = "No prior thread context."


def rule_line(rule_id: Column, text: Column, rationale: Column) -> Column:
    before, between, after = (F.lit(x) for x in RULE_LINE)
    return F.concat(before, rule_id.cast("string"), between, text, after, rationale)


def thread_context(thread: Column) -> Column:
    """Lines of an array of (login, body), root first."""
    line = lambda c, i: F.concat(
        F.lit("["), (i + 1).cast("string"), F.lit("] @"), F.coalesce(c["login"], F.lit("unknown")), F.lit(": "), F.coalesce(c["body"], F.lit("")),
    )
    return F.when(F.size(thread) > 0, F.array_join(F.transform(thread, line), "\n")).otherwise(F.lit(NO_THREAD))


def truncated(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def last_lines(text: Column, n: int) -> Column:
    lines = F.split(text, "\n")
    return F.array_join(F.slice(lines, F.greatest(F.size(lines) - n + 1, F.lit(1)), F.lit(n)), "\n")


def cost_text(cost: Column) -> Column:
    """Blank at or under 0, four places under a cent, else two; halves go to the even digit."""
    money = cost.cast("decimal(18,6)")
    short = F.bround(money, 2).cast("decimal(18,2)").cast("string")
    return (
        F.when(money <= 0, F.lit("")).when(money < 0.01, F.concat(F.lit("$"), F.bround(money, 4).cast("decimal(18,4)").cast("string")))
        .otherwise(F.concat(F.lit("$"), short))
    )


def count_text(n: Column) -> Column:
    return F.format_number(n, 0)


def age_text(seconds: Column) -> Column:
    s = F.greatest(seconds.cast("long"), F.lit(0))
    part = lambda unit, name: F.concat(F.floor(s / unit).cast("string"), F.lit(name))
    return F.when(s >= 86400, part(86400, "d ago")).when(s >= 3600, part(3600, "h ago")).otherwise(part(60, "m ago"))


def cosine(a: Column, b: Column) -> Column:
    """In double precision; 0 where a vector has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(F.lit(0.0))
