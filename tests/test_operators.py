"""Edge rows and kernels against plain versions."""

from __future__ import annotations

import json
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rulelode.functions import scalar
from rulelode.operators import annotate, comments, consolidate, extraction, graph, ledger, linkage, organize, placement, provenance, render, vectors
from rulelode.operators.numbering import with_numbers
from rulelode.plans import catalog, pipeline
from rulelode.sources import files
from rulelode.streaming import ingest

C = files.COMMENT + ", pr_number BIGINT"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def talk(spark, *data):
    return spark.createDataFrame([(i, {"login": u, "type": t} if u or t else None, b, None, None, up, 1) for i, u, t, b, up in data], C)


def test_bots(spark):
    df = talk(spark, (1, "x[bot]", None, "", None), (2, "a", "Bot", "", None), (3, "a", None, "", None), (4, None, None, "", None), (5, "Copilot", "User", "", None))
    assert [r.id for r in comments.filter_bots(df).orderBy("id").collect()] == [3, 4, 5]
    assert not spark.range(1).select(~scalar.is_bot_author(F.lit("Copilot"))).first()[0]
    assert [r.id for r in comments.filter_authors(df, "Copilot").collect()] == [5]
    assert comments.filter_authors(df, "all").count() == 5
    assert comments.filter_prs(df, [2]).count() == 0


def test_threads(spark):
    df = talk(spark, (1, "a", None, "one", None), (2, "b", None, "two", 1), (3, None, None, None, 2), (4, "a", None, "x", 99), (5, "a", None, "self", 5), (6, "a", None, "p", 7), (7, "a", None, "q", 6), (8, "a", None, "under", 6), (9, "a", None, "zero", 0))
    got = dict(rows(comments.thread_chains(df)))
    assert {k: list(v) for k, v in got.items()} == {1: [], 2: [1], 3: [1, 2], 4: [], 5: [], 6: [], 7: [], 8: [], 9: []}
    context = {r.id: r.context for r in comments.with_context(df).collect()}
    assert context[3] == "[1] @a: one\n[2] @b: two" and context[1] == "No prior thread context."
    assert comments.thread_chains(df.limit(0)).count() == 0


def test_long_thread(spark):
    df = talk(spark, *[(i, "a", None, str(i), i - 1 if i > 1 else None) for i in range(1, 70)])
    got = {r.id: list(r.chain) for r in comments.thread_chains(df).collect()}
    assert all(got[i] == list(range(1, i)) for i in range(1, 70))


def test_limits(spark):
    df, done = spark.range(10).toDF("id"), spark.createDataFrame([(0,), (1,), (None,)], "id long")
    assert rows(comments.limited(df, done, "id", 3)) == [(2,), (3,), (4,)]
    assert rows(comments.limited(df, done, "id", 3, before_resume=True)) == [(2,)]
    assert comments.sample_seeded(df, F.col("id"), 4).count() == 4
    assert rows(comments.sample_seeded(df, F.col("id"), 4)) == rows(comments.sample_seeded(df.repartition(7), F.col("id"), 4))
    assert comments.sample_seeded(df, F.col("id"), 40).count() == 10


def test_generalizations(spark):
    df = spark.createDataFrame([(1, 1, "a", True, None, None, [], [("g", "", None, 0), ("", "", None, 1), (None, "", None, 2)], None), (2, 1, "b[bot]", True, None, None, [], [("h", "", None, 0)], None), (3, 1, "a", False, "question", None, [], [("i", "", None, 0)], None), (4, 1, "a", None, "", None, None, None, None)], files.EXTRACTION)
    assert [(r.comment_id, r.generalization) for r in extraction.generalizations(df).collect()] == [(1, "g")]
    assert rows(extraction.rejections(df)) == [("question", 1), ("unknown", 1)]
    s = extraction.extraction_stats(df).first()
    assert (s.total_processed, s.actionable, s.non_actionable, s.total_potential_rules) == (4, 2, 2, 4)


@pytest.mark.parametrize(("n", "score"), [(0, 0.9), (1, 0.54), (2, 0.765), (3, 0.855), (4, 0.9), (9, 0.9)])
def test_score(spark, n, score):
    assert spark.range(1).select(scalar.rule_score(F.lit(0.9), F.lit(n))).first()[0] == pytest.approx(score)


def test_texts(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert [one(scalar.cost_text(F.lit(x))) for x in ("0", "0.0042", "0.5", "12.345")] == ["", "$0.0042", "$0.50", "$12.34"]
    assert one(scalar.heading(F.lit("config"))) == "Config" and one(scalar.heading(F.lit("typing"))) == "Type System"
    assert one(scalar.parent_directory(F.lit("a.py"))) == "root" and one(scalar.parent_directory(F.lit("a/b/c.py"))) == "a/b"
    assert one(scalar.location_key(F.lit("agents_md_dir"), F.lit(None).cast("string"), F.lit("x"))) == "unknown"
    assert one(scalar.last_lines(F.lit("\n".join(map(str, range(12)))), 8)) == "\n".join(map(str, range(4, 12)))
    assert [one(scalar.age_text(F.lit(x))) for x in (90_000, 7200, 120)] == ["1d ago", "2h ago", "2m ago"]
    assert one(scalar.cosine(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(0.0)))) == 0


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 160)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in list(parent)}
    got = dict(rows(graph.connected_components(spark.createDataFrame(edges, "src long, dst long"))))
    assert got == want
    assert graph.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_closure(spark):
    groups = spark.createDataFrame([(0, [1, 2]), (1, [2, 3]), (2, [9, 9]), (3, [5, 404])], "group_id long, rule_ids array<long>")
    valid = spark.createDataFrame([(i,) for i in (1, 2, 3, 5, 9)], "rule_id long")
    assert rows(graph.group_closure(groups, valid)) == [(1, 1), (2, 1), (3, 1)]


def test_closure_of_groups_that_come_anew(spark):
    """Groups keep their members where a table gives other numbers each time that it is worked out."""
    def numbered(batches):
        for pdf in batches:
            yield pdf.assign(group_id=[int.from_bytes(os.urandom(7)) for _ in pdf.index])

    groups = spark.createDataFrame([([1, 2],), ([2, 3],), ([5, 404],)], "rule_ids array<long>").mapInPandas(numbered, "rule_ids array<long>, group_id long")
    valid = spark.range(1, 6).withColumnRenamed("id", "rule_id")
    assert rows(graph.group_closure(groups, valid)) == [(1, 1), (2, 1), (3, 1)]


def test_closure_of_far_ids(spark, tmp_path):
    docs = [(0, "a"), (100_000_000, "b"), (7, "c"), (8, "d"), (20, "d")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(catalog.group_closure(spark, str(tmp_path))) == [(7, 7), (8, 7), (20, 7)]


def plain_linkage(x, t):
    members = {i: [i] for i in range(len(x))}
    s = x @ x.T
    while True:
        best = None
        for a in sorted(members):
            for b in sorted(members):
                if a < b:
                    m = float(np.mean([[s[i, j] for j in members[b]] for i in members[a]]))
                    if m >= t and (best is None or m > best[0] + 1e-12):
                        best = (m, a, b)
        if best is None:
            return [m for m in members.values() if len(m) > 1]
        members[best[1]] += members.pop(best[2])


@pytest.mark.parametrize("seed", range(3))
def test_average_linkage(spark, seed):
    x = np.random.default_rng(seed).standard_normal((40, 3))
    x[5] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in linkage.average_linkage_clusters(df, 0.8).collect():
        found.setdefault(r.cluster_id, {})[r.pos] = r.vec_id
    n = np.linalg.norm(x, axis=1, keepdims=True)
    want = plain_linkage(x / np.where(n > 0, n, 1), 0.8)
    assert sorted(sorted(c.values()) for c in found.values()) == sorted(sorted(m) for m in want)
    assert [min(found[k].values()) for k in sorted(found)] == sorted(min(m) for m in want)


def test_average_linkage_ties_and_guard(spark):
    x = np.array([[1.0, 0], [0, 1], [1, 0], [0, 1]])
    assert linkage.average_linkage(x, 0.5) == [[0, 2], [1, 3]]
    df = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(5)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="raise the threshold"):
        linkage.average_linkage_clusters(df, 0.5, largest=4)


def test_average_linkage_in_rounds(spark):
    x = np.random.default_rng(4).standard_normal((24, 3))
    x = np.concatenate([x, x[[3, 3, 3, 8, 8]], np.zeros((2, 3))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)], "vec_id long, embedding array<double>")
    n = np.linalg.norm(x, axis=1, keepdims=True)
    want = sorted(plain_linkage(x / np.where(n > 0, n, 1), 0.6))
    for local, block, whole in ((4096, 2048, None), (3, 5, None), (3, 8, 8)):
        found = {}
        for r in linkage.average_linkage_clusters(df, 0.6, local=local, block=block, whole=whole).collect():
            found.setdefault(r.cluster_id, {})[r.pos] = r.vec_id
        # Clusters and the order of their members, copies of a vector first.
        assert [[c[p] for p in range(len(c))] for _, c in sorted(found.items())] == want
    same = spark.range(25_000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(0.5)).alias("embedding"))
    got = linkage.average_linkage_clusters(same, 0.9)
    assert got.where("cluster_id = 0 and pos = vec_id").count() == 25_000 == got.count()


def test_cosine_blocks(spark):
    x = np.random.default_rng(1).standard_normal((60, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(60, None), (61, [0.0] * 4)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = sorted((i, j) for i in range(60) for j in range(i + 1, 60) if u[i] @ u[j] >= 0.7)
    for block in (7, 1000):
        assert sorted((r.i, r.j) for r in vectors.cosine_pairs(df, 0.7, block=block).collect()) == want


def unit_table(spark, x, extra=()):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + list(extra), "vec_id long, embedding array<double>")


def around(rng, centres, n, spread, d=16):
    c = rng.standard_normal((centres, d))
    x = c[rng.integers(0, centres, n)] + spread * rng.standard_normal((n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("seed", range(30))
def test_lazy_linkage_is_the_plain_one(seed):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((int(rng.integers(1, 50)), int(rng.integers(2, 5))))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    t = (0.1, 0.4, 0.7, 0.9)[seed % 4]
    got, sums, left = linkage.lazy_linkage(x, np.ones(len(x)), t)
    assert [m for m in got if len(m) > 1] == sorted(plain_linkage(x, t))
    assert np.allclose(sums, [x[m].sum(0) for m in got]) and not left.any()


def test_lazy_linkage_keeps_to_its_bounds():
    """Whatever stands outside, a pocket merges nothing that the whole would not."""
    for seed in range(20):
        rng = np.random.default_rng(100 + seed)
        x = rng.standard_normal((40, 3))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        whole = {frozenset(m) for m in plain_linkage(x, 0.5)}
        part = np.sort(rng.choice(40, 20, replace=False))
        out = np.setdiff1d(np.arange(40), part)
        got, _, left = linkage.lazy_linkage(x[part], np.ones(20), 0.5, (x[part] @ x[out].T).max(1))
        for m, more in zip(got, left, strict=True):
            own = set(part[m].tolist())
            assert len(m) == 1 or any(own <= c for c in whole)
            assert more or frozenset(own) in whole or len(m) == 1


def test_average_linkage_where_one_cluster_draws_in_the_others(spark, monkeypatch):
    """Each node's best is one heavy cluster: few pairs are each other's best, and pockets do the rest."""
    rng = np.random.default_rng(11)
    x = np.eye(40)[0] + 0.02 * np.arange(1, 91)[:, None] / 90 * rng.standard_normal((90, 40))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want, _, _ = linkage.lazy_linkage(x, np.ones(len(x)), 0.9)
    monkeypatch.setattr(linkage, "FEW", 0.2)
    got = linkage.average_linkage_clusters(unit_table(spark, x), 0.9, local=20, whole=60, block=40).collect()
    assert {(r.cluster_id, r.pos, r.vec_id) for r in got} == {(k, p, i) for k, m in enumerate(m for m in want if len(m) > 1) for p, i in enumerate(m)}
    assert {r["mutual"] for r in linkage.ROUNDS} == {True, False} and len(linkage.ROUNDS) < 20


def test_average_linkage_of_a_large_component(spark):
    """One component, dealt into pockets: the same clusters as in one piece, in a few rounds."""
    x = around(np.random.default_rng(3), 30, 2000, 0.7)
    want, _, _ = linkage.lazy_linkage(x, np.ones(len(x)), 0.45)
    found = {}
    for r in linkage.average_linkage_clusters(unit_table(spark, x), 0.45, local=100, whole=800, block=400).collect():
        found.setdefault(r.cluster_id, {})[r.pos] = r.vec_id
    assert [[c[p] for p in range(len(c))] for _, c in sorted(found.items())] == [m for m in want if len(m) > 1]
    assert 1 < len(linkage.ROUNDS) < 40 and linkage.ROUNDS[0]["nodes"] > 1900


@pytest.mark.parametrize("threshold", [0.9, 0.6, 0.0])
def test_pairs_partners_and_components_by_pivots(spark, threshold):
    x = around(np.random.default_rng(5), 12, 300, 0.25, 6)
    df = unit_table(spark, x * 3, [(300, None), (301, [0.0] * 6), (302, [1.0]), (303, [float("nan")] * 6), (304, []), (None, x[0].tolist()), (305, [2.0])])
    sim = x @ x.T
    pairs = {(i, j) for i, j in zip(*np.nonzero(sim >= threshold), strict=True) if i < j}
    if threshold == 0:
        # A vector of zeros is at 0 with all of its length.
        pairs |= {(i, 301) for i in range(300)}
    pairs.add((302, 305))
    label = {i: i for i in range(306)}
    for i, j in sorted(pairs):
        a, b = label[i], label[j]
        if a != b:
            label = {k: min(a, b) if v in (a, b) else v for k, v in label.items()}
    for block in (30, 100, 10_000):
        assert {(r.i, r.j) for r in vectors.cosine_pairs(df, threshold, block=block).collect()} == pairs
        assert sorted(r.vec_id for r in vectors.partnered(df, threshold, block=block).collect()) == sorted({i for p in pairs for i in p})
        got = {r.vec_id: r.component for r in vectors.similar_components(df.where("vec_id is not null"), threshold, block=block).collect()}
        assert got == label


def test_blocks_out_of_reach_are_not_compared(spark):
    """Vectors in tight groups: most pairs of blocks are no task, and few copies of a vector are made."""
    x = around(np.random.default_rng(7), 40, 2000, 0.05, 8)
    own = vectors.vectors_of(unit_table(spark, x), "vec_id", "embedding")
    blocks = vectors.blocks_of(own, 0.9, 100)
    dealt = vectors.tasks(vectors.dealt(own, blocks))
    pairs = dealt.select("lo", "hi").distinct().count()
    assert blocks.count >= 20 and pairs < blocks.count * (blocks.count + 1) / 2 / 3
    assert dealt.count() < 4 * 2000


def test_equal_directions_make_few_edges(spark):
    n = 20_000
    df = spark.range(n).select("id", F.array((F.col("id") + 1).cast("double"), (2 * (F.col("id") + 1)).cast("double")).alias("v"))
    labels, edges = vectors.labelled(df, 0.99, block=4000)
    assert edges.count() < 100 and labels.count() == n
    assert {r.component for r in vectors.similar_components(df, 0.99, "id", "v", block=4000).collect()} == {0}


def test_copies_of_a_vector_do_not_grow_with_the_table(spark):
    count = {n: vectors.blocks_of(spark.range(n).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("v")), 0.5).count for n in (20_000, 120_000)}
    assert count == {20_000: 6, 120_000: 6}


def test_strips_of_a_large_block_are_narrow():
    n = 20_000
    table = pa.table({"id": np.arange(n), "v": pa.array([[1.0, 0.0]] * n), "b": np.zeros(n, np.int32), "lo": np.zeros(n, np.int32), "hi": np.zeros(n, np.int32)})
    seen = [(len(rows), sim.size) for rows, _, sim, _ in vectors.compared(table)]
    assert sum(k for k, _ in seen) == n and max(size for _, size in seen) <= 1 << 20


def test_components_grow(spark):
    """Rows that come, change and go: the same as found anew, and only components of such rows are compared."""
    rng = np.random.default_rng(13)
    x = around(rng, 25, 160, 0.3, 8)
    table = lambda ids, texts=None: spark.createDataFrame([(int(i), x[i].tolist(), (texts or {}).get(i, f"t{i}")) for i in ids], "vec_id long, embedding array<double>, text string")
    steps = [(list(range(0, 160, 2)), {}), ([i for i in range(160) if i % 7], {}), ([i for i in range(3, 150)], {5: "new", 40: "new"})]
    state = None
    for ids, texts in steps:
        now = table(ids, texts)
        state = vectors.materialize(vectors.maintained_components(now, state, 0.8, block=40), "state")
        got = {r.vec_id: r.component for r in state.collect()}
        assert got == {r.vec_id: r.component for r in vectors.similar_components(now, 0.8, block=40).collect()}
    same = vectors.maintained_components(now, state, 0.8, block=40)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, state.collect()))


def test_a_new_row_touches_only_its_component(spark, monkeypatch):
    x = around(np.random.default_rng(17), 20, 200, 0.1, 8)
    known = unit_table(spark, x)
    known = known.join(vectors.similar_components(known, 0.9), "vec_id")
    fresh = spark.createDataFrame([(500, x[7].tolist()), (501, (-x[7]).tolist())], "vec_id long, embedding array<double>")
    added, moved = vectors.grown_components(fresh, known, 0.9)
    of = {r.vec_id: r.component for r in known.collect()}
    assert rows(added) == [(500, of[7]), (501, 501)] and rows(moved) == []
    # One that stands between two groups makes them one.
    ends = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [0.8, 0.6], 2)], "vec_id long, embedding array<double>, component long")
    between = spark.createDataFrame([(9, [0.95, 0.3])], "vec_id long, embedding array<double>")
    added, moved = vectors.grown_components(between, ends, 0.9)
    assert rows(added) == [(9, 1)] and rows(moved) == [(2, 1)]


def test_ids_by_a_fold(spark):
    rng = random.Random(1)
    data = [(g, o, [rng.randint(0, 6) for _ in range(rng.randint(1, 4))]) for g in range(30) for o in range(rng.randint(1, 5))]
    want = []
    for g in range(30):
        used = set()
        for _, _, ids in sorted(r for r in data if r[0] == g):
            one = next((i for i in sorted(ids) if i not in used), min(ids))
            used.add(one)
            want.append(one)
    df = consolidate.allocated(spark.createDataFrame(data, "group_id long, out int, merged_from array<long>"))
    assert [r.rule_id for r in df.orderBy("group_id", "out").collect()] == want
    assert "Python" not in df._jdf.queryExecution().toString() and df.dtypes == [("group_id", "bigint"), ("out", "int"), ("rule_id", "bigint")]


def test_an_id_with_several_vectors(spark):
    df = spark.createDataFrame([(5, [1.0, 0.0]), (3, [1.0, 0.01]), (5, [0.0, 1.0]), (9, [0.01, 1.0]), (7, [-1.0, -1.0])], "vec_id long, embedding array<double>")
    for block in (2, 100):
        assert rows(vectors.similar_components(df, 0.9, block=block)) == [(3, 3), (5, 3), (7, 7), (9, 3)]


def rule(i, **k):
    base = {"rule_id": i, "cluster_id": 1, "text": f"t{i}", "reason": "", "confidence": 0.9, "rule_score": 0.5, "category": "c", "scope": "s", "example_bad": None, "example_good": None, "related_entities": [], "source_comments": [i], "source_prs": [i], "unique_pr_count": 1, "cluster_coherence": 0.5, "common_pattern": "", "is_override": False, "explicit_category": False, "explicit_scope": False, "ord": i, "group_id": 1}
    return base | k


RULES = "rule_id long, cluster_id long, text string, reason string, confidence double, rule_score double, category string, scope string, example_bad string, example_good string, related_entities array<string>, source_comments array<long>, source_prs array<long>, unique_pr_count int, cluster_coherence double, common_pattern string, is_override boolean, explicit_category boolean, explicit_scope boolean, ord long, group_id long"


def rule_table(spark, *data):
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in RULES.split(", ")) for r in data], RULES)


def test_overrides(spark):
    df = rule_table(spark, rule(0, rule_score=0.7, category="best"), rule(4), rule(-1, is_override=True, text="mine", category="general", unique_pr_count=5, ord=-2, source_comments=[], source_prs=[]), rule(-2, is_override=True, text="late", ord=-1, unique_pr_count=5))
    r = consolidate.overridden(df).first()
    assert (r.rule_id, r.text, r.category, r.unique_pr_count, r.source_prs) == (0, "mine", "best", 5, [0, 4])
    assert consolidate.overridden(df, zero_is_id=False).first().rule_id == 4
    own = df.withColumn("explicit_category", F.col("is_override"))
    assert consolidate.overridden(own).first().category == "general"


def test_merge_ids(spark):
    df = rule_table(spark, rule(1), rule(2, example_bad="b"), rule(3, rule_score=0.9, common_pattern="p"))
    out = spark.createDataFrame([(1, 0, "x", "", 0.9, "c", "s", [2, 1, 77]), (1, 1, "y", "", 0.9, "c", "s", [1, 3]), (1, 2, "z", "", 0.9, "c", "s", [88])], "group_id long, out int, text string, reason string, confidence double, category string, scope string, source_rule_ids array<long>")
    got = {r.text: r for r in consolidate.merged(out, df).collect()}
    assert {k: r.rule_id for k, r in got.items()} == {"x": 1, "y": 3}
    assert got["x"].example_bad == "b" and got["y"].common_pattern == "p" and got["x"].source_prs == [1, 2]


def test_three_passes(spark):
    df = rule_table(spark, rule(1, text="Use tuples."), rule(2, text="use tuples", category="c"), rule(3, text="other"), rule(4, text="lone", category="d"), rule(5, text="close"), rule(6, text="closer"))
    comp = spark.createDataFrame([(5, 5), (6, 5), (1, 1)], "rule_id long, group_id long")
    out, log = consolidate.deduplicated(df.drop("group_id"), comp)
    assert sorted(r.rule_id for r in out.collect()) == [1, 3, 4, 5]
    assert sorted((r["pass"], list(r.merged_from)) for r in log.collect()) == [("category", [1, 2]), ("similarity", [5, 6])]


def test_placements(spark):
    df = spark.createDataFrame([(1, 0.6, "a", 0), (1, 0.6, "b", 1), (2, 0.7, "c", 2), (2, 0.6, "d", 3), (3, None, "e", 4)], "rule_id long, rule_score double, x string, ord long")
    assert sorted((r.rule_id, r.x) for r in placement.best_placement(df).collect()) == [(1, "a"), (2, "c"), (3, "e")]
    assert sorted((r.rule_id, r.x) for r in placement.last_placement(df).collect()) == [(1, "b"), (2, "d"), (3, "e")]
    assert placement.top_rules(df, 5).count() == 5
    assert {r.cutoff for r in placement.top_rules(df, 2).collect()} == {0.6}
    assert placement.at_least(df, 0.6).count() == 4
    assert next(r for r in placement.threshold_preview(df).collect() if r.threshold == 0.7).n_rules == 1


def loc(spark, counts):
    n = iter(range(10_000))
    return spark.createDataFrame([(place, next(n)) for place, k in counts.items() for _ in range(k)], "location string, rule_id long").withColumn("ord", F.col("rule_id"))


def test_rollup(spark):
    at = organize.organized(loc(spark, {"a": 4, "a/b": 3, "a/b/c": 1, "x/y": 2, "file:q.py": 1}))
    got = {}
    for r in organize.rolled_up(at).collect():
        got[r.location] = got.get(r.location, 0) + 1
    assert got == {"a": 8, "root": 2, "file:q.py": 1}


def test_topics(spark):
    at = loc(spark, {"a": 12, "b": 9})
    topics = at.select("location", F.when(F.col("rule_id") < 10, "big").otherwise("small").alias("topic_id"), "rule_id").unionByName(spark.createDataFrame([("a", "big", 999)], "location string, topic_id string, rule_id long"))
    got = organize.organized(at, topics).groupBy("location", "topic_id").count()
    assert rows(got.fillna("-")) == [("a", "-", 2), ("a", "big", 10), ("b", "-", 9)]


def test_render(spark):
    rl = organize.rolled_up(organize.organized(spark.createDataFrame([("root", 1, 1), ("root", 2, 2), ("root", 3, 3), ("root", 4, 4), ("file:a.py", 5, 5)], "location string, rule_id long, ord long")))
    info = spark.createDataFrame([(1, "testing"), (2, "testing"), (3, "config"), (4, None), (5, "x")], "rule_id long, category string")
    texts = spark.createDataFrame([(i, f"text {i}", "why") for i in (1, 2, 3, 5)], "rule_id long, rule_text string, rationale string")
    scores = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.1)], "rule_id long, rule_score double")
    [doc] = render.documents(rl, info, texts, scores).collect()
    assert doc.path == "AGENTS.md"
    line = lambda i: f"<!-- rule:{i} -->\n- text {i} — why"
    assert doc.text == "\n".join(["<!-- guidelines -->", "", "# Coding Guidelines", "", "## Testing", "", line(2), line(1), "", "## General", "", line(3), "", "## File-Specific Rules", "", "### `a.py`", "", line(5), "", "<!-- /guidelines -->"])


def test_topics_of_a_file_are_linked_from_nowhere(spark):
    at = loc(spark, {"a": 12, "file:a/b.py": 12})
    rl = organize.rolled_up(organize.organized(at, at.select("location", F.lit("t").alias("topic_id"), "rule_id")))
    ids = rl.select("rule_id").distinct()
    texts = ids.select("rule_id", F.lit("text").alias("rule_text"), F.lit("why").alias("rationale"))
    names = rl.select("location", "topic_id", F.lit("T").alias("topic_name"), F.lit("d").alias("topic_description"), F.lit("w").alias("trigger_description")).distinct()
    got = {r.path: r.text for r in render.documents(rl, ids.withColumn("category", F.lit("x")), texts, ids.withColumn("rule_score", F.lit(0.5)), names).collect()}
    assert sorted(got) == ["a/AGENTS.md", "a/agent_docs/t.md", "file:a/b.py/agent_docs/t.md"]
    assert got["a/AGENTS.md"].count("agent_docs/t.md") == 1


def test_provenance(spark):
    at = spark.createDataFrame([("b", 1, None), ("b", 1, "t"), ("c", 1, None)], "location string, rule_id long, topic_id string")
    assert rows(provenance.rule_locations(at)) == [(1, "b", None)]
    df = spark.createDataFrame([(i, "The Rule", i) for i in range(30)], "rule_id long, text string, ord long")
    assert [r.rule_id for r in provenance.search(df, "the r").collect()] == list(range(20))


def test_ledger(spark):
    s = spark.createDataFrame([(0, "extract", 0, None, None, None), (1, "place", 3, 5, "a", "a"), (2, "group", 5, 5, "a", "b"), (3, "generate", 1, None, None, "b")], "ord int, stage string, n_out long, n_expected long, stored_hash string, current_hash string")
    got = ledger.status(s)
    assert [r.status for r in got.orderBy("ord").collect()] == ["missing", "partial", "stale", "done"]
    assert ledger.next_stage(got).first().stage == "extract"
    a, b = spark.range(50).toDF("x"), spark.range(50).repartition(9).toDF("x")
    assert ledger.content_hash(a, "x").first() == ledger.content_hash(b, "x").first() != ledger.content_hash(a.limit(49), "x").first()
    assert str(ledger.total_cost(spark.createDataFrame([("0.1",), ("0.2",)], "cost string")).first().cost) == "0.300000"


def test_files(spark, tmp_path):
    d = tmp_path / "c"
    d.mkdir()
    (d / "2.json").write_text(json.dumps([{"id": 1, "user": {"login": "a"}, "body": "x"}]))
    (d / "10.json").write_text(json.dumps([{"id": 2}, {"id": 3, "in_reply_to_id": 2}]))
    got = files.comments(spark, str(d))
    assert [(r.id, r.pr_number) for r in got.orderBy("ord").collect()] == [(2, 10), (3, 10), (1, 2)]
    (d / "3.json").write_text("{broken")
    assert rows(files.count_items(spark, str(d))) == [("10.json", 2), ("2.json", 1), ("3.json", 0)]
    o = tmp_path / "o.jsonl"
    o.write_text('{"text": "a"}\n\n{"text": "b", "category": "typing"}\n')
    assert [(r.rule_id, r.category, r.explicit_category) for r in files.overrides(spark, str(o)).orderBy("ord").collect()] == [(-1, "general", False), (-3, "typing", True)]
    docs = spark.createDataFrame([("AGENTS.md", "é"), ("a/AGENTS.md", "y")], "path string, text string")
    assert files.write_documents(docs, str(tmp_path / "out")) == [("AGENTS.md", 2), ("a/AGENTS.md", 1)]
    assert (tmp_path / "out" / "a" / "AGENTS.md").read_text() == "y"
    assert ledger.file_hash(spark, [str(d / "2.json"), str(d / "10.json")]).first() == ledger.file_hash(spark, [str(d / "10.json"), str(d / "2.json")]).first()


def test_numbers(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 7 % 1009).repartition(6)
    got = {r.x: r.n for r in with_numbers(df, "x", "n").collect()}
    assert [got[x] for x in sorted(got)] == list(range(1000))
    assert with_numbers(df.limit(0), "x", "n").count() == 0


def test_cache(spark):
    calls = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "text string")

    def upper(pdf):
        calls.add(len(pdf))
        return pdf.assign(value=pdf["text"].fillna("").str.upper())

    note = annotate.batched(upper, "key string, text string, value string")
    out, cache = annotate.cached(df, "text", None, note, "value")
    assert sorted((r.text or "", r.value) for r in out.collect()) == [("", ""), ("a", "A"), ("a", "A"), ("b", "B")]
    assert calls.value == 3
    again, _ = annotate.cached(df.limit(1), "text", cache, note, "value")
    assert again.count() == 1 and calls.value == 3


def test_stages(spark):
    assert pipeline.stages_from("place", "group, nonsense") == ["place", "generate"]
    data = [(i, "a", None, f"Use tuples for constant tables please. Name test number {i % 2} well.", None) for i in range(1, 8)] + [(20, "b", None, "thanks", None), (21, "c", "Bot", "Use bots.", None)]
    df = talk(spark, *data).withColumn("pr_number", F.col("id") % 4).withColumn("ord", F.col("id"))
    out = pipeline.run(df)
    assert out["extract"].count() == 8 and out["extract"].where("is_actionable").count() == 7
    [doc] = out["generate"].collect()
    assert "Use tuples for constant tables please." in doc.text
    assert {len(r.source_file_patterns) for r in out["place"].collect()} <= set(range(6))
    o = pipeline.Options()
    pipeline.synthesize(out["extract"], o)
    assert o.unclustered.count() == 0


def test_stream(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "1.json").write_text(json.dumps([{"id": 1, "user": {"login": "a"}, "body": "Use x."}]))
    go = lambda: ingest.extract_stream(ingest.comment_stream(spark, str(d)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    go()
    (d / "2.json").write_text(json.dumps([{"id": 1, "user": {"login": "a"}, "body": "Use x."}, {"id": 2, "user": {"login": "b"}, "body": "Use y."}]))
    go()
    assert sorted(r.comment_id for r in spark.read.parquet(str(tmp_path / "out") + "/batch=*").collect()) == [1, 2]


def test_hash_of_joined_files(spark, tmp_path):
    import hashlib

    for name, data in (("b.json", b"two"), ("a.json", b"one"), ("c.json", b"")):
        (tmp_path / name).write_bytes(data)
    assert ledger.joined_hash(spark, [str(tmp_path / n) for n in ("c.json", "b.json", "a.json")]) == hashlib.sha256(b"onetwo").hexdigest()


def test_lines_in_file_order(spark, tmp_path):
    """Blocks are dealt to tasks by size; rows still come file by file, block by block."""
    (tmp_path / "in").mkdir()
    for name, n in (("a.jsonl", 4000), ("b.jsonl", 40), ("c.jsonl", 9000)):
        (tmp_path / "in" / name).write_text("\n".join(json.dumps({"rule_id": k, "text": f"{name} {k}", "adjusted_confidence": 0.5}) for k in range(n)) + "\n\nbroken\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        rows = files.rules(spark, str(tmp_path / "in")).orderBy("ord").select("text", "rule_score").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.text for r in rows] == [f"{name} {k}" for name, n in (("a.jsonl", 4000), ("b.jsonl", 40), ("c.jsonl", 9000)) for k in range(n)]
    assert {r.rule_score for r in rows} == {0.5}


def test_bounds(spark):
    df = spark.createDataFrame([(1, 0.0, "file", "x"), (2, 1.0, "file", "x"), (3, 1.1, "file", "x"), (4, None, "file", "x"), (5, 0.5, "nowhere", "x"), (6, 0.5, None, "x"), (7, 0.5, "file", " "), (8, float("nan"), "file", "x")], "id long, confidence double, kind string, text string")
    good, bad = annotate.checked(df, between={"confidence": (0.0, 1.0)}, among={"kind": annotate.PLACES}, filled=("text",))
    assert [r.id for r in good.collect()] == [1, 2] and bad.count() == 6


def test_consolidation_hook(spark):
    """A function may give several outputs a group; those out of bounds count as not given, their rules stay."""
    df = rule_table(spark, *[rule(i, text=f"t{i}", category="c", ord=i) for i in range(1, 6)], rule(9, text="alone", category="d", ord=9))
    comp = spark.createDataFrame([(i, 1) for i in range(1, 6)], "rule_id long, group_id long")
    asked = []

    def outputs(plain):
        asked.extend(r.prompt for r in consolidate.questions(plain).collect())
        rows = [(1, 0, "first", "", 0.9, "c", "s", [2, 1]), (1, 1, "second", "", 0.8, "c", "s", [1, 3]), (1, 2, "beyond", "", 1.5, "c", "s", [4]), (1, 3, " ", "", 0.5, "c", "s", [5])]
        return spark.createDataFrame(rows, "group_id long, out int, text string, reason string, confidence double, category string, scope string, source_rule_ids array<long>")

    out, log = consolidate.deduplicated(df.drop("group_id"), comp, lambda rules: consolidate.equal_texts(rules.limit(0)), outputs)
    assert {(r.rule_id, r.text) for r in out.collect()} == {(1, "first"), (3, "second"), (4, "t4"), (5, "t5"), (9, "alone")}
    assert log.count() == 2 and asked[0].startswith("## Consolidate Cluster of 5 Similar Rules") and "- **Rule ID 5**" in asked[0]


def test_caches_of_model_steps(spark):
    """Texts embedded and rules rephrased before are not asked about again; a changed rule is."""
    calls = spark.sparkContext.accumulator(0)
    data = [(i, "a", None, "Use tuples for constant tables please.", None) for i in range(1, 5)]
    raw = talk(spark, *data).withColumn("pr_number", F.col("id")).withColumn("ord", F.col("id"))

    def embed(df):
        seen = F.udf(lambda t: calls.add(1) or t)
        return annotate.embed_offline("text")(df.withColumn("text", seen("text")))

    def rephrase(df):
        assert "question" in df.columns
        return annotate.rephrase_offline(df)

    o = pipeline.Options(embed=embed, rephrase=rephrase)
    first = pipeline.run(raw, None, o)["generate"].collect()
    once = calls.value
    assert once and o.caches["rephrased"].count() == 1
    known = o.caches["rephrased"]
    o.rephrase = lambda df: annotate.rephrase_offline(df.where("false"))
    again = pipeline.run(raw, None, o)["generate"].collect()
    assert again == first and calls.value == once and annotate.new_entries(o.caches["rephrased"], known).count() == 0


def test_questions(spark):
    at = loc(spark, {"a": 12, "b": 3})
    info = at.select("rule_id", F.lit(0.5).alias("rule_score"), F.concat(F.lit("do "), F.col("rule_id").cast("string")).alias("rule_text"), F.lit("naming").alias("category"))
    [r] = organize.topic_questions(at, info).collect()
    assert r.location == "a" and "The following 12 rules" in r.prompt and "\nRule 3 (score=0.50):\n  do 3\n  Category: naming\n" in r.prompt


def test_stream_knows_threads(spark, tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    (d / "1.json").write_text(json.dumps([{"id": 1, "user": {"login": "a"}, "body": "Use x."}]))
    go = lambda: ingest.extract_stream(ingest.comment_stream(spark, str(d)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    go()
    (d / "2.json").write_text(json.dumps([{"id": 2, "user": {"login": "b"}, "body": "Use y.", "in_reply_to_id": 1}]))
    go()
    got = {r.comment_id: r.source.thread_context for r in spark.read.parquet(str(tmp_path / "out") + "/batch=*").collect()}
    assert got[2] == "[1] @a: Use x." and got[1] == "No prior thread context."


def test_offline_embedding_hashes_words_once(spark):
    """Words are no part of what is worked out for each of the dimensions."""
    rows = annotate.embed_offline("text")(spark.createDataFrame([("A b, a!",), (None,), ("",)], "text string"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and "filter(transform(" not in plan
    got = [r.embedding for r in rows.collect()]
    assert sorted(abs(v) for v in got[0] if v) == [1.0, 2.0] and len(got[0]) == 64 and got[1] == [None] * 64 and not any(got[2])


@pytest.mark.parametrize("threshold", [0.9, 0.5, -1.0])
def test_close_pairs_by_tiles(spark, monkeypatch, threshold):
    monkeypatch.setattr(vectors, "TILE", 7)
    x = around(np.random.default_rng(8), 5, 40, 0.3, 6)
    mean, block = x @ x.T, np.arange(40) % 2
    for lo, hi in ((0, 0), (0, 1)):
        of = np.flatnonzero((block == lo) | (block == hi))
        table = pa.table({"v": pa.array(x[of].tolist()), "b": block[of], "lo": np.full(len(of), lo), "hi": np.full(len(of), hi)})
        got = [(of[i], of[j]) for rows, others, _ in vectors.close(table, threshold) for i, j in zip(rows, others, strict=True)]
        want = {(i, j) for i in of for j in of if i < j and mean[i, j] >= threshold and (lo == hi or block[i] != block[j])}
        assert len(got) == len(want) and {(min(p), max(p)) for p in got} == want


def test_pairs_of_blocks_have_tasks_of_their_own(spark):
    rng = np.random.default_rng(5)
    data = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(60, 4)))], "vec_id long, embedding array<double>")
    pairs = vectors.cosine_pairs(data, -1.0, block=10)
    blocks = vectors.blocks_of(vectors.vectors_of(data, "vec_id", "embedding"), -1.0, 10).count
    assert pairs.count() == 60 * 59 // 2
    assert pairs.select(F.spark_partition_id().alias("p")).distinct().count() >= blocks * (blocks - 1) // 2


def test_joined_sets_are_components(spark):
    rng = np.random.default_rng(6)
    for n, m in ((1, 1), (50, 20), (50, 60), (400, 350)):
        edges = rng.integers(0, n, (m, 2))
        plain = np.arange(n)
        for _ in range(n):
            for a, b in edges:
                plain[[a, b]] = min(plain[a], plain[b])
        roots, left = np.arange(n), np.arange(n)
        forest = [vectors._join(roots, *part.T) for part in np.array_split(edges, 3)]
        gone, kept = (np.concatenate(x) for x in zip(*forest, strict=True))
        assert (roots == plain).all() and len(gone) == n - len(np.unique(plain))
        vectors._join(left, gone, kept)
        assert (left == plain).all()
    for share in (0.0, 0.001, 0.2, 1.0):
        flat = rng.random(1003) < share
        assert (vectors._true(flat) == np.flatnonzero(flat)).all()
