"""The stages, each on what the one before kept."""

from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from rulelode.llm import mixing, neardup, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        seen[name] = (before, docs)
        if i < 4:
            assert docs.columns == columns
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    before, after = seen["quality rules"]
    scores = quality.quality_scores(before, quality.fit(before, spark.read.parquet(f"{SF}/labels.parquet")))
    assert ids(after) == ids(scores.where("kept"))
    before, after = seen["MinHash near-dedup"]
    assert ids(after) == ids(neardup.components(before).where("doc_id = component_id"))
    before, after = seen["secret scans"]
    assert ids(before) == ids(after)
    text = {r.doc_id: r.text for r in after.collect()}
    for r in before.collect():
        if text[r.doc_id] != r.text:
            assert "[SECRET]" in text[r.doc_id]
        else:
            assert not re.search(r"[0-9a-f]{32}|AKIA[A-Z0-9]{12}", r.text)
    before, after = seen["mixing sources to target weights"]
    assert set(ids(after)) <= set(ids(before)) and after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    before, after = seen["packing"]
    assert after.where("start = 0").count() == before.count()
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0


def test_registry():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_near_stage_at_80_percent(spark):
    rng = random.Random(8)
    texts, sets = {}, {}
    for i in range(60):
        words = [str(rng.random()) for _ in range(104)]
        for k, tail in enumerate((0, 7, 10, 12, 14, 16)):
            texts[10 * i + k] = " ".join(words[: 104 - tail] + [str(rng.random()) for _ in range(tail)])
        # Only the first of these against one of the others, else they would link with one another.
        keep = 10 * i + rng.randint(1, 5)
        texts = {d: t for d, t in texts.items() if d // 10 < i or d in (10 * i, keep)}
    for d, t in texts.items():
        w = t.split()
        sets[d] = {tuple(w[a : a + 5]) for a in range(len(w) - 4)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["MinHash near-dedup"]
    kept = {}
    for percent, found in ((80, stage(spark, docs, SF)), (85, neardup.components(docs, neardup.PERCENT).where("doc_id = component_id"))):
        kept[percent] = [d for d in sorted(texts) if not any(a < d and 100 * len(sets[a] & sets[d]) >= percent * len(sets[a] | sets[d]) for a in texts)]
        assert sorted(r.doc_id for r in found.select("doc_id").collect()) == kept[percent]
    assert 60 < len(kept[80]) < len(kept[85]) < 120


def _folder(spark, tmp_path):
    """A folder with documents of all kinds, and labels: nulls, blanks, repeated rows, ties, clashing columns, a long text."""
    rng = random.Random(31)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(48))
    texts = {i: prose(rng.randint(60, 200)) for i in range(40)}
    texts |= {40: texts[3], 41: texts[3] + " tail", 42: None, 43: "", 44: " \n ", 45: "few words", 46: prose(70) + " password = hunter2hunter2 x " + key, 47: prose(9000), 48: texts[9].upper()}
    rows = [(i, t, ["en", None][i % 2], [None, "s1", "s2"][i % 3], len(t or ""), "own") for i, t in texts.items()] + [(5, texts[5], None, "s2", len(texts[5]), "own"), (None, prose(80), None, "s1", 1, "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    docs.write.parquet(str(tmp_path / "in/documents.parquet"))
    spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(48)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "in/labels.parquet"))
    return docs, str(tmp_path / "in"), key


def test_run_on_odd_rows(spark, tmp_path):
    """run() keeps what its stages keep; each stage against a plain version on rows of every kind."""
    docs, folder, key = _folder(spark, tmp_path)
    stages = dict(corpus_pipeline.STAGES)
    word = re.compile(r"[^\x20\x09-\x0D]+")

    kept = stages["quality rules"](spark, docs, folder)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert all(len(word.findall(r.text)) >= 50 for r in rows) and {r.doc_id for r in rows} >= {0, 3, 40, 41, 46, 47}

    found = stages["MinHash near-dedup"](spark, docs, folder).collect()
    sets = {}
    for r in docs.collect():
        w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        sets.setdefault(r.doc_id, {tuple(w[a : a + 5]) for a in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    alike = lambda a, b: a != b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    want = sorted([i for i in sets if i is not None and not any(j is not None and j < i and alike(i, j) for j in sets)])
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == want and sum(r.doc_id is None for r in found) == 1
    assert {r.kept for r in found} == {"own"}

    clean = {r.doc_id: r for r in stages["secret scans"](spark, docs.where("doc_id is not null"), folder).collect()}
    for r in docs.where("doc_id is not null and doc_id <> 46").collect():
        assert clean[r.doc_id].text == r.text and clean[r.doc_id].n_chars == r.n_chars
    told = next(r.text for r in docs.collect() if r.doc_id == 46)
    assert clean[46].text == told.replace("password = hunter2hunter2", "[SECRET]").replace(key, "[SECRET]") and clean[46].n_chars == len(clean[46].text)

    taken = stages["mixing sources to target weights"](spark, docs, folder).collect()
    size = {}
    for r in docs.collect():
        size.setdefault(r.source, 0)
        size[r.source] += len(word.findall(r.text or ""))
    names = ["s1", "s2", None]
    goal = dict(zip(names, mixing.targets([size[n] for n in names]), strict=True))
    longest = {n: max(len(word.findall(r.text or "")) for r in docs.collect() if r.source == n) for n in names}
    for n in names:
        got = sum(len(word.findall(r.text)) for r in taken if r.source == n)
        assert abs(got - goal[n]) <= min(longest[n], 9000)
    assert max(Counter((r.doc_id, r.text) for r in taken).values()) <= 6 and not any(r.doc_id in (42, 43, 44) for r in taken)

    out = corpus_pipeline.run(spark, folder)
    pieces = out.collect()
    assert pieces and {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(out.columns)
    assert {r.doc_id for r in pieces} <= {r.doc_id for r in rows} - {40, 41}
    places: dict = {}
    for r in pieces:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 1024
