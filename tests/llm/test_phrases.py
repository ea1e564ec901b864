"""Collocations, spelling variants and URL filters against plain versions and SQL, on odd rows."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from rulelode.llm import collocations, registry, spelling, urls

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- collocations


def plain_collocations(docs, least=10, top=2000, subsumed=50):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for k in (1, 2, 3):
                counts[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, f in counts.items():
        kept = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            longer = [b for q, b in f.items() if len(q) > len(p) and b >= least and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= subsumed * a for b in longer):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd_docs():
    rng = random.Random(3)
    words = ["Net", "das", "Über", "a\u001cb", "ß", "x" * 70, "日本", "to", "be"]
    out = [(None, None), ("en", ""), ("en", " \t\n"), (None, "a b c. a b c"), ("", "solo"), ("en", ".,;")]
    for lang in ("en", None, "de", ""):
        for _ in range(25):
            out.append((lang, "".join(rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ". ", "\n", ",", "\r"]) for _ in range(rng.randint(1, 60)))))
    out += [("en", "same words here again")] * 40 + [("fr", "UN deux trois " * 900)]
    return out


def table(spark, docs):
    # Columns that clash with the operator's own names.
    return spark.createDataFrame([(i, lang, text, "p", 1, 2) for i, (lang, text) in enumerate(docs)], "doc_id long, lang string, text string, phrase string, f int, size int")


@pytest.mark.parametrize(("least", "top"), [(10, 2000), (3, 7)])
def test_collocations_are_the_plain_ones(spark, odd_docs, least, top):
    got = rows_of(collocations.collocations(table(spark, odd_docs), least, top))
    assert got == plain_collocations(odd_docs, least, top)
    assert len({r[0] for r in got}) >= 4


def test_collocations_in_short_stretches_and_narrow_sketches(spark, odd_docs, monkeypatch):
    """Stretches cut anywhere lose no phrase; a sketch that lets nearly all through changes no result."""
    want = plain_collocations(odd_docs)
    docs = table(spark, odd_docs)
    assert rows_of(collocations.collocations(docs.repartition(7), most_width=1 << 16)) == want
    import pyarrow as pa

    monkeypatch.setattr(collocations, "WORDS", 5)
    batch = pa.RecordBatch.from_pydict({"lang": [x or "und" for x, _ in odd_docs], "text": [x or "" for _, x in odd_docs]})
    seen = Counter()
    for p, tongue, names in collocations._stretches(batch):
        for k in range(3):
            for ws, n in zip(p.words[k].T.tolist(), p.counts[k].tolist(), strict=True):
                seen[names[tongue[ws[0]]], b" ".join(p.text(w) for w in ws).decode()] += n
    plain = Counter()
    for lang, text in odd_docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            plain.update((lang or "und", " ".join(ws[i : i + k])) for k in (1, 2, 3) for i in range(len(ws) - k + 1))
    assert seen == plain


def test_sketch_never_counts_too_little(spark, odd_docs):
    """Every phrase that is frequent by exact count gets through; most of those that are not do not."""
    docs = table(spark, odd_docs).selectExpr("coalesce(lang, 'und') lang", "coalesce(text, '') text")
    width = 1 << 16
    bits = collocations.sketch_bits(docs.repartition(5), width, 10)
    import pyarrow as pa

    hashes = defaultdict(lambda: [np.uint64(0), 0])
    for p, _, _ in collocations._stretches(pa.RecordBatch.from_pydict({"lang": ["und" if r[0] is None else r[0] for r in odd_docs], "text": [r[1] or "" for r in odd_docs]})):
        for h, c in zip(np.concatenate(p.hashes).tolist(), np.concatenate(p.counts).tolist(), strict=True):
            hashes[h][1] += c
    keys = np.array(list(hashes), np.uint64)
    real = np.array([v[1] for v in hashes.values()])
    through = collocations._through(bits, keys, width)
    assert through[real >= 10].all() and (real >= 10).sum() > 50
    assert through[real < 10].mean() < 0.1


def test_scores_beyond_64_bits(spark):
    n = 4_000_000_000_000
    counts = spark.createDataFrame([("en", 2, "a b", n), ("en", 1, "a", n + 1), ("en", 1, "b", 3 * n)], "lang string, size int, phrase string, f long")
    (row,) = collocations.scored(counts).collect()
    assert (row.l, row.r, row.score) == (n + 1, 3 * n, 1000000 * n * n // ((n + 1) * 3 * n))


def test_no_collocations(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []


# --- spelling variants


def plain_words(docs, least_length=6, least_count=5):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(docs):
    n = plain_words(docs)
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], form[w] and n[form[w]], root))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def odd_words():
    rng = random.Random(9)
    base = ["walking", "talking", "éàüßñ×÷", "aaaaaa", "aaaaaaa", "abababab", "Straßen", "zebras", "x" * 130, "y" * 95 + "abc", "ÀÉÎÕÜß"]
    words = []
    for w in base:
        words += [w] * rng.choice([6, 30, 200])
        for _ in range(12):
            i, c = rng.randrange(len(w)), rng.choice("aexyé")
            v = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :], w[:i] + c + w[i:]])
            words += [v] * rng.choice([1, 5, 7, 40, 900])
    chain = ["chainaaa", "chainaab", "chainabb", "chainbbb"]
    words += [w for w, k in zip(chain, (5, 26, 131, 700), strict=True) for _ in range(k)]
    rng.shuffle(words)
    docs = [(i, rng.choice([" ", "-", "1", "\n"]).join(words[i * 40 : i * 40 + 40])) for i in range(len(words) // 40 + 1)]
    return docs + [(None, None), (None, "walking Walking WALKING"), (-3, ""), (7, "short a bc"), (8, "same88same " * 50), (8, "same88same " * 50)]


def test_variants_are_the_plain_ones(spark, odd_words):
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in odd_words], "doc_id long, text string, n int, k string")
    got = rows_of(spelling.variants(docs).select("word", "n", "n_near", "form", "form_n", "root"))
    assert got == plain_variants(odd_words)
    assert any(r[5] == "chainbbb" and r[3] == "chainaab" for r in got)


def test_every_edit_falls_into_a_region(spark):
    """All words of one edit around a few, lengths around the cuts of regions, over a small alphabet: nothing is lost."""
    rng = random.Random(2)
    some = set()
    for size in (6, 7, 8, 9, 12, 95, 96, 97, 98, 129):
        w = "".join(rng.choice("abé") for _ in range(size))
        some |= {w} | spelling.edits(w, 0, "abé") | spelling.edits(w, 1, "abé") | spelling.edits(w, 2, "abé") if size < 20 else {w, w[:40] + w[41:], w + "a", "b" + w, w[:-1] + "z"}
    words = sorted(some)
    got = {(r.word, r.other) for r in spelling.near_pairs(spark.createDataFrame([(w, 5) for w in words], "word string, n long")).collect()}
    near = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            near[w[:i] + "*" + w[i + 1 :]].add(w)
    want = {(a, b) for ws in near.values() for a, b in itertools.permutations(ws, 2)}
    want |= {p for w in words for i in range(len(w)) if (v := w[:i] + w[i + 1 :]) in some for p in ((w, v), (v, w))}
    assert got == want and len(want) > 1000


def test_long_texts_without_words(spark):
    docs = spark.createDataFrame([(1, "letters " * 60000), (2, "1 2 3")], "doc_id long, text string")
    assert [(r.word, r.n) for r in spelling.variants(docs).collect()] == [(w, n) for w, n in plain_words([(1, "letters " * 60000)]).items()]
    assert spelling.variants(docs.limit(0)).collect() == []


# --- URL filters

ODD_URLS = [
    None, "", "no scheme.com/en/", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/1", "http://a.www.example.com/en/x", "http://xexample.com/en/1",
    "http://example.com/EN/1", "http://example.com/en", "http://example.com?x=/en/", "http://a.net/es/#y", "http://net/fr/?q", "http://x.org/a://b", "https://a.net:80/es/", "ftp://é.net/fr/é",
]


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host) :]).group()
    host = host.translate(LOWER)
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_fixed_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(ODD_URLS * 2)], "page_id long, url string, host string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages).collect()}
    assert len(got) == 2 * len(ODD_URLS)
    for i, u in enumerate(ODD_URLS * 2):
        host, path, rule, verdict = plain_rule(u)
        assert got[i][:3] == (host, path, rule)
        assert got[i][3] == verdict if rule else got[i][3] in ("allow", "block")


def test_mined_rules_are_all_rules(spark):
    """Supports and confidences of all combinations of up to three tokens, by listing them."""
    rng = random.Random(4)
    data = [([t for t in "abcdef" if rng.random() < 0.5], "block" if rng.random() < 0.4 else "allow") for _ in range(300)]
    data += [(["a", "b"], "block")] * 80
    rules = urls.mined_rules(spark.createDataFrame(data, "tokens array<string>, verdict string"), 0.02, 0.6)
    got = {(tuple(r["items"]), r.said): (r.freq, round(r.conf, 9)) for r in rules.collect()}
    want = {}
    for k in (1, 2, 3):
        for c in itertools.combinations("abcdef", k):
            of = [v for ts, v in data if set(c) <= set(ts)]
            for said in ("allow", "block"):
                n = of.count(said)
                if n >= 0.02 * len(data) and n / len(of) >= 0.6:
                    want[c, said] = (n, round(n / len(of), 9))
    assert got == want and len(want) > 10


def test_a_url_that_repeats_and_one_that_is_long(spark):
    long = "http://x.example.com/en/" + "/".join(f"s{i}" for i in range(400)) + "?" + "&".join(f"k{i}=1" for i in range(400))
    pages = [(i, long) for i in range(150)] + [(1000 + i, f"http://h{i}.example.net/en/{i}") for i in range(50)] + [(2000, "http://q.org/de/1"), (2001, None)]
    pages += [(3000 + i, f"http://z{i}.com/de/") for i in range(60)]
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judged(spark.createDataFrame(pages, "page_id long, url string")).collect()}
    assert len(got) == len(pages)
    assert got[0] == ("example.com/en/", "block") and got[1010] == (None, "block") and got[2001] == (None, "allow")


def test_no_pages_and_no_labels(spark):
    assert urls.judged(spark.createDataFrame([], "page_id long, url string")).collect() == []
    rows = urls.judged(spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x")], "page_id long, url string")).collect()
    assert [(r.rule, r.verdict, r.mined) for r in rows] == [(None, "allow", None)] * 2


def test_filter_without_python(spark):
    plan = urls.op13_url_filters(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Nested" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", ["op11_collocations", "op12_spelling_variants", "op13_url_filters"])
def test_query_is_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = registry.queries()[name](spark, SF)
    want = con.sql(registry.oracle_sql()[name])
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
