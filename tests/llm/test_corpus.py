"""Each operator against a plain version, on rows with nulls, empty and long texts, ties, repeats and odd columns."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rulelode.llm import _text as tx
from rulelode.llm import embeddup, langid, licenses, mixing, neardup, packing, quality, repeats, secrets, toxicity

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def word(rng):
    return "".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 9)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def texts():
    """doc_id -> text: copies, near copies, shared passages, nulls, blanks, a long text."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(30, 120)) for _ in range(25)]
    passage = prose(rng, 60)
    out = list(base) + [base[0], base[0], base[1], None, "", " \t\n ", "one", "One", "a b c d", "A B C D", "x " * 400, "y" * 900]
    for b in base[:10]:
        w = b.split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
        w[3] = "again"
        out.append(" ".join(w).upper())
    out += [prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 20) for _ in range(6)] + [passage + passage, prose(rng, 6000)]
    return dict(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", "fr", None][i % 3], [None, "s1", "s2", "s3"][i % 4], len(t or "")) for i, t in texts.items()]
    return spark.createDataFrame(rows, DOCS).withColumns({"rk": F.lit("clash"), "h": F.lit(1), "count": F.lit(2), "_size": F.lit(3)}).repartition(5)


def empty(spark):
    return spark.createDataFrame([], DOCS)


# Kernels


def test_keys_are_of_content():
    buf = np.frombuffer(b"abcabcxabc", np.uint8)
    for h in tx.word_keys(buf, np.array([0, 3, 7, 0, 0]), np.array([3, 6, 10, 2, 0])):
        assert h[0] == h[1] == h[2] != h[3] and h[4] != h[3]


def test_words_and_shingles(texts):
    column = pa.array(list(texts.values()), pa.string())
    buf, offs = tx.buffers(column)
    start, end, first = tx.words(buf, offs)
    for r, t in enumerate(texts.values()):
        got = [buf[a:b].tobytes().decode() for a, b in zip(start[first[r] : first[r + 1]], end[first[r] : first[r + 1]], strict=True)]
        assert got == SPACE.findall(t or "")
    h, g, at = tx.shingles(buf, offs)
    assert [len(tx.members(h[at[r] : at[r + 1]], g[at[r] : at[r + 1]])[0]) for r in range(len(texts))] == [len(shingle_set(t)) for t in texts.values()]


@pytest.mark.parametrize("part", [1, 3, 64])
def test_kernels_walk_long_buffers_in_parts(texts, monkeypatch, part):
    buf, offs = tx.buffers(pa.array([t and t[:400] for t in texts.values()], pa.string()))
    whole = (*tx.words(buf, offs), *tx.shingles(buf, offs))
    heads = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    monkeypatch.setattr(tx, "PART", part)
    assert all((a == b).all() for a, b in zip(whole, (*tx.words(buf, offs), *tx.shingles(buf, offs)), strict=True))
    places = np.arange(0, len(buf) + 1, 7)
    assert (tx.code_points(buf, places) == heads[places]).all()
    stats = quality.statistics(buf, offs)
    monkeypatch.undo()
    assert all((stats[k] == v).all() for k, v in quality.statistics(buf, offs).items())


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


#: Every polynomial hash modulo a power of two gives these two the same value.
TWINS = (thue_morse(1024), thue_morse(1024).translate(str.maketrans("ab", "ba")))


def test_strings_are_told_apart_by_their_bytes(monkeypatch):
    rng = random.Random(8)
    rows = [*TWINS, "x" * 40, "x" * 41, "ab", "ab\0", "ab", *(word(rng) for _ in range(50))]
    raw = [r.encode() for r in rows]
    end = np.cumsum([len(r) for r in raw])
    buf, start = np.frombuffer(b"".join(raw), np.uint8), end - [len(r) for r in raw]
    for worst in (False, True):
        if worst:  # every key is the same
            monkeypatch.setattr(tx, "mix", lambda h: h * np.uint64(0))
            monkeypatch.setattr(tx, "digests", lambda raw, s, e: np.zeros((len(s), 2), np.uint64))
        first, number = tx.distinct(buf, start, end)
        assert len(first) == len(set(raw)) and {raw[i]: n for i, n in enumerate(number.tolist())} == {raw[i]: number[raw.index(r)] for i, r in enumerate(raw)}
    h, g = np.array([1, 1, 2, 1], np.uint64), np.array([5, 6, 5, 5], np.uint64)
    assert tx.numbered(h, g).tolist() == [0, 1, 2, 0] and len(tx.members(h, g)[0]) == 3


def test_colliding_texts_stay_apart(spark):
    a, b = TWINS
    df = spark.createDataFrame([(1, a), (2, b), (3, f"{a}\n{b}"), (4, f"{b} " * 3)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.components(df, 85).collect()} == {1: 1, 2: 2, 3: 3, 4: 4}
    assert {r.doc_id: (r.n_dup_lines, r.n_repeat_words) for r in quality.quality_scores(df, None).collect()} == {1: (0, 0), 2: (0, 0), 3: (0, 0), 4: (0, 0)}
    enc = packing.encoder(packing.default_tokenizer())
    want = {i: len(enc.tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in df.collect()}
    assert {r.doc_id: r.doc_tokens for r in packing.cut_pieces(df, packing.default_tokenizer()).collect()} == want
    assert {r.doc_id: r.n_removed for r in repeats.remove_repeats(df, "none").collect()} == {k: v[1] for k, v in plain_repeats([tuple(r) for r in df.collect()], "none").items()}


# 1


def plain_repeats(rows, keep, n=200):
    seen, out = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        for s in range(len(b) - n + 1):
            seen.setdefault(b[s : s + n], []).append((i, s))
    for i, t in rows:
        b = (t or "").encode()
        hit = np.zeros(len(b), bool)
        for s in range(len(b) - n + 1):
            where = seen[b[s : s + n]]
            if len(where) > 1 if keep == "none" else where[0] != (i, s):
                hit[s : s + n] = True
        edges = int((hit & ~np.concatenate([[False], hit[:-1]])).sum()) if len(b) else 0
        out[i] = (len(b), int(hit.sum()), edges, hashlib.sha256(np.frombuffer(b, np.uint8)[~hit].tobytes()).hexdigest())
    return out


@pytest.mark.parametrize("keep", ["none", "first"])
def test_repeats(spark, docs, texts, keep):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.s) for r in repeats.remove_repeats(docs, keep).withColumn("s", F.sha2("kept", 256)).collect()}
    assert got == plain_repeats(list(texts.items()), keep)
    assert sum(v[1] for v in got.values()) > 3000


def test_repeats_in_blocks(docs, texts, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", 2)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove_repeats(docs, "none").collect()}
    assert got == {k: v[:3] for k, v in plain_repeats(list(texts.items()), "none").items()}


def test_repeats_edges(spark):
    assert repeats.remove_repeats(empty(spark), "none").count() == 0
    same = spark.createDataFrame([(1, "q" * 250), (1, "q" * 250), (None, "z" * 199)], "doc_id long, text string")
    assert sorted((r.n_bytes, r.n_removed) for r in repeats.remove_repeats(same, "none").collect()) == [(199, 0), (250, 250), (250, 250)]


def test_suffix_ranks():
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 99, 300).astype(np.uint8)
    rank = repeats.suffix_ranks(buf, 20)
    b = buf.tobytes() + b"\0" * 20
    for i in range(0, 280, 7):
        for j in range(0, 280, 11):
            x, y = b[i : i + 20], b[j : j + 20]
            assert (rank[i] < rank[j], rank[i] == rank[j]) == (x < y, x == y)
    earlier, other = repeats.previous_factors(np.array([3, 1, 3, 2, 1, 3]), np.array([5, 4, 3, 2, 1, 0]))
    assert (earlier // repeats.LENGTH).tolist() == [1, 1, 1, 0, 0, 0] and (other // repeats.LENGTH).tolist() == [1, 1, 1, 0, 1, 1]


def test_repeats_in_strips(spark, monkeypatch):
    rng = random.Random(12)
    passage = prose(rng, 80)
    rows = [(1, prose(rng, 900) + passage + prose(rng, 900) + passage), (2, passage + prose(rng, 300)), (None, passage), (7, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for strip in (repeats.STRIP, 700):
        monkeypatch.setattr(repeats, "STRIP", strip)
        for part in (1 << 20, 1):
            monkeypatch.setattr(tx.pieces, "__defaults__", (part,))
            for keep in ("none", "first"):
                got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove_repeats(df, keep).collect()}
                want = plain_repeats([(99 if i is None else i, t) for i, t in rows], keep)
                assert got == {None if k == 99 else k: v[:3] for k, v in want.items()}


# 2


def shingle_set(t):
    w = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def plain_links(sets, percent=85):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for n, i in enumerate(keys):
        for j in keys[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_near_duplicates(docs, texts, monkeypatch):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    want = {i: (len(sets[i]), c) for i, c in plain_links(sets).items()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.components(docs).collect()}
    assert got == want
    kept = sorted(r.doc_id for r in neardup.deduplicate(docs).collect())
    assert kept == sorted(i for i, c in want.items() if c[1] == i)
    assert neardup.deduplicate(docs).columns == docs.columns
    monkeypatch.setattr(neardup, "CROWD", 1)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.components(docs).collect()} == want
    monkeypatch.setattr(neardup, "GROUP_SHINGLES", 60)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.components(docs).collect()} == want


def test_near_duplicates_edges(spark):
    assert neardup.components(empty(spark)).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (None, "alone here"), (7, None), (8, "")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in neardup.components(df).collect()), key=str)
    assert got == sorted([(None, 4), (4, 4), (4, 4), (None, None), (7, 7), (8, 8)], key=str)
    assert sorted((r.text or "") for r in neardup.deduplicate(df).collect()) == ["", "", "a b c d e f", "alone here"]


def test_sketch_estimates():
    rng = np.random.default_rng(2)
    for share in (0.5, 0.85, 0.95):
        common, n = rng.integers(0, 1 << 63, 3000).astype(np.uint64), int(3000 * (1 - share) / share / 2)
        got = []
        for _ in range(12):
            a = np.concatenate([common, rng.integers(0, 1 << 63, n).astype(np.uint64)])
            b = np.concatenate([common, rng.integers(0, 1 << 63, n).astype(np.uint64)])
            got.append(neardup.estimate(neardup.registers(a), len(a), neardup.registers(b)[None], np.array([len(b)]))[0][0])
        assert abs(np.mean(got) - share) < 0.08


def test_link_components_exact():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.choice(40, rng.integers(3, 40), replace=False)) for _ in range(60)]
    sets += [s[:-1] for s in sets if len(s) > 8]
    want = plain_links({i: set(s.tolist()) for i, s in enumerate(sets)})
    assert neardup.link_components([(s.astype(np.uint64), s.astype(np.uint64) * np.uint64(3)) for s in sets]).tolist() == [want[i] for i in range(len(sets))]


def test_shared_members():
    h, g = np.array([1, 1, 2, 5], np.uint64), np.array([5, 6, 5, 5], np.uint64)
    assert tx.common((h, g), (h[1:], g[1:])) == 3 and tx.common((h[2:], g[2:]), (h, g)) == 2 and tx.common((h[:0], g[:0]), (h, g)) == 0
    assert tx.common((h[1:], g[1:]), (h[:1], g[:1])) == 0


def test_links_from_known_parts():
    """Parts found before and sets asked about give the same components, if every set outside the largest part asks."""
    rng = np.random.default_rng(14)
    sets = [np.unique(rng.choice(30, rng.integers(3, 30), replace=False)) for _ in range(50)]
    want = plain_links({i: set(s.tolist()) for i, s in enumerate(sets)}, 60)
    pairs = [(s.astype(np.uint64), s.astype(np.uint64)) for s in sets]
    known = np.array([want[i] if rng.random() < 0.6 else 1000 + i for i in range(50)])
    kinds, counts = np.unique(known, return_counts=True)
    got = neardup.link_components(pairs, 60, known, known != kinds[counts.argmax()])
    same = lambda x: {tuple(np.flatnonzero(np.array(x) == c)) for c in set(x)}
    assert same(got.tolist()) == same([want[i] for i in range(50)])


def test_groups_in_blocks(spark, monkeypatch):
    """Families whose candidate edges join them in part only, in stars and groups of many blocks."""
    rng = random.Random(77)
    texts = {}
    for family in range(6):
        w = [word(rng) for _ in range(90)]
        for k in range(14):
            own = list(w)
            for at in rng.sample(range(90), rng.choice([0, 1, 2, 3, 4])):
                own[at] = word(rng)
            texts[100 * family + k] = " ".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = plain_links({i: shingle_set(t) for i, t in texts.items()}, 70)
    assert 6 < len(set(want.values())) < 80
    for group, star in ((neardup.GROUP_SHINGLES, neardup.STAR_SHINGLES), (200, 100)):
        monkeypatch.setattr(neardup, "GROUP_SHINGLES", group)
        monkeypatch.setattr(neardup, "STAR_SHINGLES", star)
        assert {r.doc_id: r.component_id for r in neardup.components(df, 70).collect()} == want


def test_crowded_bands(spark, docs, texts):
    """On either side of the number of sets at which a band is crowded, and in blocks of it."""
    want = {r.doc_id: r.component_id for r in neardup.components(docs, 85).collect()}
    for crowd in (1, 2, 3):
        assert {r.doc_id: r.component_id for r in neardup.components(docs, 85, crowd).collect()} == want


# 3

BASE = (
    ("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


def plain_spans(t):
    out = []
    for k, (name, rx, group, least) in enumerate(BASE):
        out += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in rx.finditer(t or "") if len(m[group]) >= least]
    return ",".join(x[2] for x in sorted(out))


def test_secrets(spark):
    rng = random.Random(1)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(44))
    data = ['é password = "hunter2hunter2" x', "API_KEY:short", "apikey='a.b-c_d=e/f+g'", "ſecret: longenough1", "toKen==xxxxxxxxxx", "AKIA" + "B7" * 8, "AKIA123 AKIAAKIAAKIAAKIA", "0f" * 16, "0f" * 15, "g" + "ab" * 40 + "h", f"see {key} there", "abcdefghijklmnopqrstuvwxyz12", "1111111111aaaaaaaaaa1111111111", None, "", "token: " + "a" * 8, "passwd:secret:abcdefgh", "token = \n abcdefghij"]
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    found = secrets.candidates(df)
    got = {r.doc_id: (r.base, r.base_sha256) for r in found.collect()}
    for i, t in enumerate(data):
        spans = ",".join(f"{secrets.KINDS[b.kind]}:{b.start}:{b.end}" for b in got[i][0])
        assert spans == plain_spans(t), t
        assert got[i][1] == hashlib.sha256(spans.encode()).hexdigest()
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.scan(df).collect()}
    assert (3, 4, 48) in spans[10] and not spans[12]
    assert {r.doc_id: r.text for r in secrets.redact(df).collect()}[10] == "see [SECRET] there"
    assert {r.doc_id: r.text for r in secrets.redact(df).collect()}[13] is None
    assert secrets.scan(empty(spark)).count() == 0 == secrets.redact(empty(spark)).count()


def test_secrets_inside_longer_runs(spark):
    rng = random.Random(6)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = ["".join(rng.choice(chars) for _ in range(40)) for _ in range(7)]
    data = [f"AWS_SECRET_ACCESS_KEY={key[0]}", f"export AUTH_KEY={key[1]} now", f"/var/my-app/some_dir/{key[2]}/x-y", f"KEY_A={key[3]}==", f"A_B={key[4]}=C_D={key[5]}", f"some_dir+my/a-b/x_{key[6]}", "NAME_OF_IT=plain_words_only_in_here", "a_b-wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLE5EY"]
    where = [(i, data[i].index(k), data[i].index(k) + 40 + 2 * (k == key[3])) for i, k in zip((0, 1, 2, 3, 4, 4, 5), key, strict=True)]
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    got = {(r.doc_id, s.start, s.end) for r in secrets.scan(df).collect() for s in r.spans}
    assert set(where) <= got and (7, 4, 44) in got and not [x for x in got if x[0] == 6]
    texts = " ".join(r.text for r in secrets.redact(df).collect())
    assert not any(k in texts for k in key)


def test_randomness():
    rng = random.Random(8)
    tokens = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(300)]
    p = np.array([secrets.p_value(t.encode(), "hex") for t in tokens])
    assert (p < 0.01).mean() < 0.03
    # Nominal far into the tail, where discovery control decides, whatever the length and the encoding.
    draw = np.random.default_rng(9)
    for n, name in itertools.product((20, 32, 64, 200), ("hex", "base62")):
        chars = np.frombuffer(secrets.ENCODINGS[name], np.uint8)
        p = np.array([secrets.p_value(chars[draw.integers(0, len(chars), n)].tobytes(), name) for _ in range(4000)])
        assert (p < 0.01).mean() < 0.015 and (p < 0.001).mean() < 0.0025 and (p < 0.0001).mean() <= 0.0005
    assert secrets.p_value(b"0123456789abcdef0123456789abcdef", "hex") < 1e-3 or secrets.p_value(b"00000000001111111111222222222233", "hex") < 1e-6
    assert secrets.infer_encoding(b"deadbeef00") == "hex" and secrets.infer_encoding(b"onlyletters") is None and secrets.infer_encoding(b"aB3+/x==") == "base64"


def plain_p(token, name):
    """The battery by counting: pairs of equal symbols and runs by simulation, the serial test by its formula."""
    chars = secrets.ENCODINGS[name].decode()
    v = np.array([chars.index(c) for c in token.rstrip("=")])
    n, k = len(v), len(chars)
    pairs = lambda x: sum(c * (c - 1) // 2 for c in Counter(x.tolist()).values())
    draw = np.random.default_rng(2).integers(0, k, (20_000, n))
    same = np.sort(draw, 1)
    size = np.zeros(len(draw), int)
    streak = np.zeros(len(draw), int)
    for i in range(1, n):
        streak = np.where(same[:, i] == same[:, i - 1], streak + 1, 0)
        size += streak
    uniform = (size >= pairs(v)).mean()
    c = v - (k - 1) / 2
    z = abs((c[1:] * c[:-1]).sum()) / ((k * k - 1) / 12 * math.sqrt(n - 1))
    z -= 5.04 / n / 24 * (z**3 - 3 * z)
    return uniform, math.erfc(z / math.sqrt(2))


def test_battery_against_simulation():
    rng = random.Random(17)
    for name in ("hex", "base62"):
        chars = secrets.ENCODINGS[name].decode()
        for n in (20, 45):
            for skew in (1, 2):
                token = "".join(chars[int(len(chars) * rng.random() ** skew)] for _ in range(n))
                v = secrets._VALUES[name][np.frombuffer(token.encode(), np.uint8)]
                uniform, serial = plain_p(token, name)
                assert secrets._p_uniform(np.bincount(v, minlength=len(chars)), n, len(chars)) == pytest.approx(uniform, abs=0.02)
                assert secrets._p_serial(v, len(chars)) == pytest.approx(serial, abs=1e-9)
    # Runs against every order of a few signs.
    for a, b in ((2, 3), (4, 4), (1, 6)):
        seen = Counter(1 + sum(x != y for x, y in itertools.pairwise(p)) for p in itertools.permutations([1] * a + [0] * b))
        total = sum(seen.values())
        odds = secrets._run_odds(a, b)
        assert all(odds[r] == pytest.approx(seen[r] / total) for r in range(len(odds)))


def test_planted_keys_among_ordinary_tokens(spark):
    """Random keys are found; of ordinary tokens a known share is, which is what the tests' power leaves."""
    rng = random.Random(23)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    parts = ["user", "account", "list", "backup", "final", "report", "config", "session", "handler", "table", "index", "daily"]
    keys = ["".join(rng.choice(chars) for _ in range(rng.randint(32, 64))) for _ in range(300)]
    plain = ["_".join(rng.choice(parts) for _ in range(6)) + f"_{rng.randint(1, 99):04d}" for _ in range(150)] + ["".join(rng.choice(parts).title() for _ in range(7)) + str(rng.randint(1, 9)) for _ in range(150)]
    rows = list(enumerate(f"see {x} there" for x in keys + plain))
    found = {r.doc_id: len(r.spans) for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(bool(found[i]) for i in range(300)) >= 294
    assert sum(bool(found[i]) for i in range(300, 600)) <= 150


# 4


def test_embeddings(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((150, 16))
    x[50:100] = x[:50] + 0.1 * rng.standard_normal((50, 16))
    x[100:110] = x[0]
    x[110:120] = 2 * x[1]
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32).astype(float))] + [(200, None), (201, []), (202, [0.0] * 16), (203, [float("nan")] * 16), (204, [None] + [1.0] * 15), (205, [float("inf")] + [0.0] * 15), (206, [1.0, 2.0]), (207, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("label", F.lit("x"))
    y = np.stack([np.array(v) for _, v in rows[:150]])
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    link = y @ y.T >= 0.95
    np.fill_diagonal(link, False)
    sets = {i: set(np.flatnonzero(link[i]).tolist()) for i in range(150)}
    comp = {}
    for i in range(150):
        todo, seen = [i], {i}
        while todo:
            for j in sets[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        comp[i] = min(seen)
    want = {i: (len(sets[i]), comp[i]) for i in range(150)} | {i: (0, i) for i in range(200, 206)} | {206: (1, 206), 207: (1, 206)}
    assert {r.vec_id: (r.n_links, r.component_id) for r in embeddup.near_duplicates(df).collect()} == want
    monkeypatch.setattr(embeddup, "BUCKET", 3)
    assert {r.vec_id: (r.n_links, r.component_id) for r in embeddup.near_duplicates(df).collect()} == want
    assert embeddup.near_duplicates(df.limit(0)).count() == 0


def test_recall_at_the_threshold(spark):
    """Links of thousands of vectors, many of them hardly over the threshold, against all cosines."""
    rng = np.random.default_rng(12)
    base = rng.standard_normal((500, 48))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = [base]
    for cosine in (0.951, 0.96, 0.98, 0.949, 0.9):
        side = rng.standard_normal(base.shape)
        side -= (side * base).sum(1, keepdims=True) * base
        side /= np.linalg.norm(side, axis=1, keepdims=True)
        rows.append(cosine * base + math.sqrt(1 - cosine**2) * side)
    x = np.concatenate(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = np.zeros(len(x), int)
    for r in embeddup.near_duplicates(df).collect():
        got[r.vec_id] = r.n_links
    want = (x @ x.T >= 0.95).sum(1) - 1
    assert (got <= want).all() and got.sum() >= 0.999 * want.sum()


def test_signs_do_not_depend_on_the_batch():
    rng = np.random.default_rng(3)
    x = embeddup.unit(rng.standard_normal((400, 64)).ravel(), 64)
    x[7] = 0
    whole = embeddup.signatures(x, 20, 30)
    for part in (1, 3, 100):
        assert (np.concatenate([embeddup.signatures(x[lo : lo + part], 20, 30) for lo in range(0, 400, part)]) == whole).all()


# 5


def dice(text, template, least=licenses.THRESHOLD):
    """Best coefficient of a whole text or a stretch, by string pairs; stretches as the operator's docstring has them."""

    def grams(s):
        w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", s.lower())
        return list(zip(w, w[1:], strict=False)), len(w)

    b, n = grams(template)
    own, _ = grams(text)
    kinds = set(b)
    best = 2 * len(set(own) & kinds) / (len(set(own)) + len(kinds)) if own else 0.0
    for i in (i for i, g in enumerate(own) if g in kinds):
        for span in (n - 1, int(len(kinds) * (2 - least) / least)):
            end = max(j for j in range(i, min(i + span, len(own))) if own[j] in kinds)
            some = set(own[i : end + 1])
            best = max(best, 2 * len(some & kinds) / (len(some) + len(kinds)))
    return best


def test_licenses(spark):
    rng = random.Random(2)
    apache = licenses.TEMPLATES[15][1]
    words = apache.split()
    data = [prose(rng, 50) + "\n" + t + "\n" + prose(rng, 9) for _, t in licenses.TEMPLATES] + [apache.upper(), " ".join(words[:30] + ["odd"] + words[31:]), "licensed under the license of the under", None, "", "mit", " ".join(words[: len(words) // 2])]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")).collect()}
    for i, t in enumerate(data):
        want = max(dice(t or "", template) for _, template in licenses.TEMPLATES)
        assert (got[i].dice if got[i].license else 0) == pytest.approx(want if want >= licenses.THRESHOLD else 0), data[i]
        if i < len(licenses.TEMPLATES):
            assert got[i].license == licenses.TEMPLATES[i][0]
    assert licenses.scan(empty(spark)).count() == 0


def test_overlaps_and_long_texts(spark, monkeypatch, tmp_path):
    found = [(0, 5, 1, 0.9), (4, 9, 0, 0.9), (5, 9, 2, 0.8), (9, 12, 3, 0.95), (0, 5, 0, 0.9)]
    assert licenses.apart(found) == [(0, 5, 0, 0.9), (5, 9, 2, 0.8), (9, 12, 3, 0.95)]
    long = " ".join([licenses.TEMPLATES[15][1]] * 60)
    monkeypatch.setattr(tx, "PART", 50)
    got = licenses.scan(spark.createDataFrame([(1, long), (1, long)], "doc_id long, text string")).collect()
    assert [r.n_matches for r in got] == [60, 60] and all(r.dice == 1 for r in got)
    (tmp_path / "Own-1.0.txt").write_text("Some own licence text of\nseveral words and lines.")
    more = licenses.read_templates(spark, str(tmp_path))
    assert more == (("Own-1.0", "Some own licence text of\nseveral words and lines."),)
    own = spark.createDataFrame([(1, "x some OWN licence text of several words and lines")], "doc_id long, text string")
    assert [r.license for r in licenses.scan(own, licenses.TEMPLATES + more).collect()] == ["Own-1.0"]


def test_license_headers(spark):
    rng = random.Random(3)
    gnu = "This {s} is free software{c} you can redistribute it and/or modify it under the terms of the GNU {n} as published by the Free Software Foundation{d} either version {v} of the License, or (at your option) any later version."
    cases = [
        ("GPL-2.0-or-later", gnu.format(s="program", c=";", n="General Public License", d=";", v="2")),
        ("GPL-3.0-or-later", gnu.format(s="program", c=":", n="General Public License", d=",", v="3")),
        ("AGPL-3.0-or-later", gnu.format(s="program", c=":", n="Affero General Public License", d=",", v="3")),
        ("LGPL-2.1-or-later", gnu.format(s="library", c=";", n="Lesser General Public License", d=";", v="2.1")),
        ("LGPL-3.0-or-later", gnu.format(s="library", c=":", n="Lesser General Public License", d=",", v="3")),
        ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License."),
        ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
        ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS"),
    ]
    holder = "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    cases.append(("BSD-3-Clause", cases[-1][1].replace("THIS SOFTWARE", "3. " + holder + " THIS SOFTWARE")))
    data = [(i, prose(rng, 30) + "\n" + t + "\n" + prose(rng, 30)) for i, (_, t) in enumerate(cases)]
    got = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(cases))] == [n for n, _ in cases]


# 6


def plain_quality(t):
    w = SPACE.findall(t or "")
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    rep = {k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(rep)


def test_quality(spark, texts):
    data = dict(texts) | {100: "a b c a b c a\nx\nx\n \n \nx", 101: "# é | <b>\n\n&\n&", 102: "same same same same " * 30}
    df = spark.createDataFrame(list(data.items()), "doc_id long, text string")
    got = quality.quality_scores(df, None).collect()
    for r in got:
        want = plain_quality(data[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)
    assert sorted(r.doc_id for r in quality.quality_filter(df, None).collect()) == sorted(r.doc_id for r in got if r.kept)
    assert quality.quality_scores(empty(spark), None).count() == 0


def test_forest(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    forest = quality.fit(docs, labels)
    rows = quality.quality_scores(docs, forest).join(labels, "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.35
    assert quality.fit(docs, labels.limit(0)) is None


def test_forest_on_unseen_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    unseen = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) == 0
    forest = quality.fit(docs, labels.where(~unseen))
    rows = quality.quality_scores(docs, forest).join(labels.where(unseen), "doc_id").where("not base_failed").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.35


def test_forest_of_all_labels(spark):
    docs = spark.range(7000).select(F.col("id").alias("doc_id"), F.concat(F.lit("Words of a text. "), F.repeat(F.concat(F.lit(" w"), F.col("id")), 3), F.expr("array_join(transform(sequence(1, 60), i -> concat('x', i * (id % 97 + 3))), ' ')")).alias("text"))
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 50 == 0, F.concat("text", F.expr("array_join(transform(sequence(1, 40), i -> concat(' #$', i)), '')"))).otherwise(F.col("text")))
    labels = docs.select("doc_id", (F.col("doc_id") % 50 != 0).cast("int").alias("quality"))
    assert quality.fit(docs, labels).rows == quality.labelled(docs, labels).count() > 6000


def test_labels_meet_counts_and_no_texts(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    plans = []
    monkeypatch.setattr(quality, "with_numbers", lambda rows, *_: plans.append(spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")) or rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        quality.labelled(docs, labels)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", plans[0])
    assert len(dealt) > 1 and not any(re.search(r"\btext#", x) for x in dealt)


def test_threshold_in_a_table(spark):
    rng = np.random.default_rng(11)
    for good, bad in ((np.round(rng.normal(0.4, 0.05, 900), 3), np.round(rng.normal(0.5, 0.05, 60), 3)), (rng.random(30), rng.random(5)), (np.full(20, 0.5), np.full(3, 0.4))):
        class Scores:
            threshold = np.inf
            score = staticmethod(lambda x: x)

        rows = [(i, int(i < len(good)), float(v)) for i, v in enumerate(np.concatenate([good, bad]))]
        assert quality.threshold_of(spark.createDataFrame(rows, "number long, quality int, score double"), len(good)) == quality.calibrate(Scores(), good, bad).threshold


def plain_path(forest, tree, x, node=0):
    k = forest.feature[tree, node]
    return forest.path[tree, node] if k < 0 else plain_path(forest, tree, x, 2 * node + 1 + int(x[k] >= forest.cut[tree, node]))


def test_paths_by_the_book():
    rng = np.random.default_rng(3)
    good = rng.normal(0, 1, (400, 4))
    forest = quality.grow(good, np.ptp(good, axis=0), trees=20)
    odd = np.array([[9.0, -9, 9, 9], [0, 0, 0, 0], [0, 0, 0, 0]])
    want = [2.0 ** (-np.mean([plain_path(forest, t, x) for t in range(20)]) / forest.norm) for x in odd]
    got = forest.score(odd)
    assert got == pytest.approx(want) and got[0] > got[1] == got[2]
    # The threshold is the middle of what keeps the good rows and loses most bad ones.
    found = quality.calibrate(forest, good, rng.normal(8, 1, (50, 4)))
    assert (found.score(good) >= found.threshold).mean() <= quality.MAX_FALSE_REJECTS
    assert (found.score(rng.normal(8, 1, (50, 4))) >= found.threshold).mean() > 0.9
    assert quality.learn(good[:10], np.ones(10)) is None


# 7


def test_toxicity(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = langid.held_out(F.col("doc_id"), 3, 1)
    model = toxicity.fit(docs.where(~out), labels.where(~out))
    rows = toxicity.toxicity(docs.where(out), model).join(labels, "doc_id").collect()
    hits, wrong = [r.score >= 0.7 for r in rows if r.toxic == 1], [r.score >= 0.7 for r in rows if r.toxic == 0]
    assert np.mean(hits) > 0.5 and np.mean(wrong) < 0.02
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!")], "doc_id long, text string")
    assert all(0 <= r.score < 0.5 for r in toxicity.toxicity(odd, model).collect())
    assert {r.score for r in toxicity.toxicity(odd, toxicity.Model()).collect()} == {0.0}
    assert toxicity.toxicity(empty(spark), model).count() == 0


def test_smoothing_sums_to_one():
    model = toxicity.count(["the cat sat", "the dog", "an idiot sat"], np.array([0, 0, 1]))
    for own in model.own:
        for context in (b"_th", b"_", b"_xyz"):
            total = 0.0
            for c in range(256):
                x = np.frombuffer(context + bytes([c]), np.uint8)
                pos = np.arange(len(x))
                keys = [toxicity.gram_key(x, pos, n)[-1:] for n in range(model.order + 1)]
                ctx = [toxicity.gram_key(x, pos, n)[-2:-1] for n in range(model.order + 1)]
                p = np.full(1, 1 / 256)
                for n, counts in enumerate([*model.shared, *own], 1):
                    p = counts.smooth(keys[n], ctx[n - 1], p)
                total += float(p[0])
            assert total == pytest.approx(1, abs=0.02)


def test_pairs_by_the_book():
    """Words in context against counts in dictionaries."""
    texts, labels = ["you great cat", "you great dog", "you bad cat", "you bad cat", "no bad dog"], np.array([0, 0, 1, 1, 1])
    model = toxicity.count(texts, labels)
    seen = {y: Counter() for y in (0, 1)}
    for t, y in zip(texts, labels.tolist(), strict=True):
        w = [None, *t.split()]
        seen[y].update(set(itertools.pairwise(w)))
    seen["both"] = seen[0] + seen[1]

    def smooth(counts, pair, below):
        total = sum(n for (a, _), n in counts.items() if a == pair[0])
        kinds = sum(a == pair[0] for a, _ in counts)
        n = counts[pair]
        return below if not total else (n - min(toxicity.DISCOUNT, n)) / total + toxicity.DISCOUNT * min(kinds, total / toxicity.DISCOUNT) / total * below

    buf, start, end, _ = toxicity.split_words(pa.array(["you bad cat"]))
    logs = model.logs(buf, start, end)
    h, g = tx.word_keys(buf, start, end)
    pair, context = toxicity.pair_keys(h, g, np.zeros(3, int))
    known, ratio = model._in_context(pair, context, logs)
    assert known.tolist() == [0, 1, 2]
    for i, p in enumerate(itertools.pairwise([None, "you", "bad", "cat"])):
        want = [math.log(smooth(seen[y], p, smooth(seen["both"], p, math.exp(logs[i, y])))) for y in (0, 1)]
        assert ratio[i] == pytest.approx(want[1] - want[0], rel=1e-5)
    again, pairs = toxicity.tally(pa.array(["a b a b", "b a", "a b"]), np.array([0, 0, 1]))
    assert sorted(zip(again[0], again[1].tolist(), again[2].tolist(), strict=True)) == [(b"a", 0, 2), (b"a", 1, 1), (b"b", 0, 2), (b"b", 1, 1)]
    assert sorted(pairs[3].tolist()) == [1, 1, 1, 1, 1, 2]


def all_stretches(text, template):
    """The greatest coefficient of a stretch of words with a template, by trying all of them."""
    words = re.findall("[a-z0-9\u0080-\uffff]+", text.lower())
    goal = re.findall("[a-z0-9\u0080-\uffff]+", template.lower())
    goal = set(itertools.pairwise(goal))
    pairs = list(itertools.pairwise(words))
    best = 0.0
    for i in range(len(pairs)):
        if pairs[i] not in goal:
            continue
        kinds, common = set(), 0
        for j in range(i, min(len(pairs), i + 4 * len(goal))):
            if pairs[j] not in kinds:
                kinds.add(pairs[j])
                common += pairs[j] in goal
            if pairs[j] in goal:
                best = max(best, 2 * common / (len(kinds) + len(goal)))
    return best


@pytest.mark.parametrize("inserted", [0, 10, 55, 68, 70, 72, 90])
def test_license_with_words_put_in_and_prose_behind(inserted):
    """Stretches end where the coefficient is greatest, whatever follows with bigrams of the template."""
    rng = random.Random(inserted)
    template = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 500)
    words = template.split()
    at = len(words) // 2
    more = [f"zz{i}" for i in range(inserted)]
    tail = "this is the work of the Software and in the other copies of the Software or use of it to the person " * 2
    for text in (" ".join(words[:at] + more + words[at:]), " ".join(words[:at] + more + words[at:]) + ". " + tail, tail + " ".join(words[:at] + more + words[at:]) + " " + prose(rng, 40)):
        own = licenses.Matcher((("MIT", template),), 0.3).scan(pa.array([text]))[0]
        assert max(m[3] for m in own) == pytest.approx(all_stretches(text, template))
        found = licenses.Matcher().scan(pa.array([text]))[0]
        want = max(all_stretches(text, t) for _, t in licenses.TEMPLATES)
        assert max((m[3] for m in found), default=0) == pytest.approx(want if want >= licenses.THRESHOLD else 0)


def test_languages_of_repeated_and_null_ids(spark):
    """A language is learned though all its rows have one id, or none."""
    rows = [(i, f"the words of number {i} are english", "en") for i in range(300)]
    for k in (4, 5, 6):
        rows += [(k, "ytterst xylofon qwerty zzz " * 3, f"x{k}")] * 800
    rows += [(None, f"bonjour le monde {i % 7}", "fr") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    p = langid.fit(df, per_language=5)
    assert sorted(p.languages) == ["en", "fr", "x4", "x5", "x6"]
    assert p.predict("bonjour le monde")[0] == "fr" and p.predict("the words of english")[0] == "en"


# 8


def test_targets():
    assert mixing.targets([100, 100, 100]) == [50, 100, 150]
    got = mixing.targets([10, 1000, 10, 50])
    assert sum(got) == pytest.approx(1070) and all(t <= 3 * s + 1e-9 for t, s in zip(got, [10, 1000, 10, 50], strict=True))
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]


def test_split():
    q = np.array([13, 0, 200, 41])
    s = mixing.split(q, 7)
    assert (s.sum(1) == q).all() and s.sum(0).max() - s.sum(0).min() <= 4
    assert (s == mixing.split(q, 7)).all() and (mixing.split(q, 1)[:, 0] == q).all()


def plain_mix(rows, goal, block, n_rows):
    """doc_id -> copies, of one source: rows (doc_id, size, key, block number's hash, order in a block, chance)."""
    total = sum(r[1] for r in rows)
    if not total:
        return {r[0]: 0 for r in rows}
    epochs = min(int(goal // total), mixing.CAP)
    rest = goal - epochs * total
    limit = rest / mixing.PARTS
    blocks = max(1, math.ceil(n_rows / block))

    def walk(own, want):
        took, left = set(), want
        for b in range(blocks):
            here = [r for r in own if r[3] % blocks == b]
            if sum(r[1] for r in here) <= left:
                took |= {r[0] for r in here}
                left -= sum(r[1] for r in here)
                continue
            items = {}
            for r in here:
                items.setdefault((r[4], r[2], r[5]), []).append(r)
            items = [(o, k, c, sum(r[1] for r in same), {r[0] for r in same}) for (o, k, c), same in sorted(items.items())]
            items = [x for x in items if x[3]]
            for o, k, c, w, ids in items:
                if w > rest and c * w < mixing.RARE * left:
                    return took | ids
            loose, part = left * mixing.LOOSE, set()
            for o, k, c, w, ids in items:
                if w <= loose:
                    part |= ids
                    loose -= w
                    left -= w
            for w, o, k, ids in sorted((-w, o, k, ids) for o, k, c, w, ids in items if not ids & part):
                if -w <= left:
                    part |= ids
                    left += w
            return took | part
        return took

    large = [r for r in rows if r[1] > limit]
    took = walk(large, rest * sum(r[1] for r in large) / total)
    took |= walk([r for r in rows if r[1] <= limit], max(rest - sum(r[1] for r in large if r[0] in took), 0.0))
    return {r[0]: (epochs + (r[0] in took)) * (r[1] > 0) for r in rows}


def hashes(docs, seeds):
    """seed -> source -> rows for plain_mix."""
    out = {}
    key = F.xxhash64("seed", "doc_id", "text")
    sized = mixing._sized(docs).select("doc_id", "text", "source", "_size").crossJoin(docs.sparkSession.createDataFrame([(x,) for x in seeds], "seed int")).withColumn("k", key)
    columns = ("seed", "source", "doc_id", "_size", "k", F.xxhash64("k", F.lit(1)).alias("b"), F.xxhash64("k", F.lit(2)).alias("o"), (F.pmod(F.xxhash64("k", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("c"))
    for r in sized.select(*columns).collect():
        out.setdefault(r["seed"], {}).setdefault(r["source"], []).append((r["doc_id"], r["_size"], r["k"], r["b"], r["o"], r["c"]))
    return out


def plain_mixes(docs, seeds, block):
    out = {}
    for seed, by_source in hashes(docs, seeds).items():
        names = sorted(by_source, key=lambda x: (x is None, x))
        goal = mixing.targets([sum(r[1] for r in by_source[n]) for n in names])
        out[seed] = {}
        for n, t in zip(names, goal, strict=True):
            out[seed] |= plain_mix(by_source[n], t, block, len(by_source[n]))
    return out


def test_mixing(spark, docs, texts, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 3)
    own = docs.drop("_size")
    want = plain_mixes(own, [mixing.SEED, 7], 3)
    source = {i: [None, "s1", "s2", "s3"][i % 4] for i in texts}
    size = {i: len(SPACE.findall(t or "")) for i, t in texts.items()}
    names = ["s1", "s2", "s3", None]
    totals = [sum(size[i] for i in texts if source[i] == n) for n in names]
    goal = dict(zip(names, mixing.targets(totals), strict=True))
    for seed in want:
        rows = mixing.mix(own.repartition(9) if seed == 7 else own, seed, shard_words=500).select("doc_id", F.col("_size").alias("s"), "source_size", "target", F.col("_shards").alias("sh")).collect()
        got = {r.doc_id: (r.s, r.source_size, r.target, list(r.sh)) for r in rows}
        assert {i: len(v[3]) for i, v in got.items()} == want[seed]
        for n, total in zip(names, totals, strict=True):
            own_ids = [i for i in texts if source[i] == n]
            assert {got[i][1] for i in own_ids} == {total} and got[own_ids[0]][2] == pytest.approx(goal[n])
        assert all(got[i][0] == size[i] and len(got[i][3]) <= 3 for i in texts)
        assert all(not got[i][3] for i in texts if size[i] == 0)
    drawn = Counter(r.doc_id for r in mixing.draw(own, 7, shard_words=500).collect())
    assert drawn == Counter({i: len(v[3]) for i, v in got.items() if v[3]})
    assert mixing.mix(empty(spark)).count() == 0


def test_every_document_can_be_mixed(spark):
    """Sources of few large documents and of many small with some large ones: over seeds each is taken at times, and
    the words stay near the targets, in the mean of all seeds quite near."""
    rng = random.Random(8)
    rows = [(i, "w " * rng.choice([900, 1500, 4000]), "a") for i in range(6)]
    rows += [(100 + i, "w " * (9000 if i % 100 == 0 else rng.randint(5, 60)), "b") for i in range(400)] + [(1000, "w " * 30000, "c"), (1001, "w", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixes = plain_mixes(docs, list(range(100)), mixing.BLOCK)
    size = {i: len(t.split()) for i, t, _ in rows}
    names = ["a", "b", "c"]
    goal = dict(zip(names, mixing.targets([sum(size[i] for i, _, s in rows if s == n) for n in names]), strict=True))
    for n in names:
        own = [i for i, _, s in rows if s == n]
        totals = [sum(size[i] * m[i] for i in own) for m in mixes.values()]
        most = max(size[i] for i in own)
        assert all(abs(t - goal[n]) <= most for t in totals)
        assert np.median([abs(t - goal[n]) for t in totals]) <= 0.02 * goal[n] or len(own) < 10
        assert all(any(m[i] for m in mixes.values()) for i in own)
        assert goal[n] >= sum(size[i] for i in own) or not all(all(m[i] for m in mixes.values()) for i in own)
    got = {r.doc_id: r.n for r in mixing.mix(docs, 3).select("doc_id", F.size("_shards").alias("n")).collect()}
    assert got == mixes[3]


def test_shards_hold_each_block_copy_once(spark, docs, texts, monkeypatch):
    """The tree draws: each copy of a document lies in one shard, shards hold their even part of all blocks, and
    whatever number of shards the table allows, the same copies are taken."""
    monkeypatch.setattr(mixing, "BLOCK", 2)
    own = docs.drop("_size")
    taken = {}
    for table, least in ((1 << 22, 12), (16, 2), (1, 1)):
        rows = mixing.mix(own, shard_words=300, table=table).select("doc_id", "_i", "_block", "_n_blocks", "_shards").collect()
        taken[table] = {r.doc_id: len(r["_shards"]) for r in rows}
        used = {s for r in rows for s in r["_shards"]}
        assert len(used) >= least if least > 2 else len(used) <= max(table // 4, 1)
        blocks: dict = {}
        for r in rows:
            blocks.setdefault((r["_i"], r["_block"]), set()).add(tuple(r["_shards"]))
        # Documents of one block go together: all of them, but those that the last epoch leaves or without words.
        for copies in blocks.values():
            longest = max(copies, key=len)
            assert all(c == longest[: len(c)] for c in copies)
        count = Counter(s for copies in blocks.values() for s in max(copies, key=len))
        assert not count or max(count.values()) <= sum(count.values()) / len(used) + 14
    assert taken[1 << 22] == taken[16] == taken[1]


def test_words_before_in_runs(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, b, rng.randint(0, 50)) for i in range(3) for b in range(40) if rng.random() < 0.8]
    want, total = {}, Counter()
    for i, b, w in rows:
        want[i, b] = total[i]
        total[i] += w
    for run in (1, 7, 4096):
        monkeypatch.setattr(mixing, "RUN", run)
        got = mixing._words_before(spark.createDataFrame(rows, "_i int, _block long, _words long")).collect()
        assert {(r["_i"], r["_block"]): r["_before"] for r in got} == want


# 9


def plain_profile(texts, top=langid.TOP):
    c = Counter()
    for t in texts:
        for w in re.findall(r"[^\W\d_]+", t.lower()):
            p = f" {w} "
            for n in (1, 2, 3):
                c.update(p[i : i + n] for i in range(len(p) - n + 1) if p[i : i + n].strip() and (n < 3 or p[i + 1] != " "))
    return c


def test_grams_match_plain_counts(monkeypatch):
    text = "Éa b. ñandú, die Straße 12 x 日本語 𐐨𐐩 a"
    want = sorted(plain_profile([text]).values())
    assert sorted(langid.grams(text)[1].tolist()) == want
    for part in (1, 2, 5):
        monkeypatch.setattr(langid, "PART", part)
        assert sorted(langid.grams(text)[1].tolist()) == want


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.held_out(F.col("doc_id"), 4, 2)
    profiles = langid.fit(docs.where(~out))
    rows = langid.identify(docs.where(out), profiles).join(docs, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    assert [bool(r[0]) for r in spark.createDataFrame([(7,), (11,)], "d long").orderBy("d").select(langid.held_out(F.col("d"), 4, 2)).collect()] == [zlib.crc32(x) % 4 == 2 for x in (b"7", b"11")]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "日本語")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, profiles).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3 and got[4][0] in profiles.languages
    assert {r.lang_pred for r in langid.identify(odd, langid.fit(docs.limit(0))).collect()} == {"und"}
    assert langid.identify(empty(spark), profiles).count() == 0


def test_out_of_place_distance():
    p = langid.build(["aaa bbb ccc", "xxx yyy zzz"], ["l", "m"])
    assert p.predict("aaa ccc")[0] == "l" and p.predict("zzz")[0] == "m"
    assert p.predict("aaa bbb ccc") == ("l", 1.0)
    assert langid.build(["same", "same"], ["b", "a"]).predict("same") == ("a", 1.0)


def plain_distance(text, profile, top=langid.TOP):
    """The out-of-place distance by the book, over n-grams as strings."""
    key = lambda g: (len(g), g.lower())
    rank = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], key(x[0])))[:top]]
    own, other = rank(plain_profile([text])), {g: i for i, g in enumerate(rank(profile))}
    return sum(min(abs(other[g] - i), top) if g in other else top for i, g in enumerate(own)) / (top * len(own))


def test_distances_by_the_book():
    rng = random.Random(14)
    made = {x: [" ".join("".join(rng.choice(abc) for _ in range(rng.randint(1, 5))) for _ in range(60)) for _ in range(3)] for x, abc in (("k", "abcdé"), ("l", "abxyz"), ("m", "語日本x"))}
    p = langid.build([t for ts in made.values() for t in ts], [x for x, ts in made.items() for _ in ts])
    for ts in made.values():
        text = ts[0][:90]
        want = {x: plain_distance(text, plain_profile(own)) for x, own in made.items()}
        name, score = p.predict(text)
        assert want[name] == min(want.values()) and score == pytest.approx(1 - want[name])


def test_every_language_is_learned(spark):
    rows = [(i, f"{chr(0x4E00 + i)}{chr(0x4E00 + i)} {chr(0x10400 + i % 40)}", f"l{i}") for i in range(450)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for sample in (100, 8000):
        p = langid.fit(df, sample_rows=sample)
        assert len(p.languages) == 450
    assert [r.doc_id for r in langid.identify(df, p).join(df, "doc_id").where("lang <> lang_pred").collect()] == []


# 10


def test_encoder_equals_tokenizer(texts):
    enc = packing.encoder(packing.default_tokenizer())
    data = [t or "" for t in texts.values()] + ["don't 'tis it's 're 'vex '' 's", "a  b\n\nc \n d", "  ", "\n", "x'st 'll x'll's'dd", "日本 foo", "foo<|endoftext|>bar", "a b", "é'sé 12½3 '12", " \t x", "it''s", "'s", "\x1c\x85 x", "naïve\r\nrow"]
    ids, at = enc.encode(*tx.buffers(pa.array(data)))
    want = enc.tokenizer.encode_batch(data, add_special_tokens=False)
    assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(data))] == [w.ids for w in want]


def test_encoder_in_strips(texts, monkeypatch):
    """Long texts are cut where no pre-token reaches over: ids are those of the whole text, whatever the strips."""
    enc = packing.encoder(packing.default_tokenizer())
    rng = random.Random(41)
    odd = ["日本語、文字。", "don't 've", "  \n\n x", "é 12½3", "a\t b", "\u00a0x", "\x85", "🙂 ok.", "一二，三四。五", "'s ", "...\n", "<|endoftext|> a"]
    data = [t or "" for t in texts.values()] + ["".join(rng.choice(odd) for _ in range(300)) for _ in range(6)] + ["", "x" * 500]
    want = [w.ids for w in enc.tokenizer.encode_batch(data, add_special_tokens=False)]
    for strip in (5, 64):
        monkeypatch.setattr(packing, "STRIP", strip)
        ids, at = enc.encode(*tx.buffers(pa.array(data)))
        assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(data))] == want


def test_packing(spark, docs, texts):
    rows = packing.pack(docs).collect()
    enc = packing.encoder(packing.default_tokenizer()).tokenizer
    ids = {i: [*enc.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts.items()}
    seen, places = {i: [] for i in texts}, {}
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
        seen[r.doc_id] += range(r.start, r.start + r.length)
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sorted(seen[i]) == list(range(len(ids[i]))) for i in texts)
    total = sum(map(len, ids.values()))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= math.ceil(total / 1024) + 1 and sorted(places) == list(range(len(places)))
    assert packing.pack(empty(spark)).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert packing.pack(twice).count() == 3


def test_fullest_is_best():
    rng = random.Random(6)
    for _ in range(60):
        counts = Counter(rng.randint(1, 30) for _ in range(rng.randint(1, 9)))
        room = rng.randint(1, 60)
        take = packing.fullest(sorted(counts, reverse=True), counts, room)
        sums = {0}
        for x, c in counts.items():
            sums = {s + k * x for s in sums for k in range(c + 1)}
        assert sum(x * c for x, c in take.items()) == max(s for s in sums if s <= room)
        assert all(c <= counts[x] for x, c in take.items())
    solved = Counter()
    for take, times in packing.solve({700: 10_000, 300: 7000, 24: 9000, 1024: 5}):
        assert sum(x * c for x, c in take.items()) <= 1024
        solved.update({x: c * times for x, c in take.items()})
    assert solved == {700: 10_000, 300: 7000, 24: 9000, 1024: 5}


# All


def scanned(name):
    """Results by doc_id of the operators that look at one document at a time."""
    model = toxicity.count(["a good day", "what a bad day", "bad bad"], np.array([0, 1, 1]))
    model.weights = np.array([-1.0, 0.5, 0.2, 0.1, 0, 0, 0, 0.3, 0.1])
    p = langid.build(["abc abc de", "ßñé ßñ"], ["k", "l"])
    return {
        "secrets": lambda d: secrets.scan(d).select("doc_id", "base_sha256", F.to_json("spans")), "licenses": lambda d: licenses.scan(d).select("doc_id", "license", "dice", F.to_json("matches")), "quality": lambda d: quality.quality_scores(d, None),
        "toxicity": lambda d: toxicity.toxicity(d, model), "langid": lambda d: langid.identify(d, p),
    }[name]


@pytest.mark.parametrize("name", ["secrets", "licenses", "quality", "toxicity", "langid"])
def test_clashing_columns_and_repeated_rows(docs, name):
    """Columns named like an operator's own change nothing; rows that stand twice get the same result twice."""
    go = scanned(name)
    plain = sorted(map(tuple, go(docs.select("doc_id", "text")).collect()), key=repr)
    clash = docs.withColumns({c: F.lit("clash") for c in ("candidates", "base", "spans", "score", "license", "dice", "kept", "anomaly", "n_words", "lang_pred", "toxic", "place", "n")})
    assert sorted(map(tuple, go(clash).collect()), key=repr) == plain
    assert sorted(map(tuple, go(docs.unionByName(docs)).collect()), key=repr) == sorted([*plain, *plain], key=repr)


def test_kept_columns_with_clashing_names(spark, docs):
    """Operators that hand rows on keep every column and value, whatever its name."""
    clash = docs.withColumns({c: F.lit("own") for c in ("candidates", "base", "spans", "kept", "digest", "k1", "component_id")})
    for out in (secrets.redact(clash), quality.quality_filter(clash, None), neardup.deduplicate(clash)):
        assert out.columns == clash.columns and {r.base for r in out.select("base").distinct().collect()} == {"own"}


def test_fit_with_ties_and_repeated_rows(spark):
    """Rows that stand twice, labels that disagree and documents that are equal leave the fits the same."""
    rows = [(i, f"good words number {i % 7} here" if i % 3 else f"vile scum number {i % 5} here", "k" if i % 2 else "l") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(60)], "doc_id long, toxic int, quality int")
    one = toxicity.fit(docs, labels)
    two = toxicity.fit(docs.unionByName(docs), labels.unionByName(labels).withColumn("text", F.lit("x")))
    assert one.weights == pytest.approx(two.weights) and one.score(pa.array(["vile scum"]))[0] > one.score(pa.array(["good words"]))[0]
    a, b = langid.fit(docs), langid.fit(docs.withColumn("n", F.lit(1)))
    assert a.languages == b.languages == ["k", "l"] and (a.vocabulary == b.vocabulary).all()


def test_embedding_duplicates_broadcast_nothing(spark, monkeypatch):
    """Every table of the operator grows with the vectors; one that is broadcast is held whole by the driver."""
    from rulelode.operators import graph

    plans = []

    def written(df, name, write=graph.materialize):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(graph, "materialize", written)
    monkeypatch.setattr(embeddup.ut, "materialize", written)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        out = embeddup.near_duplicates(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))
        plans.append(out._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [line for p in plans for line in p.splitlines()]
    assert [line for line in lines if "Broadcast" in line] == []
    assert sum("SortMergeJoin" in line for line in lines) >= 6
