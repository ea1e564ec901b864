"""Secret scans: pattern rules, and a battery of randomness tests over further tokens.

Patterns find assignments of credentials, access keys and long hexadecimal strings in whole texts. Any other run
of 20 or more token characters is cut at '=' that is not trailing padding, as in NAME=value; a piece is a candidate if
its characters fit one of the usual encodings. A piece that fits none, as it mixes '+' or '/' with '-' or '_', is cut
at '/', at '-' and '_', and at all three; each part of 20 or more that fits is a candidate, and parts may overlap. For each
candidate three tests ask whether it could be random symbols of that encoding: chi-squared uniformity of its
alphabet, the Wald-Wolfowitz runs test about the alphabet's middle, and the lag-one serial correlation; the
least p, times three, is its p-value. Tails are those of the tests' own distributions at that length, not normal ones:
up to EXACT symbols the distribution of the sum of squared counts is computed in full and runs are counted exactly;
the serial test has its fourth cumulant corrected. Per class of length and over the whole corpus, the
Benjamini-Hochberg rule at FDR rejects randomness; what is rejected is ordinary (paths, names, tables), what stays is
reported as kind `random`. The rule bounds the share of random strings among the rejected ones. It does not bound how
many of the reports are ordinary: that is the power of the tests, which the test file measures for some kinds of
ordinary tokens. Classes of length matter as short strings give the tests little power: their many p-values near 1
must not decide about long ones.

Defined results: null and empty texts have no spans; offsets are code points, ends exclusive; repeated rows get
the same spans; candidates of one p-value are judged alike; extra columns are ignored by `scan` and kept by `redact`;
an empty table gives an empty result. A very long text is read in parts, its patterns matched over the whole.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelode.llm import _text as tx
from rulelode.llm import _util as ut

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")
FDR = 0.01
MIN_TOKEN = 20
#: Lower ends of the length classes.
CLASSES = (20, 24, 32, 40, 64, 128)
BIN = 0.1
BINS = 400
#: Symbols up to which distributions are computed in full.
EXACT = 128

_ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
#: In lower case, what every assignment begins with.
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def _set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_LOW, _UP, _DIG = bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58))
_HEX = _set(_DIG + b"abcdef")
_TOKEN = _set(_LOW + _UP + _DIG + b"+/_=-")
#: Encodings from narrow to wide, and the characters in the order of their values.
ENCODINGS = {
    "hex": _DIG + b"abcdef", "HEX": _DIG + b"ABCDEF", "base32": _UP + b"234567", "lower36": _DIG + _LOW, "upper36": _DIG + _UP,
    "base62": _UP + _LOW + _DIG, "base64": _UP + _LOW + _DIG + b"+/", "base64url": _UP + _LOW + _DIG + b"-_",
}
_VALUES = {}
for _name, _chars in ENCODINGS.items():
    _VALUES[_name] = np.full(256, -1, np.int64)
    _VALUES[_name][list(_chars)] = np.arange(len(_chars))


def infer_encoding(token: bytes) -> str | None:
    """The narrowest encoding that holds the token; None without both a letter and a digit, as in words."""
    body = np.frombuffer(token.rstrip(b"="), np.uint8)
    if not (re.search(rb"[0-9]", token) and re.search(rb"[A-Za-z]", token)):
        return None
    return next((name for name, v in _VALUES.items() if len(body) and (v[body] >= 0).all()), None)


def pieces(token: bytes) -> list[tuple[int, int, str]]:
    """(start, end, encoding) of the candidates in a run of token characters."""
    out = set()
    for m in re.finditer(rb"[^=]+(?:=+$)?", token):
        mixed = re.search(rb"[+/]", m[0]) and re.search(rb"[_-]", m[0])
        for cut in (rb"[^/]+", rb"[^_-]+", rb"[^/_-]+") if mixed else (rb".+",):
            for part in re.finditer(cut, m[0]):
                if part.end() - part.start() >= MIN_TOKEN and (name := infer_encoding(part[0])):
                    out.add((m.start() + part.start(), m.start() + part.end(), name))
    return sorted(out)


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


@functools.lru_cache(1024)
def _pair_tail(n: int, k: int) -> np.ndarray:
    """P(at least s pairs of equal symbols) by s, for n uniform symbols of k kinds.

    Counts of k kinds are k Poisson numbers on condition of their sum, so the joint distribution of (sum, pairs) of
    one kind is convolved k times by squaring; as all numbers are probabilities, rounding stays near 1e-15.
    """
    most = int(n * (n - 1) / 2 / k + 40 * math.sqrt(n * (n - 1) / 2 / k) + 60)
    one = np.zeros((n + 1, most + 1))
    for c in range(n + 1):
        if c * (c - 1) // 2 <= most:
            one[c, c * (c - 1) // 2] = math.exp(-n / k + c * math.log(n / k) - math.lgamma(c + 1))
    shape = (2 * n + 2, 2 * most + 2)

    def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.maximum(np.fft.irfft2(np.fft.rfft2(a, shape) * np.fft.rfft2(b, shape), shape)[: n + 1, : most + 1], 0)

    out, power, left = None, one, k
    while left:
        if left & 1:
            out = power if out is None else both(out, power)
        left >>= 1
        power = both(power, power) if left else power
    own = out[n] / math.exp(-n + n * math.log(n) - math.lgamma(n + 1))
    return np.minimum(own[::-1].cumsum()[::-1] + max(0.0, 1 - own.sum()), 1.0)


def _p_uniform(counts: np.ndarray, n: int, k: int) -> float:
    if n <= EXACT:
        tail = _pair_tail(n, k)
        pairs = int((counts * (counts - 1)).sum()) // 2
        return float(tail[pairs]) if pairs < len(tail) else 1e-15
    # Chi-squared with the exact variance of a multinomial: fewer degrees of freedom, stretched to the same mean.
    chi, d = float(((counts - n / k) ** 2).sum() * k / n), (k - 1) / (1 - 1 / n)
    x = chi / (k - 1)
    return 0.5 * math.erfc((x ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d)) / math.sqrt(2))


@functools.lru_cache(4096)
def _run_odds(a: int, b: int) -> tuple[float, ...]:
    """P(r runs) by r in a random order of a and b signs."""
    total, out = math.comb(a + b, a), [0, 0]
    for r in range(2, a + b + 1):
        m = r // 2
        ways = 2 * math.comb(a - 1, m - 1) * math.comb(b - 1, m - 1) if r % 2 == 0 else math.comb(a - 1, m) * math.comb(b - 1, m - 1) + math.comb(a - 1, m - 1) * math.comb(b - 1, m)
        out.append(ways)
    return tuple(x / total for x in out)


def _p_runs(high: np.ndarray) -> float:
    n, a = len(high), int(high.sum())
    b = n - a
    if not a or not b:
        return 2.0 ** (1 - n)
    runs = 1 + int((high[1:] != high[:-1]).sum())
    if n <= EXACT:
        odds = _run_odds(a, b)
        return min(1.0, sum(x for x in odds if x <= odds[runs] * (1 + 1e-9)))
    mean = 1 + 2 * a * b / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    return _two_sided((runs - mean) / math.sqrt(var)) if var > 0 else 1.0


def _p_serial(v: np.ndarray, k: int) -> float:
    n, c = len(v), v - (k - 1) / 2
    z = abs(float((c[1:] * c[:-1]).sum()) / ((k * k - 1) / 12 * math.sqrt(n - 1)))
    # Excess kurtosis of the sum is about 5/n; the Cornish-Fisher term for it, up to where that stops rising.
    w = 5.04 / n / 24
    z = min(z, math.sqrt((1 / w + 3) / 3))
    return _two_sided(z - w * (z**3 - 3 * z))


def p_value(token: bytes, encoding: str) -> float:
    """Of the hypothesis that the token is made of independent uniform symbols."""
    v = _VALUES[encoding][np.frombuffer(token.rstrip(b"="), np.uint8)]
    n, k = len(v), len(ENCODINGS[encoding])
    return min(1.0, 3 * min(_p_uniform(np.bincount(v, minlength=k), n, k), _p_runs(v >= k / 2), _p_serial(v, k)))


def find(buf: np.ndarray, offs: np.ndarray) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int, float]]]]:
    """For each row: base spans (start, kind, end), sorted, and candidates (start, end, length class, -log10 p)."""
    whole = buf.tobytes()
    n = len(offs) - 1
    found: list[set] = [set() for _ in range(n)]
    spans: list[set] = [set() for _ in range(n)]

    def rows_with(word: bytes, text: bytes) -> set[int]:
        out, at = set(), text.find(word)
        while at >= 0:
            r = int(np.searchsorted(offs, at, "right")) - 1
            out.add(r)
            at = text.find(word, int(offs[r + 1]))
        return out

    low = tx.lower(buf).tobytes()
    for r in set().union(*(rows_with(w, low) for w in _WORDS)):
        a, b = int(offs[r]), int(offs[r + 1])
        spans[r] |= {(m.start() + a, 0, m.end() + a) for m in _ASSIGN.finditer(whole[a:b]) if m.end(2) - m.start(2) >= 8}
    del low
    for r in rows_with(b"AKIA", whole):
        a, b = int(offs[r]), int(offs[r + 1])
        spans[r] |= {(m.start() + a, 1, m.end() + a) for m in _ACCESS.finditer(whole[a:b]) if m.end() - m.start() >= 16}
    for s, e in zip(*_long(_HEX, buf, offs, 32), strict=True):
        spans[int(np.searchsorted(offs, s, "right")) - 1].add((int(s), 2, int(e)))
    # Ends of base spans so far, by start: a piece is free of them if the furthest end before its own end is not past its start.
    base = np.array(sorted((s, e) for own in spans for s, _, e in own), np.int64).reshape(-1, 2)
    reach = np.maximum.accumulate(base[:, 1]) if len(base) else base[:, 1]
    for s, e in zip(*_long(_TOKEN, buf, offs, MIN_TOKEN), strict=True):
        r = int(np.searchsorted(offs, s, "right")) - 1
        for a, b, name in pieces(whole[s:e]):
            before = int(np.searchsorted(base[:, 0], s + b, "left"))
            if before and reach[before - 1] > s + a:
                continue
            (
                found[r]
                .add(
                    (
                        int(s) + a, int(s) + b, int(np.searchsorted(CLASSES, b - a, "right")) - 1,
                        -math.log10(max(p_value(whole[s + a : s + b], name), 1e-300)),
                    )
                )
            )
    # Offsets in code points: all places of all rows in one walk over the text.
    places = np.unique(
        np.array(
            [
                0, *(offs[r] for r in range(n) if spans[r] or found[r]), *(x for own in spans for s, _, e in own for x in (s, e)),
                *(x for own in found for s, e, _, _ in own for x in (s, e)),
            ],
            np.int64,
        )
    )
    points = dict(zip(places.tolist(), tx.code_points(buf, places).tolist(), strict=True))
    out: list = []
    for r in range(n):
        if not spans[r] and not found[r]:
            out.append(([], []))
            continue
        base_point = points[int(offs[r])]
        out.append(
            (
                sorted((points[s] - base_point, k, points[e] - base_point) for s, k, e in spans[r]),
                sorted((points[s] - base_point, points[e] - base_point, c, p) for s, e, c, p in found[r]),
            )
        )
    return out


def _long(table: np.ndarray, buf: np.ndarray, offs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    start, end = tx.runs(table, buf, offs)
    long = end - start >= least
    return start[long], end[long]


_FOUND = "doc_id long, base array<struct<start:long,kind:int,`end`:long>>, base_sha256 string, candidates array<struct<start:long,`end`:long,class:int,score:double>>"
_BASE_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_CAND_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("class", pa.int32()), ("score", pa.float64())]))


def candidates(docs: DataFrame) -> DataFrame:
    """One row per document: base spans, their digest, and scored candidates."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in tx.pieces(batch, "text"):
            rows = find(buf, offs)
            base = pa.array([[{"start": s, "kind": k, "end": e} for s, k, e in b] for b, _ in rows], _BASE_TYPE)
            sha = pa.array([hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in b).encode()).hexdigest() for b, _ in rows])
            cand = pa.array([[{"start": s, "end": e, "class": c, "score": p} for s, e, c, p in cs] for _, cs in rows], _CAND_TYPE)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), base, sha, cand], ["doc_id", "base", "base_sha256", "candidates"])

    return ut.map_batches(ut.only(docs, doc_id="long", text="string"), run, _FOUND)


def thresholds(found: DataFrame, fdr: float = FDR) -> list[float]:
    """Per length class the -log10 p from which randomness is rejected; the histogram is of all candidates.

    What reaches the driver is at most len(CLASSES) * BINS counts, whatever the input.
    """
    binned = (
        found.select(F.explode("candidates").alias("c"))
        .select(F.col("c.class").alias("cls"), F.least(F.floor(F.col("c.score") / BIN), F.lit(BINS)).cast("int").alias("bin")).groupBy("cls", "bin")
        .count()
    )
    counts = np.zeros((len(CLASSES), BINS + 1), np.int64)
    for row in binned.collect():
        counts[row["cls"], row["bin"]] = row["count"]
    out = []
    for c in counts:
        passed = c[::-1].cumsum()[::-1]
        p = 10.0 ** (-BIN * np.arange(BINS + 1))
        ok = np.flatnonzero((passed > 0) & (p * c.sum() <= fdr * passed))
        out.append(float(BIN * ok[0]) if len(ok) else math.inf)
    return out


def _is_random(cut: list[float]):  # noqa: ANN202
    limits = F.array(*[F.lit(x) for x in cut])
    return lambda c: c["score"] < F.element_at(limits, c["class"] + 1)


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, base_sha256 and spans (array of start, kind, end) by start, then kind, for every row."""
    found = ut.materialize(candidates(docs), "secrets")
    more = F.transform(
        F.filter("candidates", _is_random(thresholds(found, fdr))),
        lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")),
    )
    return found.select("doc_id", "base_sha256", F.array_sort(F.concat("base", more)).alias("spans"))


def redact(docs: DataFrame, fdr: float = FDR, mark: str = "[SECRET]") -> DataFrame:
    """docs with every reported span of `text` replaced by `mark`; rows, order of columns and other values stay.

    A column n_chars, where there is one, is counted anew for the texts that change.
    """
    seen = candidates(docs).select("candidates").where(F.size("candidates") > 0)
    cut = thresholds(seen, fdr)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, offs in tx.pieces(batch, "text"):
                spans = [sorted([(s, e) for s, _, e in b] + [(s, e) for s, e, c, p in cs if p < cut[c]]) for b, cs in find(buf, offs)]
                hit = {r: x for r, x in enumerate(spans) if x}
                if not hit:
                    yield part
                    continue
                texts = part.column("text").to_pylist()
                for r, own in hit.items():
                    made, at = [], 0
                    for s, e in own:
                        if s >= at:
                            made += [texts[r][at:s], mark]
                        at = max(at, e)
                    texts[r] = "".join([*made, texts[r][at:]])
                columns = {name: part.column(i) for i, name in enumerate(part.schema.names)}
                columns["text"] = pa.array(texts, part.schema.field("text").type)
                if "n_chars" in columns:
                    n = columns["n_chars"].to_pylist()
                    for r in hit:
                        n[r] = len(texts[r])
                    columns["n_chars"] = pa.array(n, part.schema.field("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.array(*[F.lit(k) for k in KINDS])
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return scan(ut.table(spark, sf_dir, "documents")).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), "base_sha256",
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", F.element_at(named, s["kind"] + 1), s["start"], s["end"])), ",").alias("spans"),
        count(3).alias("n_random"),
    )
