"""Language identification by rank-order profiles.

A profile lists the TOP most frequent character n-grams (one to three characters, a word being padded with one
blank on each side) of a language, by falling frequency. A document's own profile is compared with each language's
by the out-of-place distance: the sum, over the document's n-grams, of how far apart an n-gram's two ranks are,
and TOP for an n-gram that the language's profile lacks. The nearest language wins.

Profiles are fitted on a bounded sample of labelled rows: at most `per_language` documents of each language, those
of least hash, and about SAMPLE_ROWS in all, but one at least of every language. Executors count the n-grams of the
sample's whole texts; what reaches the driver is TOP n-grams of each language. A letter is any of Unicode's, in
lower case; three of them fit one 64-bit number. A very long text is counted in parts.

Defined results: a null text, and one without a letter, is `und` with score 0; without any labelled row all are
`und`; ties go to the language first by code point, of n-grams to the one first by its letters; repeated rows get the
same prediction; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulelode.llm import _util as ut

TOP = 300
PER_LANGUAGE = 1500
#: Rows of the sample in all, where there are no more languages than that.
SAMPLE_ROWS = 8000
#: Code points of a text whose n-grams are counted at once.
PART = 1 << 20
UNKNOWN = "und"
_BASE = 0x110000
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            y = x.lower()
            out[c] = ord(y) if len(y) == 1 else c
    return out


def letters(text: str) -> np.ndarray:
    """Lower-case letters of a text as numbers, with 0 for every other character."""
    if not _FOLD:
        _FOLD.append(_fold())
    return _FOLD[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kinds, inverse = np.unique(keys, return_inverse=True)
    return kinds, np.bincount(inverse, counts, len(kinds)).astype(np.int64)


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of the n-grams of a text's letters; blanks pad words on both sides, and none reaches over one.

    Keys are numbers to the base _BASE: those of one letter come before those of two, and these before those of three.
    """
    found = []
    padded = f" {text} "
    for lo in range(0, len(padded), PART):
        x = letters(padded[lo : lo + PART + 2]).astype(np.int64)
        n = min(PART, len(padded) - lo)
        ink = x > 0
        two = np.flatnonzero((ink[:-1] | ink[1:])[:n])
        three = np.flatnonzero(ink[1:-1][:n])
        keys = np.sort(
            np.concatenate(
                [x[:n][ink[:n]], _BASE + x[two] * _BASE + x[two + 1], _BASE + _BASE**2 + (x[three] * _BASE + x[three + 1]) * _BASE + x[three + 2]]
            )
        )
        at = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
        found.append((keys[at], np.diff(np.append(at, len(keys)))))
    return found[0] if len(found) == 1 else _merged(np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))


def ranked(keys: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The top keys by falling count; ties by key."""
    if len(keys) > 4 * top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        some = counts >= least
        keys, counts = keys[some], counts[some]
    return keys[np.argsort(-counts, kind="stable")][:top]


@dataclass
class Profiles:
    """Over one sorted vocabulary, the languages that rank an n-gram and their ranks, as stretches of two arrays."""

    languages: list[str]
    vocabulary: np.ndarray
    start: np.ndarray
    language: np.ndarray
    rank: np.ndarray
    top: int = TOP

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score); the score is 1 for a profile met exactly and 0 for one without a common n-gram."""
        if text is None or not self.languages:
            return UNKNOWN, 0.0
        keys, counts = grams(text)
        if not len(keys) or keys[0] >= _BASE:
            return UNKNOWN, 0.0
        own = ranked(keys, counts, self.top)
        at = np.minimum(np.searchsorted(self.vocabulary, own), len(self.vocabulary) - 1)
        place = np.flatnonzero(self.vocabulary[at] == own)
        at = at[place]
        n = self.start[at + 1] - self.start[at]
        stop = np.cumsum(n)
        which = np.repeat(self.start[at] - stop + n, n) + np.arange(int(stop[-1]) if len(stop) else 0)
        # What a common n-gram saves of the distance TOP that a missing one costs.
        saved = self.top - np.minimum(np.abs(self.rank[which] - np.repeat(place, n)), self.top)
        distance = self.top * len(own) - np.bincount(self.language[which], saved, len(self.languages)).astype(np.int64)
        best = int(np.argmin(distance))
        return self.languages[best], float(1 - distance[best] / (self.top * len(own)))


def profiles(tops: dict[str, np.ndarray], top: int = TOP) -> Profiles:
    """From the ranked n-grams of each language."""
    names = sorted(tops, key=lambda x: x.encode("utf-8"))
    keys = np.concatenate([*(tops[x] for x in names), np.zeros(0, np.int64)]).astype(np.int64)
    language = np.repeat(np.arange(len(names)), [len(tops[x]) for x in names])
    rank = np.concatenate([*(np.arange(len(tops[x])) for x in names), np.zeros(0, np.int64)]).astype(np.int64)
    order = np.lexsort((language, keys))
    vocabulary, start = np.unique(keys[order], return_index=True)
    return Profiles(names, vocabulary, np.append(start, len(keys)), language[order], rank[order], top)


def build(texts: list[str], labels: list[str], top: int = TOP) -> Profiles:
    """Profiles of a few texts at hand."""
    tops = {}
    for name in set(labels):
        parts = [grams(t) for t, x in zip(texts, labels, strict=True) if x == name]
        tops[name] = ranked(*_merged(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])), top)
    return profiles(tops, top)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the id as text falls in the fold; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, top: int = TOP, sample_rows: int = SAMPLE_ROWS) -> Profiles:
    """Profiles from text and lang of docs: of each language the rows of least hash, at most per_language, at most
    its even share of sample_rows, and at least one. Rows equal in doc_id and text count once."""
    named = ut.only(docs, doc_id="long", text="string", lang="string").where("lang is not null and text is not null")
    counts = ut.materialize(named.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    languages = counts.count()
    if not languages:
        return profiles({}, top)
    per_language = max(1, min(per_language, sample_rows // languages))
    # A hash bound per language leaves about twice the rows wanted, and 32 more, before any shuffle, however frequent it is.
    named = named.withColumn("rk", ut.row_key(F.col("doc_id"), F.col("text")))
    draw = F.pmod(F.xxhash64("rk"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    some = named.join(counts, "lang").where(draw * F.col("rows") <= 2 * per_language + 32).groupBy("lang", "rk").agg(F.first("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("rk"))
    some = ut.materialize(some.withColumn("place", place).where(F.col("place") <= per_language).select("lang", "text"), "sample")
    # A language whose rows repeat one another can have none under the bound: it is learned from its least row.
    least = named.groupBy("lang").agg(F.min_by("text", "rk").alias("text")).join(some.select("lang").distinct(), "lang", "left_anti")
    chosen = some.unionByName(least)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for name, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            keys, n = grams(text.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array([name.as_py()] * len(keys), pa.string()), pa.array(keys), pa.array(n, pa.int64())], ["lang", "gram", "n"],
            )

    counted = ut.map_batches(chosen, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = counted.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("place") <= top)
    rows = best.select("lang", "gram", "place").toArrow()
    names, keys, places = rows.column("lang").to_pylist(), rows.column("gram").to_numpy(), rows.column("place").to_numpy()
    tops: dict[str, np.ndarray] = {}
    index = np.array(names, object)
    for name in set(names):
        own = index == name
        tops[name] = keys[own][np.argsort(places[own])]
    return profiles(tops, top)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, lang_pred, score of every row."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names, scores = [], []
        for text in batch.column("text"):
            name, score = profiles.predict(text.as_py())
            names.append(name)
            scores.append(score)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"],
        )

    return ut.map_batches(ut.only(docs, doc_id="long", text="string"), run, "doc_id long, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ut.table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    return identify(docs, fit(docs.where(~out))).select("doc_id", out.alias("held_out"), "lang_pred", "score")
