"""Quality rules: an isolation forest over per-document rule statistics.

Statistics of every whole text are computed in one Arrow pass; labels are joined to them, so that no text is shuffled.
A forest of random splits is grown on half of the labelled rows of good quality; a short mean path means an odd
document. The threshold on the path score is calibrated on the other half, good and bad, which the trees have not seen. All labelled rows are used: each tree draws
its TREE_ROWS rows, as an isolation forest does, from the whole half; ranges of statistics and the threshold are exact
over all rows and found by Spark, and only the rows of the trees reach the driver, TREES * TREE_ROWS at most. Repeated
words and lines are found by comparing bytes, not hashes.

Defined results: a null or empty text has zero statistics and fails the base rule; extra columns are ignored by
`quality_scores` and kept by `quality_filter`; repeated rows are judged alike; documents of one score, tied with the
threshold, are judged alike; with under 16 good or 2 bad labelled rows the method rejects nothing and only the base
rule decides; an empty table gives an empty result. A very long text is walked in parts, words numbered at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelode.llm import _text as tx
from rulelode.llm import _util as ut
from rulelode.operators.numbering import with_numbers

TREES = 200
TREE_ROWS = 256
MAX_FALSE_REJECTS = 0.005

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_BANG = np.zeros(256, bool)
_BANG[0x21] = True
#: Bytes that begin a code point of a word.
_INK_HEAD = tx._INK & ((np.arange(256) & 0xC0) != 0x80)


def _per_row(flags: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many bytes of each row the table of 256 flags marks."""
    return np.array([sum(int(np.count_nonzero(flags[buf[lo : min(lo + tx.PART, b)]])) for lo in range(a, b, tx.PART)) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)], np.int64)


def repeated_words(number: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which of the numbered words stand in a window of three that its row holds twice or more."""
    out = np.zeros(len(number), bool)
    at = np.flatnonzero(row[2:] == row[:-2])
    if len(at):
        # Numbers instead of hashes: windows are equal exactly if theirs are.
        pair = np.unique(number[at] << 32 | number[at + 1], return_inverse=True)[1]
        window = pair << 32 | number[at + 2]
        order = np.lexsort((window, row[at]))
        w, r = window[order], row[at][order]
        same = (w[1:] == w[:-1]) & (r[1:] == r[:-1])
        twice = np.zeros(len(w), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = at[order[twice]]
        for k in range(3):
            out[hit + k] = True
    return out


def _lines(raw: bytes) -> tuple[int, int]:
    """(lines with a word, those among them equal to an earlier one) of a text."""
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


def statistics(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """Rule statistics of each row of a byte buffer."""
    n = len(offs) - 1
    start, end, first = tx.words(buf, offs)
    row = np.repeat(np.arange(n), np.diff(first))
    repeat = repeated_words(tx.distinct(buf, start, end)[1], row)
    raw = buf.tobytes()
    lines = np.array([_lines(raw[a:b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)], np.int64).reshape(-1, 2)
    return {
        "n_words": np.diff(first), "word_chars": _per_row(_INK_HEAD, buf, offs), "n_symbols": _per_row(_SYMBOL, buf, offs),
        "n_dup_lines": lines[:, 1], "n_repeat_words": np.bincount(row[repeat], minlength=n),
        "n_upper": _per_row(_UPPER, buf, offs), "n_digits": _per_row(_DIGIT, buf, offs), "n_bangs": _per_row(_BANG, buf, offs),
        "n_lines": lines[:, 0],
    }


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    """One row of rates for each document; counts alone would call every long document odd."""
    w, c = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    rates = np.stack(
        [
            s["n_symbols"] / w, s["n_dup_lines"] / np.maximum(s["n_lines"], 1), s["n_repeat_words"] / w, s["n_upper"] / c, s["n_digits"] / c,
            s["n_bangs"] / w,
        ],
        1,
    )
    # Roots, as rates near zero matter most; symbols, the rate least shared by ordinary prose, stand three times among the choices of a cut.
    return np.concatenate([np.log(s["word_chars"] / w + 1)[:, None], np.sqrt(rates), np.sqrt(rates[:, [0, 0]])], 1)


@dataclass
class Forest:
    """Trees as arrays: feature (-1 at a leaf), cut, children at 2i+1 and 2i+2, path length at leaves."""

    feature: np.ndarray
    cut: np.ndarray
    path: np.ndarray
    norm: float
    threshold: float = np.inf
    #: Labelled rows that it was fitted on.
    rows: int = 0

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): near 1 for odd rows, about 0.5 and less for ordinary ones."""
        total = np.zeros(len(x))
        at = np.arange(len(x))
        for f, c, p in zip(self.feature, self.cut, self.path, strict=True):
            node = np.zeros(len(x), np.int64)
            while True:
                k = f[node]
                inner = k >= 0
                if not inner.any():
                    break
                node = np.where(inner, 2 * node + 1 + (x[at, np.maximum(k, 0)] >= c[node]), node)
            total += p[node]
        return 2.0 ** (-total / max(len(self.feature), 1) / self.norm)


def _expected(n: int) -> float:
    return 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else float(n == 2)


def drawn(n: int, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7) -> list[np.ndarray]:
    """Places of the rows that each tree grows on, among n."""
    rng = np.random.default_rng([seed, n])
    return [rng.choice(n, min(rows, n), replace=False) for _ in range(trees)]


def grow(
    x: np.ndarray, spread: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7, draws: list[np.ndarray] | None = None,
) -> Forest:
    """Trees over the ordinary rows x, each on `rows` of them or on those of its draw. Cuts reach past a node's range by a part of `spread`, the range of each
    statistic over all labelled rows: a statistic that never varies in x still isolates rows where it does."""
    rng = np.random.default_rng(seed)
    depth = int(np.ceil(np.log2(max(min(rows, len(x)), 2)))) + 3
    size = 2 ** (depth + 1) - 1
    feature, cut, path = np.full((trees, size), -1, np.int8), np.zeros((trees, size)), np.zeros((trees, size))
    for t in range(trees):
        todo = [(0, 0, x[rng.choice(len(x), min(rows, len(x)), replace=False) if draws is None else draws[t]])]
        while todo:
            node, d, own = todo.pop()
            lo, hi = own.min(0), own.max(0)
            can = np.flatnonzero((hi > lo) | (spread > 0))
            if d == depth or len(own) < 2 or not len(can):
                path[t, node] = d + _expected(len(own))
                continue
            k = int(rng.choice(can))
            reach = spread[k] / 4
            c = rng.uniform(lo[k] - reach, hi[k] + reach)
            feature[t, node], cut[t, node] = k, c
            right = own[:, k] >= c
            for child, part in ((2 * node + 1, own[~right]), (2 * node + 2, own[right])):
                if len(part):
                    todo.append((child, d + 1, part))
                else:
                    path[t, child] = d + 1
    return Forest(feature, cut, path, max(_expected(min(rows, len(x))), 1.0))


def calibrate(forest: Forest, good: np.ndarray, bad: np.ndarray, most: float = MAX_FALSE_REJECTS) -> Forest:
    """Put the threshold where most bad rows lie above it while at most a share `most` of the good ones do."""
    g, b = np.sort(forest.score(good)), np.sort(forest.score(bad))
    cuts = np.unique(np.concatenate([g, b]))
    mid = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    lost = 1 - np.searchsorted(g, mid, "left") / len(g)
    found = 1 - np.searchsorted(b, mid, "left") / len(b)
    ok = lost <= most
    if ok.any() and found[ok].max() > 0:
        best = found[ok].max()
        at = np.flatnonzero(ok & (found >= best - 1e-12))
        forest.threshold = float(mid[at[len(at) // 2]])
    return forest


_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_bangs", "n_lines")


def _stats_of(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    return features({k: rows.column(k).to_numpy() for k in _NAMES})


def rule_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every row: what the rules and the forest need to know of a text, without the text."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in tx.pieces(batch, "text"):
            s = statistics(buf, offs)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(s[k], pa.int64()) for k in _NAMES)], ["doc_id", *_NAMES])

    return ut.map_batches(ut.only(docs, doc_id="long", text="string"), run, "doc_id long, " + ", ".join(f"{k} long" for k in _NAMES))


def labelled(docs: DataFrame, labels: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(number, quality, statistics) of every labelled row of quality 0 or 1 that the base rule lets pass, each doc_id
    once, numbered from 0 by quality and doc_id. Labels meet the `rule_counts` of docs, so that no text is shuffled."""
    marks = ut.only(labels, doc_id="long", quality="int").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = (rule_counts(docs) if counts is None else counts).join(marks.where("quality in (0, 1)"), "doc_id").where(~base_failed({k: F.col(k) for k in ("n_words", "n_repeat_words")}))
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("quality", *_NAMES)).alias("s")).select("doc_id", "s.*")
    return with_numbers(rows.withColumn("at", F.struct("quality", "doc_id")), "at", "number").drop("at", "doc_id")


def _spread(rows: DataFrame) -> np.ndarray:
    """The range of each feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _stats_of(batch)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(x.shape[1])), pa.array(x.min(0)), pa.array(x.max(0))], ["f", "lo", "hi"])

    ends = rows.select(*_NAMES).mapInArrow(run, "f long, lo double, hi double").groupBy("f").agg((F.max("hi") - F.min("lo")).alias("d"))
    return np.array([r["d"] for r in ends.orderBy("f").collect()])


def threshold_of(scores: DataFrame, n_good: int, most: float = MAX_FALSE_REJECTS) -> float:
    """The threshold of `calibrate` over (number, quality, score) rows of any number, n_good of them of quality 1."""
    lost = int(most * n_good) + 1
    while lost and 1 - (n_good - lost) / n_good > most:
        lost -= 1
    # With `lost` good rows above it, the lowest cut is right over the next good score.
    good = with_numbers(scores.where("quality = 1").select(F.struct("score", "number").alias("at")), "at", "rank")
    least = good.where(F.col("rank") == n_good - 1 - lost).select("at.score").first()[0]
    bad = scores.where(F.col("score") > least).agg(F.min(F.when(F.col("quality") == 0, F.col("score")))).first()[0]
    if bad is None:
        return np.inf
    # All cuts up to the next bad score find as many bad rows: the one in the middle is taken.
    cuts = with_numbers(scores.where(F.col("score").between(least, bad)).select("score").distinct(), "score", "rank")
    at = (cuts.count() - 1) // 2
    pair = [r[0] for r in cuts.where(F.col("rank").isin(at, at + 1)).orderBy("rank").select("score").collect()]
    return (pair[1] + pair[0]) / 2


def fit(docs: DataFrame, labels: DataFrame, counts: DataFrame | None = None) -> Forest | None:
    """A forest fitted on all labelled rows: as `learn`, with the rows in a table. `counts` are the `rule_counts` of
    docs, where they are at hand."""
    rows = labelled(docs, labels, counts)
    n_bad, n_good = rows.agg(F.count_if(F.col("quality") == 0), F.count_if(F.col("quality") == 1)).first()
    if n_good < 16 or n_bad < 2:
        return None
    # Every other row of each kind, bad ones first in number.
    rank = F.when(F.col("quality") == 1, F.col("number") - F.lit(n_bad)).otherwise(F.col("number"))
    rows = rows.withColumn("rank", rank)
    seen, unseen = rows.where(F.col("rank") % 2 == 0), rows.where(F.col("rank") % 2 == 1)
    draws = drawn((n_good + 1) // 2)
    need = np.unique(np.concatenate(draws))
    places = ut.local_table(rows.sparkSession, [(int(2 * i),) for i in need], {"rank": pa.int64()})
    grown = seen.where("quality = 1").join(F.broadcast(places), "rank").orderBy("rank").select(*_NAMES).toArrow()
    forest = grow(_stats_of(grown), _spread(seen), draws=[np.searchsorted(need, d) for d in draws])
    forest.rows = n_good + n_bad

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("number"), batch.column("quality"), pa.array(forest.score(_stats_of(batch)))], ["number", "quality", "score"],
            )

    scores = unseen.select("number", "quality", *_NAMES).mapInArrow(run, "number long, quality int, score double")
    forest.threshold = threshold_of(ut.materialize(scores, "scores"), n_good // 2)
    return forest


def learn(x: np.ndarray, quality: np.ndarray) -> Forest | None:
    """Trees from every other row of each kind, the threshold from the rows between, which the trees have not seen."""
    good, bad = x[quality == 1], x[quality == 0]
    if len(good) < 16 or len(bad) < 2:
        return None
    return calibrate(grow(good[::2], np.ptp(np.concatenate([good[::2], bad[::2]]), axis=0)), good[1::2], bad[1::2])


def base_failed(s: dict[str, np.ndarray] | dict[str, Column]) -> np.ndarray | Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def _verdict(forest: Forest | None, s: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    failed = base_failed(s)
    score = forest.score(features(s)) if forest is not None else np.zeros(len(failed))
    kept = ~failed & (score < forest.threshold if forest is not None else True)
    return failed, score, kept


def quality_scores(docs: DataFrame, forest: Forest | None, counts: DataFrame | None = None) -> DataFrame:
    """doc_id, the counts of COUNTS, base_failed, kept, anomaly (the forest's score), for every row; from the
    `rule_counts` of docs, where they are at hand."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        failed, score, kept = _verdict(forest, {k: batch.column(k).to_numpy() for k in _NAMES})
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(batch.column(k) for k in COUNTS), pa.array(failed), pa.array(kept), pa.array(score)],
            ["doc_id", *COUNTS, "base_failed", "kept", "anomaly"],
        )

    return ut.map_batches(
        rule_counts(docs) if counts is None else counts, run,
        "doc_id long, " + ", ".join(f"{k} long" for k in COUNTS) + ", base_failed boolean, kept boolean, anomaly double",
    )


def quality_filter(docs: DataFrame, forest: Forest | None) -> DataFrame:
    """The rows of docs, all columns, that the rules and the forest keep."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in tx.pieces(batch, "text"):
            yield part.filter(pa.array(_verdict(forest, statistics(buf, offs))[2]))

    return docs.mapInArrow(lambda it: (out for b in it for out in run(b)), docs.schema)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ut.table(spark, sf_dir, "documents")
    counts = ut.materialize(rule_counts(docs), "counts")
    return quality_scores(docs, fit(docs, ut.table(spark, sf_dir, "labels"), counts), counts)
