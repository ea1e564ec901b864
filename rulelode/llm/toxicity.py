"""Toxicity by class-conditional Kneser-Ney models.

Two interpolated Kneser-Ney models, one of toxic and one of ordinary documents. Below, each gives a word a likelihood
from its byte n-grams: orders over SHARED are counted per class, with continuation counts below the highest; orders up
to SHARED are counted over both classes together. Above, each gives a word its likelihood after the word before it:
pairs of words in two or more documents are counted over both classes together, then per class, and what is rarer
backs off to the word. So an expression too rare to tell the classes apart has nearly the same likelihood in both.
A document is described by the length-normalised difference of its two log-likelihoods, by words alone and by words
in their context, and by the same of the few words and pairs that differ most. A logistic curve over these, fitted on
rows that the counted model had not seen, turns them into a score.

The models are fitted on a bounded sample of labelled rows, of each class the half of `sample_rows` of least hash,
and the curve is fitted with each class weighted as frequent as it is. Executors read the sample's whole texts and
count; counts of words and of pairs in two documents or more reach the driver, no texts. Word scores are cached per
worker, at most CACHE of them; words are told apart by 128 bits.

Defined results: null and empty texts, and texts without a letter, get the score of no evidence, which is below
0.5; repeated rows get the same score; documents of one score are predicted alike; extra columns are ignored;
without labelled rows of both classes every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelode.llm import _text as tx
from rulelode.llm import _util as ut
from rulelode.llm.langid import held_out

SAMPLE_ROWS = 3000
ORDER = 6
SHARED = 2
DISCOUNT = 0.95
CACHE = 400_000
CUT = 0.7
TOPS = 3
FEATURES = 9

_IN_WORD = np.zeros(256, bool)
_IN_WORD[97:123] = True
_IN_WORD[128:] = True
_EDGE = np.uint8(0x5F)


def split_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end, first) of the lower-cased letter runs of each row."""
    buf, offs = tx.buffers(pc.utf8_lower(column))
    start, end = tx.runs(_IN_WORD, buf, offs)
    return buf, start, end, np.searchsorted(start, offs)


def pair_keys(h: np.ndarray, g: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair, context): keys of each word with the one before it, and of that one; a row begins after the edge."""
    context = np.full(len(h), _EDGE, np.uint64)
    context[1:] = np.where(row[1:] == row[:-1], h[:-1], np.uint64(_EDGE))
    return tx.mix(context * np.uint64(0xC2B2AE3D27D4EB4F) + g), context


def strands(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words laid end to end, each between two edge marks: (bytes, position in its word, word of each byte)."""
    size = end - start + 2
    word = np.repeat(np.arange(len(size)), size)
    pos = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
    out = np.full(len(word), _EDGE, np.uint8)
    inner = (pos > 0) & (pos < size[word] - 1)
    out[inner] = buf[(start[word] + pos - 1)[inner]]
    return out, pos, word


def gram_key(x: np.ndarray, pos: np.ndarray, n: int) -> np.ndarray:
    """The n bytes that end at each place as a number, fewer where the word is younger; their count stands above."""
    size = np.minimum(pos + 1, n)
    key = size.astype(np.uint64) << np.uint64(48)
    for k in range(n):
        shifted = np.zeros(len(x), np.uint64)
        shifted[k:] = x[: max(len(x) - k, 0)]
        key |= np.where(k < size, shifted << np.uint64(8 * k), np.uint64(0))
    return key


@dataclass
class Counts:
    """Counts of n-grams and of their contexts: sum of counts, and kinds of what follows."""

    gram: np.ndarray
    n: np.ndarray
    context: np.ndarray
    total: np.ndarray
    kinds: np.ndarray

    @staticmethod
    def of(gram: np.ndarray, context: np.ndarray, weight: np.ndarray) -> Counts:
        g, first, inverse = np.unique(gram, return_index=True, return_inverse=True)
        n = np.bincount(inverse, weight, len(g))
        c, cinv = np.unique(context[first], return_inverse=True)
        return Counts(
            g, n.astype(np.float32), c, np.bincount(cinv, n, len(c)).astype(np.float32), np.bincount(cinv, minlength=len(c)).astype(np.float32),
        )

    def smooth(self, gram: np.ndarray, context: np.ndarray, below: np.ndarray) -> np.ndarray:
        if not len(self.gram):
            return below
        a = np.minimum(np.searchsorted(self.gram, gram), len(self.gram) - 1)
        n = np.where(self.gram[a] == gram, self.n[a], 0.0)
        b = np.minimum(np.searchsorted(self.context, context), len(self.context) - 1)
        seen = self.context[b] == context
        total = np.where(seen, self.total[b], 1.0)
        d = np.minimum(DISCOUNT, n)
        return np.where(seen, (n - d) / total + DISCOUNT * np.minimum(self.kinds[b], total / DISCOUNT) / total * below, below)


def _counted(x: np.ndarray, pos: np.ndarray, weight: np.ndarray, n: int, order: int) -> Counts:
    """Of order n: weighted at the highest order, kinds of preceding bytes below it. Position 0 is the edge mark."""
    at = np.flatnonzero(pos > 0)
    gram, before = gram_key(x, pos, n), gram_key(x, pos, n - 1)
    gram, context = gram[at], before[at - 1]
    if n < order:
        _, first = np.unique(gram_key(x, pos, n + 1)[at], return_index=True)
        return Counts.of(gram[first], context[first], np.ones(len(first)))
    return Counts.of(gram, context, weight[at])


@dataclass
class Model:
    shared: list[Counts] = field(default_factory=list)
    own: list[list[Counts]] = field(default_factory=list)
    #: Pairs of words: over both classes, of ordinary documents, of toxic ones.
    pairs: list[Counts] = field(default_factory=list)
    order: int = ORDER
    weights: np.ndarray | None = None
    cache: dict = field(default_factory=dict)

    def logs(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """log P(word | ordinary) and log P(word | toxic) of each word."""
        if not len(start):
            return np.zeros((0, 2))
        x, pos, word = strands(buf, start, end)
        at = np.flatnonzero(pos > 0)
        keys = [gram_key(x, pos, n) for n in range(self.order + 1)]

        def pair(n: int) -> tuple[np.ndarray, np.ndarray]:
            return keys[n][at], keys[n - 1][at - 1]

        base = np.full(len(at), 1 / 256)
        for n, counts in enumerate(self.shared, 1):
            base = counts.smooth(*pair(n), base)
        out = []
        for own in self.own:
            q = base
            for n, counts in enumerate(own, len(self.shared) + 1):
                q = counts.smooth(*pair(n), q)
            out.append(np.bincount(word[at], np.log(np.maximum(q, 1e-30)), len(start)))
        return np.stack(out, 1)

    def _cached(self, h: np.ndarray, g: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        keys, others, values = self.cache.get("words", (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros((0, 2))))
        if len(keys) + len(h) > CACHE:
            keys, others, values = keys[:0], others[:0], values[:0]
        k = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
        known = (keys[k] == h) & (others[k] == g) if len(keys) else np.zeros(len(h), bool)
        out = np.zeros((len(h), 2))
        out[known] = values[k[known]] if known.any() else 0
        new = ~known
        if new.any():
            out[new] = self.logs(buf, start[new], end[new])
            keys, others, values = np.concatenate([keys, h[new]]), np.concatenate([others, g[new]]), np.concatenate([values, out[new]])
            order = np.argsort(keys, kind="stable")
            self.cache["words"] = (keys[order], others[order], values[order])
        return out

    def rows(self, column: pa.Array) -> np.ndarray:
        """What describes each row: 1, the mean ratio by word, the mean of its highest few kinds of words, the highest
        one, the roots of the numbers of kinds with a high ratio, per word, the mean ratio in context, and the mean of
        its highest few kinds of pairs."""
        buf, start, end, first = split_words(column)
        n = len(first) - 1
        out = np.zeros((n, FEATURES))
        out[:, 0] = 1
        if not len(start):
            return out
        at, number = tx.distinct(buf, start, end)
        h, g = tx.word_keys(buf, start[at], end[at])
        logs = self._cached(h, g, buf, start[at], end[at])
        row = np.repeat(np.arange(n), np.diff(first))
        r = (logs[:, 1] - logs[:, 0])[number]
        count = np.maximum(np.bincount(row, minlength=n), 1)
        out[:, 1] = np.bincount(row, r, n) / count
        ro, rr = _kinds(row, r, number)
        place = np.arange(len(ro)) - np.searchsorted(ro, np.arange(n))[ro]
        best, one = place < TOPS, place == 0
        out[:, 2] = np.bincount(ro[best], np.clip(rr[best], -2, 12), n) / TOPS
        out[ro[one], 3] = np.clip(rr[one], -2, 12)
        for j, least in enumerate((2, 3, 4), 4):
            out[:, j] = 10 * np.sqrt(np.bincount(ro, rr > least, n) / count)
        pair, context = pair_keys(h[number], g[number], row)
        known, ratio = self._in_context(pair, context, logs[number])
        inside = r.copy()
        inside[known] = ratio
        out[:, 7] = np.bincount(row, inside, n) / count
        ro, rr = _kinds(row[known], ratio, pair[known])
        best = np.arange(len(ro)) - np.searchsorted(ro, np.arange(n))[ro] < TOPS
        out[:, 8] = np.bincount(ro[best], np.clip(rr[best], -2, 12), n) / TOPS
        return out

    def _in_context(self, pair: np.ndarray, context: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which pairs are counted, log P(word | before, toxic) - log P(word | before, ordinary) of those)."""
        if not self.pairs or not len(self.pairs[0].gram):
            return np.zeros(0, np.int64), np.zeros(0)
        grams = self.pairs[0].gram
        known = np.flatnonzero(grams[np.minimum(np.searchsorted(grams, pair), len(grams) - 1)] == pair)
        kinds, at, number = np.unique(pair[known], return_index=True, return_inverse=True)
        before = context[known][at]
        p = []
        for label in (0, 1):
            below = self.pairs[0].smooth(kinds, before, np.exp(logs[known][at][:, label]))
            p.append(np.log(np.maximum(self.pairs[1 + label].smooth(kinds, before, below), 1e-30)))
        return known, (p[1] - p[0])[number]

    def score(self, column: pa.Array) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(column))
        return 1 / (1 + np.exp(-np.clip(self.rows(column) @ self.weights, -30, 30)))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}


def _kinds(row: np.ndarray, value: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of each row's kinds once, by falling value within the row."""
    order = np.lexsort((kind, -value, row))
    row, value, kind = row[order], value[order], kind[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (kind[1:] != kind[:-1])
    return row[new], value[new]


def tally(column: pa.Array, group: np.ndarray) -> tuple[
    tuple[list[bytes], np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray],
]:
    """((words, group, documents), (pairs, contexts, group, documents)): how many documents of each group hold a word
    or pair; a document counts once, as repeats tell of one author only."""
    buf, start, end, first = split_words(column)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at, number = tx.distinct(buf, start, end)
    h, g = tx.word_keys(buf, start[at], end[at])

    def once(kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(one place, group, documents) of each kind and group."""
        kinds = int(kind.max()) + 1 if len(kind) else 1
        _, place = np.unique(row * kinds + kind, return_index=True)
        both, some, docs = np.unique(group[row[place]] * kinds + kind[place], return_index=True, return_counts=True)
        return place[some], both // kinds, docs

    place, own, docs = once(number)
    words = [bytes(buf[a:b]) for a, b in zip(start[place].tolist(), end[place].tolist(), strict=True)]
    pair, context = pair_keys(h[number], g[number], row)
    spot, whose, many = once(np.unique(pair, return_inverse=True)[1])
    return (words, own, docs), (pair[spot], context[spot], whose, many)


def counted(words: list[bytes], docs: np.ndarray, pairs: tuple[np.ndarray, np.ndarray, np.ndarray], order: int = ORDER) -> Model:
    """A model from words with the documents of each class (row 0 ordinary, row 1 toxic) that hold them, and from
    (pairs, contexts, documents of each class)."""
    model = Model(order=order)
    size = np.array([len(w) for w in words], np.int64)
    buf, end = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size)
    parts = []
    for n in docs:
        own = np.flatnonzero(n)
        x, pos, word = strands(buf, (end - size)[own], end[own])
        parts.append((x, pos, n[own][word].astype(np.float32)))
    joint = [np.concatenate([a, b]) for a, b in zip(*parts, strict=True)]
    model.shared = [_counted(*joint, n, order) for n in range(1, SHARED + 1)]
    model.own = [[_counted(*p, n, order) for n in range(SHARED + 1, order + 1)] for p in parts]
    gram, context, n = pairs
    model.pairs = [Counts.of(gram[w > 0], context[w > 0], w[w > 0]) for w in (n.sum(0), n[0], n[1])]
    return model


def count(texts: list[str], labels: np.ndarray, order: int = ORDER) -> Model:
    """A model of a few texts at hand."""
    (words, own, docs), (gram, context, whose, many) = tally(pa.array(texts, pa.string()), np.asarray(labels))
    return counted(
        words, np.stack([np.where(own == y, docs, 0) for y in (0, 1)]), (gram, context, np.stack([np.where(whose == y, many, 0) for y in (0, 1)])),
        order,
    )


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; column 0 is the constant and is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * (p * (1 - p) + 1e-9))[:, None]).T @ x + np.diag(shrink), x.T @ (weight * (y - p)) - shrink * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> tuple[DataFrame, float] | None:
    """(text, toxic, fold of the rows to learn from; share of toxic rows among all labelled ones)."""
    marks = ut.only(labels, doc_id="long", toxic="int").dropna().groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic in (0, 1)")
    total = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(total) < 2:
        return None
    pick = lambda label: marks.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows // 2)
    chosen = pick(0).unionByName(pick(1))
    rows = ut.only(docs, doc_id="long", text="string").join(F.broadcast(chosen), "doc_id").where("text is not null").dropDuplicates(["doc_id"])
    rows = (
        rows.select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int").alias("fold"))
        .repartition(ut.shuffle_parts(docs.sparkSession))
    )
    return ut.materialize(rows, "sample"), total[1] / (total[0] + total[1])


def _summed(rows: DataFrame, pairs: bool) -> pa.Table:
    """Documents of each toxic + 2 * fold that hold a word, or a pair found in two or more."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, _, _ in tx.pieces(batch, "text"):
            group = part.column("toxic").to_numpy() + 2 * part.column("fold").to_numpy()
            (words, own, docs), (gram, context, whose, many) = tally(part.column("text"), group)
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), pa.array(whose, pa.int32()), pa.array(many, pa.int64())],
                    ["gram", "context", "own", "n"],
                )
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.binary()), pa.array(own, pa.int32()), pa.array(docs, pa.int64())], ["word", "own", "n"],
                )

    key = ["gram", "context"] if pairs else ["word"]
    found = ut.map_batches(rows, run, "gram long, context long, own int, n long" if pairs else "word binary, own int, n long")
    each = [F.sum(F.when(F.col("own") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)]
    found = found.groupBy(*key).agg(*each, F.sum("n").alias("n"))
    return (found.where("n > 1") if pairs else found).drop("n").orderBy(*key).toArrow()


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model whose curve is fitted on rows that the counts behind their scores had not seen (two folds)."""
    found = _sample(docs, labels, sample_rows)
    if found is None:
        return Model()
    rows, toxic_share = found
    words, pairs = _summed(rows, False), _summed(rows, True)
    names = words.column("word").to_pylist()
    keys = [pairs.column(c).to_numpy().view(np.uint64) for c in ("gram", "context")]
    by_word, by_pair = (np.stack([t.column(f"n{k}").to_numpy() for k in range(4)]) for t in (words, pairs))

    def model(*folds: int) -> Model:
        here = lambda n: np.stack([sum(n[y + 2 * f] for f in folds) for y in (0, 1)])
        return counted(names, here(by_word), (*keys, here(by_pair)))

    halves = [model(1), model(0)]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, _, _ in tx.pieces(batch, "text"):
            fold = part.column("fold").to_numpy()
            for f in (0, 1):
                own = np.flatnonzero(fold == f)
                if len(own):
                    x = halves[f].rows(part.column("text").take(pa.array(own)))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("toxic").take(pa.array(own)), *(pa.array(x[:, k]) for k in range(FEATURES))],
                        ["toxic", *(f"x{k}" for k in range(FEATURES))],
                    )

    names_x = [f"x{k}" for k in range(FEATURES)]
    seen = ut.map_batches(rows, run, "toxic int, " + ", ".join(f"{c} double" for c in names_x)).orderBy("toxic", *names_x).toArrow()
    y = seen.column("toxic").to_numpy()
    out = model(0, 1)
    if len(set(y.tolist())) < 2:
        return Model()
    x = np.stack([seen.column(c).to_numpy() for c in names_x], 1)
    out.weights = logistic(x, y.astype(float), np.where(y == 1, toxic_share / y.mean(), (1 - toxic_share) / (1 - y.mean())))
    return out


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, _, _ in tx.pieces(batch, "text"):
            column = pc.fill_null(part.column("text"), "")
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(column))], ["doc_id", "score"])

    return ut.map_batches(ut.only(docs, doc_id="long", text="string"), run, "doc_id long, score double")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = ut.table(spark, sf_dir, "documents"), ut.table(spark, sf_dir, "labels")
    out = held_out(F.col("doc_id"), 3, 1)
    return (
        toxicity(docs, fit(docs.where(~out), labels.where(~out)))
        .select("doc_id", out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
    )
