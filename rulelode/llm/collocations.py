"""Phrase collocations: merged count-min sketches, exact counts of what they let through, scores, subsumption.

Method. Texts are cut into pieces at punctuation and line ends and into words inside them; phrases of 1 to 3 words are
counted for each language. The first pass counts them in count-min sketches: ROWS rows of cells, a phrase falls into
one cell of each row, and the sketches of all tasks are added up cell by cell. A cell is never less than a phrase's
count, so what has `least` occurrences is over the bound in all rows. The second pass counts exactly, and only the
phrases that the bits "cell >= least" let through, and whose parts they let through as well. Nothing frequent is lost;
what gets through by colliding is dropped by its exact count.

Scale. A task sends the cells it has touched, sorted, in blocks of 65,536 cells; a block is added up as a stream.
Only bits go to the driver and from there to the tasks: at most ROWS * most_width / 8 bytes (32 MB), whatever the
corpus. The width follows the size of the texts up to most_width; beyond that the sketch lets more phrases through,
which costs shuffle and changes no result: raise most_width where executors have the memory. Counts are combined in
each task before they are shuffled. The rows of a language never meet in one task: ranks come from the best `top` of
SALTS parts of it. A text of any length is worked off in blocks of words.

Edges. A null lang is `und`, a null text empty. Repeated rows count as often as they stand. Empty tables give no rows.
Columns other than lang and text are not read. Ties go to the smaller phrase in UTF-8 byte order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulelode.llm import _text as tx
from rulelode.llm import _util as ut

LEAST = 10
LONGEST = 3
TOP = 2000
#: A candidate goes where 100 * f(longer) >= SUBSUMED * f(candidate).
SUBSUMED = 50
ROWS = 2
LEAST_WIDTH, MOST_WIDTH = 1 << 16, 1 << 27
SALTS = 16
#: Words that are numbered at once; three such numbers fit into 63 bits.
WORDS = 1 << 19
#: Touched cells that a task holds before it sends them.
HELD = 1 << 20
_BLOCK = 1 << 16
_U = np.uint64

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False
_PLACES = tuple(_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Phrases:
    """The distinct phrases of a stretch of words: numbers of their words, language, count and hash."""

    def __init__(self, raw: bytes, start: np.ndarray, end: np.ndarray, ids: np.ndarray, some: np.ndarray, hashes: np.ndarray, joined: np.ndarray, starts: int):
        self.raw, self.start, self.end, self.some = raw, start, end, some
        size = len(some)
        self.words: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.hashes: list[np.ndarray] = []
        self.total = np.bincount(ids[:starts], minlength=size)
        key = ids.astype(np.int64)
        fits = np.arange(len(ids)) < starts
        for k in range(1, LONGEST + 1):
            if k > 1:
                # A phrase goes on where the word before is followed by this one in the same piece.
                fits = fits[:-1] & joined[k - 2 : len(ids) - 1]
                key = key[:-1] * size + ids[k - 1 :]
            found, count = np.unique(key[fits], return_counts=True)
            places = np.empty((k, len(found)), np.int64)
            rest = found
            for i in range(k - 1, -1, -1):
                places[i] = rest % size
                rest = rest // size
            h = np.zeros(len(found), _U)
            for i in range(k):
                h = tx.mix(h + hashes[places[i]] * _PLACES[i])
            self.words.append(places)
            self.counts.append(count)
            self.hashes.append(h)

    def text(self, word: int) -> bytes:
        i = self.some[word]
        return self.raw[self.start[i] : self.end[i]]


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[Phrases, np.ndarray, list]]:
    """Phrases of a batch of (lang, text) by stretches of words, with the language number of each word number."""
    for part, buf, offs in tx.pieces(batch, "text", 1 << 21):
        langs = part.column("lang").dictionary_encode()
        names, lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        low = tx.lower(buf)
        start, end = tx.runs(_WORD, low, offs)
        if not len(start):
            continue
        row = np.searchsorted(offs, start, "right") - 1
        broken = np.zeros(len(start), bool)
        for lo in range(0, len(start), WORDS):
            hi = min(lo + WORDS, len(start) - 1)
            a, b = int(end[lo]), int(start[hi])
            before = np.concatenate([[0], np.cumsum(_BREAK[low[a:b]], dtype=np.int64)])
            broken[lo:hi] = before[start[lo + 1 : hi + 1] - a] != before[end[lo:hi] - a]
        joined = (row[1:] == row[:-1]) & ~broken[:-1]
        for lo in range(0, len(start), WORDS):
            hi = min(lo + WORDS + LONGEST - 1, len(start))
            s, e = start[lo:hi], end[lo:hi]
            at, to = int(s[0]), int(e[-1])
            own, s, e = low[at:to], s - at, e - at
            some, ids = tx.distinct(own, s, e)
            # A word of two languages is two words: a phrase's words then tell its language.
            pair, first, ids = np.unique(lang[row[lo:hi]].astype(np.int64) * len(some) + ids, return_index=True, return_inverse=True)
            tongue = pair // len(some)
            salt = np.array([int.from_bytes(tx.digests(x, np.array([0]), np.array([len(x)]))[0, 0].tobytes(), "little") for x in (n.encode() for n in names)], _U)
            hashes = tx.word_keys(own, s[first], e[first])[0] + salt[tongue]
            yield Phrases(own.tobytes(), s, e, ids, first, hashes, joined[lo : hi - 1], min(WORDS, len(start) - lo)), tongue, names


def _cells(h: np.ndarray, row: int, width: int) -> np.ndarray:
    return (tx.mix(h + _U(row) * _PLACES[0]) & _U(width - 1)).astype(np.int64)


def _blocks(cells: list[np.ndarray], counts: list[np.ndarray], row: int, width: int) -> Iterator[pa.RecordBatch]:
    found, inverse = np.unique(np.concatenate(cells), return_inverse=True)
    total = np.minimum(np.bincount(inverse, np.concatenate(counts), len(found)), 255).astype(np.uint8)
    edges = np.flatnonzero(np.concatenate([[True], found[1:] // _BLOCK != found[:-1] // _BLOCK, [True]]))
    part = found[edges[:-1]] // _BLOCK + row * (width // _BLOCK)
    place = (found % _BLOCK).astype("<u2")
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(part, pa.int32()), pa.array([place[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()),
            pa.array([total[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()),
        ],
        ["part", "cells", "counts"],
    )


def sketch_bits(docs: DataFrame, width: int, least: int = LEAST) -> np.ndarray:
    """The merged sketch of the phrases of (lang, text), as bits: one row of `width` bits for each of ROWS, set where
    the cell's count is `least` or more. Counts end at 255, so least may not be greater."""
    if not 1 <= least <= 255:
        raise ValueError("least must be from 1 to 255")

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], []]
        size = 0
        for batch in batches:
            for phrases, _, _ in _stretches(batch):
                for h, c in zip(phrases.hashes, phrases.counts, strict=True):
                    held[0].append(h)
                    held[1].append(c)
                    size += len(h)
                if size >= HELD:
                    for row in range(ROWS):
                        yield from _blocks([_cells(h, row, width) for h in held[0]], held[1], row, width)
                    held, size = [[], []], 0
        if size:
            for row in range(ROWS):
                yield from _blocks([_cells(h, row, width) for h in held[0]], held[1], row, width)

    def bits(part: int, sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(sums >= least).tobytes()], pa.binary())], ["part", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(_BLOCK, np.uint16)
        for batch in batches:
            for part, cells, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "cells", "counts")), strict=True):
                if part != now:
                    if now is not None:
                        yield bits(now, sums)
                    now, sums = part, np.zeros(_BLOCK, np.uint16)
                at = np.frombuffer(cells, "<u2")
                sums[at] = np.minimum(sums[at] + np.frombuffer(counts, np.uint8), 255)
        if now is not None:
            yield bits(now, sums)

    blocks = docs.mapInArrow(touched, "part int, cells binary, counts binary").repartition("part").sortWithinPartitions("part")
    out = np.zeros(ROWS * width // 8, np.uint8)
    for r in blocks.mapInArrow(merge, "part int, bits binary").toLocalIterator():
        out[r["part"] * _BLOCK // 8 : (r["part"] + 1) * _BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(ROWS, width // 8)


def _through(bits: np.ndarray, h: np.ndarray, width: int) -> np.ndarray:
    ok = np.ones(len(h), bool)
    for row in range(ROWS):
        cell = _cells(h, row, width)
        ok &= (bits[row][cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return ok


def phrase_counts(docs: DataFrame, least: int = LEAST, most_width: int = MOST_WIDTH) -> DataFrame:
    """(lang, size, phrase, f): exact counts of all phrases of 1 to 3 words with f >= least, and of all words of a
    language together as size 0 with an empty phrase. A table of the shared folder."""
    spark = docs.sparkSession
    own = ut.only(docs, lang="string", text="string").select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    amount = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = min(max(LEAST_WIDTH, 1 << max(amount // 4, 1).bit_length()), most_width)
    known = spark.sparkContext.broadcast(sketch_bits(own, width, least).tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(known.value, np.uint8).reshape(ROWS, width // 8)
        for batch in batches:
            for p, tongue, names in _stretches(batch):
                passed: dict[tuple, np.ndarray] = {}
                one = _through(bits, p.hashes[0], width)
                in_one = np.zeros(len(p.some), bool)
                in_one[p.words[0][0][one]] = True
                two = _through(bits, p.hashes[1], width) & in_one[p.words[1][0]] & in_one[p.words[1][1]]
                pairs = p.words[1][0] * len(p.some) + p.words[1][1]
                pairs = pairs[two]
                three = _through(bits, p.hashes[2], width)
                for a, b in ((0, 1), (1, 2)):
                    three &= np.isin(p.words[2][a] * len(p.some) + p.words[2][b], pairs)
                passed = {1: one, 2: two, 3: three}
                texts: dict[int, bytes] = {}
                for k, ok in passed.items():
                    words = [w[ok].tolist() for w in p.words[k - 1]]
                    for w in set().union(*words) - texts.keys():
                        texts[w] = p.text(w)
                    phrase = [b" ".join([texts[w] for w in ws]) for ws in zip(*words, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([names[t] for t in tongue[words[0]].tolist()] if words[0] else [], pa.string()), pa.array([k] * len(phrase), pa.int32()),
                            pa.array(phrase, pa.binary()).cast(pa.string()), pa.array(p.counts[k - 1][ok], pa.int64()),
                        ],
                        ["lang", "size", "phrase", "f"],
                    )
                sums = np.bincount(tongue, p.total, len(names)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array([0] * len(names), pa.int32()), pa.array([""] * len(names), pa.string()), pa.array(sums)], ["lang", "size", "phrase", "f"],
                )

    rows = own.mapInArrow(count, "lang string, size int, phrase string, f long")
    summed = rows.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return ut.materialize(summed.where((F.col("f") >= least) | (F.col("size") == 0)), "phrases")


def scored(counts: DataFrame, subsumed: int = SUBSUMED) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one subsumes, from phrase_counts' table.

    Each candidate looks up its parts, and tells its parts how frequent it is; both meet in one group per candidate.
    """
    words = F.split("phrase", " ")
    grams = counts.where("size > 1").withColumn("w", words)

    def joined(a: int, b: int | None = None):
        return F.array_join(F.slice("w", a, 1 if b is None else b - a + 1), " ")

    def look(slot: str, part) -> object:
        return F.struct(F.lit(slot).alias("slot"), part.alias("part"))

    pair = F.array(look("l1", joined(1)), look("r1", joined(2)))
    triple = F.array(look("l1", joined(1)), look("r1", joined(2, 3)), look("l2", joined(1, 2)), look("r2", joined(3)))
    asked = grams.select("lang", "phrase", F.inline(F.when(F.col("size") == 2, pair).otherwise(triple)))
    known = counts.where("size > 0").select("lang", F.col("phrase").alias("part"), "f")
    found = asked.join(known, ["lang", "part"]).select("lang", "phrase", "slot", "f")
    own = grams.select("lang", "phrase", F.lit("a").alias("slot"), "f")
    longer = grams.where("size = 3").select("lang", F.explode(F.array_distinct(F.array(joined(1, 2), joined(2, 3)))).alias("phrase"), F.lit("longer").alias("slot"), "f")
    slots = {s: F.max(F.when(F.col("slot") == s, F.col("f"))).alias(s) for s in ("a", "l1", "r1", "l2", "r2", "longer")}
    rows = found.unionByName(own).unionByName(longer).groupBy("lang", "phrase").agg(*slots.values())
    rows = rows.where("longer is null or cast(100 as decimal(20,0)) * longer < cast(a as decimal(20,0)) * " + str(int(subsumed)))
    # a <= l, r, so a score is at most 1,000,000; the products have up to 38 digits.
    cut = "cast(cast(1000000 as decimal(7,0)) * (cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast({0} as decimal(15,0)) * cast({1} as decimal(15,0))) as bigint)"
    rows = rows.withColumn("s1", F.expr(cut.format("l1", "r1"))).withColumn("s2", F.when(F.col("l2").isNotNull(), F.expr(cut.format("l2", "r2"))))
    second = F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))
    return rows.select(
        "lang", "phrase", "a", F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"), F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.when(second, F.col("s2")).otherwise(F.col("s1")).alias("score"),
    )


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, subsumed: int = SUBSUMED, most_width: int = MOST_WIDTH) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first `top` collocations of (lang, text)."""
    counts = phrase_counts(docs, least, most_width)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = scored(counts, subsumed).withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    best = rows.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_at") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language of all documents."""
    return collocations(ut.table(spark, sf_dir, "documents"))


#: Every phrase counted, joined and ranked in full.
SQL = r"""
with t as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as x from documents),
 p as (select lang, unnest(string_split_regex(x, '[.,;:!?\x0A-\x0D]')) as x from t),
 w as (select lang, regexp_extract_all(x, '[^\x20\x09]+') as ws from p),
 n as (select lang, sum(len(ws))::bigint as n from w group by lang),
 g as (select lang, k, array_to_string(ws[i : i + k - 1], ' ') as x, count(*) as f from (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from w, (values (1), (2), (3)) as v(k)) group by all having count(*) >= 10),
 h as (select lang, k, x, f, string_split(x, ' ') as ws from g where k > 1),
 q as (select lang, x, f as a, c.k as cut, array_to_string(ws[1 : c.k], ' ') as lx, array_to_string(ws[c.k + 1 : h.k], ' ') as rx from h join (values (1), (2)) as c(k) on c.k < h.k),
 c as (select q.*, l.f as l, r.f as r, (1000000::hugeint * a * a) // (l.f::hugeint * r.f) as score from q join g l on l.lang = q.lang and l.x = lx join g r on r.lang = q.lang and r.x = rx),
 b as (select * from c qualify row_number() over (partition by lang, x order by score, cut) = 1),
 m as (select lang, x, max(f) as f from (select lang, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) as x, f from h where k = 3) group by all),
 k as (select b.lang, b.x as phrase, a, l, r, score::bigint as score from b left join m on m.lang = b.lang and m.x = b.x where m.f is null or 100 * m.f < 50 * a)
select lang, rank, phrase, a, l, r, n, score from (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from k) join n using (lang) where rank <= 2000
"""
