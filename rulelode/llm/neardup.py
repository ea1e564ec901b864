"""Near duplicates by HyperMinHash sketches, banding and exact verification.

A document's set holds its distinct five-word shingles. The sketch deals the hashed shingles over REGISTERS buckets
and keeps, of each bucket's least value, the number of leading zeros (6 bits) and the MANTISSA bits after the first
one: two bytes a register. Four registers make a band of 64 bits; documents that share a band are candidates if
the Jaccard estimate from equal registers, corrected for registers that agree by chance, is not below the threshold
by more than SIGMAS standard errors. The threshold is a parameter in percent: 85 for the operator, 80 for the
pipeline's stage. The number of bands follows from it, so that a pair at the threshold shares none with probability
under MISS: 20 bands at 85, 27 at 80. Candidates are only grouped by the sketches; links are decided on the full sets.

Scale: equal sets are one class and take part once, so copies cost nothing. In a band, documents are compared with
leaders, those unlike every leader before them, and only edges that join something are kept. Bands of more than
`crowd` sets, brought about by a passage that very many documents share, say little; their sets meet by their rarest
shingles instead, which is exact too. Any meeting place of more than `crowd` sets is dealt into blocks and every
pair of blocks is a task. Candidate edges are verified first: the set in the middle of a star meets the others one by
one, in tasks of at most STAR_SHINGLES members, which is linear in the edges. A family of near copies that these
links join, however large, is done. In other groups every set outside the largest part found meets all sets of the
group: blocks of about GROUP_SHINGLES members of the former, of STAR_SHINGLES of the latter, so nothing is dropped and
no task grows with its group.

Shingles are told apart by 128 bits, made from their words' bytes or cryptographic digests; sets by a digest of all
of these; rows by a SHA-256 of doc_id and text. A very long text is walked in parts: memory goes with its words.

Defined results: texts without words have an empty set and link with nothing; null doc_ids are never a component's
name while others are in it; rows equal in doc_id and text get one result; extra columns are ignored by
`components` and kept by `deduplicate`; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulelode.llm import _text as tx
from rulelode.llm import _util as ut

REGISTERS = 80
BAND = 4
MANTISSA = 10
#: Thresholds of op2_near_dedup and of `components` and the pipeline's stage.
PERCENT = 85
STAGE_PERCENT = 80
MISS = 1e-6
SIGMAS = 5.0
ABSORB = 0.92
GROUP_SHINGLES = 4_000_000
STAR_SHINGLES = 250_000
#: Sets in a band above which it is left to the rarest shingles of its sets, and sets in a block.
CROWD = 5_000
EMPTY = 0xFFFF


def width(percent: int) -> int:
    """Registers of a sketch for this threshold."""
    return max(REGISTERS, BAND * math.ceil(math.log(MISS) / math.log1p(-((min(percent, 99) / 100) ** BAND))))


def registers(h: np.ndarray, count: int = REGISTERS) -> np.ndarray:
    """The sketch of one set of hashes."""
    out = np.full(count, EMPTY, np.uint16)
    if len(h):
        bucket = ((tx.mix(h ^ tx.U(0x2545F4914F6CDD1D)) >> tx.U(32)) * tx.U(count) >> tx.U(32)).astype(np.int64)
        least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, bucket, tx.mix(h + tx.U(0x632BE59BD9B4E019)) >> tx.U(1))
        used = np.unique(bucket)
        v = least[used]
        _, e = np.frexp((v >> tx.U(11)).astype(np.float64))
        zeros = np.minimum(53 - e, 62)
        rest = v << (zeros + 1).astype(np.uint64)
        out[used] = (zeros.astype(np.uint64) << tx.U(MANTISSA) | rest >> tx.U(64 - MANTISSA)).astype(np.uint16)
    return out


@functools.lru_cache(4096)
def _zeros(items: int) -> np.ndarray:
    """Probabilities of the numbers of leading zeros of the least of so many values."""
    p = 1 - (1 - 0.5 ** np.arange(64)) ** max(items, 1)
    return p[:-1] - p[1:]


def chance(a: int, b: int, count: int = REGISTERS) -> float:
    """How often registers of sets of these sizes agree although nothing is shared."""
    return float(_zeros(1 << max(a // count, 1).bit_length() - 1) @ _zeros(1 << max(b // count, 1).bit_length() - 1)) / (1 << MANTISSA)


def estimate(x: np.ndarray, n: int, others: np.ndarray, sizes: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimates, standard errors at the threshold) of a sketch against others."""
    some = (others != EMPTY) | (x != EMPTY)
    valid = np.maximum(some.sum(1), 1)
    same = ((others == x) & some).sum(1)
    c = chance(n, int(sizes[0]), len(x)) if len(sizes) == 1 else np.array([chance(n, int(m), len(x)) for m in sizes.tolist()])
    t = percent / 100
    return np.maximum(0, (same / valid - c) / (1 - c)), np.sqrt(t * (1 - t) / valid)


def _sets(buf: np.ndarray, offs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The set of each row, as its shingles' two keys in order."""
    h, g, first = tx.shingles(buf, offs)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        yield tx.members(h[a:b], g[a:b])


def sketches(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, rk (the row's key), n_shingles, digest (of both keys of all shingles of the set), sketch."""
    count = width(percent)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in tx.pieces(batch, "text"):
            n, key, sketch = [], [], []
            for h, g in _sets(buf, offs):
                n.append(len(h))
                key.append(hashlib.blake2b(np.concatenate([h, g]).tobytes(), digest_size=16).digest())
                sketch.append(registers(h, count).tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("rk"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sketch, pa.binary())],
                ["doc_id", "rk", "n_shingles", "digest", "sketch"],
            )

    return ut.map_batches(ut.keyed(docs), run, "doc_id long, rk binary, n_shingles long, digest binary, sketch binary")


def _bands(classes: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            s = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint16).reshape(part.num_rows, -1, BAND)
            some = (s != EMPTY).any(2)
            packed = np.zeros(some.shape, np.uint64)
            for k in range(BAND):
                packed = packed << tx.U(16) | s[:, :, k].astype(np.uint64)
            key = tx.mix(packed + np.arange(1, some.shape[1] + 1, dtype=np.uint64) * tx.U(0x9FB21C651E98DF25)).astype(np.int64)
            row, _ = np.nonzero(some)
            yield pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(part.column("k1").to_numpy()[row])], ["band", "k1"])

    return ut.map_batches(classes.select("k1", "sketch"), run, "band long, k1 long")


class _Leaders:
    """Documents of a band that no earlier leader resembles, and which of them edges have joined."""

    def __init__(self, percent: int) -> None:
        self.ids, self.root, self.n, self.percent = [], [], 0, percent
        self.sketch, self.size = np.empty((4, width(percent)), np.uint16), np.empty(4, np.int64)

    def meet(self, ident: int, sketch: np.ndarray, size: int) -> list[tuple[int, int]]:
        edges, top = [], 0.0
        if self.n:
            j, error = estimate(sketch, size, self.sketch[: self.n], self.size[: self.n], self.percent)
            near = np.flatnonzero(j >= self.percent / 100 - SIGMAS * error)
            top = float(j.max())
            roots = {self._find(i): i for i in reversed(near.tolist())}
            edges = [(self.ids[i], ident) for i in roots.values()]
            target = min(roots, default=-1)
            for r in roots:
                self.root[r] = target
        else:
            target = -1
        if top < ABSORB:
            if self.n == len(self.size):
                self.sketch, self.size = np.concatenate([self.sketch, self.sketch]), np.concatenate([self.size, self.size])
            self.sketch[self.n], self.size[self.n] = sketch, size
            self.ids.append(ident)
            self.root.append(target if target >= 0 else self.n)
            self.n += 1
        return edges

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i


def _prefixes(docs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """(band, k1) by rare shingles of the members (k1, rk, n_shingles), an exact way where bands are crowded.

    Sets with 100 * intersection >= percent * union share one of the first n - ceil(percent * n / 100) + 1 shingles
    of each, whatever order all sets have; here the rarest come first, so that what very many documents hold, a line
    or a passage, brings none of them together.
    """
    texts = ut.keyed(docs).select("rk", "text").hint("merge").join(members.select("rk", "k1", "n_shingles"), "rk").select("k1", "n_shingles", "text")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in tx.pieces(batch, "text"):
            sets = [h for h, _ in _sets(buf, offs)]
            row = pa.array(np.repeat(np.arange(part.num_rows), [len(s) for s in sets]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)), part.column("k1").take(row),
                    part.column("n_shingles").take(row),
                ],
                ["band", "k1", "n"],
            )

    rows = ut.materialize(ut.map_batches(texts, run, "band long, k1 long, n long"), "shingles")
    counts = ut.materialize(rows.groupBy("band").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "counts")
    place = F.row_number().over(Window.partitionBy("k1").orderBy("m", "band"))
    # Shingles of one set alone are first in its order; they bring it together with none, but take up places.
    shared = rows.join(counts, "band").withColumn("alone", F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("k1")))
    last = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    return shared.withColumn("place", place + F.col("alone")).where(F.col("place") <= last).select("band", "k1", "m")


def candidate_edges(classes: DataFrame, docs: DataFrame, percent: int = PERCENT, crowd: int = CROWD) -> DataFrame:
    """(src, dst) of sets whose sketches are close, enough edges to join every group of them.

    Bands of more than `crowd` sets are left to the rarest shingles of their sets. Whatever brings sets together, a
    task compares two blocks of it, of about `crowd` sets each.
    """
    bands = _bands(classes)
    shared = ut.materialize(bands.groupBy("band").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "bands")
    met = bands.join(shared.where(F.col("m") <= crowd), "band")
    if not shared.where(F.col("m") > crowd).isEmpty():
        crowded = ut.materialize(bands.join(shared.where(F.col("m") > crowd).select("band"), "band").select("k1").distinct(), "crowded")
        met = met.unionByName(_prefixes(docs, classes.join(crowded, "k1"), percent))
    blocks = F.ceil(F.col("m") / crowd).cast("int")
    met = met.withColumn("b", F.pmod(F.xxhash64("k1"), blocks).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.select(F.xxhash64("band", F.least("b", "c"), F.greatest("b", "c")).alias("task"), "k1")
    rows = met.join(classes.select("k1", "sketch", "n_shingles"), "k1")
    parts = ut.shuffle_parts(classes.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaders = None, _Leaders(percent)
        for batch in batches:
            task, ids, size = (batch.column(c).to_numpy().tolist() for c in ("task", "k1", "n_shingles"))
            s = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            edges: list[tuple[int, int]] = []
            for i, t in enumerate(task):
                if t != key:
                    key, leaders = t, _Leaders(percent)
                edges += leaders.meet(ids[i], s[i], size[i])
            edges = list(set(edges))
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in edges], pa.int64()), pa.array([b for _, b in edges], pa.int64())], ["src", "dst"],
            )

    return (
        rows.select("task", "k1", "n_shingles", "sketch").repartition(parts, "task").sortWithinPartitions("task", "k1")
        .mapInArrow(run, "src long, dst long").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    )


def link_components(
    sets: list[tuple[np.ndarray, np.ndarray]], percent: int = PERCENT, known: np.ndarray | None = None, probe: np.ndarray | None = None,
) -> np.ndarray:
    """Component (an index of one of its sets, the least without `known`) of each set under links of
    100 * intersection >= percent * union, decided on both keys of all members of the full sets.

    `known` numbers components that are found already; only sets marked in `probe` are compared. Sets outside the
    largest component are compared with all others through an inverted index; a pair of two components has one such
    set, and pairs inside a component need no comparing.
    """
    m = len(sets)
    size = np.array([len(h) for h, _ in sets])
    word = tx.numbered(np.concatenate([h for h, _ in sets]), np.concatenate([g for _, g in sets]))
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(word, kind="stable")
    posting = owner[order]
    begin = np.concatenate([[0], np.cumsum(np.bincount(word))])
    start = np.concatenate([[0], np.cumsum(size)])
    comp = np.arange(m)
    if known is not None:
        _, first, number = np.unique(known, return_index=True, return_inverse=True)
        comp = first[number]
    done = np.zeros(m, bool) if probe is None else ~probe
    fresh = known is None
    while True:
        kinds, counts = np.unique(comp, return_counts=True)
        if len(kinds) == 1:
            break
        todo = np.zeros(1, np.int64) if fresh else np.flatnonzero(~done & (comp != kinds[np.argmax(counts)]))
        fresh = False
        if not len(todo):
            break
        for x in todo[:16].tolist():
            w = word[start[x] : start[x + 1]]
            n = begin[w + 1] - begin[w]
            stop = np.cumsum(n)
            hits = posting[np.repeat(begin[w] - stop + n, n) + np.arange(stop[-1])]
            shared = np.bincount(hits, minlength=m)
            linked = np.flatnonzero(100 * shared >= percent * (size[x] + size - shared))
            done[x] = True
            own = np.unique(comp[linked])
            if len(own) > 1:
                comp[np.isin(comp, own)] = own[0]
    return comp


def _texts(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """rows with the texts of their rk. Always by shuffle: rows grow with the corpus, so no size should change the plan."""
    return rows.join(ut.keyed(docs).select("rk", "text").hint("merge"), "rk")


def _star_links(docs: DataFrame, classes: DataFrame, edges: DataFrame, percent: int) -> DataFrame:
    """(src, dst): the candidate edges that are links. The edges of one set are a star; a task holds the set in the
    middle and meets the others one by one, so a star of any size is dealt into blocks at the cost of its middle."""
    own = classes.select(F.col("k1").alias("dst"), "rk", "n_shingles")
    ends = ut.materialize(edges.join(own, "dst"), "stars")
    blocks = ends.groupBy("src").agg(F.ceil(F.sum("n_shingles") / STAR_SHINGLES).cast("int").alias("blocks"))
    outer = ends.join(blocks, "src").select(
        F.xxhash64("src", F.pmod(F.xxhash64("dst"), F.col("blocks"))).alias("task"), F.lit(1).alias("place"), F.col("dst").alias("k1"), "rk",
    )
    inner = blocks.join(classes.select(F.col("k1").alias("src"), "rk"), "src")
    inner = inner.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    inner = inner.select(F.xxhash64("src", "b").alias("task"), F.lit(0).alias("place"), F.col("src").alias("k1"), "rk")
    parts = ut.shuffle_parts(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, middle, held = None, None, None
        for batch in batches:
            for part, buf, offs in tx.pieces(batch, "text"):
                found: tuple[list, list] = ([], [])
                for own_set, t, place, k in zip(_sets(buf, offs), *(part.column(c).to_pylist() for c in ("task", "place", "k1")), strict=True):
                    if place == 0:
                        task, middle, held = t, k, own_set
                    elif t == task:
                        both = tx.common(held, own_set)
                        if 100 * both >= percent * (len(held[0]) + len(own_set[0]) - both):
                            found[0].append(middle)
                            found[1].append(k)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["src", "dst"])

    rows = _texts(ut.materialize(inner.unionByName(outer), "ends"), docs).select("task", "place", "k1", "text")
    return rows.repartition(parts, "task").sortWithinPartitions("task", "place", "k1").mapInArrow(run, "src long, dst long")


def _verified(docs: DataFrame, classes: DataFrame, edges: DataFrame, percent: int) -> DataFrame:
    """(node, component) over set keys of the groups that candidate edges make, under exact links.

    First the edges themselves are verified, which is linear, and their links make parts. Where all candidate edges
    lie inside parts, that is all. Parts between which edges were no links are a group; there every set outside the
    largest part meets all sets of the group, in blocks.
    """
    linked = ut.materialize(_star_links(docs, classes, edges, percent), "links")
    parted = ut.materialize(ut.connected_components(linked).withColumnRenamed("component", "v"), "parts")
    part_of = lambda side, v: parted.select(F.col("node").alias(side), F.col("v").alias(v))
    between = edges.join(linked, ["src", "dst"], "left_anti").join(part_of("src", "v"), "src", "left").join(part_of("dst", "w"), "dst", "left")
    between = between.select(F.coalesce("v", "src").alias("src"), F.coalesce("w", "dst").alias("dst")).where("src <> dst")
    groups = ut.materialize(ut.connected_components(between).withColumnRenamed("node", "v"), "groups")
    settled = parted.select("node", F.col("v").alias("component"))
    alone = groups.select(F.col("v").alias("node"), "v").join(parted.select("node"), "node", "left_anti")
    known = parted.unionByName(alone).join(groups, "v")
    sizes = known.groupBy("component", "v").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("component").agg(F.max_by("v", F.struct("n", "v")).alias("main"))
    rest = known.join(largest, "component").withColumnRenamed("node", "k1").join(classes.select("k1", "n_shingles", "rk"), "k1")
    rest = ut.materialize(rest.withColumn("out", F.col("v") != F.col("main")), "members")
    if rest.isEmpty():
        return settled
    some = lambda x, size: F.greatest(F.ceil(F.sum(x) / size), F.lit(1)).cast("int")
    few = F.when(F.col("out"), F.col("n_shingles")).otherwise(0)
    blocks = rest.groupBy("component").agg(some("n_shingles", STAR_SHINGLES).alias("all"), some(few, GROUP_SHINGLES).alias("few"))
    dealt = rest.join(blocks, "component")
    place = lambda n: F.pmod(F.xxhash64("k1"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    met = dealt.withColumns({"b": place("all"), "c": each("few"), "probe": F.lit(False)})
    asked = dealt.where("out").withColumns({"b": each("all"), "c": place("few"), "probe": F.lit(True)})
    both = met.unionByName(asked).select(F.xxhash64("component", "b", "c").alias("task"), "k1", "rk", "v", "probe")
    # A set that asks where it is met stands there once.
    both = ut.materialize(both.groupBy("task", "k1", "rk", "v").agg(F.max("probe").alias("probe")), "asked")
    full = _texts(both, docs).select("task", "k1", "v", "probe", "text")
    parts = ut.shuffle_parts(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, sets, marks = None, [], [], []

        def flush() -> tuple[list[int], list[int]]:
            if len(sets) < 2:
                return [], []
            comp = link_components(sets, percent, np.array([v for v, _ in marks]), np.array([p for _, p in marks]))
            parts_met = {(marks[i][0], marks[c][0]) for i, c in enumerate(comp.tolist()) if marks[i][0] != marks[c][0]}
            return [a for a, _ in parts_met], [b for _, b in parts_met]

        for batch in batches:
            out: tuple[list, list] = ([], [])
            for part, buf, offs in tx.pieces(batch, "text"):
                columns = (part.column(c).to_pylist() for c in ("task", "k1", "v", "probe"))
                for own, t, k, v, ask in zip(_sets(buf, offs), *columns, strict=True):
                    if t != task:
                        for column, more in zip(out, flush(), strict=True):
                            column += more
                        task, ids, sets, marks = t, [], [], []
                    if not ids or ids[-1] != k:  # repeated rows follow one another
                        ids.append(k)
                        sets.append(own)
                        marks.append((v, ask))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["src", "dst"])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in flush()], ["src", "dst"])

    found = full.repartition(parts, "task").sortWithinPartitions("task", "k1").mapInArrow(run, "src long, dst long")
    # Links found there join parts: few nodes, named by the parts they lie in.
    found = ut.materialize(found, "found").where("src <> dst")
    more = ut.connected_components(found).withColumnsRenamed({"node": "v", "component": "to"})
    both = settled.withColumnRenamed("component", "v").unionByName(alone).join(more, "v", "left")
    return both.select("node", F.coalesce("to", "v").alias("component"))


def components(docs: DataFrame, percent: int = STAGE_PERCENT, crowd: int = CROWD) -> DataFrame:
    """doc_id, rk, n_shingles, component_id of every row; see the module for what links documents."""
    rows = ut.materialize(sketches(docs, percent), "sketches")
    full = rows.where("n_shingles > 0")
    # The number of a class is drawn as the table is written and read from it ever after.
    classes = (
        full.groupBy("digest")
        .agg(F.min("rk").alias("rk"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.min("doc_id").alias("low"))
    )
    classes = ut.materialize(classes.withColumn("k1", F.monotonically_increasing_id()), "classes")
    own = _verified(docs, classes, ut.materialize(candidate_edges(classes, docs, percent, crowd), "edges"), percent)
    # A class outside every group is its own component.
    named = (
        classes.select("k1", "digest", "low").join(own.withColumnRenamed("node", "k1"), "k1", "left")
        .withColumn("component", F.coalesce("component", "k1"))
    )
    low = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(low, "component").select("digest", "component_id")
    full = full.select("doc_id", "rk", "n_shingles", "digest").join(named, "digest").drop("digest")
    return full.unionByName(rows.where("n_shingles = 0").select("doc_id", "rk", "n_shingles", F.col("doc_id").alias("component_id")))


def deduplicate(docs: DataFrame, percent: int = STAGE_PERCENT) -> DataFrame:
    """The rows of docs, all columns, with one document of each component; rows without words all stay, and a row
    that repeats another's doc_id and text is taken once."""
    found = ut.materialize(components(docs, percent), "components")
    keep = (
        found.where(F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull() & F.col("component_id").isNull())).groupBy("rk")
        .count()
    )
    text = F.col("text").cast("string") if "text" in docs.columns else F.lit(None).cast("string")
    out = docs.withColumn("__rk", ut.row_key(F.col("doc_id").cast("long"), text)).join(keep.select(F.col("rk").alias("__rk")).hint("merge"), "__rk")
    if not keep.where("count > 1").isEmpty():
        out = out.dropDuplicates(["__rk"])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(ut.table(spark, sf_dir, "documents"), PERCENT)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
