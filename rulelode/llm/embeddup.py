"""Near duplicates of embeddings: sign hashing by random hyperplanes, exact cosines, connected components.

Each of several tables hashes a vector to the signs of its products with `bits` random hyperplanes. Two vectors at
cosine 0.95 differ in sign about one hyperplane in ten; with the number of tables from `tables_for` they miss each
other in all tables with probability MISS. Whoever shares a bucket is compared by exact cosine in double precision.
A linked pair counts in the first table whose bucket it shares, so that links are counted once without any list of
pairs: a bucket gives sums per vector and one edge per vector to its group. Signs are taken of products of whole
numbers, exact in double precision, so they come out alike wherever they are computed.

Scale: equal vectors are one class with a weight; bits grow with the number of classes, without an end, so that
unlike vectors rarely meet; buckets of one class end before vectors are shuffled; a bucket over BUCKET classes is
dealt into blocks, and every pair of blocks is a task of its own. Joins are merges: every table here grows with the
vectors, and a table of buckets just under the threshold of a broadcast takes some hundred MB of the driver.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of different length never link; rows that repeat a vec_id are rows of their own; a cosine of exactly the
threshold links; labels and extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelode.llm import _text as tx
from rulelode.llm import _util as ut

COSINE = 0.95
MISS = 1e-5
BUCKET = 8192
#: Bits of a bucket's number beyond those that count the classes: one vector in 2 ** SPARE meets an unlike one in a table.
SPARE = 5
SEED = 95
#: Whole numbers for components of unit vectors and of hyperplanes: products of up to 2 ** 18 components stay exact.
_GRID, _PLANE = 1 << 24, 64
#: Rows of a bucket up to which pairs are listed at once for many buckets.
_SMALL = 32
TASK_BYTES = 8 << 20


def tables_for(bits: int, cosine: float = COSINE, miss: float = MISS) -> int:
    p = (1 - math.acos(cosine) / math.pi) ** bits
    return max(1, math.ceil(math.log(miss) / math.log(1 - p)))


def unit(flat: np.ndarray, dim: int) -> np.ndarray:
    """Rows of unit length in double precision; scaling by the largest component first keeps squares finite."""
    x = flat.reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def signatures(x: np.ndarray, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    """Bucket numbers (row, table) of unit vectors."""
    planes = np.rint(np.random.default_rng([seed, x.shape[1], bits, tables]).standard_normal((x.shape[1], bits * tables)) * _PLANE)
    signs = (np.rint(x * _GRID) @ planes > 0).reshape(len(x), tables, bits)
    return (signs * (1 << np.arange(bits, dtype=np.int64))).sum(2)


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: vec_id, ok, two hashes of the vector; classes of equal hashes: k, weight, dim, v, low)."""
    kind = dict(vectors.dtypes).get("embedding", "array<double>")
    kind = kind if kind == "array<float>" else "array<double>"
    own = ut.only(vectors, vec_id="long", embedding=kind)
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    ok = F.coalesce(F.forall("embedding", good) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    hashes = {f"h{seed}": F.when(F.col("ok"), F.xxhash64(F.lit(seed), F.size("embedding"), "embedding")) for seed in (1, 2)}
    rows = own.withColumn("ok", ok).withColumns(hashes)
    classes = (
        rows.where("ok").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("low"), F.first("embedding").alias("v"))
    )
    # The number of a class is drawn as the table is written and read from it ever after.
    classes = classes.select(F.monotonically_increasing_id().alias("k"), "h1", "h2", "weight", "low", F.size("v").alias("dim"), "v")
    return rows.select("vec_id", "h1", "h2", "ok"), ut.materialize(classes, "vectors")


def _each_dim(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each length of vector."""
    dims = batch.column("dim").to_numpy()
    for d in np.unique(dims).tolist():
        at = np.flatnonzero(dims == d)
        yield at, unit(batch.column("v").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), d)


def _buckets(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            k = part.column("k").to_numpy()
            for at, x in _each_dim(part):
                s = signatures(x, bits, tables)
                bucket = tx.mix(tx.mix(s.astype(np.uint64) + np.uint64(x.shape[1] << 48)) + np.arange(tables, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket.view(np.int64).ravel()), pa.array(np.repeat(k[at], tables)),
                        pa.array(np.tile(np.arange(tables, dtype=np.int32), len(at))),
                    ],
                    ["bucket", "k", "t"],
                )

    return ut.map_batches(classes.select("k", "dim", "v"), run, "bucket long, k long, t int")


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each of n nodes' component under the edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _compared(rows: DataFrame, bits: int, tables: int, cosine: float) -> DataFrame:
    """(k, links, to): weights linked in a bucket, and one member of the group that k joins there."""
    parts = ut.shuffle_parts(rows.sparkSession)

    def pairs(x: np.ndarray, block: np.ndarray, group: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.append(begin, len(group)))
        last = np.repeat(begin + size, size)
        small = np.repeat(size <= _SMALL, size)
        # Small buckets all at once: every row with the one `step` rows further on, while that is in its bucket.
        for step in range(1, _SMALL):
            i = np.flatnonzero(small[: max(len(group) - step, 0)] & (np.arange(max(len(group) - step, 0)) + step < last[: max(len(group) - step, 0)]))
            if not len(i):
                break
            for lo in range(0, len(i), 65_536):
                p = i[lo : lo + 65_536]
                p = p[np.einsum("ij,ij->i", x[p], x[p + step]) >= cosine]
                p = p[~cross[p] | (block[p] != block[p + step])]
                if len(p):
                    yield p, p + step
        for lo, hi in zip(begin[size > _SMALL].tolist(), (begin + size)[size > _SMALL].tolist(), strict=True):
            for s in range(lo, hi, 1024):
                i, j = np.nonzero(x[s : min(s + 1024, hi)] @ x[s:hi].T >= cosine)
                own = j > i
                i, j = i[own] + s, j[own] + s
                # Between two blocks only pairs across count; within one all do.
                if cross[lo]:
                    across = block[i] != block[j]
                    i, j = i[across], j[across]
                if len(i):
                    yield i, j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in ut.key_groups(batches, "task", TASK_BYTES):
            whole = table.combine_chunks().to_batches()
            if not whole:
                continue
            batch = whole[0]
            k, weight, t, block, task, cross = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "weight", "t", "block", "task", "cross")
            )
            links, to = np.zeros(len(k), np.int64), np.arange(len(k))
            a, b = [], []
            for at, x in _each_dim(batch):
                sign = None
                for i, j in pairs(x, block[at], task[at], cross[at]):
                    if sign is None:
                        used = np.zeros(len(at), bool)
                        sign = np.zeros((len(at), tables), np.int64)
                    need = np.unique(np.concatenate([i, j]))
                    need = need[~used[need]]
                    if len(need):
                        sign[need], used[need] = signatures(x[need], bits, tables), True
                    for lo in range(0, len(i), 100_000):
                        p, q = i[lo : lo + 100_000], j[lo : lo + 100_000]
                        counts = (sign[p] == sign[q]).argmax(1) == t[at[p]]
                        p, q = at[p[counts]], at[q[counts]]
                        np.add.at(links, p, weight[q])
                        np.add.at(links, q, weight[p])
                        a.append(p)
                        b.append(q)
            if a:
                to = _labels(len(k), np.concatenate(a), np.concatenate(b))
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(k[hit]), pa.array(links[hit]), pa.array(k[to[hit]])], ["k", "links", "to"])

    return rows.repartition(parts, "task").sortWithinPartitions("task", "k").mapInArrow(run, "k long, links long, to long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows, classes = _classes(vectors)
    n = max(classes.count(), 1)
    bits = max(math.ceil(math.log2(n)) + SPARE, 8)
    tables = tables_for(bits, cosine)
    buckets = _buckets(classes, bits, tables)
    counts = (
        buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1").withColumn("blocks", F.ceil(F.col("m") / BUCKET).cast("int"))
        .drop("m")
    )
    met = (
        buckets.join(counts.hint("merge"), "bucket").withColumn("block", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
        .withColumn("c", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    met = met.select(
        F.xxhash64("bucket", F.least("block", "c"), F.greatest("block", "c")).alias("task"), "k", "t", "block",
        (F.col("block") != F.col("c")).alias("cross"),
    )
    found = ut.materialize(_compared(met.join(classes.select("k", "weight", "dim", "v").hint("merge"), "k"), bits, tables, cosine), "cosines")
    joined = ut.materialize(ut.connected_components(found.select(F.col("k").alias("src"), F.col("to").alias("dst"))), "components")
    links = found.groupBy("k").agg(F.sum("links").alias("links"))
    per_class = (
        classes.select("k", "h1", "h2", "weight", "low").join(links.hint("merge"), "k", "left")
        .join(joined.withColumnRenamed("node", "k").hint("merge"), "k", "left")
        .withColumn("component", F.coalesce("component", "k"))
    )
    names = per_class.groupBy("component").agg(F.min("low").alias("component_id"))
    per_class = (
        per_class.join(names.hint("merge"), "component").select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    )
    linked = rows.where("ok").join(per_class.hint("merge"), ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(ut.table(spark, sf_dir, "embeddings"))
