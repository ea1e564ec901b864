"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree.

Sizes are words. Targets share the corpus by weight and stop at CAP times a source's size. A source takes whole
epochs of its documents and a part of one more: documents fall by a seeded hash into blocks of about BLOCK rows, and
blocks are taken in that random order up to what the part wants. Documents over 1 / PARTS of that are walked apart from
the others, up to their share of its words; the other documents fill what these leave. Within the one block where a
walk ends, documents that fit are taken in random order, and for the last of the words the largest that fit. A document
that is larger than all of the part is drawn now and then instead. So any document can be in the mix, whatever its size,
and a source misses its target by less than a document, a small one where there are enough of them. This fixes an
exact quota of blocks for every source. The quotas are then split over the output shards by a binary tree: a node
draws, without replacement, how many blocks of each source go left (a multivariate hypergeometric variate), and the
rest go right, so every shard gets a fair mixture and no block twice. Shards take consecutive runs of each source's
blocks, permuted anew for each epoch, and are shuffled inside.

Everything is a function of the rows and `seed`: reruns agree. A source of any share is spread over its blocks;
no window or group holds more than RUN blocks, the runs of one source or the rows of one block.
Bounds: one row per source and one number per source and shard reach the driver; shards hold more than `shard_words`
where there would be more than `table` of these numbers, and blocks more than BLOCK rows where there would be more
than MOST_BLOCKS of them. What is taken does not depend on either.

Defined results: null texts have size 0; a document of size 0 is never taken; a null source is a source of its
own, last in order; rows equal in doc_id, text and source are taken alike; blocks and documents tied in their hash
follow each other by number and key; with extra columns `draw` keeps them all; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulelode.llm import _util as ut

WEIGHTS = (1, 2, 3)
CAP = 3
BLOCK = 128
SHARD_WORDS = 100_000
#: A document over this part of what the last epoch wants is a large one.
PARTS = 64
#: The share of a block's last words that is taken in random order, before what fits best; and how much rarer than its
#: fit a document is taken that is larger than all that is wanted: each can be in a mix, and few mixes miss a target.
LOOSE, RARE = 0.5, 0.1
SEED = 20
TABLE = 1 << 22
#: Blocks in all, below what numpy can draw from; blocks hold more rows where BLOCK would make more of them.
MOST_BLOCKS = 5 * 10**8
#: Neighbouring blocks of a source whose words are summed up in one window.
RUN = 4096
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> list[float]:
    """Shares of sum(sizes) by repeating weights, none above cap times its size; the excess is shared anew."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(w[i] for i in open_)
        full = {i for i in open_ if left * w[i] / total > cap * sizes[i]}
        if not full:
            for i in open_:
                out[i] = left * w[i] / total
            break
        for i in full:
            out[i] = float(cap * sizes[i])
        left -= sum(out[i] for i in full)
        open_ -= full
    return out


def split(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Block quotas of each source (rows) by shard (columns); rows sum to the quotas, columns are even."""
    out = np.zeros((len(quotas), shards), np.int64)
    todo = [(0, shards, quotas.astype(np.int64))]
    while todo:
        lo, hi, own = todo.pop()
        if hi - lo == 1 or not own.sum():
            out[:, lo] = own
            continue
        mid = (lo + hi) // 2
        n = int(round(int(own.sum()) * (mid - lo) / (hi - lo)))
        rng = np.random.default_rng(np.random.SeedSequence([seed, lo, hi]))
        left = rng.multivariate_hypergeometric(own, n, method="marginals")
        todo += [(lo, mid, left), (mid, hi, own - left)]
    return out


def _sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows with _size and the row's random key _key; _source and _id stand for its columns."""
    have = set(docs.columns)
    text = F.col("text").cast("string") if "text" in have else F.lit(None).cast("string")
    ident = F.col("doc_id").cast("long") if "doc_id" in have else F.lit(None).cast("long")
    source = F.col("source").cast("string") if "source" in have else F.lit(None).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.withColumns({"_size": size, "_source": source, "_id": ident, "_key": F.xxhash64(F.lit(seed), ident, text)})


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), blocks)


def _words_before(words: DataFrame) -> DataFrame:
    """words of blocks (_i, _block, _words) with _before, the words of the source's blocks before: sums inside runs
    of RUN blocks, and sums of whole runs, so that no task holds all blocks of a source."""
    words = ut.materialize(words.withColumn("_run", (F.col("_block") / RUN).cast("long")), "words")
    runs = words.groupBy("_i", "_run").agg(F.sum("_words").alias("_all"))
    runs = (
        runs.withColumn(
            "_past",
            F.sum("_all").over(Window.partitionBy("_i").orderBy("_run").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_all"),
        )
        .drop("_all")
    )
    inside = F.sum("_words").over(
        Window.partitionBy("_i", "_run").orderBy("_block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ) - F.col("_words")
    return (
        words.withColumn("_inside", inside).join(runs, ["_i", "_run"]).withColumn("_before", F.col("_inside") + F.col("_past"))
        .drop("_run", "_inside", "_past")
    )


def _walk(words: DataFrame, on: DataFrame, wanted: dict[int, tuple[float, float]]) -> tuple[DataFrame, DataFrame]:
    """(blocks taken whole, documents taken one by one) of each number in `wanted`, up to so many words.

    words: _i, _block, _words, _before; on: _i, _block, _size, _key; wanted: the words and what the source's last epoch
    wants in all. In the block where the words end, documents that fit are taken in the order of their keys up to
    LOOSE of what is left, then the largest that fit. A document that is larger than all of the last epoch never fits:
    it is taken, and ends the walk, with RARE times the probability that it would.
    """
    rows = [(i, w, r) for i, (w, r) in wanted.items()]
    goal = ut.local_table(words.sparkSession, rows, {"_i": pa.int32(), "_want": pa.float64(), "_rest": pa.float64()})
    at = words.join(goal, "_i").where("_before <= _want")
    whole = at.where("_before + _words <= _want").select("_i", "_block", "_words")
    cut = at.where("_before + _words > _want").select("_i", "_block", (F.col("_want") - F.col("_before")).alias("_cut"), "_rest")
    # One such block a number. Copies of one key are one item, so that an item list stays as short as a block.
    items = on.join(cut, ["_i", "_block"]).groupBy("_i", "_block", "_cut", "_rest", "_key").agg(F.sum("_size").alias("w")).where("w > 0")
    odd = (F.col("w") > F.col("_rest")) & (F.pmod(F.xxhash64("_key", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30)) * F.col("w") < RARE * F.col("_cut"))
    one = F.struct(F.xxhash64("_key", F.lit(2)).alias("o"), "_key", "w", odd.alias("odd"))
    listed = items.select("_i", "_block", "_cut", one.alias("x")).groupBy("_i", "_block", "_cut").agg(F.array_sort(F.collect_list("x")).alias("items"))

    def fit(items: Column, left: Column) -> Column:
        start = F.struct(left.alias("left"), F.array().cast("array<struct<_key:bigint,w:bigint>>").alias("took"))
        return F.aggregate(
            items, start,
            lambda a, x: F.when(
                x["w"] <= a["left"],
                F.struct((a["left"] - x["w"]).alias("left"), F.concat(a["took"], F.array(F.struct(x["_key"].alias("_key"), x["w"].alias("w")))).alias("took")),
            ).otherwise(a),
        )

    # Arrays as columns of their own are worked out once.
    rare = F.slice(F.filter("items", lambda x: x["odd"]), 1, 1)
    listed = listed.withColumn("rare", F.transform(rare, lambda x: F.struct(x["_key"].alias("_key"), x["w"].alias("w"))))
    listed = ut.materialize(listed.withColumn("first", fit(F.col("items"), F.col("_cut") * LOOSE)), "first")
    keys = F.transform("first.took", lambda x: x["_key"])
    rest = F.array_sort(F.transform(F.filter("items", lambda x: ~F.array_contains(keys, x["_key"])), lambda x: F.struct((-x["w"]).alias("n"), x["o"].alias("o"), x["_key"].alias("_key"), x["w"].alias("w"))))
    more = fit(rest, F.col("first.left") + F.col("_cut") * (1 - LOOSE))["took"]
    took = F.when(F.size("rare") > 0, F.col("rare")).otherwise(F.concat("first.took", more))
    return ut.materialize(whole, "whole"), ut.materialize(listed.select("_i", "_block", F.inline(took)), "picks")


def plan(sized: DataFrame, seed: int = SEED, shard_words: int = SHARD_WORDS, table: int = TABLE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sources, blocks, picks) from rows of _source, _size, _key.

    sources: _source, _i, _n_blocks, source_size, target, _epochs, _limit (the size over which a document is large).
    blocks: _i, _block, _shards (one shard per copy that the block's documents get), _part (whether the last of them
    is of the last epoch), _small and _large (whether all small and all large documents have that copy). picks: _i,
    _key of the other documents that have it.
    """
    spark = sized.sparkSession
    found = (
        sized.groupBy("_source").agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("size")).orderBy(F.col("_source").asc_nulls_last()).collect()
    )
    goal = targets([r["size"] for r in found])
    block = max(BLOCK, math.ceil(CAP * sum(r["n"] for r in found) / MOST_BLOCKS))
    rows = []
    for i, (r, t) in enumerate(zip(found, goal, strict=True)):
        epochs = min(int(t // r["size"]), CAP) if r["size"] else 0
        rest = t - epochs * r["size"]
        rows.append((r["_source"], i, max(1, math.ceil(r["n"] / block)), r["size"], t, epochs, rest, rest / PARTS))
    sources = ut.local_table(
        spark, rows,
        {
            "_source": pa.string(), "_i": pa.int32(), "_n_blocks": pa.int64(), "source_size": pa.int64(), "target": pa.float64(),
            "_epochs": pa.int32(), "_rest": pa.float64(), "_limit": pa.float64(),
        },
    )
    # What is walked is a source's small (even numbers) and its large documents (odd ones).
    on = (
        sized.join(sources, sized["_source"].eqNullSafe(sources["_source"]))
        .select((2 * F.col("_i") + (F.col("_size") > F.col("_limit")).cast("int")).alias("_i"), "_size", "_key", _block(F.col("_key"), F.col("_n_blocks")).alias("_block"))
    )
    words = ut.materialize(_words_before(on.groupBy("_i", "_block").agg(F.sum("_size").alias("_words"))), "blocks")
    sums = {r["_i"]: r["w"] for r in words.groupBy("_i").agg(F.sum("_words").alias("w")).collect()}
    large = {2 * r[1] + 1: (r[6] * sums.get(2 * r[1] + 1, 0) / r[3] if r[3] else 0.0, r[6]) for r in rows}
    whole, some = _walk(words, on, large)
    took = {r["_i"]: r["w"] for r in whole.select("_i", "_words").unionByName(some.select("_i", F.col("w").alias("_words"))).groupBy("_i").agg(F.sum("_words").alias("w")).collect()}
    small = {2 * r[1]: (max(r[6] - took.get(2 * r[1] + 1, 0), 0.0), r[6]) for r in rows}
    more, fill = _walk(words, on, small)
    picks = some.unionByName(fill).select((F.col("_i") / 2).cast("int").alias("_i"), "_key")

    full = whole.unionByName(more).select((F.col("_i") / 2).cast("int").alias("_i"), "_block", (F.col("_i") % 2 == 1).alias("_odd"))
    cut = some.unionByName(fill).select((F.col("_i") / 2).cast("int").alias("_i"), "_block", F.lit(None).cast("boolean").alias("_odd"))
    every = words.select((F.col("_i") / 2).cast("int").alias("_i"), "_block").distinct()
    marks = full.unionByName(cut).groupBy("_i", "_block").agg(
        F.coalesce(F.bool_or(F.col("_odd")), F.lit(False)).alias("_large"), F.coalesce(F.bool_or(~F.col("_odd")), F.lit(False)).alias("_small"), F.lit(True).alias("_part"),
    )
    words = every.join(marks, ["_i", "_block"], "left").join(sources.select("_i", "_n_blocks", "_epochs"), "_i")
    no = {c: F.coalesce(c, F.lit(False)) for c in ("_large", "_small", "_part")}
    words = ut.materialize(words.withColumns(no), "marked")

    # Quotas in blocks: whole epochs, and the blocks up to the cut.
    last = {r["_i"]: r["b"] for r in words.where("_part").groupBy("_i").agg(F.max("_block").alias("b")).collect()}
    quotas = np.array([r[5] * r[2] + last.get(r[1], -1) + 1 for r in rows], np.int64)
    shards = max(1, min(math.ceil(sum(goal) / shard_words), table // max(len(rows), 1)))
    upto = split(quotas, shards, seed).cumsum(1) if len(rows) else np.zeros((0, 1), np.int64)

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            out = []
            for i, block, n, epochs, part in zip(*(b.column(c).to_pylist() for c in ("_i", "_block", "_n_blocks", "_epochs", "_part")), strict=True):
                at = []
                for e in range(epochs):
                    step = np.random.default_rng([seed, i, e]).integers(1, 1 << 31, 2)
                    a = int(step[0])
                    while math.gcd(a, n) != 1:
                        a += 1
                    at.append(e * n + (a * block + int(step[1])) % n)
                if part:
                    at.append(epochs * n + block)
                out.append(np.minimum(np.searchsorted(upto[i], at, "right"), shards - 1).astype(np.int32).tolist())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("_i", "_block", "_part", "_small", "_large")), pa.array(out, pa.list_(pa.int32()))],
                ["_i", "_block", "_part", "_small", "_large", "_shards"],
            )

    return sources, words.select("_i", "_block", "_n_blocks", "_epochs", "_part", "_small", "_large").mapInArrow(
        run, "_i int, _block long, _part boolean, _small boolean, _large boolean, _shards array<int>",
    ), picks


def mix(docs: DataFrame, seed: int = SEED, shard_words: int = SHARD_WORDS, table: int = TABLE) -> DataFrame:
    """The rows of docs with _size, source_size, target and _shards: the shard of each copy that the mix takes."""
    sized = _sized(docs, seed)
    narrow = ut.materialize(sized.select("_source", "_size", "_key"), "sizes")
    sources, blocks, picks = plan(narrow, seed, shard_words, table)
    full = (
        sized.join(sources.withColumnRenamed("_source", "_name"), F.col("_source").eqNullSafe(F.col("_name")), "left")
        .drop("_name", "_rest", "_epochs")
    )
    full = full.withColumn("_block", _block(F.col("_key"), F.col("_n_blocks"))).join(blocks, ["_i", "_block"], "left")
    full = full.join(picks.withColumn("_picked", F.lit(True)), ["_i", "_key"], "left")
    # The last epoch's copy is of the documents that it takes.
    takes = F.when(F.col("_size") > F.col("_limit"), F.col("_large")).otherwise(F.col("_small")) | F.col("_picked").isNotNull()
    own = (
        F.when(F.col("_size") == 0, F.array().cast("array<int>"))
        .when(F.col("_part") & ~takes, F.slice("_shards", F.lit(1), F.greatest(F.size("_shards") - 1, F.lit(0))))
        .otherwise(F.col("_shards"))
    )
    return full.withColumn("_shards", F.coalesce(own, F.array().cast("array<int>")))


def draw(docs: DataFrame, seed: int = SEED, shard_words: int = SHARD_WORDS, table: int = TABLE) -> DataFrame:
    """The mixed corpus: rows of docs with their columns, repeated as taken, laid out by shard and shuffled inside."""
    mixed = (
        mix(docs, seed, shard_words, table).select(*[F.col(f"`{c}`") for c in docs.columns], "_key", F.posexplode("_shards").alias("_copy", "_shard"))
    )
    return (
        mixed.repartitionByRange(ut.shuffle_parts(docs.sparkSession), "_shard", F.xxhash64(F.lit(seed), "_key", "_copy"))
        .sortWithinPartitions("_shard", F.xxhash64(F.lit(seed), "_key", "_copy")).select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ut.only(ut.table(spark, sf_dir, "documents"), doc_id="long", text="string", source="string")
    return (
        mix(docs)
        .select(
            "doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.size("_shards")).alias("taken"),
            F.col("_shards").alias("shards"),
        )
    )
