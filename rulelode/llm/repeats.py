"""Repeated passages by longest-previous-factor arrays over a distributed sparse suffix array.

A string of LENGTH bytes repeats if it starts at two places. Two equal strings hold the same anchor: of all GRAM-byte
strings inside a window the one of least hash, the first of equals. A maximal run of windows with one anchor is a
stretch of at most 2 * LENGTH bytes; there is about one for 77 bytes of text. Only anchors that occur twice can
belong to a repeat, which leaves the repeated part of the corpus. There, stretches with one anchor are a group, and
those of a group that are equal as a whole, the inside of every long repeat, are one class. In suffix order the same
suffixes of a class's members stand side by side, so each member but the first has a longest previous factor of LENGTH
or more throughout: there is nothing to sort. Of groups with two classes or more, at the ends of repeats, every
class's first member goes to a suffix array. Suffixes are ranked by prefix doubling up to LENGTH bytes; a run of equal
ranks is a run of suffixes with longest common prefix of LENGTH or more. In it, a suffix with a smaller position
before it (previous smaller value) or after it (next smaller value) in suffix order has a longest previous factor of
LENGTH or more: it is a later copy. What has neither, in a run of two or more, is the first. `keep="first"` removes
later copies only, `keep="none"` every copy.

Classes are told apart by 128-bit cryptographic digests of their bytes, rows by a SHA-256 of doc_id and text.

Scale: anchors shuffle as their hash, digest, row and place; counts are combined before they are shuffled; classes
collapse copies, however many; a group of more than GROUP classes is dealt into blocks, and every pair of blocks
is a task. Texts are shuffled once to cut stretches and once to remove what was found. A very long text is walked in
strips; stretches over a seam become two, which still share their anchors with their copies elsewhere.

Defined results: null and empty texts have nothing to remove; matches never cross documents; rows equal in doc_id
and text are copies of each other, but share one result, so keep="first" keeps both; ties between copies are broken
by doc_id (null last), then by a hash of the row, then by place; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulelode.llm import _text as tx
from rulelode.llm import _util as ut

LENGTH = 200
GRAM = 48
GROUP = 20_000
#: Bytes of stretches that one suffix array holds; groups are kept whole.
ARRAY_BYTES = 2 << 20
#: Bytes of a very long text whose anchors are found at once.
STRIP = 1 << 20


def anchors(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, start, windows, anchor's place in the stretch) of the stretches of all rows."""
    m = len(buf) - length + 1
    if m < 1:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z, z
    kh = tx.rolling(buf, gram)
    key = kh & tx.U(0xFFFFFFFF00000000) | np.arange(len(kh), dtype=np.uint64)
    span, width = 1, length - gram + 1
    while 2 * span <= width:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < width:
        key = np.minimum(key[: len(key) - (width - span)], key[width - span :])
    at = (key & tx.U(0xFFFFFFFF)).astype(np.int64)
    edges = np.zeros(m + 1, np.int32)
    long = np.diff(offs) >= length
    np.add.at(edges, offs[:-1][long], 1)
    np.add.at(edges, np.minimum(offs[1:][long] - length + 1, m), -1)
    valid = np.cumsum(edges[:m]) > 0
    new = valid.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    start = np.flatnonzero(new)
    if not len(start):
        return kh[:0], start, start, start
    seen = np.cumsum(valid)
    windows = np.diff(np.append(seen[start] - 1, seen[-1]))
    return kh[at[start]], start, windows, at[start] - start


def strips(buf: np.ndarray, offs: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(where it begins, bytes, offsets): the buffer as it is, or one very long row in strips that share length - 1
    bytes, so that every window lies in one strip. A stretch over the seam of two strips becomes two."""
    if len(offs) != 2 or len(buf) <= 2 * STRIP:
        yield 0, buf, offs
        return
    for lo in range(0, len(buf), STRIP):
        own = buf[lo : lo + STRIP + length - 1]
        yield lo, own, np.array([0, len(own)], np.int64)


def _rank(v: np.ndarray) -> np.ndarray:
    return np.unique(v, return_inverse=True)[1].astype(np.uint64)


def suffix_ranks(buf: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Order of all suffixes by their first `length` bytes, by prefix doubling; equal ranks share all those bytes.

    Suffixes shorter than that are filled up with zero bytes.
    """
    padded = np.concatenate([buf, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(buf), np.uint64)
    for k in range(min(8, length)):
        word = word << tx.U(8) | padded[k : k + len(buf)]
    rank, have = _rank(word), min(8, length)
    while have < length:
        step = min(have, length - have)
        ahead = np.zeros(len(rank), np.uint64)
        ahead[: len(rank) - step] = rank[step:] + tx.U(1)
        rank, have = _rank(rank << tx.U(32) | ahead), have + step
    return rank


def previous_factors(rank: np.ndarray, position: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(longest previous factor, longest factor that occurs at any other position) of suffixes, cut at `length`: the
    ranks tell of `length` bytes and no less, so what is shorter counts as 0.

    The longest previous factor of a suffix is the longer of its common prefixes with two others: the last before it
    and the first after it, in suffix order, whose positions are smaller. Cut at the ranks' length it is full exactly
    if one of the two lies in the same run of equal ranks.
    """
    order = np.argsort(rank, kind="stable")
    r, p = rank[order], position[order].astype(np.int64)
    n = len(r)
    earlier, other = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if n:
        same = r[1:] == r[:-1]
        run = np.concatenate([[0], np.cumsum(~same)])
        step = int(p.max()) + 1
        # Least position so far within the run, read from either side: runs are laid apart by more than any position.
        down, up = p + (run[-1] - run) * step, p + run * step
        previous_smaller = np.concatenate([[False], np.minimum.accumulate(down)[:-1] < down[1:]])
        next_smaller = np.concatenate([np.minimum.accumulate(up[::-1])[::-1][1:] < up[:-1], [False]])
        earlier[order] = length * (previous_smaller | next_smaller)
        # A place that stands twice, as blocks of one group may meet in one array, is not its own copy.
        above_before = np.concatenate([[False], np.maximum.accumulate(up)[:-1] > up[1:]])
        above_after = np.concatenate([np.maximum.accumulate(down[::-1])[::-1][1:] > down[:-1], [False]])
        other[order] = length * (previous_smaller | next_smaller | above_before | above_after)
    return earlier, other


def _anchor_rows(keyed: DataFrame, whole: bool, ordered: bool, length: int) -> DataFrame:
    """h of every stretch; with `whole` also g (a digest of its bytes), the row's order and key, and at: start,
    windows and place in one number."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, whole_buf, whole_offs in tx.pieces(batch, "text"):
            for base, buf, offs in strips(whole_buf, whole_offs, length):
                h, start, windows, place = anchors(buf, offs, length)
                if not whole:
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])
                    continue
                row = np.searchsorted(offs, start, "right") - 1
                at = start + base - offs[row] << 16 | windows << 8 | place
                g = tx.digests(np.ascontiguousarray(buf), start, start + windows + length - 1)
                order = part.column("doc_id").fill_null(np.iinfo(np.int64).max).take(pa.array(row)) if ordered else pa.array(np.zeros(len(row), np.int64))
                g = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(g), [None, pa.py_buffer(g.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), g, order, part.column("rk").take(pa.array(row)), pa.array(at)], ["h", "g", "o", "rk", "at"],
                )

    return ut.map_batches(keyed, run, "h long, g binary, o long, rk binary, at long" if whole else "h long")


def _array_input(keyed: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """Of groups with two or more classes, the stretch of every class's first member: task, o, rk, at, n, stretch."""
    blocks = (
        classes.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
        .select("h", F.ceil(F.col("kinds") / GROUP).cast("int").alias("blocks"))
    )
    some = (
        classes.join(blocks, "h").withColumn("b", F.pmod(F.xxhash64("g"), F.col("blocks")).cast("int"))
        .withColumn("to", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    some = some.select(
        F.xxhash64("h", F.least("b", "to"), F.greatest("b", "to")).alias("task"), F.col("first.o").alias("o"), F.col("first.rk").alias("rk"),
        F.col("first.at").alias("at"), "n",
    )
    wanted = some.groupBy("rk").agg(F.collect_list(F.struct("task", "o", "at", "n")).alias("cuts"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in tx.pieces(batch, "text"):
            lists = part.column("cuts")
            flat = lists.flatten()
            row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            view = memoryview(np.ascontiguousarray(buf))
            for lo in range(0, len(row), 50_000):
                task, order, at, n = (flat.field(k).slice(lo, 50_000) for k in ("task", "o", "at", "n"))
                own = row[lo : lo + 50_000]
                a = at.to_numpy()
                begin = (a >> 16) + offs[own]
                cut = [bytes(view[s : s + w + length - 1]) for s, w in zip(begin.tolist(), (a >> 8 & 255).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [task, order, part.column("rk").take(pa.array(own)), at, n, pa.array(cut, pa.binary())],
                    ["task", "o", "rk", "at", "n", "stretch"],
                )

    return ut.map_batches(keyed.select("rk", "text").join(wanted, "rk"), run, "task long, o long, rk binary, at long, n long, stretch binary")


def _array_spans(rows: DataFrame, length: int, keep: str) -> DataFrame:
    """(rk, a, b): what the suffix arrays of the groups find of first members, as byte spans of single rows."""
    parts = ut.shuffle_parts(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in ut.key_groups(batches, "task", ARRAY_BYTES):
            table = table.combine_chunks()
            column = table.column("stretch").combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            buf, offs = tx.buffers(column)
            at, n, order = (table.column(c).to_numpy() for c in ("at", "n", "o"))
            rk = np.unique(np.array(table.column("rk").to_pylist(), "S16"), return_inverse=True)[1]
            windows = at >> 8 & 255
            row = np.repeat(np.arange(len(at)), windows)
            inside = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
            place = np.empty(len(at), np.int64)
            by = np.lexsort((at, rk, order))
            place[by] = np.cumsum(np.concatenate([[False], (at[by][1:] != at[by][:-1]) | (rk[by][1:] != rk[by][:-1])]))
            factors = previous_factors(suffix_ranks(buf, length)[offs[row] + inside], place[row] << 8 | inside, length)
            # If every copy goes, a first member with copies of its own is found with these.
            hit = factors[0] >= length if keep == "first" else (factors[1] >= length) & (n[row] == 1)
            begin = hit & ~np.concatenate([[False], hit[:-1] & (row[1:] == row[:-1])])
            end = hit & ~np.concatenate([hit[1:] & (row[1:] == row[:-1]), [False]])
            s, e = np.flatnonzero(begin), np.flatnonzero(end)
            base = (at >> 16)[row[s]]
            yield pa.RecordBatch.from_arrays(
                [table.column("rk").combine_chunks().take(pa.array(row[s])), pa.array(base + inside[s]), pa.array(base + inside[e] + length)],
                ["rk", "a", "b"],
            )

    return rows.repartition(parts, "task").sortWithinPartitions("task").mapInArrow(run, "rk binary, a long, b long")


def repeated_spans(docs: DataFrame, keep: str = "first", length: int = LENGTH) -> DataFrame:
    """(rk, spans): byte spans to remove of each row that has any, by the row's key; spans may touch and overlap."""
    keyed = ut.keyed(docs)
    # Written before it is joined: a join of two plain exchanges can be split where one anchor is very frequent.
    twice = ut.materialize(
        _anchor_rows(keyed, False, False, length).groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("h"), "frequent",
    )
    some = ut.materialize(_anchor_rows(keyed, True, keep == "first", length).join(twice, "h", "left_semi"), "anchors")
    member = F.struct("o", "rk", "at")
    classes = ut.materialize(some.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.min(member).alias("first")), "stretches")
    found = ut.materialize(_array_spans(_array_input(keyed, classes, length), length, keep), "factors")
    # A table of its own, so that nothing but a join of two plain exchanges stands in this step.
    equal = some.join(classes.where("n > 1").select("h", "g", "first"), ["h", "g"])
    if keep == "first":
        equal = equal.where(~member.eqNullSafe(F.col("first")))
    start = F.shiftright("at", 16)
    equal = ut.materialize(
        equal.select("rk", start.alias("a"), (start + F.shiftright("at", 8).bitwiseAND(F.lit(255)) + F.lit(length - 1)).alias("b")), "members",
    )
    return ut.materialize(found.unionByName(equal).groupBy("rk").agg(F.collect_set(F.struct("a", "b")).alias("spans")), "spans")


def _merged(lists: pa.ListArray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs (row, a, b) of the spans of each row."""
    flat = lists.flatten()
    a, b = flat.field("a").to_numpy(), flat.field("b").to_numpy()
    size = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
    row = np.repeat(np.arange(rows), size)
    order = np.lexsort((b, a, row))
    out: list[tuple[int, int, int]] = []
    for r, s, e in zip(row[order].tolist(), a[order].tolist(), b[order].tolist(), strict=True):
        if out and out[-1][0] == r and s <= out[-1][2]:
            out[-1] = (r, out[-1][1], max(e, out[-1][2]))
        else:
            out.append((r, s, e))
    x = np.array(out, np.int64).reshape(-1, 3)
    return x[:, 0], x[:, 1], x[:, 2]


def remove_repeats(docs: DataFrame, keep: str = "first", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) of every row."""
    spans = repeated_spans(docs, keep, length)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, buf, offs in tx.pieces(batch, "text"):
            n = part.num_rows
            row, a, b = _merged(part.column("spans"), n)
            raw = buf.tobytes()
            kept, removed = [raw[offs[r] : offs[r + 1]] for r in range(n)], np.zeros(n, np.int64)
            first = np.searchsorted(row, np.arange(n + 1))
            for r in np.unique(row).tolist():
                own, at, parts = kept[r], 0, []
                for s, e in zip(a[first[r] : first[r + 1]].tolist(), b[first[r] : first[r + 1]].tolist(), strict=True):
                    parts.append(own[at:s])
                    removed[r] += e - s
                    at = e
                kept[r] = b"".join([*parts, own[at:]])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(offs)), pa.array(removed), pa.array(np.diff(first)), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return ut.map_batches(
        ut.keyed(docs).join(spans, "rk", "left").select("doc_id", "text", "spans"), run,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary",
    )


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(ut.table(spark, sf_dir, "documents"), keep="none")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
