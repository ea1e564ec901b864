"""Packing token pieces into windows by minimum bin slack.

Every document is tokenised whole and closed with one id 0. Full windows are cut off; what remains of a document,
shorter than a window, is a piece. The pieces' lengths make a histogram of at most `window` counts, whatever the
corpus, and the packing is solved on it: the longest length left opens a window, a subset-sum over bitsets (one
big integer per stage of the dynamic programme) finds the fullest reachable sum of the lengths left, and
backtracking gives the multiset that reaches it. A multiset is used as often as its counts allow, so the number
of programmes depends on the lengths and not on the documents. Pieces then take slots by their rank within their
length. Ranks come from counts per length and hash bucket: a length that many copies share is no single task. Full
windows need no rank and are not shuffled; one count per task of the first pass reaches the driver.

Defined results: null and empty texts are the one id 0; repeated rows are packed once each; a text with the
literal end-of-text marker is tokenised like any other by the tokenizer's own rules; extra columns are ignored;
an empty table gives an empty result; pieces alike in id, start and tokens take their slots in any order. Cached token
ids per worker are bounded by CACHE entries, and an entry is used for equal bytes only. A very long text is cut at
seams, places that no pre-token reaches over, and tokenised strip by strip.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulelode.llm import _text as tx
from rulelode.llm import _util as ut

WINDOW = 1024
CACHE = 400_000
#: Rows per hash bucket at which ranks are dealt out, as a number of buckets per shuffle partition.
BUCKETS_PER_PARTITION = 4

_SPACE, _BLANK, _LETTER, _NUMBER, _OTHER, _RARE = range(6)


def _class(code: int) -> int:
    if code == 0x20:
        return _SPACE
    if 9 <= code <= 13:
        return _BLANK
    if 0x1C <= code <= 0x1F or code in (0x85, 0xA0):
        return _RARE
    kind = unicodedata.category(chr(code))
    return _RARE if kind in ("Cn", "Co", "Cs") else {"L": _LETTER, "N": _NUMBER}.get(kind[0], _OTHER)


#: Classes of the code points that the fast splitter knows; texts with others go to the tokenizer whole.
_CLASS = np.array([_class(c) for c in range(0x250)] + [_RARE] * (0x800 - 0x250), np.int8)
#: A place between a printed ASCII sign and white space, or between a Chinese letter and its comma or full stop: no
#: pre-token reaches over it, whatever stands around, so texts may be cut there and tokenised apart.
_SEAM = re.compile(rb"[!-~](?=[ \n])|[\xe5-\xe9][\x80-\xbf]{2}(?=\xe3\x80\x82|\xef\xbc\x8c)")
STRIP = 1 << 18
_SHORT = {ord("s"): b"", ord("t"): b"", ord("m"): b"", ord("d"): b"", ord("r"): b"e", ord("v"): b"e", ord("l"): b"l"}


class Encoder:
    """The ids of a byte-level BPE tokenizer, with each distinct pre-token encoded once while it stays cached."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.at, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.tokens: list[bytes] = []

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _lookup(self, start: np.ndarray, end: np.ndarray, buf: np.ndarray) -> np.ndarray:
        """Cache slots of pre-tokens; encodes those not there yet. A slot is reused for equal bytes only."""
        first, number = tx.distinct(buf, start, end)
        a, b = start[first], end[first]
        u, _ = tx.word_keys(buf, a, b)
        view = memoryview(np.ascontiguousarray(buf))
        tokens = [bytes(view[s:e]) for s, e in zip(a.tolist(), b.tolist(), strict=True)]
        if len(self.keys) + len(u) > CACHE:
            self._clear()
        at = np.minimum(np.searchsorted(self.keys, u), max(len(self.keys) - 1, 0))
        known = self.keys[at] == u if len(self.keys) else np.zeros(len(u), bool)
        slots = np.empty(len(u), np.int64)
        if known.any():
            slots[known] = self.slot[at[known]]
            for i in np.flatnonzero(known).tolist():
                known[i] = self.tokens[slots[i]] == tokens[i]
        new = np.flatnonzero(~known)
        if len(new):
            ids = self.whole([tokens[i].decode("utf-8") for i in new.tolist()])
            size = np.array([len(x) for x in ids], np.int64)
            slots[new] = len(self.size) + np.arange(len(new))
            self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.pool = np.concatenate([self.pool, *ids])
            self.tokens += [tokens[i] for i in new.tolist()]
            keys, slot = np.concatenate([self.keys, u[new]]), np.concatenate([self.slot, slots[new]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.slot = keys[order], slot[order]
        return slots[number]

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of every row; rows over STRIP bytes are tokenised in strips cut at seams."""
        cuts = [0]
        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
            if b - a > 2 * STRIP:
                view, at = memoryview(np.ascontiguousarray(buf[a:b])), STRIP
                while m := _SEAM.search(view, at, b - a):
                    cuts.append(a + m.end())
                    at = m.end() + STRIP
            cuts.append(b)
        if len(cuts) == len(offs):
            return self._encode(buf, offs)
        inner, ids, total = np.array(cuts, np.int64), [], np.zeros(len(cuts), np.int64)
        lo = 0
        while lo < len(inner) - 1:
            hi = max(lo + 1, int(np.searchsorted(inner, inner[lo] + 4 * STRIP, "right")) - 1)
            own, at = self._encode(buf[inner[lo] : inner[hi]], inner[lo : hi + 1] - inner[lo])
            ids.append(own)
            total[lo + 1 : hi + 1] = total[lo] + at[1:]
            lo = hi
        # Rows that are equal in place, as empty ones are, have as many strips as they stand in the list of cuts.
        last = np.searchsorted(inner, offs[1:], "right") - 1
        return np.concatenate(ids), np.concatenate([[0], total[last]])

    def _encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(offs) - 1
        raw = buf.tobytes()
        cls = _CLASS[buf]
        lead = np.flatnonzero(buf >= 0xC0)
        if len(lead):
            code = ((buf[lead].astype(np.int32) & 0x1F) << 6) | (buf[lead + 1] & 0x3F)
            cls[lead] = np.where(buf[lead] < 0xE0, _CLASS[code], _RARE)
            # Longer sequences are rare already at their lead; marking one more byte does no harm.
            cls[lead + 1] = cls[lead]
        odd = np.zeros(n, bool)
        odd[np.searchsorted(offs, np.flatnonzero(cls == _RARE), "right") - 1] = True
        for mark in self.marks:
            at = raw.find(mark)
            while at >= 0:
                odd[np.searchsorted(offs, at, "right") - 1] = True
                at = raw.find(mark, at + 1)
        start = self._starts(buf, offs, cls)
        end = np.append(start[1:], len(buf))
        row = np.searchsorted(offs, start, "right") - 1
        easy = ~odd[row]
        start, end, row = start[easy], end[easy], row[easy]
        slots = self._lookup(start, end, buf) if len(start) else np.zeros(0, np.int64)
        size = self.size[slots]
        total = np.bincount(row, size, n).astype(np.int64)
        stop = np.cumsum(size)
        ids = self.pool[np.repeat(self.at[slots] - stop + size, size) + np.arange(int(stop[-1]) if len(stop) else 0)]
        if odd.any():
            which = np.flatnonzero(odd)
            whole = dict(zip(which.tolist(), self.whole([raw[offs[r] : offs[r + 1]].decode("utf-8") for r in which]), strict=True))
            cut = np.concatenate([[0], np.cumsum(total)])
            ids = np.concatenate([whole[r] if odd[r] else ids[cut[r] : cut[r + 1]] for r in range(n)])
            total[which] = [len(whole[r]) for r in which.tolist()]
        return ids, np.concatenate([[0], np.cumsum(total)])

    @staticmethod
    def _starts(buf: np.ndarray, offs: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Where pre-tokens begin: contractions, runs of letters, numbers or other signs with one blank before them,
        and runs of white space that leave their last character to what follows."""
        m = len(buf)
        edge = np.zeros(m + 1, bool)
        edge[offs] = True
        before = np.empty(m, np.int8)
        after = np.empty(m, np.int8)
        before[1:], after[:-1] = cls[:-1], cls[1:]
        before[edge[:-1]] = -1
        if m:
            after[edge[1:]] = -1
        ink = cls >= _LETTER
        flag = ink & (before != cls) & (before != _SPACE)
        blank = ~ink
        flag |= blank & ((before >= _LETTER) | (before == -1))
        flag |= blank & (after >= _LETTER)
        for i in np.flatnonzero(flag & (buf == 0x27) & (after == _LETTER)).tolist():
            rest = _SHORT.get(int(buf[i + 1]))
            if rest is None or (rest and (i + 2 >= m or edge[i + 2] or buf[i + 2] != rest[0])):
                continue
            stop = i + 2 + len(rest)
            flag[i + 1] = False
            if stop < m and not edge[stop] and cls[stop] == _LETTER:
                flag[stop] = True
        return np.flatnonzero(flag)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cut_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of the full windows and the remainder of every document; _task and
    _nth count the full windows of each task, from 0."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_task", "_nth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, task, full = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part, buf, offs in tx.pieces(batch, "text"):
                ids, at = enc.encode(buf, offs)
                rows: list[list] = [[] for _ in names]
                for own, lo, hi in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                    x = np.append(ids[lo:hi], np.uint32(0)).astype("<u4")
                    for s in range(0, len(x), window):
                        p = x[s : s + window]
                        nth = full if len(p) == window else None
                        full += len(p) == window
                        for column, value in zip(rows, (own, s, len(p), zlib.crc32(p.tobytes()), len(x), task, nth), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names)

    return ut.only(docs, doc_id="long", text="string").mapInArrow(run, ", ".join(f"{k} long" for k in names))


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths whose sum comes closest to room from below, by subset sums over bitsets.

    Stage k holds, as bits of one integer, the sums reachable with the first k lengths; a length with c copies is
    added in binary portions. Backtracking tries few copies first, so long lengths, which come first, are used up.
    """
    mask = (1 << (room + 1)) - 1
    used = [x for x in lengths if x <= room and counts[x] > 0]
    stages = [1]
    for x in used:
        reach, left, portion = stages[-1], min(counts[x], room // x), 1
        while left:
            portion = min(portion, left)
            reach |= (reach << (portion * x)) & mask
            left -= portion
            portion *= 2
        stages.append(reach)
        if reach >> room & 1:
            break
    goal = stages[-1].bit_length() - 1
    out: dict[int, int] = {}
    for k in range(len(stages) - 1, 0, -1):
        x, c = used[k - 1], 0
        while not stages[k - 1] >> goal & 1:
            goal -= x
            c += 1
        if c:
            out[x] = c
    return out


def solve(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """(multiset of lengths, times) for all pieces: minimum bin slack with the longest piece left in each window."""
    counts = {x: c for x, c in histogram.items() if c > 0}
    out = []
    while counts:
        top = max(counts)
        rest = dict(counts)
        rest[top] -= 1
        take = fullest(sorted((x for x, c in rest.items() if c > 0), reverse=True), rest, window - top)
        take[top] = take.get(top, 0) + 1
        times = min(counts[x] // c for x, c in take.items())
        for x, c in take.items():
            counts[x] -= c * times
            if not counts[x]:
                del counts[x]
        out.append((take, times))
    return out


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """sequence_id and offset of pieces: each shorter piece takes the slot of its rank within its length; full windows
    are sequences of their own, numbered on by task and place in it, and never shuffled."""
    spark = pieces.sparkSession
    names = [c for c in pieces.columns if c not in ("_task", "_nth")]
    short = pieces.where(F.col("length") < window).select(*names)
    buckets = ut.shuffle_parts(spark) * BUCKETS_PER_PARTITION
    keyed = short.withColumn("_b", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    counts = ut.materialize(keyed.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for take, times in solve(histogram, window):
        offset = 0
        for x, c in sorted(take.items(), reverse=True):
            slots.setdefault(x, []).append((rank.get(x, 0), c, sequence, offset))
            rank[x] = rank.get(x, 0) + c * times
            offset += c * x
        sequence += times
    arrays = {x: np.array(v, np.int64) for x, v in slots.items()}
    before = counts.select("length", "_b", (F.sum("n").over(Window.partitionBy("length").orderBy("_b")) - F.col("n")).alias("_before"))
    ranked = (
        keyed.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_b").orderBy("doc_id", "start", "ids_crc32")) - 1)
        .join(before, ["length", "_b"])
    )
    ranked = ranked.select(*names, (F.col("_rank") + F.col("_before")).cast("long").alias("_rank"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        length, at = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
        seq, off = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        for x in np.unique(length).tolist():
            own = length == x
            t = arrays[x]
            k = np.searchsorted(t[:, 0], at[own], "right") - 1
            step = at[own] - t[k, 0]
            seq[own] = t[k, 2] + step // t[k, 1]
            off[own] = t[k, 3] + step % t[k, 1] * x
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(seq), pa.array(off)], [*names, "sequence_id", "offset"])

    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}
    shared = ut.map_batches(ranked, run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", sequence_id long, offset long")
    full = pieces.where(F.col("length") == window)
    starts = []
    for r in full.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).orderBy("_task").collect():
        starts.append((r["_task"], sequence))
        sequence += r["n"]
    known = ut.local_table(spark, starts, {"_task": pa.int64(), "_start": pa.int64()})
    alone = full.join(known, "_task").select(*names, (F.col("_start") + F.col("_nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return shared.unionByName(alone)


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return place(ut.materialize(cut_pieces(docs, tokenizer or default_tokenizer(), window), "pieces"), window)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(ut.table(spark, sf_dir, "documents"))
