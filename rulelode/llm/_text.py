"""Vectorised byte kernels shared by the corpus operators.

Words are compared by their bytes or by two independent 64-bit keys; nothing here decides equality by one 64-bit
number. Kernels that make something for every byte walk long buffers in parts of PART bytes, so that one very long
text needs memory for its words, not several numbers for each of its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
PART = 1 << 22
#: The six ASCII white-space bytes; every word is a run of other bytes.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_INK = ~_SPACE
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], U)
#: Odd multipliers of the two keys: of the first eight bytes, of the next eight, of the length.
_KEYS = ((0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407), (0x8CB92BA72F3D8DD7, 0xC2B2AE3D27D4EB4F, 0x9E3779B185EBCA87))
_STEP = (0xD6E8FEB86659FD93, 0xE7037ED1A0B428DB)


def _powers(n: int, which: str) -> np.ndarray:
    """The first n powers of the (inverse) base mod 2^64."""
    have = _POWERS[which]
    if len(have) < n:
        base = _BASE if which == "up" else pow(_BASE, -1, 1 << 64)
        have = np.cumprod(np.concatenate([np.ones(1, U), np.full(max(n, 1 << 20) - 1, base, U)]), dtype=U)
        _POWERS[which] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def rolling(buf: np.ndarray, width: int) -> np.ndarray:
    """A number for each string of `width` bytes, equal for equal strings. Different strings can be given equal ones
    on purpose, so it picks and groups places; what it groups is compared by other means."""
    pre = np.zeros(len(buf) + 1, U)
    np.cumsum(_BYTE[buf] * _powers(len(buf), "up"), out=pre[1:])
    return mix((pre[width:] - pre[:-width]) * _powers(len(buf), "down")[: len(buf) - width + 1] + U(width))


def digests(raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit cryptographic digests of the strings raw[start:end], as rows of two numbers."""
    view = memoryview(raw)
    joined = b"".join([hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)])
    return np.frombuffer(joined, U).reshape(-1, 2)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def pieces(batch: pa.RecordBatch, text: str, size: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch between rows into parts of about `size` text bytes, so that what is made per byte stays small.

    A longer text comes alone; the kernels that see it walk it in parts.
    """
    _, offs = buffers(batch.column(text))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + size, "right")) - 1)
        part = batch.slice(at, to - at)
        yield part, *buffers(part.column(text))
        at = to


def runs(table: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs, within rows, of bytes that the table of 256 flags marks."""
    starts, ends = [], []
    for lo in range(0, len(buf), PART):
        hi = min(lo + PART, len(buf))
        # One more byte on either side, unmarked beyond the ends of the buffer.
        marked = np.zeros(hi - lo + 2, bool)
        a, b = max(lo - 1, 0), min(hi + 1, len(buf))
        marked[a - lo + 1 : b - lo + 1] = table[buf[a:b]]
        edge = np.zeros(hi - lo + 1, bool)
        own = offs[np.searchsorted(offs, lo) : np.searchsorted(offs, hi, "right")]
        edge[own - lo] = True
        here = marked[1:-1]
        starts.append(np.flatnonzero(here & (~marked[:-2] | edge[:-1])) + lo)
        ends.append(np.flatnonzero(here & (~marked[2:] | edge[1:])) + lo + 1)
    return np.concatenate([*starts, np.zeros(0, np.int64)]), np.concatenate([*ends, np.zeros(0, np.int64)])


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte spans of the words of all rows, and the index of each row's first word (n+1 long)."""
    start, end = runs(_INK, buf, offs)
    return start, end, np.searchsorted(start, offs)


def lower(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def code_points(buf: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many code points begin before each of some places, which come in rising order."""
    out = np.zeros(len(places), np.int64)
    before = 0
    for lo in range(0, len(buf) + 1, PART):
        part = buf[lo : lo + PART]
        a, b = np.searchsorted(places, [lo, lo + len(part) + (lo + PART >= len(buf))])
        if b > a or lo + PART <= len(buf):
            heads = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80, dtype=np.int32)])
            out[a:b] = before + heads[places[a:b] - lo]
            before += int(heads[-1])
    return out


def packed(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first eight and the next eight bytes of spans as numbers, filled up with zero bytes."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    view = np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))
    size = end - start
    one = view[start] & _MASK[np.minimum(size, 8)]
    two = view[np.minimum(start + 8, len(buf))] & _MASK[np.clip(size - 8, 0, 8)]
    return one, two


def _mixed(one: np.ndarray, two: np.ndarray, size: np.ndarray, which: int) -> np.ndarray:
    a, b, c = (U(x) for x in _KEYS[which])
    return mix(one * a + mix(two * b + size.astype(U) * c))


def word_keys(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys of byte strings: mixed from their bytes up to 16, from a digest beyond."""
    one, two = packed(buf, start, end)
    size = end - start
    out = _mixed(one, two, size, 0), _mixed(one, two, size, 1)
    long = np.flatnonzero(size > 16)
    if len(long):
        found = digests(memoryview(np.ascontiguousarray(buf)), start[long], end[long])
        out[0][long], out[1][long] = found[:, 0], found[:, 1]
    return out


def distinct(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one, number): the byte strings buf[start:end] numbered, equal numbers exactly for equal strings, and the
    index of one string of each number. Strings that a key brings together are compared by their bytes."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    one, two = packed(buf, start, end)
    size = end - start
    key = _mixed(one, two, size, 0)
    long = np.flatnonzero(size > 16)
    if len(long):
        key[long] = digests(memoryview(np.ascontiguousarray(buf)), start[long], end[long])[:, 0]
    order = np.argsort(key)
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    number = np.empty(len(key), np.int64)
    number[order] = np.cumsum(new) - 1
    some = order[new]
    like = some[number]
    same = (one == one[like]) & (two == two[like]) & (size == size[like])
    for i in long[same[long] & (like[long] != long)].tolist():
        j = like[i]
        same[i] = np.array_equal(buf[start[i] : end[i]], buf[start[j] : end[j]])
    if not same.all():
        seen: dict[bytes, int] = {}
        raw = buf.tobytes()
        number = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(start.tolist(), end.tolist(), strict=True)])
        some = np.unique(number, return_index=True)[1]
    return some, number


def shingles(buf: np.ndarray, offs: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, other keys, first): two keys for each run of `width` words of a row after lower-casing A-Z.

    A row with fewer words has one, of all of them; one with none has none.
    """
    low = lower(buf)
    start, end, first = words(low, offs)
    n = np.diff(first)
    if not len(start):
        return np.zeros(0, U), np.zeros(0, U), np.zeros(len(n) + 1, np.int64)
    own = word_keys(low, start, end)
    row = np.repeat(np.arange(len(n)), n)
    keep = np.arange(len(row)) + width <= first[1:][row]
    few = np.flatnonzero((n > 0) & (n < width))
    keep[first[few]] = True
    out = []
    for h, step in zip(own, _STEP, strict=True):
        powers = [U(pow(step, k + 1, 1 << 64)) for k in range(width)]
        acc = np.zeros(len(h), U)
        for k, p in enumerate(powers):
            acc[: max(len(h) - k, 0)] += h[k:] * p
        for r in few.tolist():
            own_words = h[first[r] : first[r + 1]] * np.array(powers[: n[r]], U)
            acc[first[r] : first[r] + 1] = own_words.sum(keepdims=True) + n[r : r + 1].astype(U) * U(0xA24BAED4963EE407)
        out.append(mix(acc[keep]))
    return out[0], out[1], np.concatenate([[0], np.cumsum(np.bincount(row[keep], minlength=len(n)))])


def members(h: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of keys, sorted by the first of them, then by the second."""
    order = np.argsort(h, kind="stable")
    h, g = h[order], g[order]
    same = h[1:] == h[:-1]
    if (same & (g[1:] != g[:-1])).any():
        order = np.lexsort((g, h))
        h, g = h[order], g[order]
        same = (h[1:] == h[:-1]) & (g[1:] == g[:-1])
    keep = np.concatenate([[True], ~same])[: len(h)]
    return h[keep], g[keep]


def numbered(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """A number for each pair of keys, equal exactly for equal pairs."""
    order = np.argsort(h, kind="stable")
    new = h[order][1:] != h[order][:-1]
    other = g[order][1:] != g[order][:-1]
    if (other & ~new).any():
        order = np.lexsort((g, h))
        new = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    out = np.empty(len(h), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(new)])[: len(h)]
    return out


def common(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """How many pairs of keys two sets share, each as `members` gives it."""
    (h, g), (x, y) = a, b
    if not len(h) or not len(x):
        return 0
    if (h[1:] == h[:-1]).any():
        return len(set(zip(h.tolist(), g.tolist(), strict=True)) & set(zip(x.tolist(), y.tolist(), strict=True)))
    at = np.minimum(np.searchsorted(h, x), len(h) - 1)
    return int(((h[at] == x) & (g[at] == y)).sum())
