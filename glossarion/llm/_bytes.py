"""Vectorised hashing over the bytes of Arrow string arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
#: Prime modulus of the substring hashes, and their bases (fixed, so that equal bytes hash alike everywhere).
PRIME = (1 << 61) - 1
BASES = (0x1B7A6F3C59D2E487, 0x0D3E91C7A4F86B25)
#: A slice of a batch has about so many bytes, unless one text is longer.
SLICE = 1 << 20
#: Bytes whose products with 32-bit halves of a power can be summed in 64 bits.
SPAN = 1 << 22
#: Elements that are hashed at once.
CACHED = 1 << 15


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(32))
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    return h


@lru_cache(maxsize=4)
def _byte_names(seed: int, fold_case: bool) -> np.ndarray:
    """A random 64-bit value for each byte; A-Z as a-z when folding."""
    values = np.random.Generator(np.random.PCG64(seed)).integers(1, (1 << 64) - 1, 256, np.uint64, endpoint=True)
    if fold_case:
        values[65:91] = values[97:123]
    return values


def segment_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0, fold_case: bool = False) -> np.ndarray:
    """64-bit hashes of byte ranges: the sum of a mixed value for each byte and its place in the range.

    The value is no polynomial of the bytes, so no text's structure makes two ranges collide.
    Ranges are taken in parts of about ``CACHED`` bytes, so that a part's arrays stay in the processor's cache.
    """
    lens = (end - start).astype(np.int64)
    out = np.zeros(len(lens), np.uint64)
    names, step = _byte_names(seed, fold_case), U(0x9E3779B97F4A7C15 if seed else 0xC2B2AE3D27D4EB4F)
    upto, i = np.cumsum(lens), 0
    while i < len(lens):
        before = int(upto[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(upto, before + CACHED, "right")))
        if j == i + 1 and lens[i] > CACHED:
            for at in range(0, int(lens[i]), CACHED):
                part = data[start[i] + at : min(end[i], start[i] + at + CACHED)]
                out[i : i + 1] += mix(names[part] + np.arange(at, at + len(part)).astype(np.uint64) * step).sum(dtype=np.uint64)
        else:
            n = lens[i:j]
            first = np.cumsum(n) - n
            place = np.arange(int(n.sum())) - np.repeat(first, n)
            values = mix(names[data[place + np.repeat(start[i:j], n)]] + place.astype(np.uint64) * step)
            sums = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(values, out=sums[1:])
            out[i:j] = sums[first + n] - sums[first]
        i = j
    return mix(out + lens.astype(np.uint64) * U(0x2545F4914F6CDD1D))


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo 2^61 - 1."""
    p, low = U(PRIME), U(0xFFFFFFFF)
    a1, a0, b1, b0 = a >> U(32), a & low, b >> U(32), b & low
    mid = a1 * b0 + a0 * b1
    c = a0 * b0
    x = (c & p) + (c >> U(61)) + ((mid << U(32)) & p) + (mid >> U(29)) + (a1 * b1 << U(3))
    x = (x & p) + (x >> U(61))
    return np.where(x >= p, x - p, x)


_TABLES: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1) modulo 2^61 - 1."""
    got = _TABLES.get(base)
    if got is None or len(got) < n:
        size, k = max(1 << 16, 1 << int(n - 1).bit_length()), 1
        got = np.ones(size, np.uint64)
        while k < size:
            got[k : 2 * k] = _times(got[:k], np.array([pow(base, k, PRIME)], np.uint64))
            k *= 2
        if size <= SPAN:  # a longer text's tables are not kept
            _TABLES[base] = got
    return got[:n]


class PrefixHash:
    """Hashes of any substrings of one byte array modulo the prime, each in constant time."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        n = len(data)
        base = BASES[seed]
        power = _powers(base, max(n, 1))[:n]
        self.inverse = pow(base, -1, PRIME)
        value = data.astype(np.uint64) + U(1)
        self.low, self.high = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        np.cumsum(value * (power & U(0xFFFFFFFF)), out=self.low[1:])
        np.cumsum(value * (power >> U(32)), out=self.high[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        back, out = _powers(self.inverse, len(self.low)), np.empty(len(start), np.uint64)
        for i in range(0, len(start), CACHED):
            out[i : i + CACHED] = self._of(start[i : i + CACHED], end[i : i + CACHED], back)
        return out

    def _of(self, start: np.ndarray, end: np.ndarray, back: np.ndarray) -> np.ndarray:
        p, total = U(PRIME), np.zeros(len(start), np.uint64)
        at = start
        while True:
            to = np.minimum(end, at + SPAN)
            low, high = self.low[to] - self.low[at], self.high[to] - self.high[at]
            x = (low & p) + (low >> U(61)) + ((high << U(32)) & p) + (high >> U(29)) + total
            total = (x & p) + (x >> U(61))
            if not (to < end).any():
                break
            at = to
        total = np.where(total >= p, total - p, total)
        return mix(_times(total, back[start]) + (end - start).astype(np.uint64) * U(0x2545F4914F6CDD1D))


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks != 1 else col.chunk(0)
    if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
        wide = np.int32
    else:
        wide = np.int64
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, wide)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    if col.null_count:
        lens = np.where(np.asarray(col.is_valid()), np.diff(off), 0)
        if lens.sum() != len(raw):
            return string_buffers(col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b""))
    return raw, off - off[0]


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE):
    """The batch in slices of about ``max_bytes`` of the column; one long text stays whole."""
    col = batch.column(batch.schema.get_field_index(column))
    _, off = string_buffers(col)
    start = 0
    while start < len(col):
        end = int(np.searchsorted(off, off[start] + max_bytes, "right")) - 1
        end = min(len(col), max(end, start + 1))
        yield batch.slice(start, end - start)
        start = end


def spans(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices start..start+len-1 of every row, in one array."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)


#: Bytes 0x09-0x0D and 0x20 separate words.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words end with their row."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~SPACE[data]
    begin = ink.copy()
    begin[1:] &= ~ink[:-1]
    cut = off[:-1][off[:-1] < len(data)]
    begin[cut] = ink[cut]
    end = ink.copy()
    end[:-1] &= ~ink[1:]
    last = off[1:][off[1:] > 0] - 1
    end[last] = ink[last]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(off, s, "right") - 1
