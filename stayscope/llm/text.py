"""Vectorised helpers over Arrow string columns: flat bytes, words, hashes.

An Arrow string column already is one byte buffer plus offsets; the operators
work on that buffer with numpy instead of looping over Python strings.
Whole texts are always processed; a column is only cut between rows, into
slices of about ``budget`` bytes, to bound the temporaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240601))
BYTE_MIX = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
BASE = _U(0x9E3779B97F4A7C15)                       # odd, so invertible mod 2**64
BASE_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# white space of the word rule [^\x20\x09-\x0D]+ and the A-Z fold
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n (kept for the task's life)."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        for name, b in (("up", BASE), ("down", BASE_INV)):
            a = np.full(size, b, np.uint64)
            a[0] = 1
            _powers[name] = np.cumprod(a, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or
                            pa.types.is_large_string(col.type) else b"")
    col = col.cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def row_slices(off: np.ndarray, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of about ``budget`` bytes; at least one row each."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + budget, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


class Words:
    """Words of consecutive texts: ``start``/``end`` byte positions, 64-bit
    ``hash`` and ``doc`` (row in the slice), lower-cased when asked."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = True,
                 space: np.ndarray = IS_SPACE):
        off = off - off[0]
        n = len(data)
        word = ~space[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        edge = off[(off > 0) & (off < n)]               # a text's first byte starts a word
        first[edge] = word[edge]
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[edge - 1] = word[edge - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        up, down = powers(n + 1)
        acc = np.zeros(n + 1, np.uint64)
        v = BYTE_MIX[LOWER[data]] if lower else BYTE_MIX[data]
        np.cumsum(v * up[:n], out=acc[1:])
        self.hash = mix64((acc[self.end] - acc[self.start]) * down[self.start]
                          + (self.end - self.start).astype(np.uint64))
        self.n_docs = len(off) - 1
        self.bounds = np.searchsorted(self.start, off)  # words of row i: bounds[i]:bounds[i+1]
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(self.bounds))

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, bounds) of every row's ``k``-word shingles in text order; a
        row with 1..k-1 words has one shingle, its whole word sequence."""
        h, b = self.hash, self.bounds
        cnt = np.diff(b)
        m = len(h)
        full = np.zeros(m, np.uint64)
        for j in range(k):
            full[:max(0, m - j)] += h[j:] * (BASE ** _U(2 * j + 1)) if j < m else _U(0)
        full = mix64(full)
        keep = np.arange(m) + k <= np.repeat(b[1:], cnt)
        out_n = np.where(cnt >= k, cnt - k + 1, np.minimum(cnt, 1))
        for i in np.flatnonzero((cnt > 0) & (cnt < k)):
            seq = h[b[i]:b[i + 1]]
            keep[b[i]] = True
            acc = _U(0)
            with np.errstate(over="ignore"):
                for j, x in enumerate(seq):
                    acc += x * (BASE ** _U(2 * j + 1))
                full[b[i]] = mix64(np.array([acc + _U(len(seq))]))[0]
        return full[keep], np.concatenate([[0], np.cumsum(out_n)])
