"""Suffix array and common-prefix values by external induced sorting.

A shard is a text over symbols up to 257; its last symbol 0 is unique, 1
separates strings.  Left-most S
(LMS) substrings are ranked, the reduced string of ranks is sorted, and all
other suffixes are induced from the sorted LMS suffixes in two sweeps.  The
sweeps pop (first symbol, order, position) tuples from a disk-backed priority
queue: the order in which tuples are pushed is already their order within a
symbol, so the queue is one run per symbol, and runs beyond the memory limit
go to an unlinked scratch file of the task (as Spark's own spills do; nobody
else reads it).  Tuples of one symbol that do not depend on each other are
handled as one numpy batch.

Common prefixes follow the permuted order: where the symbols before a suffix
and before its predecessor differ the prefix is compared symbol by symbol;
every other value is carried from the suffix one position earlier, less one.
"""

from __future__ import annotations

import tempfile

import numpy as np

SEPARATOR = 1
QUEUE_ENTRIES = 1 << 22      # queued tuples held in memory (16 MB); the rest is on disk


class SymbolQueue:
    """Priority queue of (symbol, arrival, position), popped symbol by symbol."""

    def __init__(self, symbols: int, limit: int = QUEUE_ENTRIES):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.held, self.limit, self.file, self.spilled = 0, limit, None, 0

    def push(self, symbol: np.ndarray, position: np.ndarray) -> None:
        """Entries in arrival order."""
        if not len(symbol):
            return
        by = np.argsort(symbol, kind="stable")
        symbol, position = symbol[by], position[by].astype(np.int32)
        cut = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
        for s, run in zip(symbol[np.concatenate([[0], cut])], np.split(position, cut)):
            self.parts[s].append(run)
        self.held += len(position)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(prefix="suffix-queue-")
        self.file.seek(0, 2)
        for part in self.parts:
            for i, run in enumerate(part):
                if isinstance(run, np.ndarray):
                    part[i] = (self.file.tell(), len(run))
                    self.file.write(run.tobytes())
                    self.spilled += len(run)
        self.held = 0

    def pop(self, symbol: int) -> np.ndarray:
        """All entries of ``symbol`` in arrival order."""
        out = []
        for run in self.parts[symbol]:
            if isinstance(run, tuple):
                self.file.seek(run[0])
                run = np.frombuffer(self.file.read(4 * run[1]), np.int32)
            else:
                self.held -= len(run)
            out.append(run)
        self.parts[symbol] = []
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def rank_doubling(name: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names; only tied suffixes are
    sorted again as the compared length doubles."""
    n = len(name)
    rank = np.unique(name, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    count = np.bincount(rank)
    rank = (np.cumsum(count) - count)[rank]                         # first place of the class
    k = 1
    while True:
        r = rank[order]
        same = r[1:] == r[:-1]
        tied = np.flatnonzero(np.concatenate([[False], same]) | np.concatenate([same, [False]]))
        if not len(tied) or k >= n:
            return order
        at = order[tied]
        nxt = np.where(at + k < n, rank[np.minimum(at + k, n - 1)] + 1, 0)
        key = r[tied] * (n + 1) + nxt
        by = np.argsort(key, kind="stable")
        order[tied] = at[by]
        key = key[by]
        # a class is a run of consecutive places, so its new ranks are places
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order[tied]] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        k *= 2


def _lms_names(text: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Names, in order, of the LMS substrings (each up to the next LMS symbol).
    Where one is another's prefix the shorter is the larger one."""
    n = len(text)
    length = np.append(lms[1:], n - 1) - lms + 1
    order, rank = None, np.zeros(len(lms), np.int64)
    todo = np.arange(len(lms))
    step = 6                                     # 9-bit symbols in one 64-bit key
    for at in range(0, int(length.max()), step):
        key = np.zeros(len(todo), np.int64)
        for j in range(at, at + step):
            inside = j < length[todo]
            sym = np.where(inside, text[np.minimum(lms[todo] + j, n - 1)].astype(np.int64), 511)
            key = (key << 9) | sym
        order = np.lexsort((key, rank[todo]))
        key, r = key[order], rank[todo][order]
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (r[1:] != r[:-1])])
        first = np.concatenate([[True], r[1:] != r[:-1]])
        place = np.arange(len(todo))
        base = np.maximum.accumulate(np.where(first, place, 0))
        rank[todo[order]] = r + np.maximum.accumulate(np.where(new, place, 0)) - base
        longer = length[todo] > at + step
        if not longer.any():
            break
        # only classes that hold a longer substring can still split
        open_ = np.zeros(len(lms) + 1, bool)
        open_[rank[todo[longer]]] = True
        todo = todo[open_[rank[todo]]]
    return rank


def suffix_array(text: np.ndarray, limit: int = QUEUE_ENTRIES) -> np.ndarray:
    """Suffix array of ``text`` (uint16, ending with its only 0)."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32)
    # S type: the next different symbol is larger; the last symbol is S
    differs = np.concatenate([text[:-1] != text[1:], [True]])
    nxt = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]
    s_type = np.ones(n, bool)
    s_type[:-1] = text[np.minimum(nxt[:-1] + 1, n - 1)] > text[:-1]
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    if not len(lms):
        lms = np.array([n - 1])
    names = _lms_names(text, lms)
    lms = lms[rank_doubling(names)].astype(np.int32)

    symbols = int(text.max()) + 1
    of = np.searchsorted(text[lms], np.arange(symbols + 1))       # LMS suffixes by first symbol
    queue = SymbolQueue(symbols, limit)
    l_part = []

    def induce(batch, c, want_s, queue):
        """Predecessors of the given type: same symbol returned, others pushed."""
        prev = batch[batch > 0] - 1
        prev = prev[s_type[prev] == want_s]
        sym = text[prev]
        same = sym == c
        queue.push(sym[~same], prev[~same])
        return prev[same]

    for c in range(symbols):
        batch, own = queue.pop(c), []
        while len(batch):
            own.append(batch)
            batch = induce(batch, c, False, queue)
        l_part.append(np.concatenate(own) if own else np.zeros(0, np.int32))
        induce(lms[of[c]:of[c + 1]], c, False, queue)
    queue.close()

    queue = SymbolQueue(symbols, limit)
    out = []
    for c in range(symbols - 1, -1, -1):
        batch, own = queue.pop(c), []
        if c == 0:
            batch = np.array([n - 1], np.int32)             # the end, the least suffix
        while len(batch):
            own.append(batch)
            batch = induce(batch, c, True, queue)
        s_part = np.concatenate(own)[::-1] if own else np.zeros(0, np.int32)
        induce(l_part[c][::-1], c, True, queue)
        out.append(s_part)
        out.append(l_part[c])
    queue.close()
    return np.concatenate(out[::-1])


def common_prefixes(text: np.ndarray, sa: np.ndarray, upto: int) -> np.ndarray:
    """lcp[i] of suffixes sa[i-1] and sa[i], stopped at ``upto`` where compared;
    lcp[0] is 0.  ``upto`` covers the longest string of the shard."""
    n = len(text)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    p = before
    fresh = (p < 0) | (at == 0) | (p == 0)
    fresh[~fresh] = text[at[~fresh] - 1] != text[p[~fresh] - 1]
    fresh[1:] |= text[:-1] == SEPARATOR          # nothing is carried into another string
    i = np.flatnonzero(fresh & (p >= 0))
    length = np.zeros(n, np.int32)
    open_, done = i, 0
    step = 8
    while len(open_) and done < upto:
        a, b = open_ + done, p[open_] + done
        eq = np.ones(len(open_), bool)
        for j in range(step):
            x, y = a + j, b + j
            ok = (x < n) & (y < n)
            eq &= ok & (text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)])
            length[open_] += eq
        open_ = open_[eq]
        done += step
    last = np.maximum.accumulate(np.where(fresh, at, 0))
    plcp = np.maximum(length[last] - (at - last), 0)
    return plcp[sa]
