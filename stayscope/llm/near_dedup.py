"""MinHash near-duplicates by tensored banding (dealt operator 12).

Each text is the set of its distinct k-word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``).  Two small collections of ``m`` hash functions, each
the combination of ``WIDTH`` minima, stand in for ``m * m`` tables: a table's key
is one function of the left collection with one of the right, so ``2 * m *
WIDTH`` minima are computed where separate tables would take ``m * m * 2 *
WIDTH``.  Sets of similarity s agree on one function with s**WIDTH; a link is
missed if one collection has no agreement, with at most ``2 * (1 -
s**WIDTH)**m``, and ``m`` is chosen so that this stays below ``MISS`` at the
threshold itself (13 at 0.85: 169 tables from 78 minima).

A table's key can only be shared where both of its functions' values are, so
the values are counted first (``2 * m`` rows a set) and a set hands on the keys
of its shared values alone: most sets have none.  Sets that share a key form a
candidate cluster (``clusters``); inside its blocks the pairs that agree in both
collections are verified on the full sets, unless already linked.  Equal sets
are one set throughout, so exact copies cost a row each and no more.

Edge cases: null, empty and white-space texts have no shingles, link with
nothing and are kept; texts of fewer than k words are one shingle; null ids are
kept as rows (a null id never is a component id unless all of a class are
null); repeated rows each give a row, and all rows of a kept id are kept; an
empty table gives an empty result; only the id and the text column are read, so
extra columns cannot clash.
"""

from __future__ import annotations

from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clusters import CHUNK, KEY_ROWS, candidate_clusters, classes, combine_keys, doc_sets, link_clusters, overlap, set_id
from .shipping import ship
from .store import stored
from .text import flat, mix64, row_slices

WIDTH = 3               # minima of one hash function
MISS = 1e-5             # chance at most that a pair at the threshold shares no table
TILE = 128              # sets of a block compared at a time
_U = np.uint64
_ODD = np.random.Generator(np.random.PCG64(20240712)).integers(1, 1 << 63, 4096, dtype=np.uint64) | _U(1)


def collection_size(percent: int, miss: float = MISS) -> int:
    """Functions of a collection for pairs of ``percent`` similarity."""
    agree = (percent / 100) ** WIDTH
    return max(2, ceil(log(miss / 2) / log(1 - agree))) if agree < 1 else 2


def functions_of(h: np.ndarray, cut: np.ndarray, m: int) -> np.ndarray:
    """(sets, 2 * m) values of the left and the right collection for the
    non-empty sets ``h[cut[i]:cut[i + 1]]`` of distinct or repeated shingles."""
    if 2 * m * WIDTH > len(_ODD):
        raise ValueError(f"a threshold that needs {2 * m * WIDTH} minima; at most {len(_ODD)}")
    out = np.zeros((len(cut), 2 * m), np.uint64)
    for f in range(2 * m):
        value = np.full(len(cut), f + 1, np.uint64)
        for w in range(WIDTH):
            value = mix64(value + np.minimum.reduceat(h * _ODD[f * WIDTH + w], cut))
        out[:, f] = value
    return out


def _points(k: int, m: int):
    def run(batches):
        for batch in batches:
            data, off = flat(batch.column("text"))
            n, sid = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.uint64)
            values = np.zeros((len(batch), 2 * m), np.uint64)
            for lo, hi in row_slices(off):
                rows, sets = [], []
                for r, s in doc_sets(data[off[lo]:off[hi]], off[lo:hi + 1], k):
                    if len(s):
                        rows.append(lo + r)
                        sets.append(s)
                        n[lo + r], sid[lo + r] = len(s), set_id(s)
                if rows:
                    cut = np.cumsum([0, *(len(s) for s in sets[:-1])])
                    values[rows] = functions_of(np.concatenate(sets), cut, m)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n), pa.array(sid.view(np.int64)),
                 pa.array([v.tobytes() if x else None for v, x in zip(values, n)], pa.binary())],
                ["id", "n_shingles", "sid", "minima"])
    return run


def _minima(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    sid = batch.column("sid").to_numpy(zero_copy_only=False).view(np.uint64)
    if not len(sid):
        return sid, np.zeros((0, 2), np.uint64)
    data, _ = flat(batch.column("minima"))
    return sid, np.frombuffer(data.tobytes(), np.uint64).reshape(len(sid), -1)


def _count_chunk(value: np.ndarray, sid: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
    """One row a value, known to be shared if it occurs here again; the other
    rows of such values are shared for certain and go by their set."""
    by = np.argsort(value, kind="stable")
    value, sid, f = value[by], sid[by], f[by]
    first = np.concatenate([[True], value[1:] != value[:-1]])
    again = np.concatenate([value[1:] == value[:-1], [False]])
    part = np.where(first, value, mix64(sid))
    return pa.RecordBatch.from_arrays(
        [pa.array(part.view(np.int64)), pa.array(sid.view(np.int64)), pa.array(f), pa.array(again | ~first)],
        ["value", "sid", "f", "shared"])


def _values(batches):
    """One row a set and function, keyed by the function's value and counted a
    chunk at a time."""
    held, rows = [], 0
    chunk = lambda: _count_chunk(*(np.concatenate(c) for c in zip(*held)))
    for batch in batches:
        sid, values = _minima(batch)
        each = values.shape[1] if len(sid) else 0
        held.append((values.reshape(-1), np.repeat(sid, each), np.tile(np.arange(each, dtype=np.int32), len(sid))))
        rows += len(sid) * each
        if rows >= CHUNK:
            yield chunk()
            held, rows = [], 0
    if rows:
        yield chunk()


def _shared(batches):
    """Rows sorted by value: those whose value another row has too.  A run of
    equal values may go on in the next batch, so the last row waits for it."""
    names, held = ["value", "sid", "f", "shared"], None
    for batch in batches:
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        if held is not None:
            cols = [np.concatenate([[x], y]) for x, y in zip(held, cols)]
        value, sid, f, shared = cols
        if not len(value):
            continue
        same = value[1:] == value[:-1]
        shared = shared.copy()
        shared[1:] |= same
        shared[:-1] |= same
        held = (value[-1], sid[-1], f[-1], shared[-1])
        out = np.flatnonzero(shared[:-1])
        if len(out):
            yield pa.RecordBatch.from_arrays(
                [pa.array(sid[out].astype(np.int64)), pa.array(f[out].astype(np.int32))], ["sid", "f"])
    if held is not None and held[3]:
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(held[1])], pa.int64()), pa.array([int(held[2])], pa.int32())], ["sid", "f"])


def table_keys(values: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all pairs of a shared left and a shared right value."""
    m = values.shape[1] // 2
    row, i, j = np.nonzero(shared[:, :m, None] & shared[:, None, m:])
    return row, mix64(values[row, i] + mix64(values[row, m + j] ^ _U(0x632BE59BD9B4E019)))


def _emit(batches):
    keys, sids, held = [], [], 0
    for batch in batches:
        sid, values = _minima(batch)
        shared = np.zeros(values.shape, bool)
        hit = batch.column("shared")
        row = np.repeat(np.arange(len(sid)), hit.value_lengths().to_numpy())
        shared[row, hit.flatten().to_numpy()] = True
        for lo in range(0, len(sid), 512):
            at, key = table_keys(values[lo:lo + 512], shared[lo:lo + 512])
            keys.append(key)
            sids.append(sid[lo + at])
            held += len(key)
            if held >= CHUNK:
                yield combine_keys(keys, sids)
                keys, sids, held = [], [], 0
    if held:
        yield combine_keys(keys, sids)


def verify_block(m: int):
    def join(sets: list[np.ndarray], percent: int, side: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Component number of each set: pairs that agree in both collections
        are compared in full unless they are in one component already."""
        comp = np.unique(label, return_inverse=True)[1]
        size = np.array([len(s) for s in sets], np.int64)
        cut = np.cumsum(size) - size
        values = functions_of(np.concatenate(sets), cut, m)
        for lo in range(0, len(sets), TILE):
            a = values[lo:lo + TILE]
            meet = np.zeros((2, len(a), len(sets)), bool)
            for f in range(2 * m):
                meet[f // m] |= a[:, f, None] == values[None, :, f]
            for x in range(len(a)):
                p = lo + x
                ok = meet[0, x] & meet[1, x] & (comp != comp[p])
                ok &= 100 * np.minimum(size, size[p]) >= percent * np.maximum(size, size[p])
                ok[:p + 1] = False
                if side[p]:
                    ok &= side == 0
                for q in np.flatnonzero(ok):
                    if comp[q] == comp[p]:
                        continue
                    both = overlap(sets[p], sets[q])
                    if 100 * both >= percent * (size[p] + size[q] - both):
                        comp[comp == comp[q]] = comp[p]
        return comp
    return join


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: (id, n_shingles, component_id, kept); kept is the
    row whose id is its component's."""
    ship(docs.sparkSession)
    m = collection_size(percent)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = d.schema["id"].dataType.simpleString()
    point = stored(d.mapInArrow(_points(k, m), f"id {id_type}, n_shingles long, sid long, minima binary"), "points")
    first = stored(point.where("n_shingles > 0").groupBy("sid").agg(
        F.min("id").alias("id"), F.max("n_shingles").alias("n_shingles"), F.first("minima").alias("minima")), "sets")
    shared = (first.select("sid", "minima").mapInArrow(_values, "value long, sid long, f int, shared boolean")
              .repartition("value").sortWithinPartitions("value").mapInArrow(_shared, "sid long, f int")
              .groupBy("sid").agg(F.collect_list("f").alias("shared")))
    keyed = first.select("sid", "minima").join(shared, "sid")
    cluster = candidate_clusters(keyed.mapInArrow(_emit, KEY_ROWS))
    linked = link_clusters(d, first, cluster, k, percent, verify_block(m))
    out = classes(point.drop("minima"), first.select("sid", "id"), linked, id_col)
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
