"""N-gram Jaccard join with a count-vector R-tree (dealt operator 5).

Each text is the set of its distinct k-word shingles (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``).  Tokens are hashed into ``DIMS`` groups and a set is
the point of its group counts.  Two sets overlap in at most the sum of the
coordinate minima of their points; on the tree's boxes, of the upper corners.
A packed R-tree joins only nodes whose bound still allows the similarity and
verifies the surviving pairs on the sets themselves.

Distribution, without losing a link.  Similar sets differ in at most
d <= k(size band) shingles.  A second hash splits each set into more than k
groups, the same for all sets of the band.  A set whose own size allows d
differences gives keys of its d+1 first groups in an order that only depends on
a group's content: the groups that fewest sets have come first, so that groups
of a passage or line that many sets share seldom give any, and groups without
shingles come last.  Of two linked sets, each has an equal group among its first
ones, and the one of these that comes earlier in the order is among the first of
both: there they meet.  How many sets have a group is counted by a shuffle of
all groups' keys (``rarest_keys``), of which only shared ones go further.
Sets that share a key form a candidate cluster (``clusters``),
and every link lies inside one cluster, whose blocks the tree joins.  Equal
sets are one set throughout.

Edge cases: null, empty and white-space texts have no shingles and link with
nothing; texts of fewer than k words are one shingle; null ids are kept (they
never become a component id unless all of a class are null); repeated rows
each give a row; an empty table gives an empty result; only the id and the text
column are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clusters import (BLOCK_ITEMS, BUCKET_KEYS, CHUNK, PACKED_KEYS, candidate_clusters, classes, doc_sets, link_clusters,
                       overlap, packed_keys, rarest_keys, rows_by_bits, set_id, wanted_bits)
from .shipping import ship
from .store import free_name, stored, text_key
from .text import flat, mix64, row_slices

DIMS = 32               # coordinates of a point
LEAF = 32               # sets in a leaf, nodes in an inner node
SPARE = 2               # groups beyond those that differences may touch,
SPARE_PERCENT = 30      # and as many percent of these: the commonest groups give no keys
_U = np.uint64


def bands(percent: int, upto: int) -> np.ndarray:
    """Lower size bounds; a linked pair lies in one band or two neighbours."""
    out = [1]
    while out[-1] <= upto:
        out.append(max(out[-1] + 1, 100 * (out[-1] - 1) // percent + 1))
    for _ in range(2):
        out.append(max(out[-1] + 1, 100 * (out[-1] - 1) // percent + 1))
    return np.array(out, np.int64)


def max_diff(total: int, percent: int) -> int:
    """Most shingles in which linked sets of together ``total`` may differ."""
    return total * (100 - percent) // (100 + percent)


class CountRTree:
    """Packed R-tree over group-count points."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        # sort-tile order: size first, then the two widest coordinates
        wide = np.argsort(-counts.astype(np.int64).var(axis=0), kind="stable")[:2]
        tile = np.argsort(np.argsort(sizes, kind="stable"), kind="stable") // (LEAF * LEAF)
        self.order = np.lexsort((counts[:, wide[-1]], counts[:, wide[0]], tile))
        top, low = counts[self.order], sizes[self.order]
        self.levels = []                                 # [(upper corners, least sizes)], leaves first
        while True:
            cut = np.arange(0, len(low), LEAF)
            top, low = np.maximum.reduceat(top, cut), np.minimum.reduceat(low, cut)
            self.levels.append((top, low))
            if len(low) == 1:
                break

    def node_pairs(self, need) -> Iterator[tuple[int, int]]:
        """Leaf pairs (i <= j) whose boxes may hold a pair with enough overlap."""
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            lv, i, j = stack.pop()
            if lv == 0:
                yield i, j
                continue
            top, low = self.levels[lv - 1]
            a = np.arange(i * LEAF, min((i + 1) * LEAF, len(low)))
            b = np.arange(j * LEAF, min((j + 1) * LEAF, len(low)))
            bound = np.minimum(top[a][:, None], top[b][None]).sum(axis=2)
            ok = bound >= need(low[a][:, None] + low[b][None])
            for x, y in zip(*np.nonzero(ok)):
                if a[x] <= b[y]:
                    stack.append((lv - 1, int(a[x]), int(b[y])))

    def rows(self, leaf: int) -> np.ndarray:
        return self.order[leaf * LEAF:(leaf + 1) * LEAF]


def join_block(sets: list[np.ndarray], percent: int, side: np.ndarray,
               label: np.ndarray) -> np.ndarray:
    """Component label per set after linking all pairs of the block.

    ``side``: 0 home, 1 visitor; two visitors are not compared (they meet in
    a home block), nor are sets that already have one label.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    counts = np.stack([np.bincount((s >> _U(40)).astype(np.int64) % DIMS, minlength=DIMS)
                       for s in sets]).astype(np.int32)
    known, parent = np.unique(label, return_inverse=True)[1], {}

    def root(x: int) -> int:
        while (y := parent.get(x, x)) != x:
            parent[x] = parent.get(y, y)
            x = y
        return x

    need = lambda total: -(-percent * total // (100 + percent))
    tree = CountRTree(counts, sizes)
    for i, j in tree.node_pairs(need):
        a, b = tree.rows(i), tree.rows(j)
        bound = np.minimum(counts[a][:, None], counts[b][None]).sum(axis=2)
        ok = bound >= need(sizes[a][:, None] + sizes[b][None])
        ok &= ~((side[a] == 1)[:, None] & (side[b] == 1)[None])
        if i == j:
            ok = np.triu(ok, 1)
        for x, y in zip(*np.nonzero(ok)):
            p, q = int(a[x]), int(b[y])
            rp, rq = root(int(known[p])), root(int(known[q]))
            if rp == rq:
                continue
            both = overlap(sets[p], sets[q])
            if 100 * both >= percent * (sizes[p] + sizes[q] - both):
                parent[max(rp, rq)] = min(rp, rq)
    return np.array([root(int(x)) for x in known])


def _points(k: int):
    def run(batches):
        for batch in batches:
            data, off = flat(batch.column("text"))
            n = np.zeros(len(batch), np.int64)
            sid = np.zeros(len(batch), np.uint64)
            for lo, hi in row_slices(off):
                for r, s in doc_sets(data[off[lo]:off[hi]], off[lo:hi + 1], k):
                    n[lo + r], sid[lo + r] = len(s), set_id(s)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n), pa.array(sid.view(np.int64))],
                ["id", "n_shingles", "sid"])
    return run


def set_groups(s: np.ndarray, percent: int, edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """For both bands that this set may link in: (keys, sizes, groups that hold
    shingles, differences d that its own size allows).  Groups without shingles
    come last, and only where no more than d hold any."""
    n = len(s)
    band = int(np.searchsorted(edges, n, side="right")) - 1
    for j in (band, band + 1):
        most = int(edges[j + 1]) - 1
        k = max_diff(2 * most, percent)
        own = max_diff(n + min(100 * n // percent, most), percent)
        groups = k + 1 + (SPARE + SPARE_PERCENT * k // 100 if k else 0)
        x = mix64(s + _U(0x9E3779B97F4A7C15 * (2 * j + 3) % (1 << 64)))
        g = ((x >> _U(33)).astype(np.int64)) % groups
        by = np.argsort(g, kind="stable")
        g = g[by]
        cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        body = np.add.reduceat(x[by], cut)
        ids, size = g[cut], np.diff(cut, append=n)
        held = len(ids)
        if held <= own:
            empty = np.setdiff1d(np.arange(groups), ids)
            none = np.zeros(len(empty), np.int64)
            ids, body, size = np.concatenate([ids, empty]), np.concatenate([body, none.view(np.uint64)]), np.concatenate([size, none])
        yield mix64(body + mix64(ids.astype(np.uint64) + _U((j + 1) << 32))), size, held, own


def set_keys(s: np.ndarray, percent: int, edges: np.ndarray) -> np.ndarray:
    """Keys under which this set meets every set it may link with, where nothing
    is known of how many sets share a group: those of the largest groups."""
    return np.concatenate([keys[np.lexsort((keys, -size))[:own + 1]]
                           for keys, size, _, own in set_groups(s, percent, edges)])


def _emit(k: int, percent: int, buckets: int):
    """Map side: all groups of every set that is new to the task, a chunk at a time."""
    def run(batches):
        seen: set[int] = set()
        keys, sids, counts, spare, held, edges = [], [], [], [], 0, bands(percent, 1 << 16)
        for batch in batches:
            data, off = flat(batch.column("text"))
            for lo, hi in row_slices(off):
                for _, s in doc_sets(data[off[lo]:off[hi]], off[lo:hi + 1], k):
                    if not len(s) or (sid := int(set_id(s))) in seen:
                        continue
                    seen.add(sid)
                    if len(s) >= edges[-3]:
                        edges = bands(percent, 2 * len(s))
                    for scope, (key, _, full, own) in enumerate(set_groups(s, percent, edges)):
                        # the last bit tells groups without shingles
                        keys.append((key & ~_U(1)) | (np.arange(len(key)) >= full).astype(np.uint64))
                        sids.append(sid)
                        counts.append(len(key))
                        spare.append(2 * max(0, full - own - 1) + scope)
                        held += len(key)
                if held >= CHUNK:
                    yield packed_keys(keys, sids, counts, spare, buckets)
                    keys, sids, counts, spare, held = [], [], [], [], 0
        if held:
            yield packed_keys(keys, sids, counts, spare, buckets)
    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       k: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``docs``: (id, n_shingles, component_id)."""
    ship(docs.sparkSession)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = d.schema["id"].dataType.simpleString()
    point = stored(d.mapInArrow(_points(k), f"id {id_type}, n_shingles long, sid long"), "points")
    first = point.where("n_shingles > 0").groupBy("sid").agg(
        F.min("id").alias("id"), F.max("n_shingles").alias("n_shingles"))
    groups = point.where("n_shingles > 0").agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]     # more than there are
    buckets = max(1, -(-int(groups) // BUCKET_KEYS))
    cluster = candidate_clusters(rarest_keys(d.mapInArrow(_emit(k, percent, buckets), PACKED_KEYS)))
    return classes(point, first, link_clusters(d, first, cluster, k, percent, join_block, BLOCK_ITEMS), id_col)


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      k: int = 3, percent: int = 90) -> DataFrame:
    """``docs`` with one row of each component: of its rows with the least id
    (nulls last), the least by text key and other columns.  Rows without
    shingles stay.  Texts are what is linked, so an id's other texts stay too.
    Texts of one row that are kept, by a bit per hashed key most of them, pass
    without a shuffle."""
    key = free_name(docs, "__key")
    keyed = docs.withColumn(key, text_key(text_col))
    comp = (jaccard_components(keyed, key, text_col, k, percent).where("n_shingles > 0")
            .groupBy(F.col(key).alias("key")).agg(F.min("component_id").alias("component"), F.count("*").alias("rows")))
    least = keyed.groupBy(F.col(key).alias("key")).agg(F.min(id_col).alias("id"))
    comp = stored(comp.join(least, "key"), "text-components")
    best = comp.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", "key"))["key"].alias("best"))
    judged = stored(comp.join(best, "component").select(
        F.col("key").alias(key), (F.col("key") == F.col("best")).alias("kept"), "rows").where("rows > 1 or not kept"), "judged")
    bits = wanted_bits(judged, key)
    free = rows_by_bits(keyed, bits, key, held=False).select(*docs.columns)
    keyed = rows_by_bits(keyed, bits, key)
    alone = keyed.join(judged.select(key), key, "left_anti").select(*docs.columns)
    order = F.struct(F.col(id_col).isNull(), id_col, *[c for c in docs.columns if c not in (id_col, text_col)])
    # an aggregate, so a text that very many rows hold is combined inside the tasks
    one = (keyed.join(judged.where("kept").select(key), key)
           .groupBy(key).agg(F.min_by(F.struct(*docs.columns), order).alias("row")).select("row.*"))
    return free.union(alone).union(one)
