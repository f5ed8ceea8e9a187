"""Classes of linked sets: candidate clusters from shared keys, exact links
inside the clusters, one row a document.

Shared by the operators on word shingles (5 and 12).  Sets that share a key
belong to one candidate cluster.  Map and reduce tasks hand on spanning forests
of what they have seen (one edge a set and chunk), never a key's pairs, and
clusters are the connected components of these edges.  Clusters are cut into
blocks of bounded size (most clusters are one); an operator's own block join
verifies links within a block, then blocks' main components meet through a few
members, and last every set outside its cluster's main component visits every
block.  Later passes link labels, not sets, so their edges are few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import connected_components, free_name, stored
from .text import Words, flat, mix64, row_slices

BLOCK_ITEMS = 1 << 19   # shingles in a block (about 4 MB of hashes)
SET_ITEMS = 512         # what a set counts besides its shingles: bounds a block's sets
PIVOTS = 8              # members by which blocks' main components meet
CHUNK = 1 << 18         # keys combined at a time in a task
FILTER_BITS = 1 << 26   # most bits of the filter over wanted ids (8 MB)
KEY_ROWS = "key long, a long, b long, is_pair boolean"
PACKED_KEYS = "bucket int, body binary"
BUCKET_KEYS = 1 << 21   # keys that one group of ``rarest_keys`` compares, at some 40 bytes each
_U = np.uint64


def doc_sets(data: np.ndarray, off: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row in the slice."""
    h, b = Words(data, off).shingles(k)
    for r in range(len(b) - 1):
        yield r, np.unique(h[b[r]:b[r + 1]])


def set_id(s: np.ndarray) -> np.uint64:
    """64 bits by which a set is known; 0 for the empty one."""
    if not len(s):
        return _U(0)
    x = mix64(s * _U(0xD6E8FEB86659FD93) + _U(1))
    return mix64(np.array([x.sum(dtype=np.uint64) ^ (np.bitwise_xor.reduce(mix64(x)) + _U(len(s)))]))[0]


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def forest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least node of the component, node) for every other node of the edges."""
    if not len(x):
        return x, y
    nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    u, v = at[:len(x)], at[len(x):]
    label = np.arange(len(nodes))
    while len(live := np.flatnonzero(label[u] != label[v])):
        a, b = label[u[live]], label[v[live]]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != (low := label[label])).any():
            label = low
    other = label != np.arange(len(nodes))
    return nodes[label[other]], nodes[other]


def _stars(key: np.ndarray, sid: np.ndarray):
    """Each key with its least set, and (least set, other) for the rest."""
    by = np.lexsort((sid, key))
    key, sid = key[by], sid[by]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    center = sid[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
    rest = ~first & (sid != center)
    return key[first], sid[first], center[rest], sid[rest]


def combine_keys(keys: list[np.ndarray], sids: list[np.ndarray]) -> pa.RecordBatch:
    """Map side: one (key, set) row a key, and a spanning forest of the sets
    that share keys here."""
    key, sid, x, y = _stars(np.concatenate(keys), np.concatenate(sids))
    x, y = forest(x, y)
    part = np.concatenate([key, mix64(x ^ (y * _U(3)))])
    cols = [part, np.concatenate([sid, x]), np.concatenate([np.zeros(len(sid), np.uint64), y])]
    return pa.RecordBatch.from_arrays(
        [pa.array(c.view(np.int64)) for c in cols] + [pa.array(np.arange(len(part)) >= len(key))],
        ["key", "a", "b", "is_pair"])


def _reduce_keys(batches):
    """Reduce side, rows sorted by key: a spanning forest a chunk of rows.
    Between chunks only the current key's first set is kept."""
    last, center = None, _U(0)
    held, rows = [], 0

    def edges():
        nonlocal last, center
        key, a, b = (np.concatenate([h[i] for h in held]) for i in range(3))
        pair = np.concatenate([h[3] for h in held])
        x, y = [a[pair]], [b[pair]]
        key, a = key[~pair], a[~pair]
        if len(key):
            first = np.concatenate([[key[0] != last], key[1:] != key[:-1]])
            at = np.maximum.accumulate(np.where(first, np.arange(len(key)), -1))
            middle = np.where(at >= 0, a[at], center)
            rest = ~first & (a != middle)
            x.append(middle[rest])
            y.append(a[rest])
            last, center = key[-1], middle[-1]
        x, y = forest(np.concatenate(x), np.concatenate(y))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y).view(np.int64)),
                                           pa.array(np.maximum(x, y).view(np.int64))], ["a", "b"])

    for batch in batches:
        held.append([batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("key", "a", "b")]
                    + [batch.column("is_pair").to_numpy(zero_copy_only=False)])
        rows += len(batch)
        if rows >= CHUNK:
            yield edges()
            held, rows = [], 0
    if held:
        yield edges()


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes()


def _of_planes(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(4, -1).T).view(np.uint32).ravel()


def packed_keys(keys: list[np.ndarray], sids: list[int], counts: list[int], spare: list[int], buckets: int) -> pa.RecordBatch:
    """Map side of ``rarest_keys``: the keys of each (set, spare) in ``counts``'
    order, one row a bucket of keys.  A body holds the number of its runs (4 bytes),
    their sets (8), lengths and spares (4 in planes), and the keys' last 40 bits
    (4 and 1): a bucket holds keys that differ there, but for some millionths."""
    key = np.concatenate(keys)
    run = np.repeat(np.arange(len(counts)), counts)
    bucket = ((key >> _U(40)) * _U(buckets) >> _U(24)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    key, run, cut = key[by], run[by], np.searchsorted(bucket[by], np.arange(buckets + 1))
    sid, spare_ = np.array(sids, np.uint64), np.array(spare, np.uint32)
    full, body = np.flatnonzero(np.diff(cut)), []
    for i in full:
        x, r = key[cut[i]:cut[i + 1]], run[cut[i]:cut[i + 1]]
        first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
        body.append(b"".join([
            np.uint32(len(first)).tobytes(), sid[r[first]].tobytes(), _planes(np.diff(first, append=len(r))),
            _planes(spare_[r[first]]), x.astype(np.uint32).tobytes(), (x >> _U(32)).astype(np.uint8).tobytes()]))
    return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(body, pa.binary())], ["bucket", "body"])


def _shared_keys(table: pa.Table) -> pa.Table:
    """One bucket: the keys that several sets have, with how many have them."""
    key, sid, spare, runs = [], [], [], []
    for body in table.column("body"):
        raw = np.frombuffer(body.as_buffer(), np.uint8)
        r = int(raw[:4].view(np.uint32)[0])
        runs.append(_of_planes(raw[4 + 8 * r:4 + 12 * r]))
        m, at = int(runs[-1].sum()), 4 + 16 * r
        sid.append(np.frombuffer(raw[4:4 + 8 * r].tobytes(), np.uint64))
        spare.append(_of_planes(raw[4 + 12 * r:at]))
        key.append(np.frombuffer(raw[at:at + 4 * m].tobytes(), np.uint32).astype(np.uint64)
                   | (raw[at + 4 * m:].astype(np.uint64) << _U(32)))
    key, sid, spare, runs = (np.concatenate(x) for x in (key, sid, spare, runs))
    by = np.argsort(key, kind="stable")
    key = key[by]
    same = key[1:] == key[:-1]
    same = np.concatenate([[False], same]) | np.concatenate([same, [False]])        # held twice or more
    key, run = key[same], np.repeat(np.arange(len(runs), dtype=np.int32), runs)[by[same]]
    by = np.lexsort((sid[run], key))
    key, sid, spare = key[by], sid[run[by]], spare[run[by]]
    once = np.concatenate([[True], (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])])[:len(key)]
    key, sid, spare = key[once], sid[once], spare[once]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
    n = np.diff(cut, append=len(key))
    n = np.repeat(n, n)
    keep = n > 1
    bucket = _U(table.column("bucket")[0].as_py()) << _U(40)
    return pa.table([pa.array(sid[keep].view(np.int64)), pa.array(spare[keep].astype(np.int32)), pa.array(n[keep].astype(np.int32)),
                     pa.array((key[keep] | bucket).view(np.int64))], names=["sid", "spare", "n", "key"])


def _first_keys(batches):
    """Rows sorted by set, spare, whether empty, count and key: a set's keys but
    the last ``spare`` (halved: its last bit tells two bands apart)."""
    tail = None

    def chosen(cols):
        sid, spare, key = cols
        cut = np.flatnonzero(np.concatenate([[True], (sid[1:] != sid[:-1]) | (spare[1:] != spare[:-1])]))
        n = np.diff(cut, append=len(sid))
        keep = np.arange(len(sid)) - np.repeat(cut, n) < np.repeat(n - spare[cut] // 2, n)
        if keep.any():
            yield combine_keys([key[keep]], [sid[keep]])

    for batch in batches:
        cols = [batch.column(c).to_numpy() for c in ("sid", "spare", "key")]
        cols = [cols[0].view(np.uint64), cols[1].astype(np.int64), cols[2].view(np.uint64)]
        if tail is not None:
            cols = [np.concatenate(x) for x in zip(tail, cols)]
        if not len(cols[0]):
            continue
        last = int(np.flatnonzero(np.concatenate([[True], (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])]))[-1])
        if last >= CHUNK:
            yield from chosen([x[:last] for x in cols])
            cols = [x[last:] for x in cols]
        tail = cols
    if tail is not None:
        yield from chosen(tail)


def rarest_keys(packed: DataFrame) -> DataFrame:
    """``combine_keys`` rows of the keys by which sets may meet, from all keys of
    all sets (``packed_keys``).  A set leaves out as many of its keys as it can
    spare: those that most sets have, which are its last ones in an order that is
    the same for all sets.  Keys that one set alone has come first and meet nothing;
    so a set whose keys are shared by a passage or a few lines gives none."""
    shared = packed.groupBy("bucket").applyInArrow(_shared_keys, "sid long, spare int, n int, key long")
    order = F.col("key").bitwiseAND(F.lit(1))
    return (stored(shared, "shared-keys").repartition("sid").sortWithinPartitions("sid", "spare", order, "n", "key")
            .mapInArrow(_first_keys, KEY_ROWS))


def candidate_clusters(key_rows: DataFrame) -> DataFrame:
    """(node, component) of the sets that share keys, from ``combine_keys`` rows."""
    return connected_components(key_rows.repartition("key").sortWithinPartitions("key")
                                .mapInArrow(_reduce_keys, "a long, b long"))


def cluster_blocks(first: DataFrame, cluster: DataFrame, block_items: int | None = None) -> DataFrame:
    """(cluster, blocks, block, sid, id): the sets in clusters and the block of
    each, dealt by their sizes in ``first`` (sid, id, n_shingles), without the sets."""
    member = first.select("sid", "id", "n_shingles").join(
        cluster.select(F.col("node").alias("sid"), F.col("component").alias("cluster")), "sid")
    size = (member.groupBy("cluster").agg(F.sum(F.col("n_shingles") + SET_ITEMS).alias("items"))
            .select("cluster", F.ceil(F.col("items") / (block_items or BLOCK_ITEMS)).cast("int").alias("blocks")))
    return member.join(size, "cluster").select(
        "cluster", "blocks", F.pmod(F.xxhash64("sid"), F.col("blocks").cast("long")).cast("int").alias("block"), "sid", "id")


def _may_hold(bits: np.ndarray, name: str, held: bool):
    def run(batches):
        for batch in batches:
            at = batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64)
            hit = (bits[at >> _U(6)] >> (at & _U(63))) & _U(1) == (1 if held else 0)
            yield batch.drop_columns([name]).take(pa.array(np.flatnonzero(hit)))
    return run


def wanted_bits(ids: DataFrame, col: str = "id") -> np.ndarray:
    """A bit per hashed id, 16 to 32 for each of ``ids``, at most ``FILTER_BITS``."""
    size = min(FILTER_BITS, max(64, 1 << (16 * ids.count()).bit_length()))
    at = F.pmod(F.xxhash64(col), F.lit(size).cast("long")).alias("at")
    words = (ids.select(at).groupBy(F.shiftright("at", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("mask")).toArrow())
    bits = np.zeros(size // 64, np.uint64)
    bits[words.column("word").to_numpy()] = words.column("mask").to_numpy().view(np.uint64)
    return bits


def rows_by_bits(d: DataFrame, bits: np.ndarray, col: str = "id", held: bool = True) -> DataFrame:
    """The rows of ``d`` whose id may be one of those of ``wanted_bits``; or, not
    ``held``, all others, which are none of them.  Nothing is shuffled."""
    name = free_name(d, "__at")
    at = F.pmod(F.xxhash64(col), F.lit(64 * len(bits)).cast("long")).alias(name)
    return d.select("*", at).mapInArrow(_may_hold(bits, name, held), d.schema)


def rows_wanted(d: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``d`` whose id is in ``ids`` (column id), and a few others: bits
    tell before any shuffle.  With more ids than ``FILTER_BITS`` serve well, more
    other rows pass."""
    return rows_by_bits(d, wanted_bits(ids))


def _cluster_sets(k: int):
    """Sets of the clusters' members: one row a set and task."""
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            data, off = flat(batch.column("text"))
            want = batch.column("sid").to_numpy(zero_copy_only=False).view(np.uint64)
            keep, body = [], []
            for lo, hi in row_slices(off):
                for r, s in doc_sets(data[off[lo]:off[hi]], off[lo:hi + 1], k):
                    if (sid := int(want[lo + r])) not in seen and set_id(s) == sid:
                        seen.add(sid)
                        keep.append(lo + r)
                        body.append(s.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(keep, pa.int64())) for c in ("cluster", "blocks", "block", "sid")]
                + [pa.array(body, pa.binary())], ["cluster", "blocks", "block", "sid", "shingles"])
    return run


def block_sets(d: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(cluster, blocks, block, sid, shingles) of ``cluster_blocks`` rows, from the
    texts ``d`` (id, text) of their first documents; other texts are left out
    before the join.  The sets are dealt by block once: there copies of a set are
    dropped and blocks are grouped."""
    want = blocks.withColumnRenamed("id", "want_id")
    d = rows_wanted(d, blocks)
    return (d.join(want, d["id"].eqNullSafe(F.col("want_id"))).select("cluster", "blocks", "block", "sid", "text")
            .mapInArrow(_cluster_sets(k), "cluster long, blocks int, block int, sid long, shingles binary")
            .repartition("cluster", "block").dropDuplicates(["cluster", "block", "sid"]))


JoinBlock = Callable[[list, int, np.ndarray, np.ndarray], np.ndarray]


def _units(join_block: JoinBlock, percent: int):
    """One block: its labels, each with the least label that it links with."""
    def run(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        label = table.column("label").to_numpy()
        comp = join_block(sets, percent, table.column("side").to_numpy(), label)
        least = np.full(len(label), np.iinfo(np.int64).max)
        np.minimum.at(least, comp, label)
        label, at = np.unique(label, return_index=True)
        return pa.table({"label": label, "to": least[comp[at]]})
    return run


def _relabel(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` with ``label`` replaced by the least label that ``edges`` reach."""
    comp = connected_components(edges.select(F.col("label").alias("a"), F.col("to").alias("b")))
    return (rows.join(comp.withColumnRenamed("node", "label"), "label", "left")
            .withColumn("label", F.coalesce("component", "label")).drop("component"))


def link_clusters(d: DataFrame, first: DataFrame, cluster: DataFrame, k: int, percent: int,
                  join_block: JoinBlock, block_items: int | None = None) -> DataFrame:
    """(sid, component) of the sets in clusters (node, component); a component is
    named by its least sid; a block holds about ``block_items``.  The sets come
    from the texts ``d`` (id, text) of their first documents ``first`` (sid, id,
    n_shingles).  ``join_block(sets, percent, side, label)`` gives the
    component number of each set of a block after linking all its pairs; two
    sets of side 1 (visitors) or of one label need not be compared."""
    blocks = stored(cluster_blocks(first, cluster, block_items), "blocks")
    unit = _units(join_block, percent)
    out = "label long, to long"
    home = (block_sets(d, blocks, k).select("cluster", "block", "sid", "shingles", F.lit(0).alias("side"), F.col("sid").alias("label"))
            .groupBy("cluster", "block").applyInArrow(unit, out))
    links = stored(home, "links").select(F.col("label").alias("sid"), F.col("to").alias("label"))
    if blocks.where("blocks > 1").isEmpty():
        return links.select("sid", F.col("label").alias("component"))

    # main component of each block, met through a few of its members
    big = stored(block_sets(d, blocks.where("blocks > 1"), k).join(links, "sid"), "big")
    count = big.groupBy("cluster", "block", "label").count()
    main = count.groupBy("cluster", "block").agg(
        F.max_by(F.struct("label", "count"), F.struct("count", "label")).alias("m")).select(
        "cluster", "block", "m.label", F.ceil(F.col("m.count") / PIVOTS).alias("every"))
    pivot = (big.join(main, ["cluster", "block", "label"])
             .where((F.col("sid") == F.col("label")) | (F.pmod(F.xxhash64("sid", F.lit(1)), F.col("every")) == 0))
             .select("cluster", "sid", "shingles", "label", "block"))
    # a unit holds the pivots of 64 blocks and of the next unit's first block
    unit_of = F.floor(F.col("block") / 64).cast("int")
    met = (pivot.withColumn("unit", F.explode(F.when(
               (F.col("block") % 64 == 0) & (F.col("block") > 0), F.array(unit_of - 1, unit_of))
               .otherwise(F.array(unit_of))))
           .select("cluster", F.col("unit").alias("block"), "sid", "shingles", F.lit(0).alias("side"), "label")
           .groupBy("cluster", "block").applyInArrow(unit, out))
    big = stored(_relabel(big, met), "labelled")

    # whatever is still outside its cluster's main component visits all blocks
    main = (big.groupBy("cluster", "label").count().groupBy("cluster")
            .agg(F.max_by("label", F.struct("count", "label")).alias("main")))
    big = big.join(main, "cluster")
    visit = (big.where("label <> main")
             .withColumn("to_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .where("to_block <> block")
             .select("cluster", F.col("to_block").alias("block"), "sid", "shingles",
                     F.lit(1).alias("side"), "label"))
    rows = big.select("cluster", "block", "sid", "shingles", F.lit(0).alias("side"), "label").union(visit)
    # dealt by block: both sides of the union come dealt by cluster
    far = rows.repartition("cluster", "block").groupBy("cluster", "block").applyInArrow(unit, out)
    big = _relabel(big.select("sid", "label"), far).select("sid", F.col("label").alias("component"))
    rest = links.join(big.select("sid"), "sid", "left_anti")              # clusters of one block
    done = rest.select("sid", F.col("label").alias("component")).union(big)
    # written, because a join on top of a union of partitioned sides can fail to
    # plan ("unequal numbers of partitions") when adaptive execution splits one
    return stored(done, "components")


def classes(point: DataFrame, first: DataFrame, component: DataFrame, id_col: str) -> DataFrame:
    """Per row of ``point`` (id, n_shingles, sid): (id, n_shingles,
    component_id), the least id of its set's component; without shingles its own."""
    root = first.join(component, "sid", "left").select(
        "sid", "id", F.coalesce("component", "sid").alias("root"))
    least = root.groupBy("root").agg(F.min("id").alias("component_id"))
    klass = root.join(least, "root").select("sid", "component_id")
    return (point.join(klass, "sid", "left")
            .select(F.col("id").alias(id_col), "n_shingles",
                    F.when(F.col("n_shingles") > 0, F.col("component_id"))
                    .otherwise(F.col("id")).alias("component_id")))
