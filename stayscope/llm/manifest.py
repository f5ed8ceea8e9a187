"""Merkle manifest of a dataset as a persistent tree (dealt operator 13).

Every row is a leaf, the SHA-256 of its fields; the leaves of a group, in id
order, are hashed in pairs up to the group's subroot, and the subroots, in
group order, up to the root.  The tree is persistent: ``PathTree.update``
appends the copied ancestors of a changed leaf as a new version, which shares
every untouched node with the tree before; older versions stay readable.

Distribution.  Leaves are numbered by a range shuffle and cut into aligned
blocks of ``2**bits``; a block is one row that holds its leaves, so no task
holds more than a block's tree at a time.  The blocks' digests are the leaves of
the next tier, cut into aligned blocks again, until one digest a group is left;
then the same over the groups.  A tier has one node for 1024 of the tier below,
so the paths above a block are composed from the top tier down by joins of
bounded fan-out.  A changed leaf's version copies the ancestors in its block
and goes on along the block's path through the tiers above, in the block's own
task: versions of different blocks never meet in one task, however many there are.

Edge cases: a null field is ``-``, so it differs from an empty one; null ids
come first (ties by leaf digest) and are leaves like others; repeated rows are
equal leaves, each with its place; a null group comes before the empty one; a
group of one leaf has it as subroot, one group's subroot is the root; an empty
table has no rows and no root; only the named fields are read, so other columns
cannot clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import numbered
from .shipping import ship
from .store import stored

BITS = 10                       # a block has 2**BITS leaves, unless told otherwise
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def joined_hash(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


class PathTree:
    """Binary hash tree over ``leaves``; nodes are only ever appended.

    A node is a number; ``left``, ``right`` (-1: none) and ``digest`` are read
    by it.  ``levels`` above what the leaves need repeat the hash of one child,
    as in a last block that is not full.
    """

    def __init__(self, leaves: Sequence[str], levels: int):
        self.digest, self.levels = list(leaves), levels
        self.left, self.right = [-1] * len(leaves), [-1] * len(leaves)
        row = list(range(len(leaves)))
        for _ in range(levels):
            row = [self._node(row[i], row[i + 1] if i + 1 < len(row) else -1) for i in range(0, len(row), 2)]
        self.root = row[0]

    def _node(self, left: int, right: int) -> int:
        self.digest.append(joined_hash(self.digest[left], self.digest[right] if right >= 0 else ""))
        self.left.append(left)
        self.right.append(right)
        return len(self.digest) - 1

    def path(self, place: int, root: int | None = None) -> list[tuple[str, int]]:
        """From the leaf up: (side of the sibling, its node); ("-", -1) for none."""
        node, steps = self.root if root is None else root, []
        for level in range(self.levels - 1, -1, -1):
            if place >> level & 1:
                steps.append(("L", self.left[node]))
                node = self.right[node]
            else:
                steps.append(("R" if self.right[node] >= 0 else "-", self.right[node]))
                node = self.left[node]
        return steps[::-1]

    def update(self, place: int, leaf: str, root: int | None = None) -> int:
        """Root of a version of ``root`` in which ``place`` holds ``leaf``:
        one new node a level, all others shared."""
        steps = self.path(place, root)
        self.digest.append(leaf)
        self.left.append(-1)
        self.right.append(-1)
        node = len(self.digest) - 1
        for side, other in steps:
            node = self._node(other, node) if side == "L" else self._node(node, other)
        return node


def _children(side: str, node: str, other: str) -> tuple[str, str | None]:
    return (other, node) if side == "L" else (node, other or None)


def _pages(nodes: DataFrame, cells: Sequence[str], bits: int) -> DataFrame:
    """One row a block: its cells in order (at most ``2**bits``), the levels it
    climbs, and the blocks ``n`` of its group, which are the next tier's nodes."""
    whole = F.first("n") > 1 << bits
    exact = F.ceil(F.log2(F.first("n").cast("double") - 0.5))       # of n <= 2**bits, the levels to one node
    return (nodes.groupBy("g", F.shiftright("pos", bits).alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("pos", *cells))).alias("cells"),
                 F.when(whole, bits).when(F.first("n") == 1, 0).otherwise(exact).cast("int").alias("levels"),
                 F.when(whole, F.shiftright(F.first("n") + ((1 << bits) - 1), bits)).otherwise(1).alias("n")))


def _rows(batch: pa.RecordBatch):
    """Per page of a batch: (row number, its cells as lists by field)."""
    cells = batch.column("cells")
    for i in range(len(batch)):
        page = cells.slice(i, 1).flatten()
        yield i, {f.name: page.field(j).to_pylist() for j, f in enumerate(page.type)}


def _block_digests(batches):
    """Pages to the nodes of the next tier."""
    for batch in batches:
        levels = batch.column("levels").to_pylist()
        top = [(t := PathTree(c["digest"], levels[i])).digest[t.root] for i, c in _rows(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("g"), batch.column("block"), pa.array(top, pa.string()),
                                          batch.column("n")], ["g", "pos", "digest", "n"])


def _block_paths(batches):
    """Pages to one row a node: its path in the block and the block's digest."""
    for batch in batches:
        g, n, levels = (batch.column(c).to_pylist() for c in ("g", "n", "levels"))
        out = [[], [], [], [], []]
        for i, c in _rows(batch):
            tree = PathTree(c["digest"], levels[i])
            for place, pos in enumerate(c["pos"]):
                steps = [side + (tree.digest[node] if node >= 0 else "") for side, node in tree.path(place)]
                for column, value in zip(out, (g[i], pos, steps, tree.digest[tree.root], n[i])):
                    column.append(value)
        types = (pa.string(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)],
                                         ["g", "pos", "path", "above", "n"])


def climb(nodes: DataFrame, bits: int) -> DataFrame:
    """(g, pos, top, path) of nodes (g, pos, digest, n): the digest that is left
    of each group and every node's siblings on the way to it, from below."""
    if nodes.where("n > 1").isEmpty():
        return nodes.select("g", "pos", F.col("digest").alias("top"),
                            F.array().cast("array<string>").alias("path"))
    tier = stored(_pages(nodes, ["digest"], bits).mapInArrow(
        _block_paths, "g string, pos long, path array<string>, above string, n long"), "tier")
    over = climb(tier.where(F.col("pos") % (1 << bits) == 0).select(
        "g", F.shiftright("pos", bits).alias("pos"), F.col("above").alias("digest"), "n"), bits)
    over = over.select("g", F.col("pos").alias("block"), "top", F.col("path").alias("beyond"))
    return stored(tier.withColumn("block", F.shiftright("pos", bits)).join(over, ["g", "block"])
                  .select("g", "pos", "top", F.concat("path", "beyond").alias("path")), "paths")


def _fold(digest: str, steps: Sequence[str]) -> str:
    for step in steps:
        digest = joined_hash(*(x or "" for x in _children(step[0], digest, step[1:])))
    return digest


def _proofs(batches):
    """Pages with the path above them to one row a leaf; a changed leaf is a
    version of the block's tree, folded on along the path above."""
    for batch in batches:
        above, root, sub = (batch.column(c).to_pylist() for c in ("path", "root", "subroot"))
        levels = batch.column("levels").to_pylist()
        ids, out = [], [[], [], [], [], [], []]
        for i, c in _rows(batch):
            tree = PathTree(c["digest"], levels[i])
            far = [step[1:] for step in above[i]]
            ids.extend(c["id"])
            for place, (leaf, changed) in enumerate(zip(c["digest"], c["changed"])):
                near = [tree.digest[node] for _, node in tree.path(place) if node >= 0]
                version = tree.update(place, changed or leaf)
                folded = _fold(tree.digest[version], above[i])
                for column, value in zip(out, (leaf, sub[i], root[i], joined_hash(*near, *far),
                                               folded, folded == root[i])):
                    column.append(value)
        names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.schema.field("cells").type.value_type.field("id").type),
             *(pa.array(v, pa.bool_() if k == "verified" else pa.string()) for k, v in zip(names, out))],
            ["id", *names])


def _versions(batches):
    """Pages to the nodes that the changed leaves' versions copied."""
    for batch in batches:
        above, levels = batch.column("path").to_pylist(), batch.column("levels").to_pylist()
        ids, out = [], [[], [], [], []]
        for i, c in _rows(batch):
            tree = PathTree(c["digest"], levels[i])
            for place, changed in enumerate(c["changed"]):
                if changed is None or changed == c["digest"][place]:
                    continue
                node, copied = tree.update(place, changed), []
                top = tree.digest[node]
                for _ in range(tree.levels):
                    l, r = tree.left[node], tree.right[node]
                    copied.append((tree.digest[l], tree.digest[r] if r >= 0 else None, tree.digest[node]))
                    # the copied child is the one appended by this version
                    node = l if r < 0 or l > r else r
                copied.reverse()
                for step in above[i]:
                    l, r = _children(step[0], top, step[1:])
                    top = joined_hash(l, r or "")
                    copied.append((l, r, top))
                ids.extend([c["id"][place]] * len(copied))
                for level, made in enumerate(copied, 1):
                    for column, value in zip(out, (level, *made)):
                        column.append(value)
        types = (pa.int32(), pa.string(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, batch.schema.field("cells").type.value_type.field("id").type),
             *(pa.array(v, t) for v, t in zip(out, types))], ["id", "level", "left", "right", "digest"])


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each with its length in bytes, or ``-`` if null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]).cast("binary"), 256)


@dataclass
class Manifest:
    """``pages``: blocks of leaves with the path above them (g, block, cells,
    levels, subroot, root, path)."""

    pages: DataFrame
    id_type: str

    def proofs(self) -> DataFrame:
        """Per row: id, leaf, subroot, root, proof_sha256 (its siblings' hash),
        folded_root (from its changed leaf, else its own) and verified."""
        return self.pages.mapInArrow(_proofs, f"id {self.id_type}, leaf string, subroot string, root string, "
                                              "proof_sha256 string, folded_root string, verified boolean")

    def versions(self) -> DataFrame:
        """Nodes copied for each changed leaf, from its parent (level 1) to the
        root of its version; every other node is shared with the tree."""
        return self.pages.mapInArrow(_versions, f"id {self.id_type}, level int, left string, right string, digest string")

    def roots(self) -> DataFrame:
        """(group, subroot, root), one row a group."""
        return self.pages.where("block = 0").select(
            F.when(F.col("g") != "", F.substring("g", 2, 1 << 30)).alias("group"), "subroot", "root")


def build(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
          where: Column | None = None, changes: Mapping[str, Column] | None = None, bits: int = BITS) -> Manifest:
    """The manifest of ``docs``; rows that satisfy ``where`` also carry the leaf
    that ``changes`` (field: new value) would give them.  ``bits`` sets the
    blocks' size; it does not change any digest."""
    ship(docs.sparkSession)
    changes = changes or {}
    changed = leaf_digest([changes.get(f, F.col(f)) for f in fields])
    leaves = stored(docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col(group_col).cast("string")), F.lit("")).alias("g"),
        F.col(id_col).alias("id"), leaf_digest([F.col(f) for f in fields]).alias("digest"),
        F.when(where if where is not None else F.lit(False), changed).alias("changed")), "leaves")
    pages = stored(_pages(numbered(leaves, "g", ["id", "digest"]), ["id", "digest", "changed"], bits), "pages")
    node = "g string, pos long, digest string, n long"
    below = climb(stored(pages.mapInArrow(_block_digests, node), "blocks"), bits)
    groups = numbered(below.where("pos = 0").select(F.lit("").alias("all"), "g", F.col("top").alias("digest")),
                      "all", ["g"])
    over = climb(stored(groups.select(F.col("all").alias("g"), "pos", "digest", "n"), "groups"), bits)
    over = groups.select("g", "pos").join(over.select("pos", F.col("top").alias("root"),
                                                      F.col("path").alias("beyond")), "pos").drop("pos")
    paths = below.withColumnsRenamed({"pos": "block", "top": "subroot"}).join(over, "g").select(
        "g", "block", "subroot", "root", F.concat("path", "beyond").alias("path"))
    return Manifest(stored(pages.join(paths, ["g", "block"]), "pages-paths"),
                    docs.schema[id_col].dataType.simpleString())
