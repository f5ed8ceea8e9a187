"""Mixing sources to target weights with a multivariate-hypergeometric
splitting tree (dealt operator 4).

Targets: the sources, by code point with null last, have the given weights
(repeating) and share the whole size; a target stops at ``max_repeat`` times
its source's size and the excess is shared again by weight until none is
above.  A source is read whole floor(target / size) times, and for the rest
documents are taken in the order of a hash of id and text until the target is
reached: the hash at which it is reached is found exactly, to one document,
by counting words per hash digit and descending into the digit where the
running sum crosses the rest, for all sources at once; what then still lacks
is filled the same way from later documents that fit.

Blocks: an epoch of a source is its documents by that epoch's hash, cut into
equal hash ranges of about ``block_words`` words; so blocks are disjoint and
already permuted.  The exact block quotas of all sources are split among the
output shards: a node of the tree that covers m shards draws the blocks of its
left half from its own quota vector by a multivariate hypergeometric draw,
seeded by the node, down to single shards.  A shard then holds, of each
source, the next run of blocks, and orders its documents by a hash
(local shuffle).  Every draw depends on seeds, ids and texts only, so reruns
agree.

Edge cases: null texts and texts without words have size 0 and are taken 0
words; a null source is a source of its own; a source without words has
target 0; repeated rows (same id and text) fall on one side of the cut
together; an empty table gives an empty result; only the three named columns
are read, so extra columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEAT = 3
SHARDS = 64
BLOCK_WORDS = 50_000
SEED = 20240607
HASH_BITS = 36            # of a document's place in an epoch
DIGIT_BITS = 12           # hash bits looked at in a pass of the cut search


def targets(sizes: Sequence[float], weights: Sequence[float], max_repeat: float) -> np.ndarray:
    """Share sum(sizes) by weight, none above ``max_repeat`` times its size."""
    sizes = np.asarray(sizes, float)
    weights = np.asarray(weights, float)
    out, open_ = np.zeros(len(sizes)), np.ones(len(sizes), bool)
    left = sizes.sum()
    while open_.any():
        share = left * weights / weights[open_].sum()
        over = open_ & (share > max_repeat * sizes)
        if not over.any():
            out[open_] = share[open_]
            break
        out[over] = max_repeat * sizes[over]
        left -= out[over].sum()
        open_ &= ~over
    return out


def split_tree(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source for each shard [shards, sources]; sums are exact."""
    out = np.zeros((shards, len(quotas)), np.int64)
    stack = [(0, shards, quotas.astype(np.int64))]
    while stack:
        lo, hi, q = stack.pop()
        if hi - lo == 1:
            out[lo] = q
            continue
        mid = (lo + hi) // 2
        rng = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        draw = int(q.sum()) * (mid - lo) // (hi - lo)
        left = rng.multivariate_hypergeometric(q, draw, method="marginals")
        stack += [(lo, mid, left), (mid, hi, q - left)]
    return out


def _place(epoch) -> Column:
    """A document's place in an epoch, 0 .. 2**HASH_BITS - 1."""
    return F.shiftrightunsigned(F.xxhash64("id", "text_hash", epoch), 64 - HASH_BITS)


def _cuts(placed: DataFrame, plan: DataFrame, nearer: bool, hint) -> DataFrame:
    """(sid, cut, left): the documents (sid, place, size) with place < cut have
    at most ``rest`` words, and with the next one more; ``left`` is what then
    lacks.  With ``nearer`` that next one is taken if it comes nearer."""
    open_ = plan.select("sid", F.col("rest").alias("left"), F.lit(0).cast("long").alias("prefix"))
    done = 0
    while done < HASH_BITS:
        step = min(DIGIT_BITS, HASH_BITS - done)
        done += step
        digit = F.shiftrightunsigned("place", HASH_BITS - done)
        near = (placed.join(hint(open_), "sid")
                .where(F.shiftrightunsigned(digit, step) == F.col("prefix"))
                .groupBy("sid", digit.alias("digit")).agg(F.sum("size").alias("words")))
        # at most 2**DIGIT_BITS rows a source, whatever the table's size
        listed = near.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("digit", "words"))).alias("d"))
        zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("at"),
                        F.lit(0).cast("long").alias("cross"))
        walked = F.aggregate("d", zero, lambda a, x: F.when(
            (a["at"] < 0) & (a["sum"] + x["words"] <= F.col("left")),
            F.struct((a["sum"] + x["words"]).alias("sum"), a["at"].alias("at"), a["cross"].alias("cross")))
            .when(a["at"] < 0, F.struct(a["sum"].alias("sum"), x["digit"].alias("at"), x["words"].alias("cross")))
            .otherwise(a))
        last = done == HASH_BITS
        w = (open_.join(listed, "sid", "left").withColumn("w", walked)
             .withColumn("left", F.col("left") - F.coalesce("w.sum", F.lit(0))))
        # the crossing document is taken if that comes nearer
        up = F.when(F.lit(last and nearer) & (F.coalesce("w.cross", F.lit(0)) - F.col("left") < F.col("left")), 1).otherwise(0)
        open_ = stored(w.select("sid", "left", F.when(F.coalesce("w.at", F.lit(-1)) >= 0, F.col("w.at") + up)
                                .when(F.col("left") <= 0, F.col("prefix") * (1 << step))
                                .otherwise((F.col("prefix") + 1) * (1 << step)).cast("long").alias("prefix")), "cuts")
    return open_.select("sid", F.col("prefix").alias("cut"), "left")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT, shards: int = SHARDS,
        block_words: int = BLOCK_WORDS, seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document of ``docs``: (id, source, size, source_size, target,
    draws: array of (epoch, block, shard, order)) and the columns ``carry``.  ``order`` is the local
    shuffle's key in the shard.  The driver holds one row per source."""
    spark = docs.sparkSession
    sized = stored(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(text_col)).alias("text_hash"),
        *[F.col(c).alias(f"carry{i}") for i, c in enumerate(carry)]), "sized")
    found = sized.groupBy("source").agg(F.sum("size").alias("words")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    size = np.array([r["words"] for r in found], float)
    goal = targets(size, [weights[i % len(weights)] for i in range(len(found))], max_repeat)
    plan_type = ("sid int, name string, source_size long, target double, whole long, rest long")
    rows = []
    for i, r in enumerate(found):
        whole = int(goal[i] // size[i] + 1e-9) if size[i] else 0
        rows.append((i, r["source"], r["words"], float(goal[i]), whole,
                     max(0, round(goal[i] - whole * size[i]))))
    plan = spark.createDataFrame(rows, plan_type)
    small = len(rows) * shards <= 1 << 20
    hint = F.broadcast if small else (lambda x: x)
    sized = sized.join(hint(plan), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    # the cut, then a second one among later documents that fit what still lacks
    placed = stored(sized.where("rest > 0 and size > 0").select(
        "sid", "size", _place(F.col("whole").cast("int")).alias("place")), "places")
    first = _cuts(placed, plan.select("sid", "rest"), nearer=False, hint=hint)
    fits = placed.join(hint(first), "sid").where("place >= cut and size <= left").select("sid", "size", "place")
    second = _cuts(fits, first.select("sid", F.col("left").alias("rest")), nearer=True, hint=hint)
    cut = {r["sid"]: (r["cut"], r["left"], max(r["cut"], r["cut2"])) for r in first.join(
        second.select("sid", F.col("cut").alias("cut2")), "sid").collect()}

    blocks = np.array([max(1, math.ceil(r[2] / block_words)) for r in rows], np.int64)
    part = np.array([math.ceil(min(2 ** HASH_BITS, cut[i][2]) / 2 ** HASH_BITS * blocks[i]) for i in range(len(rows))], np.int64)
    quota = np.array([r[4] for r in rows], np.int64) * blocks + part
    ends = np.cumsum(split_tree(quota, shards, seed), axis=0) if rows else np.zeros((shards, 0), np.int64)
    more = spark.createDataFrame(
        [(i, *map(int, cut[i]), int(blocks[i]), ends[:, i].tolist()) for i in range(len(rows))],
        "sid int, cut long, left long, cut2 long, blocks long, ends array<long>")
    d = sized.join(hint(more), "sid")
    place = _place(F.col("whole").cast("int"))
    again = (F.col("rest") > 0) & (F.col("size") > 0) & ((place < F.col("cut")) | (
        (F.col("size") <= F.col("left")) & (place < F.col("cut2"))))
    epochs = F.sequence(F.lit(0), (F.col("whole") + again.cast("int")).cast("int"))
    epochs = F.slice(epochs, 1, F.size(epochs) - 1)       # 0 .. times - 1

    def draw(e):
        block = F.floor(_place(e) / F.lit(float(2 ** HASH_BITS)) * F.col("blocks"))
        t = e * F.col("blocks") + block
        shard = F.size(F.filter("ends", lambda x: x <= t))
        return F.struct(e.alias("epoch"), block.alias("block"), shard.alias("shard"),
                        F.xxhash64("id", "text_hash", e, F.lit(seed)).alias("order"))

    draws = F.when(F.col("size") > 0, F.transform(epochs, draw)).otherwise(F.transform(F.slice(epochs, 1, 0), draw))
    return d.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size",
                    "source_size", "target", draws.alias("draws"),
                    *[F.col(f"carry{i}").alias(c) for i, c in enumerate(carry)])
