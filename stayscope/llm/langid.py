"""Language identification by prediction by partial matching (dealt operator 10).

One byte context tree a language, orders 0 to ``ORDER``, statistics frozen
after training.  A byte seen in a context has probability count / (total +
distinct); the context escapes to the next shorter one with distinct /
(total + distinct); below order 0 a byte costs 8 bits (escape method C, no
exclusion).  The code length of a text is the exact sum over its bytes under
each language's tree, plus the language's own cost from its share of the
training documents; the shortest code wins.  A text is preceded by ``ORDER``
zero bytes.

Training reads at most ``sample_docs`` whole documents a language, those with
the least hash of their id; all counts of that bounded sample are taken.
Scoring reads all bytes of all texts: since the statistics are frozen, the
cost of a byte depends only on itself and ``ORDER`` bytes before it, so costs
of known (ORDER+1)-grams are looked up and others are computed from the tree.

Edge cases: null text, and text without a letter, is ``und`` with score 0;
documents with null text or language do not train; without any training
document all texts are ``und``; ties go to the first language by code point;
repeated rows each get their row; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .shipping import ship
from .store import stored
from .text import flat, mix64, row_slices

ORDER = 3                # bytes of context
SAMPLE_DOCS = 300        # whole training documents a language, at most
MAX_BROADCAST = 10_000   # languages up to which their counts are broadcast
CHUNK = 1 << 18          # bytes scored at a time
UND = "und"
_U = np.uint64


def grams(data: np.ndarray, off: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The (ORDER+1)-byte gram that ends at each byte in [lo, hi), zero bytes
    standing before a text's start."""
    start = off[np.searchsorted(off, np.arange(lo, hi), side="right") - 1]
    at = np.arange(lo, hi)
    out = data[lo:hi].astype(np.uint32)
    for j in range(1, ORDER + 1):
        prev = data[np.maximum(at - j, 0)].astype(np.uint32)
        out |= np.where(at - j >= start, prev, 0).astype(np.uint32) << np.uint32(8 * j)
    return out


class ContextTree:
    """Frozen counts of one language: per order, sorted grams and contexts."""

    def __init__(self, full: np.ndarray, counts: np.ndarray):
        self.orders = []
        for k in range(ORDER + 1):
            g = full & np.uint32((1 << (8 * (k + 1))) - 1)
            g, inv = np.unique(g, return_inverse=True)
            c = np.bincount(inv, weights=counts)
            ctx, cinv = np.unique(_context(g), return_inverse=True)
            total = np.bincount(cinv, weights=c)
            kinds = np.bincount(cinv)
            seen = np.log2((total + kinds)[cinv]) - np.log2(c)
            escape = np.log2(total + kinds) - np.log2(kinds)
            self.orders.append((g, seen, ctx, escape))

    def bits(self, full: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each gram after the bytes before."""
        out = np.zeros(len(full))
        open_ = np.arange(len(full))
        for k in range(ORDER, -1, -1):
            if not len(open_):
                break
            g, seen, ctx, escape = self.orders[k]
            x = full[open_] & np.uint32((1 << (8 * (k + 1))) - 1)
            at = np.minimum(np.searchsorted(g, x), len(g) - 1)
            hit = g[at] == x
            out[open_[hit]] += seen[at[hit]]
            open_, x = open_[~hit], x[~hit]
            c = _context(x)
            at = np.minimum(np.searchsorted(ctx, c), len(ctx) - 1)
            out[open_] += np.where(ctx[at] == c, escape[at], 0.0)
        out[open_] += 8.0
        return out


def _context(g: np.ndarray) -> np.ndarray:
    """The bytes before a gram's last byte (the last byte is the low one)."""
    return g >> np.uint32(8)


class Model:
    """Trees, priors and a table of the known grams' costs."""

    def __init__(self, trees: dict[str, ContextTree], prior_bits: np.ndarray):
        self.langs = sorted(trees)
        self.trees = [trees[x] for x in self.langs]
        self.prior = prior_bits
        known = np.unique(np.concatenate([t.orders[ORDER][0] for t in self.trees]))
        size = 1 << max(12, int(2 * len(known) - 1).bit_length())
        self.shift = _U(64 - size.bit_length() + 1)
        self.cost = np.stack([t.bits(known) for t in self.trees], axis=1)
        slot = self._slot(known)
        self.table = np.full(size + 64, -1, np.int32)
        self.known = known
        left = np.arange(len(known))
        for _ in range(64):                               # linear probing, one round a step
            free = self.table[slot[left]] < 0
            self.table[slot[left[free]]] = left[free]
            lost = self.table[slot[left]] != left
            left = left[lost]
            if not len(left):
                break
            slot[left] += 1
        self.spill = left                                 # practically none; looked up by the tree

    def _slot(self, g: np.ndarray) -> np.ndarray:
        return (mix64(g.astype(np.uint64)) >> self.shift).astype(np.int64)

    def bits(self, g: np.ndarray) -> np.ndarray:
        """Code lengths [len(g), languages]."""
        idx = np.full(len(g), -1, np.int64)
        open_ = np.arange(len(g))
        slot = self._slot(g)
        for _ in range(64):
            got = self.table[slot[open_]]
            hit = (got >= 0) & (self.known[got] == g[open_])
            idx[open_[hit]] = got[hit]
            open_ = open_[~hit & (got >= 0)]
            if not len(open_):
                break
            slot[open_] += 1
        out = self.cost[idx]
        new = np.flatnonzero(idx < 0)
        if len(new):
            u, inv = np.unique(g[new], return_inverse=True)
            out[new] = np.stack([t.bits(u) for t in self.trees], axis=1)[inv]
        return out


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str,
          sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Fit on at most ``sample_docs`` documents a language.

    Candidates are first thinned by a hash threshold taken from the language's
    document count, so the ranking that makes the bound exact sees a few
    hundred rows a language, never a whole language."""
    d = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                    F.xxhash64(F.col(id_col).cast("string"), F.lit(17)).alias("h")) \
        .where("text is not null and lang is not null")
    ship(docs.sparkSession)
    n = d.groupBy("lang").agg(F.count("*").alias("n"))
    n = stored(n, "languages")               # one row a language
    near = d.join(F.broadcast(n) if n.count() <= MAX_BROADCAST else n, "lang").where(
        F.pmod("h", F.lit(1 << 20)) < F.ceil(F.lit(2.0 * sample_docs * (1 << 20)) / F.col("n")))
    rank = Window.partitionBy("lang").orderBy("h", "text")
    picked = near.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= sample_docs)
    counted = (picked.select("lang", "n", "text").repartition("lang")
               .mapInArrow(_count_grams, "lang string, n long, g long, c long")
               .groupBy("lang", "n", "g").agg(F.sum("c").alias("c")).toArrow())
    if not counted.num_rows:
        return None
    lang = np.array(counted.column("lang").to_pylist(), object)
    g, c, n = (counted.column(x).to_numpy() for x in ("g", "c", "n"))
    trees, docs_n = {}, {}
    for x in sorted(set(lang)):
        at = lang == x
        trees[x] = ContextTree(g[at].astype(np.uint32), c[at].astype(float))
        docs_n[x] = float(n[at][0])
    share = np.array([docs_n[x] for x in sorted(trees)])
    return Model(trees, -np.log2(share / share.sum()))


def _count_grams(batches):
    for batch in batches:
        data, off = flat(batch.column("text"))
        for i in range(len(batch)):
            lo, hi = int(off[i]), int(off[i + 1])
            if hi > lo:
                g, c = np.unique(grams(data[lo:hi], np.array([0, hi - lo]), 0, hi - lo), return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.repeat(batch.column("lang")[i], len(g)),
                    "n": pa.repeat(batch.column("n")[i], len(g)),
                    "g": g.astype(np.int64), "c": c.astype(np.int64)})


def pieces(off: np.ndarray, chunk: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of at most ``chunk``: whole texts, and a longer one by itself in
    pieces from its start, so that a text's sum does not depend on its neighbours."""
    for a, b in row_slices(off, chunk):
        for lo in range(int(off[a]), int(off[b]), chunk):
            yield lo, min(int(off[b]), lo + chunk)


def _score(model, chunk):
    def run(batches):
        m = model.value
        for batch in batches:
            data, off = flat(batch.column("text"))
            rows = len(batch)
            total = np.tile(m.prior, (rows, 1))
            for lo, hi in pieces(off, chunk):
                bits = m.bits(grams(data, off, lo, hi))
                a = int(np.searchsorted(off, lo, side="right")) - 1
                b = int(np.searchsorted(off, hi, side="left"))
                cut = np.maximum(off[a:b], lo) - lo
                full = np.flatnonzero(np.diff(np.append(cut, hi - lo)) > 0)
                total[a + full] += np.add.reduceat(bits, cut[full], axis=0)
            best = total.argmin(axis=1)
            least = total[np.arange(rows), best]
            score = 1.0 / np.exp2(np.minimum(least[:, None] - total, 0.0)).sum(axis=1)
            n = np.maximum(np.diff(off), 1)
            ok = batch.column("letter").to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays([
                batch.column("id"),
                pa.array([m.langs[x] if y else UND for x, y in zip(best, ok)], pa.string()),
                pa.array(np.where(ok, score, 0.0)),
                pa.array(np.where(ok, (least - m.prior[best]) / n, 0.0)), pa.array(np.diff(off))],
                ["id", "lang_pred", "score", "bits_per_byte", "n_bytes"])
    return run


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(id, lang_pred, score, bits_per_byte, n_bytes) for every row."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                    F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    if model is None:
        return d.select(F.col("id").alias(id_col), F.lit(UND).alias("lang_pred"),
                        F.lit(0.0).alias("score"), F.lit(0.0).alias("bits_per_byte"),
                        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)     # bounded by the training sample
    out = (StructType().add("id", d.schema["id"].dataType).add("lang_pred", "string").add("score", "double")
           .add("bits_per_byte", "double").add("n_bytes", "long"))
    return (d.mapInArrow(_score(held, chunk), out)
            .withColumnRenamed("id", id_col))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", held_out=None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Train on the rows where ``held_out`` is false and predict all rows."""
    fit = docs if held_out is None else docs.where(~F.coalesce(held_out, F.lit(False)))
    return predict(docs, train(fit, id_col, text_col, lang_col, sample_docs), id_col, text_col)
