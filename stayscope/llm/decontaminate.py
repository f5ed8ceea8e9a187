"""Benchmark decontamination by size-partitioned MinHash containment search
(dealt operator 7, DataFrame functions only).

A test item of q distinct k-word shingles leaks into a document that holds at
least ``threshold`` of them.  Documents are partitioned by size, class j
holding fewer than 2**j shingles.  A class has 2**(j + extra) MinHash bins by
the hash's top bits; a document's signature is the least hash of each bin
(one permutation), an item's signature is computed with every class's bins,
and a document is a candidate where any bin agrees (bands of one row).
``extra`` follows from the smallest item so that a leak is missed by all its
bins with probability at most ``miss``; for an item of one shingle this makes
every shingle its own bin, which is exact.  Candidates are verified by exact
containment of the shingle strings.

An item of 1 to k - 1 words has its whole word sequence as its one shingle and
leaks into a document that holds this sequence: for each such length among the
items the documents' shingles of that many words are joined with them.

Words are ``[^\\x20\\x09-\\x0D]+`` after folding A-Z.  Edge cases: null or empty
texts have no shingles; such items match nothing, such documents hold nothing;
documents of fewer than k words can hold items of fewer words; repeated rows of one id are one pair
with the largest containment; a null id is an id like others; an empty table
gives an empty result; only ids and texts are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import free_name, stored, text_key

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "\t\n\x0b\x0c\r"
BROADCAST_ROWS = 1 << 20      # rows of (class, hash, item) that may be broadcast: about 32 MB


def words(text: Column) -> Column:
    """Folded words of a text; null gives an empty array."""
    flat = F.translate(F.coalesce(text, F.lit("")), UPPER + SPACES, LOWER + " " * len(SPACES))
    return F.array_remove(F.split(flat, " "), "")


def over_words(text: Column, k: int, make) -> Column:
    """``make(words, i)`` for every k-word shingle; the words are bound once
    as a lambda variable instead of being recomputed for each shingle."""
    empty = F.array().cast("array<int>")
    return F.transform(F.array(words(text)), lambda w: F.transform(
        F.when(F.size(w) >= k, F.sequence(F.lit(1), F.size(w) - (k - 1))).otherwise(empty),
        lambda i: make(w, i)))[0]


def shingle_hashes(text: Column, k: int) -> Column:
    return over_words(text, k, lambda w, i: F.xxhash64(F.slice(w, i, k)))


def shingle_strings(text: Column, k: int) -> Column:
    return F.array_distinct(over_words(text, k, lambda w, i: F.array_join(F.slice(w, i, k), " ")))


def signature(hashes: Column, size_class: Column, extra: int) -> Column:
    """Least hash of each of the class's bins: in sorted order, the first hash
    of each run with equal top bits; the others become null."""
    shift = F.greatest(F.lit(0), F.lit(64 - extra) - size_class)
    top = lambda x: F.call_function("shiftright", x, shift)
    none = F.array(F.lit(None).cast("long"))
    return F.transform(F.array(F.sort_array(hashes)), lambda s: F.zip_with(
        s, F.concat(none, s), lambda h, prev: F.when(
            prev.isNull() | (top(h) != top(prev)), h)))[0]


def size_class(n: Column) -> Column:
    return F.length(F.bin(n.cast("long")))


def extra_bits(smallest: int, threshold: float, miss: float) -> int:
    """Bins per shingle (log2) for the wanted miss probability."""
    share = math.ceil(threshold * max(1, smallest) - 1e-9)
    load = 2 * miss ** (1 / share)           # a shingle loses its bin with about load / 2
    return min(63, max(2, math.ceil(-math.log2(load))))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", k: int = 5,
                 threshold: float = 0.8, miss: float = 1e-9) -> DataFrame:
    """(id, item, n_item, n_shared, containment) of every leak."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    bodies = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("body"))
    it = stored(bodies.withColumn("grams", shingle_strings(F.col("body"), k))
                .withColumn("hashes", shingle_hashes(F.col("body"), k))
                .where(F.size("grams") > 0).drop("body"), "items")
    short = stored(bodies.withColumn("words", words(F.col("body"))).select(
        "item", F.size("words").alias("m"), F.array_join("words", " ").alias("gram"))
        .where((F.col("m") > 0) & (F.col("m") < k)).distinct(), "short-items")
    small = it.agg(F.min(F.size("grams"))).first()[0]
    extra = extra_bits(small or 1, threshold, miss)

    signed = (d.withColumn("h", shingle_hashes(F.col("text"), k)).where(F.size("h") > 0)
              .withColumn("j", size_class(F.size("h")))
              .select("id", "j", F.explode(signature(F.col("h"), F.col("j"), extra)).alias("v"))
              .where("v is not null"))
    wanted = (it.select("item", "hashes", F.explode(F.sequence(F.lit(1), F.lit(31))).alias("j"))
              .select("j", "item", F.explode(signature(F.col("hashes"), F.col("j"), extra)).alias("v"))
              .where("v is not null").distinct())
    wanted = stored(wanted, "item-signatures")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    pairs = stored(signed.join(wanted, ["j", "v"]).select("id", "item").distinct(), "candidates")

    found = pairs.groupBy("id").agg(F.collect_set("item").alias("found"))
    if pairs.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    held = (d.join(found.withColumnRenamed("id", "found_id"), F.col("id").eqNullSafe(F.col("found_id")))
            .select("id", shingle_strings(F.col("text"), k).alias("own"), "found")
            .select("id", "own", F.explode("found").alias("item")))
    both = held.join(F.broadcast(it.select("item", "grams")) if small_table(it) else it.select("item", "grams"), "item")
    n, shared = F.size("grams"), F.size(F.array_intersect("grams", "own"))
    leaks = (both.select("id", "item", n.alias("n_item"), shared.alias("n_shared"))
             .withColumn("containment", F.col("n_shared") / F.col("n_item"))
             .where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item") - 1e-9))
    lengths = [r["m"] for r in short.select("m").distinct().collect()]              # at most k - 1
    side = F.broadcast(short) if lengths and short.count() <= BROADCAST_ROWS else short
    for m in lengths:
        grams = d.select("id", F.explode(shingle_strings(F.col("text"), m)).alias("gram"))
        leaks = leaks.unionByName(grams.join(side.where(F.col("m") == m), "gram").select(
            "id", "item", F.lit(1).alias("n_item"), F.lit(1).alias("n_shared"), F.lit(1.0).alias("containment")))
    return (leaks.groupBy("id", "item")
            .agg(F.max_by(F.struct("n_item", "n_shared", "containment"), "containment").alias("m"))
            .select(F.col("id").alias(id_col), F.col("item").alias(item_col),
                    F.col("m.n_item").cast("long").alias("n_item"),
                    F.col("m.n_shared").cast("long").alias("n_shared"), "m.containment"))


def small_table(items: DataFrame) -> bool:
    return items.count() <= BROADCAST_ROWS // 64


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without the rows that hold a test item; rows of one id with
    other texts stay."""
    key = free_name(docs, "__key")
    keyed = docs.withColumn(key, text_key(text_col))
    bad = contaminated(keyed, items, id_col=key, text_col=text_col, **kw).select(key).distinct()
    return keyed.join(bad, key, "left_anti").select(*docs.columns)
