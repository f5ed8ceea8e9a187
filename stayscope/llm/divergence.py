"""How the sources of each language differ in their words (dealt operator 11).

Texts are lower-cased and split by Arrow compute kernels, words are
dictionary-encoded, and Arrow's hash group-by counts them per (language,
source) inside ``mapInArrow``; a task merges its batches' counts before it hands
them on.  The merged counts are a columnar table, one row a (language, term)
with the occurrences by source; a language keeps the terms that at least
``least_docs`` of its documents hold.  Shards of (language, term) rows, cut so
that terms times sources are bounded, then meet their language's totals and
compute the divergences of all pairs of sources and of every source from its
language.  Shares are whole numbers (parts of ``SCALE``), so sums are exact and
do not depend on how the shards were cut.

Bounds.  A task holds a shard of at most ``max(CELLS, sources**2)`` cells; the
totals are one row a (language, source), never collected.  Exact while a
language's occurrences and terms stay below 9e15.

Edge cases: null text, language and source are empty ones; a group without
terms is still compared (with ``V`` kept terms of the language, each of count
0); a language without kept terms gives pairs of value 0; a language with one
source has no pairs; repeated rows count as documents of their own; ties go by
the item's bytes; an empty table gives no rows; only the three named columns are
read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shipping import ship
from .store import stored

NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"     # what separates terms
SCALE_STEPS, STEP = 3, 1000                       # SCALE = STEP ** SCALE_STEPS
LEAST_DOCS = 3                                    # documents of its language that hold a kept term
TOP_TERMS = 200                                   # terms reported of a group
CELLS = 1 << 16                                   # terms times sources of a shard
MERGE_ROWS = 1 << 18                              # counts that a task gathers before it merges them
_COUNTS = "lang string, source string, term string, occ long, docs long"
_NAMES = ["lang", "source", "term", "occ", "docs"]


def _text(column: pa.Array) -> pa.Array:
    return pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "")


def count_terms(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, occurrences, documents) of one batch; a null term
    says that the group occurs."""
    lang, source = (_text(batch.column(c)).dictionary_encode() for c in ("lang", "source"))
    group = (lang.indices.to_numpy().astype(np.int64) * len(source.dictionary)
             + source.indices.to_numpy())
    parts = pc.split_pattern_regex(pc.ascii_lower(_text(batch.column("text"))), NOT_TERM)
    row, term = pc.list_parent_indices(parts), pc.list_flatten(parts)
    real = pc.not_equal(term, "")
    row, term = row.filter(real), term.filter(real).dictionary_encode()
    words = (pa.table({"row": row, "code": term.indices})
             .group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")]))
    counts = (pa.table({"group": group[words.column("row").to_numpy()], "code": words.column("code"),
                        "n": words.column("count_all")})
              .group_by(["group", "code"], use_threads=False).aggregate([("n", "sum"), ("n", "count")]))
    seen = np.unique(group)
    code = pa.chunked_array([*counts.column("code").chunks, pa.nulls(len(seen), term.indices.type)])
    group = np.concatenate([counts.column("group").to_numpy(), seen])
    none = np.zeros(len(seen), np.int64)
    return pa.table([lang.dictionary.take(pa.array(group // max(1, len(source.dictionary)))),
                     source.dictionary.take(pa.array(group % max(1, len(source.dictionary)))),
                     pa.chunked_array([term.dictionary.take(code.combine_chunks())]),
                     np.concatenate([counts.column("n_sum").to_numpy(), none]),
                     np.concatenate([counts.column("n_count").to_numpy(), none])], names=_NAMES)


def _merge(tables: list[pa.Table]) -> pa.Table:
    return (pa.concat_tables(tables).group_by(_NAMES[:3], use_threads=False)
            .aggregate([("occ", "sum"), ("docs", "sum")]).select([*_NAMES[:3], "occ_sum", "docs_sum"])
            .rename_columns(_NAMES))


def _partial_counts(batches):
    held, rows = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(count_terms(batch))
        rows += len(held[-1])
        if rows >= MERGE_ROWS:
            merged = _merge(held)
            held, rows = [merged], len(merged)
            if rows >= MERGE_ROWS // 2:             # mostly different terms: hand them on
                yield from merged.to_batches()
                held, rows = [], 0
    if held:
        yield from _merge(held).to_batches()


def shares(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10**9 * (count + 1) / total), exactly, by long division."""
    left, out = count.astype(np.int64) + 1, np.zeros(np.broadcast(count, total).shape, np.int64)
    for _ in range(SCALE_STEPS):
        left = left * STEP
        out = out * STEP + left // total
        left = left % total
    return out + 1


def _divergences(shard: pa.Table, groups: pa.Table) -> pa.Table:
    """Of one shard of one language: part sums of each pair of sources, and
    each source's own first terms."""
    source = groups.column("source").to_pylist()
    order = np.argsort(np.array([s.encode() for s in source], object), kind="stable")
    source = [source[i] for i in order]
    v = groups.column("v")[0].as_py()
    total = groups.column("occ").to_numpy()[order] + v
    out = {"source": [], "part": [], "item": [], "value": []}

    def add(who, part, items, values):
        out["source"] += [who] * len(items)
        out["part"] += [part] * len(items)
        out["item"] += items
        out["value"] += values.tolist()

    if not len(shard):                                   # no kept term: pairs of value 0
        for a in source:
            other = [b for b in source if b != a]
            add(a, "pair", other, np.zeros(len(other), np.int64))
        return _parted(groups, out)
    cells = shard.column("cells").combine_chunks()
    length = pc.list_value_length(cells).to_numpy()
    flat = cells.flatten()
    at = pc.index_in(flat.field("source"), pa.array(source, flat.field("source").type)).to_numpy()
    count = np.zeros((len(source), len(shard)), np.int64)
    count[at, np.repeat(np.arange(len(shard)), length)] = flat.field("occ").to_numpy()
    p = shares(count, total[:, None])
    for a, who in enumerate(source):
        apart = p[a][None] - p
        value = (apart * apart // p).sum(axis=1)
        add(who, "pair", source[:a] + source[a + 1:], np.delete(value, a))
    q = shares(count.sum(axis=0), groups.column("lang_occ")[0].as_py() + v)
    apart = p - q[None]
    value = apart * apart // q[None]
    term = shard.column("term").combine_chunks()
    for a, who in enumerate(source):
        own = np.flatnonzero((count[a] > 0) & (p[a] > q))
        found = pa.table({"term": term.take(pa.array(own)).cast(pa.binary()), "value": value[a][own]})
        first = pc.sort_indices(found, [("value", "descending"), ("term", "ascending")])[:TOP_TERMS]
        found = found.take(first)
        add(who, "term", found.column("term").cast(pa.string()).to_pylist(), found.column("value").to_numpy())
    return _parted(groups, out)


def _parted(groups: pa.Table, out: dict) -> pa.Table:
    lang = groups.column("lang")[0].as_py()
    return pa.table([pa.array([lang] * len(out["value"]), pa.string()),
                     *(pa.array(out[c], pa.string()) for c in ("source", "part", "item")),
                     pa.array(out["value"], pa.int64())], names=["lang", "source", "part", "item", "value"])


def kept_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """(terms, groups): terms (lang, term, cells of (source, occ)) that a
    language keeps; groups (lang, source, occ, lang_occ, v, sources), one row a
    group that occurs."""
    ship(docs.sparkSession)
    named = docs.select(*[F.col(c).cast("string").alias(n) for c, n in
                          ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    rows = (named.mapInArrow(_partial_counts, _COUNTS).repartition("lang", "term")
            .groupBy("lang", "term", "source").agg(F.sum("occ").alias("occ"), F.sum("docs").alias("docs"))
            .groupBy("lang", "term").agg(F.collect_list(F.struct("source", "occ")).alias("cells"),
                                         F.sum("docs").alias("docs")))
    rows = stored(rows.where(F.col("term").isNull() | (F.col("docs") >= least_docs)).drop("docs"), "terms")
    terms = rows.where("term is not null")
    occ = (rows.select("lang", F.explode("cells").alias("c")).groupBy("lang", "c.source")
           .agg(F.sum("c.occ").alias("occ")))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    by_lang = Window.partitionBy("lang")
    groups = occ.join(kept, "lang", "left").select(
        "lang", "source", "occ", F.sum("occ").over(by_lang).alias("lang_occ"),
        F.coalesce("v", F.lit(0)).alias("v"), F.count(F.lit(1)).over(by_lang).alias("sources"))
    return terms, stored(groups, "groups")


def ranked(rows: DataFrame) -> Column:
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return F.row_number().over(w).alias("rank")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank).  Part ``pair``: the divergence
    of the source from each other source of its language; part ``term``: the
    terms that the source uses more than its language, the first ``top_terms``
    (at most 200) of them."""
    if not 0 < top_terms <= TOP_TERMS:
        raise ValueError(f"top_terms is 1 to {TOP_TERMS}")
    terms, groups = kept_counts(docs, text_col, lang_col, source_col, least_docs)
    per_shard = F.greatest(F.floor(F.lit(CELLS) / F.col("sources")), F.col("sources"))
    plan = groups.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("v") / per_shard)).cast("long"))
    langs = plan.groupBy("lang").agg(F.first("shards").alias("shards"))
    dealt = terms.join(langs, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("shards")).alias("shard"), "term", "cells")
    every = plan.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"),
                        "source", "occ", "lang_occ", "v")
    found = stored(dealt.groupBy("lang", "shard").cogroup(every.groupBy("lang", "shard")).applyInArrow(
        _divergences, "lang string, source string, part string, item string, value long"), "divergences")
    pair = (found.where("part = 'pair'").groupBy("lang", "source", "part", "item")
            .agg(F.sum("value").alias("value")))
    pair = pair.select("*", ranked(pair))
    term = found.where("part = 'term'")
    term = term.select("*", ranked(term)).where(F.col("rank") <= top_terms)
    return pair.unionByName(term)
