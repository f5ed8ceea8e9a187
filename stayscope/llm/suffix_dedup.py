"""Suffix-array removal of repeated byte strings (dealt operator 1).

Every byte covered by a ``length``-byte string that also starts anywhere else
in the corpus, in the same text or another, is removed; overlaps count, and
strings are judged on the input.  Texts are UTF-8 bytes, matches never cross
texts.

Distribution.  A window of ``length`` bytes belongs to the key of its least
``GRAM``-byte hash, so equal windows share a key; a text is cut into the
maximal runs of windows with one key ("strings", about 1.3 windows long).
Keys that occur once cannot hold a repeat and are dropped, unless their gram
occurs twice in the one string (map tasks mark the keys they see twice, so rows of a frequent key are dealt at random and not to
one task).  A key whose different strings overfill a shard is cut again, by the
least hashes under more hash orders, as many as its size asks for.  Equal strings under a key are one string with a count.  What is
left is dealt by key into shards of about ``SHARD_BYTES``; each shard's
strings form one text whose suffixes are sorted by external induced sorting
with their common prefixes (``suffix_sort``).  A window repeats where its
string's count is above one or the common prefix with a neighbour in suffix
order is at least ``length``.  Covered ranges go back to the texts.

Edge cases: null and empty texts have 0 bytes and nothing removed, texts
shorter than ``length`` keep everything; repeated rows (same id and text)
repeat each other; texts of one repeated symbol are one long string; null ids
are kept; an empty table gives an empty result; only id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .store import free_name, stored
from .suffix_sort import common_prefixes, suffix_array
from .text import BYTE_MIX, flat, mix64, powers, row_slices

LENGTH = 200
GRAM = 64                    # bytes whose least hash keys a window
SHARD_BYTES = 2 << 20
MAX_ORDERS = 40              # hash orders after which a key's strings stay together
FLUSH = 1 << 18              # strings a map task looks at for keys it sees twice
_U = np.uint64
_KNOWN, _DEALT = 1 << 62, 1 << 61      # flags in a string's packed position
_LEN_BITS = 30


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones (two running minima)."""
    m = len(h) - width + 1
    x = np.concatenate([h, np.full(-len(h) % width, ~_U(0), np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:m], ahead[width - 1:width - 1 + m])


def cut_strings(data: np.ndarray, off: np.ndarray, length: int, orders: int = 1):
    """(row, key, content hash, start, end, own) of every text's strings; own:
    its key's gram occurs twice in the string, so it may repeat itself.
    ``orders``: the key combines the least hashes under so many hash orders."""
    off = off - off[0]
    n = len(data)
    if n < length:
        return (np.zeros(0, np.int64),) + (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
    gram = min(GRAM, length)
    up, down = powers(n + 1)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_MIX[data] * up[:n], out=acc[1:])
    grams = mix64((acc[gram:] - acc[:-gram]) * down[:n - gram + 1])
    least = _sliding_min(grams, length - gram + 1)
    key = least
    for order in range(1, orders):
        other = _sliding_min(mix64(grams + _U(order) * _U(0x9E3779B97F4A7C15)), length - gram + 1)
        key = mix64(key * _U(3) + other)
    row = np.searchsorted(off, np.arange(len(key)), side="right") - 1
    inside = np.arange(len(key)) + length <= off[row + 1]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new & inside)
    stop = np.flatnonzero(new | ~inside)
    end = np.append(stop, len(key))[np.searchsorted(stop, start) + 1] - 1 + length
    body = mix64((acc[end] - acc[start]) * down[start] + (end - start).astype(np.uint64))
    # first place of the gram in the first window, last place in the last one
    wide = np.lib.stride_tricks.sliding_window_view(grams, length - gram + 1)
    own = np.zeros(len(start), bool)
    for lo in range(0, len(start), 4096):
        a, b = start[lo:lo + 4096], end[lo:lo + 4096] - length
        head = (wide[a] == least[a][:, None]).argmax(axis=1) + a
        tail = b + (length - gram) - (wide[b][:, ::-1] == least[b][:, None]).argmax(axis=1)
        own[lo:lo + 4096] = head < tail
    return row[start], key[start], body, start - off[row[start]], end - off[row[start]], own


def _marked(key, body, rid, pos, own):
    """Rows of a map task, with flags for keys that the task sees twice."""
    by = np.argsort(key, kind="stable")
    key, body, rid, pos, own = key[by], body[by], rid[by], pos[by], own[by]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    twice = own | ~first | np.concatenate([~first[1:], [False]])
    pos = pos | np.where(twice, _KNOWN, 0) | np.where(~first, _DEALT, 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(body.view(np.int64)), pa.array(rid), pa.array(pos)],
        ["key", "body", "rid", "pos"])


def _flushed(parts):
    """Batches of ``_marked`` from a task's strings, a bounded number at a time."""
    held, size = [], 0
    for key, body, rid, start, end, own in parts:
        if len(key):
            held.append((key, body, rid, (start << _LEN_BITS) | (end - start), own))
            size += len(key)
        if size >= FLUSH:
            yield _marked(*map(np.concatenate, zip(*held)))
            held, size = [], 0
    if size:
        yield _marked(*map(np.concatenate, zip(*held)))


def _cut(length: int):
    """Strings of every text."""
    def parts(batches):
        for batch in batches:
            data, off = flat(batch.column("text"))
            rid = batch.column("rid").to_numpy()
            for lo, hi in row_slices(off):
                row, key, body, start, end, own = cut_strings(data[off[lo]:off[hi]], off[lo:hi + 1], length)
                yield key, body, rid[lo + row], start, end, own
    return lambda batches: _flushed(parts(batches))


def _cut_again(length: int):
    """Strings of overfull keys, cut by more hash orders."""
    def parts(batches):
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            for z, rid, want in zip(batch.column("body_z"), batch.column("rid").to_numpy(), batch.column("want")):
                text = np.frombuffer(unzip.decompress(z.as_py()), np.uint8)
                for w in want.as_py():
                    part = text[w["start"]:w["start"] + w["len"]]
                    _, key, body, start, end, own = cut_strings(part, np.array([0, len(part)]), length, w["orders"])
                    yield key, body, np.full(len(key), rid), start + w["start"], end + w["start"], own
    return lambda batches: _flushed(parts(batches))


def _repeated(batches):
    """Rows sorted by key: those whose key occurs again or is known to.  One
    row is held back until the next key shows."""
    cols = ("key", "body", "rid", "pos")
    pending, emitted_key = None, None
    for batch in batches:
        key, body, rid, pos = (batch.column(c).to_numpy() for c in cols)
        if pending is not None:
            key, body, rid, pos = (np.concatenate([[p], x]) for p, x in zip(pending, (key, body, rid, pos)))
            pending = None
        if not len(key):
            continue
        again = np.concatenate([[key[0] == emitted_key], key[1:] == key[:-1]])
        keep = again | ((pos & _KNOWN) != 0)
        keep[:-1] |= again[1:]
        if not keep[-1]:
            pending = (key[-1], body[-1], rid[-1], pos[-1])
            key, body, rid, pos, keep = key[:-1], body[:-1], rid[:-1], pos[:-1], keep[:-1]
        else:
            emitted_key = key[-1]
        if keep.any():
            at = pos[keep] & (_DEALT - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (key[keep], body[keep], rid[keep], at >> _LEN_BITS,
                                       at & ((1 << _LEN_BITS) - 1))],
                ["key", "body", "rid", "start", "len"])


def _pack(batches):
    """Texts compressed for the two joins that carry them."""
    zip_ = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, off = flat(batch.column("text"))
        body = [zip_.compress(data[off[i]:off[i + 1]].tobytes()) for i in range(len(batch))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in batch.schema.names if c != "text"] + [pa.array(body, pa.binary())],
            [c for c in batch.schema.names if c != "text"] + ["body_z"])


def _strings(batches):
    unzip = zstandard.ZstdDecompressor()
    for batch in batches:
        out = {"shard": [], "key": [], "body": [], "n": [], "bytes": []}
        for z, want in zip(batch.column("body_z"), batch.column("want")):
            text = unzip.decompress(z.as_py())
            for w in want.as_py():
                for c in ("shard", "key", "body", "n"):
                    out[c].append(w[c])
                out["bytes"].append(text[w["start"]:w["start"] + w["len"]])
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("shard", pa.int32()), ("key", pa.int64()), ("body", pa.int64()), ("n", pa.int64()),
            ("bytes", pa.binary())]))


def covered_ranges(strings: list[bytes], count: np.ndarray, length: int) -> list[np.ndarray]:
    """Per string the covered byte ranges, [[start, end], ...], of the windows
    that occur again among the strings or in a string with a count above one."""
    size = np.array([len(s) for s in strings], np.int64)
    body = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.uint16) + 2
    start = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    text = np.append(body, np.uint16(0))
    text[start + size] = 1
    sa = suffix_array(text)
    lcp = common_prefixes(text, sa, int(size.max()))
    near = lcp >= length
    near[:-1] |= lcp[1:] >= length
    hit = np.zeros(len(text), bool)
    hit[sa[near]] = True
    for i in np.flatnonzero(count > 1):
        hit[start[i]:start[i] + size[i] - length + 1] = True
    valid = np.zeros(len(text) + 1, np.int8)              # windows inside one string
    valid[start] += 1
    valid[start + size - length + 1] -= 1
    hit &= np.cumsum(valid)[:-1] > 0
    first = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1]]))
    last = np.flatnonzero(hit & ~np.concatenate([hit[1:], [False]])) + length
    of = np.searchsorted(start, first, side="right") - 1
    spans = np.stack([first - start[of], np.minimum(last - start[of], size[of])], axis=1)
    cut = np.searchsorted(of, np.arange(len(strings) + 1))
    return [_merged(spans[cut[i]:cut[i + 1]]) for i in range(len(strings))]


def _merged(spans: np.ndarray) -> np.ndarray:
    """Union of ranges, as maximal ranges in order."""
    if len(spans) < 2:
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], np.append(reach[at[1:] - 1], reach[-1])], axis=1)


def _sort_shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        strings = table.column("bytes").to_pylist()
        spans = covered_ranges(strings, table.column("n").to_numpy(), length)
        keep = [i for i, s in enumerate(spans) if len(s)]
        at = pa.array(keep, pa.int64())
        return pa.table({"key": table.column("key").take(at), "body": table.column("body").take(at),
                         "spans": pa.array([spans[i].astype(np.int64).tobytes() for i in keep], pa.binary())})
    return run


def _remove(as_text: bool):
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        for batch in batches:
            size, spans_out, kept = [], [], []
            for z, found in zip(batch.column("body_z"), batch.column("found")):
                text = np.frombuffer(unzip.decompress(z.as_py()), np.uint8)
                spans = np.zeros((0, 2), np.int64)
                if found.is_valid:
                    spans = _merged(np.concatenate([
                        np.frombuffer(f["spans"], np.int64).reshape(-1, 2) + f["start"] for f in found.as_py()]))
                keep = np.ones(len(text), bool)
                for a, b in spans:
                    keep[a:b] = False
                size.append(len(text))
                rest = text[keep].tobytes()
                kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
                spans_out.append([{"start": int(a), "end": int(b)} for a, b in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column("carry"), pa.array(size, pa.int64()), pa.array(spans_out, span_type),
                 pa.array(kept, pa.string() if as_text else pa.binary())], ["carry", "n_bytes", "spans", "kept"])
    return run


_CUT_SCHEMA = "key long, body long, rid long, pos long"


def _repeats_only(cut: DataFrame) -> DataFrame:
    """Strings whose key occurs again (or that may repeat themselves)."""
    dealt = F.when(F.col("pos").bitwiseAND(_DEALT) != 0, F.xxhash64("rid", "pos")).otherwise(F.col("key"))
    return stored(cut.repartition(dealt).sortWithinPartitions("key")
                  .mapInArrow(_repeated, "key long, body long, rid long, start long, len long"), "runs")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """Per row of ``docs``: carry (struct of the columns other than the text),
    n_bytes, spans removed, kept (bytes; with ``as_text`` a string, where the
    bytes of a character that was cut through go with it)."""
    ship(docs.sparkSession)
    others = [c for c in docs.columns if c != text_col]
    d = docs.select(F.struct(*others).alias("carry"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("rid", F.xxhash64(F.col("carry").getField(id_col), "text"))
    carry_type = d.schema["carry"].dataType.simpleString()
    packed = d.mapInArrow(_pack, f"carry {carry_type}, rid long, body_z binary")
    runs = _repeats_only(d.select("rid", "text").mapInArrow(_cut(length), _CUT_SCHEMA))
    orders = 1
    while True:                                    # keys whose strings overfill a shard
        size = (runs.groupBy("key", "body").agg(F.max("len").alias("len"))
                .groupBy("key").agg(F.sum("len").alias("bytes")).where(F.col("bytes") > SHARD_BYTES))
        full = stored(size, "overfull")
        if orders > MAX_ORDERS or full.isEmpty():
            break
        # as many orders as halvings are needed; each leaves a window of other
        # surroundings in company with about a third of the others
        full = full.select("key", (F.lit(orders) + F.ceil(F.log2(F.col("bytes") / SHARD_BYTES)))
                           .cast("int").alias("orders"))
        want = runs.join(full, "key").groupBy("rid").agg(
            F.collect_list(F.struct("start", "len", "orders")).alias("want"))
        again = _repeats_only(packed.join(want, "rid").select("rid", "body_z", "want")
                              .mapInArrow(_cut_again(length), _CUT_SCHEMA))
        orders = full.agg(F.max("orders")).first()[0] + 1
        runs = stored(runs.join(full, "key", "left_anti").unionByName(again), "runs")
    total = runs.agg(F.sum("len")).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_BYTES))
    one = (runs.groupBy("key", "body")
           .agg(F.count("*").alias("n"), F.min(F.struct("rid", "start", "len")).alias("m"))
           .select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"),
                   "key", "body", "n", "m.rid", "m.start", "m.len"))
    want = one.groupBy("rid").agg(F.collect_list(
        F.struct("shard", "key", "body", "n", "start", "len")).alias("want"))
    strings = (packed.select("rid", "body_z").join(want, "rid").select("body_z", "want")
               .mapInArrow(_strings, "shard int, key long, body long, n long, bytes binary"))
    spans = stored(strings.groupBy("shard").applyInArrow(
        _sort_shard(length), "key long, body long, spans binary"), "spans")
    # repeated rows may name a string twice; the union of ranges absorbs it, and
    # a plain join lets adaptive execution split the rows of many equal strings
    found = (runs.join(spans, ["key", "body"])
             .groupBy("rid").agg(F.collect_list(F.struct("start", "spans")).alias("found")))
    return (packed.join(found, "rid", "left").select("carry", "body_z", "found").mapInArrow(
        _remove(as_text), f"carry {carry_type}, n_bytes long, spans array<struct<start:long,end:long>>, "
                          f"kept {'string' if as_text else 'binary'}"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated strings removed from the text (null stays
    null); no row goes."""
    no_text = free_name(docs, "__no_text")
    marked = docs.withColumn(no_text, F.col(text_col).isNull())
    kept = remove_repeats(marked, id_col, text_col, length, as_text=True)
    return kept.select(*[
        F.when(~F.col("carry").getField(no_text), F.col("kept")).alias(c) if c == text_col
        else F.col("carry").getField(c).alias(c) for c in docs.columns])
