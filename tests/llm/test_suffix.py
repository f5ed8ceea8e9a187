"""Suffix sorting and removal of repeated strings against brute force."""

import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_fixtures import awkward_docs, collected, docs_frame, empty_docs
from stayscope.llm import suffix_dedup as D
from stayscope.llm import suffix_sort as S


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(2, 5), min_size=1, max_size=60), st.integers(1, 40))
def test_suffix_array_and_prefixes_match_sorting(symbols, limit):
    text = np.array(symbols + [0], np.uint16)
    sa = S.suffix_array(text, limit=limit)          # a small limit puts the queue on disk
    assert list(sa) == sorted(range(len(text)), key=lambda i: tuple(text[i:]))
    lcp = S.common_prefixes(text, sa, len(text))
    for i in range(1, len(text)):
        a, b = text[sa[i - 1]:], text[sa[i]:]
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        assert lcp[i] == k


def test_queue_spills_and_keeps_order():
    q = S.SymbolQueue(3, limit=4)
    q.push(np.array([1, 2, 1, 2]), np.array([10, 20, 11, 21]))
    q.push(np.array([2, 1, 2]), np.array([22, 12, 23]))
    assert q.spilled >= 7
    q.push(np.array([1]), np.array([13]))
    assert list(q.pop(1)) == [10, 11, 12, 13] and list(q.pop(2)) == [20, 21, 22, 23] and not len(q.pop(0))
    q.close()


def brute(rows, length):
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    for _, b in texts:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] += 1
    out = []
    for i, b in texts:
        cover = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                cover[p:p + length] = True
        runs = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        out.append((i, len(b), runs, bytes(np.frombuffer(b, np.uint8)[~cover])))
    return out


def test_removed_bytes_match_brute_force(spark):
    for length in (200, 50):
        got = collected(D.remove_repeats(docs_frame(spark), length=length))
        got = [(r["carry"]["doc_id"], r["n_bytes"], len(r["spans"]), bytes(r["kept"])) for r in got]
        order = lambda r: (r[0] is None, r[0] or 0, r[1:])
        assert sorted(got, key=order) == sorted(brute(awkward_docs(), length), key=order)


def test_many_shards_and_overfull_keys_agree(spark, monkeypatch):
    rng = random.Random(8)
    rows = awkward_docs()
    line = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(16))
    tail = ["".join(rng.choice("abcdef ") for _ in range(400)) for _ in range(30)]
    for i in range(120):                              # one line amid ever other surroundings
        rows.append((2000 + i, "".join(rng.choice("uvwxyz ") for _ in range(250)) + line + rng.choice(tail), "en", "a"))
    monkeypatch.setattr(D, "SHARD_BYTES", 6000)
    cut = []
    monkeypatch.setattr(D, "_cut_again", lambda n, f=D._cut_again: cut.append(n) or f(n))
    got = collected(D.remove_repeats(docs_frame(spark, rows)))
    kept = {(r["carry"]["doc_id"], bytes(r["kept"])) for r in got}
    assert kept == {(i, k) for i, _, _, k in brute(rows, 200)} and cut


def test_stage_keeps_rows_columns_and_nulls(spark):
    docs = docs_frame(spark)
    out = D.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("doc_id = 1").first()["text"] is None
    assert D.without_repeats(empty_docs(spark)).count() == 0
    assert D.remove_repeats(empty_docs(spark)).count() == 0
    assert out.where(F.col("text").contains("�")).count() == 0
