"""Candidate clusters of the Jaccard join: sets that share passages, but are no
near copies, do not meet; near copies among them do."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from stayscope.llm import clusters
from stayscope.llm import jaccard_rtree as J
from test_jaccard import components, near_group, run, same


def _with_passages(n, seed):
    """Texts of 150 own words and five of eight passages of 40 words; every
    tenth one has a near copy."""
    rng = random.Random(seed)
    passages = [[f"p{i}x{j}" for j in range(40)] for i in range(8)]
    out = []
    for i in range(n):
        words = [f"own{i}x{j}" for j in range(150)]
        for passage in rng.sample(passages, 5):
            at = rng.randrange(len(words))
            words[at:at] = passage
        out.append((10 * i, " ".join(words), "en", "a"))
        if i % 10 == 0:
            words[7] = "other"
            out.append((10 * i + 1, " ".join(words), "en", "a"))
    return out


def test_sets_that_share_passages_make_no_cluster(spark, monkeypatch):
    rows, found, stored = _with_passages(200, 3), [], clusters.stored

    def seen(df, name):
        out = stored(df, name)
        if name == "blocks":
            found.extend(r["count"] for r in out.groupBy("cluster").count().collect())
        return out
    monkeypatch.setattr(clusters, "stored", seen)
    got = {i: c for i, _, c in run(spark, rows)}
    assert got == {i: i - i % 10 for i, *_ in rows}
    assert sorted(found) == [2] * 20


def test_keys_dealt_over_many_buckets_link_the_same_sets(spark, monkeypatch):
    rows = near_group(60, 11) + [(5000 + i, t, "en", "a") for i, (_, t, *_) in enumerate(_with_passages(20, 4))]
    monkeypatch.setattr(J, "BUCKET_KEYS", 500)
    same(run(spark, rows), components(rows))


def _texts(rows):
    return pa.RecordBatch.from_arrays([pa.array([t for _, t, *_ in rows])], ["text"])


@pytest.mark.parametrize("buckets, chunk", [(1, 1 << 18), (7, 300)])
def test_shared_keys_and_their_counts(monkeypatch, buckets, chunk):
    rows = near_group(12, 2) + _with_passages(10, 5)
    monkeypatch.setattr(J, "CHUNK", chunk)
    edges, have = J.bands(80, 1 << 16), {}
    for _, text, *_ in rows:
        (_, s), = clusters.doc_sets(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), 3)
        for key, size, held, own in J.set_groups(s, 80, edges):
            for x, empty in zip(key.tolist(), np.arange(len(key)) >= held):
                have.setdefault((x >> 1 << 1) | int(empty), set()).add((int(clusters.set_id(s)), held - own - 1))
    parts = {}
    for _ in range(2):                                  # a second task that has the same texts
        for batch in J._emit(3, 80, buckets)([_texts(rows), _texts(rows[:3])]):
            for b, body in zip(batch.column("bucket").to_pylist(), batch.column("body").to_pylist()):
                parts.setdefault(b, []).append(body)
    got = {}
    for b, bodies in parts.items():
        table = pa.table([pa.array([b] * len(bodies), pa.int32()), pa.array(bodies, pa.binary())], names=["bucket", "body"])
        for r in clusters._shared_keys(table).to_pylist():
            got.setdefault((r["key"] % (1 << 40), r["n"]), set()).add((r["sid"] % (1 << 64), r["spare"] // 2))
    assert got == {(x % (1 << 40), len(sets)): {(i, max(0, e)) for i, e in sets} for x, sets in have.items() if len(sets) > 1}


def test_a_set_leaves_out_its_commonest_keys_over_batches(monkeypatch):
    monkeypatch.setattr(clusters, "CHUNK", 4)
    rows = [(sid, 2 * spare + scope, key) for sid, scope, spare, n in [(1, 0, 2, 5), (1, 1, 9, 3), (2, 0, 0, 4), (3, 1, 1, 1)]
            for key in range(100 * sid + 10 * scope, 100 * sid + 10 * scope + n)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i:i + 2]), (pa.int64(), pa.int32(), pa.int64()))],
                                          ["sid", "spare", "key"]) for i in range(0, len(rows), 2)]
    out = [r for b in clusters._first_keys(batches) for r in b.to_pylist() if not r["is_pair"]]
    assert sorted((r["a"], r["key"]) for r in out) == [(1, 100), (1, 101), (1, 102), (2, 200), (2, 201), (2, 202), (2, 203)]
    assert list(clusters._first_keys([])) == []
