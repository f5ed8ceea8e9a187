import random

import numpy as np
import pyarrow as pa

from stayscope.llm import clusters, near_dedup
from stayscope.llm.store import connected_components
from llm_fixtures import awkward_docs, collected, docs_frame, empty_docs, shingles


def _brute(rows, k, percent):
    sets = [shingles(t, k) for _, t, _, _ in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                comp[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    out = []
    for i, r in enumerate(rows):
        c = least.get(root(i)) if sets[i] else r[0]
        out.append((r[0], len(sets[i]), c, r[0] == c))
    return sorted(out, key=str)


def _near_rows(seed, groups, size, words=120):
    """Groups of copies with few scattered edits, and rows that share half."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows, n = [], 1000
    for g in range(groups):
        base = [word() for _ in range(words)]
        for i in range(size):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(words)] = word()
            if i % 7 == 6:
                text[words // 2:] = [word() for _ in range(words // 2)]
            rows.append((n, " ".join(text), "en", "a"))
            n += 1
    rng.shuffle(rows)
    return rows


def test_equals_brute_force(spark):
    rows = awkward_docs() + _near_rows(1, 6, 15)
    got = [tuple(r) for r in near_dedup.near_duplicates(docs_frame(spark, rows), percent=85).collect()]
    assert sorted(got, key=str) == _brute(rows, 5, 85)
    got = [tuple(r) for r in near_dedup.near_duplicates(docs_frame(spark, rows)).collect()]
    assert sorted(got, key=str) == _brute(rows, 5, 80)


def test_blocks_of_one_cluster(spark, monkeypatch):
    """A cluster of many blocks gives the components of a whole one."""
    monkeypatch.setattr(clusters, "BLOCK_ITEMS", 8000)
    rows = _near_rows(2, 2, 60)
    got = [tuple(r) for r in near_dedup.near_duplicates(docs_frame(spark, rows), percent=85).collect()]
    assert sorted(got, key=str) == _brute(rows, 5, 85)


def test_collections_meet_as_often_as_promised():
    rng = np.random.default_rng(5)
    m, trials, size, both = near_dedup.collection_size(85), 400, 370, 340
    agree = missed = 0
    for _ in range(trials):
        pool = rng.integers(0, 1 << 63, 2 * size - both, dtype=np.uint64)
        sets = [np.sort(pool[:size]), np.sort(pool[size - both:])]       # similarity 0.85
        v = near_dedup.functions_of(np.concatenate(sets), np.array([0, size]), m)
        same = v[0] == v[1]
        agree += same.sum()
        missed += not (same[:m].any() and same[m:].any())
    assert abs(agree / (trials * 2 * m) - 0.85 ** near_dedup.WIDTH) < 0.03
    assert missed == 0 and m * m * 2 * near_dedup.WIDTH > 10 * 2 * m * near_dedup.WIDTH


def test_shared_values_over_batches():
    value = np.array([1, 1, 2, 3, 3, 3, 4, 5, 5], np.int64)
    sid = np.arange(9, dtype=np.int64) + 10
    known = np.array([0, 0, 0, 0, 0, 0, 1, 0, 0], bool)
    names = ["value", "sid", "f", "shared"]
    for cut in ([9], [1, 8], [2, 2, 2, 3], [4, 0, 1, 1, 2, 1]):
        at, batches = 0, []
        for n in cut:
            s = slice(at, at + n)
            batches.append(pa.RecordBatch.from_arrays(
                [pa.array(value[s]), pa.array(sid[s]), pa.array(np.zeros(n, np.int32)), pa.array(known[s])], names))
            at += n
        got = sorted(x for b in near_dedup._shared(iter(batches)) for x in b.column("sid").to_pylist())
        assert got == [10, 11, 13, 14, 15, 16, 17, 18]


def test_forest_spans():
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 300, 250).astype(np.uint64), rng.integers(0, 300, 250).astype(np.uint64)
    a, b = clusters.forest(x, y)
    assert len(b) == len(set(b.tolist()))                      # one edge a node but the least

    def parts(p, q):
        label = {int(i): int(i) for i in np.concatenate([x, y])}
        for _ in range(300):
            for i, j in zip(p.tolist(), q.tolist()):
                label[i] = label[j] = min(label[i], label[j])
        return label
    assert parts(x, y) == parts(a, b)


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(1, 70)]
    tree = [(100, 100 + i) for i in range(1, 200)]
    loose = [(rng.randint(400, 600), rng.randint(400, 600)) for _ in range(120)]
    pairs = chain + tree + loose + [(5, 5), (None, 3), (900, 900)]
    rng.shuffle(pairs)
    label = {}
    for a, b in pairs:
        if a is not None and a != b:
            label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(300):
        for a, b in pairs:
            if a is not None and a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == label
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_edges_a_set_do_not_grow_with_the_group(spark, monkeypatch):
    """Edge rows a set that enter the components, for groups of growing size."""
    seen = {}
    whole = clusters.connected_components

    def counting(edges):
        seen["edges"] = max(seen.get("edges", 0), edges.distinct().count())
        return whole(edges)
    monkeypatch.setattr(clusters, "connected_components", counting)
    for n in (100, 400, 1600):
        seen.clear()
        out = near_dedup.near_duplicates(docs_frame(spark, _near_rows(9, 1, n, 60)), percent=85)
        sets = out.select("doc_id").distinct().count()
        assert seen["edges"] < 3 * sets


def test_empty(spark):
    assert collected(near_dedup.near_duplicates(empty_docs(spark))) == []
