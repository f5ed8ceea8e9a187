"""Jaccard components against brute force, and the tree's bound."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import awkward_docs, collected, docs_frame, empty_docs, shingles
from stayscope.llm import jaccard_rtree as J


def components(rows, k=3, percent=90):
    sets = [(i, shingles(t, k)) for i, t, *_ in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(a)] = find(b)
    ids = {}
    for a, (i, s) in enumerate(sets):
        if i is not None:
            ids.setdefault(find(a), []).append(i)
    return [(i, len(s), min(ids.get(find(a), [None])) if s else i) for a, (i, s) in enumerate(sets)]


def same(got, want):
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=order) == sorted(want, key=order)


def run(spark, rows):
    got = collected(J.jaccard_components(docs_frame(spark, rows)))
    return [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got]


def near_group(n, seed):
    """One text, each copy with a few words of its own: links, chains and
    pairs just under the threshold."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            w[rng.randrange(150)] = f"x{rng.randrange(40)}"
        out.append((1000 + i, " ".join(w), "en", "a"))
    return out


def test_awkward_table(spark):
    same(run(spark, awkward_docs()), components(awkward_docs()))


def test_near_copies_in_one_and_in_many_blocks(spark, monkeypatch):
    rows = near_group(120, 5)
    want = components(rows)
    same(run(spark, rows), want)
    monkeypatch.setattr(J, "BLOCK_ITEMS", 2000)      # cuts the cluster into blocks
    same(run(spark, rows), want)


def test_empty_table_and_one_per_component(spark):
    assert J.jaccard_components(empty_docs(spark)).count() == 0
    docs = docs_frame(spark)
    kept = J.one_per_component(docs)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    comp = components(awkward_docs())
    assert ids == {i for i, _, c in comp if i is None or i == c}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 40), st.integers(0, 40), st.integers(0, 10**6))
def test_linked_sets_share_a_key(common, only_a, only_b, seed):
    rng = np.random.default_rng(seed)
    h = np.unique(rng.integers(0, 1 << 63, common + only_a + only_b).astype(np.uint64))
    a = np.sort(h[:common + only_a])
    b = np.sort(np.concatenate([h[:common], h[common + only_a:]]))
    both = len(np.intersect1d(a, b))
    if 100 * both >= 90 * (len(a) + len(b) - both):
        edges = J.bands(90, 2000)
        assert np.intersect1d(J.set_keys(a, 90, edges), J.set_keys(b, 90, edges)).size


def test_tree_join_equals_all_pairs():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(5, 60), replace=False)) for _ in range(150)]
    sets += [np.unique(np.concatenate([s[1:], rng.choice(pool, 1)])) for s in sets]
    label = np.arange(len(sets))
    comp = J.join_block(sets, 80, np.zeros(len(sets), int), label)
    root = list(label)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert [find(i) for i in range(len(sets))] == list(comp)
