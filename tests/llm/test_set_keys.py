"""Keys of the Jaccard join: linked sets always share one, unrelated sets do not
meet under keys of empty or very small groups."""

from __future__ import annotations

import numpy as np
import pytest

from stayscope.llm import jaccard_rtree as J


def _keys(sets, percent):
    edges = J.bands(percent, 1 << 12)
    return [set(J.set_keys(np.sort(s), percent, edges).tolist()) for s in sets]


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_sets_at_the_threshold_share_a_key(percent):
    rng = np.random.default_rng(percent)
    linked = 0
    for n in [*range(1, 40), *rng.integers(40, 900, 160).tolist()]:
        a = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        # the least sets that still link: shingles left out, added, or both
        d = J.max_diff(2 * n, percent)
        for out, more in ((d // 2, d - d // 2), (n - -(-percent * n // 100), 0), (0, n * 100 // percent - n)):
            b = np.concatenate([a[out:], rng.integers(1, 1 << 63, more, dtype=np.uint64)])
            if len(b) and 100 * (n - out) >= percent * (n + more):
                ka, kb = _keys([a, b], percent)
                assert ka & kb, (n, out, more)
                linked += 1
    assert linked > 300


@pytest.mark.parametrize("percent", [80, 90])
def test_unrelated_sets_share_no_key(percent):
    rng = np.random.default_rng(7)
    sets = [rng.integers(1, 1 << 63, n, dtype=np.uint64) for n in rng.integers(60, 700, 300).tolist()]
    found = [key for keys in _keys(sets, percent) for key in keys]
    assert len(found) == len(set(found))


def test_one_shared_line_seldom_makes_a_key():
    rng = np.random.default_rng(8)
    line = rng.integers(1, 1 << 63, 8, dtype=np.uint64)
    sets = [np.concatenate([line, rng.integers(1, 1 << 63, n, dtype=np.uint64)]) for n in rng.integers(200, 700, 200).tolist()]
    found = [key for keys in _keys(sets, 80) for key in keys]
    assert len(found) - len(set(found)) < 20
