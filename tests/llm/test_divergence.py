import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from stayscope.llm import divergence
from llm_fixtures import FOLD, awkward_docs, docs_frame, empty_docs


def _brute(rows, least=3, top=200):
    docs, groups = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
        groups[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        counts = {s: {t: c[t] for t in kept} for (g, s), c in groups.items() if g == lang}
        whole = {t: sum(c[t] for c in counts.values()) for t in kept}
        p = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        q, of = p(whole), {s: p(c) for s, c in counts.items()}
        for s in counts:
            pair = [(sum((of[s][t] - of[b][t]) ** 2 // of[b][t] for t in kept), b) for b in counts if b != s]
            term = [((of[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and of[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found)
                        if part == "pair" or i < top]
    return sorted(out)


def _rows():
    """The awkward rows, words of many kinds, a source without terms, a group
    of hot copies and ties in bytes."""
    rows = awkward_docs()
    rows += [(300 + i, "Don't STOP_at ünder-Straße日本 x" + "\x00" + "Y\x7fz " * (i % 4), "fr", "abc"[i % 3]) for i in range(12)]
    rows += [(400 + i, "hot hot copy of one line", "en", None) for i in range(40)]
    rows += [(500, "12 34 --", "fr", "none"), (501, None, "fr", "null"), (502, "lonely", "la", "one")]
    rows += [(600 + i, " ".join(f"t{j:c}" for j in range(97, 123)) * 2, "tie", "ab"[i % 2]) for i in range(6)]
    return rows


def test_equals_brute_force(spark):
    rows = _rows()
    assert sorted(map(tuple, divergence.audit(docs_frame(spark, rows)).collect())) == _brute(rows)


def test_shards_do_not_change_the_result(spark, monkeypatch):
    rows = _rows()
    monkeypatch.setattr(divergence, "CELLS", 1)                # a shard for a few terms
    assert sorted(map(tuple, divergence.audit(docs_frame(spark, rows), top_terms=5).collect())) == _brute(rows, top=5)


def test_batches_merge_and_hand_on(monkeypatch):
    monkeypatch.setattr(divergence, "MERGE_ROWS", 6)
    batch = pa.RecordBatch.from_pydict({"text": ["a b a", None, "c d e f g h i"], "lang": ["x", None, "x"],
                                        "source": ["s", "s", None]})
    total = Counter()
    for out in divergence._partial_counts(iter([batch, batch.slice(0, 0), batch, batch])):
        for r in out.to_pylist():
            total[r["lang"], r["source"], r["term"]] += r["occ"]
    assert total["x", "s", "a"] == 6 and total["x", "", "i"] == 3 and total["", "s", None] == 0
    assert ("", "s", None) in total and ("x", "s", None) in total


def test_shares_are_exact():
    count = np.array([0, 1, 7, 10**14, 8 * 10**15], np.int64)
    total = 8 * 10**15 + 5
    assert divergence.shares(count, total).tolist() == [1 + 10**9 * (int(c) + 1) // total for c in count]


def test_empty(spark):
    assert divergence.audit(empty_docs(spark)).collect() == []
