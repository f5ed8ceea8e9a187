"""Containment search, Merkle fingerprints and license scans."""

import hashlib
import random

from pyspark.sql import functions as F

from llm_fixtures import awkward_docs, collected, docs_frame, empty_docs, shingles, words
from stayscope.llm import decontaminate as D
from stayscope.llm import fingerprints as P
from stayscope.llm import licenses as L


def full(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def leak_table():
    rng = random.Random(9)
    vocab = [f"v{i}" for i in range(500)]
    prose = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(prose(rng.choice([3, 5, 7, 20, 45])))) for i in range(30)]
    items += [(50, "Only"), (51, "two  words"), (52, "one two\tthree four"), (53, "not there"), (54, "wo words")]
    items += [(40, None), (41, ""), (42, items[4][1].upper()), (42, items[4][1])]
    docs = awkward_docs() + [(900, "only", "en", "a"), (901, "x One two three FOUR y", "en", "a"),
                             (902, "one two three, four", "en", "a"), (903, "lonely onlyx", "en", "a")]
    for n, (_, t) in enumerate(items[:30]):
        w = t.split(" ")
        for gap in (0, len(w) // 4):
            w2 = list(w)
            if gap:
                w2[-1] = "changed"
            body = prose(rng.choice([2, 30, 4000]))
            body[1:1] = w2
            docs.append((1000 + 2 * n + bool(gap), "\n".join(body), "en", "a"))
    return docs, items


def test_containment_matches_brute_force(spark, monkeypatch):
    docs, items = leak_table()
    it = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_item int")
    want = {}
    for i, t, *_ in docs:
        for j, x in items:
            k = min(5, max(1, len(words(x))))             # a shorter item is one shingle
            own, q = full(t, k), full(x, k)
            if q and len(q & own) >= 0.8 * len(q):
                want[(i, j)] = (len(q), len(q & own))
    got = {(r["doc_id"], r["item_id"]): (r["n_item"], r["n_shared"])
           for r in collected(D.contaminated(docs_frame(spark, docs), it))}
    assert got == want and len(want) > 30
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)           # the way without broadcasts
    assert {(r["doc_id"], r["item_id"]) for r in collected(D.contaminated(docs_frame(spark, docs), it))} == set(want)
    clean = D.without_leaks(docs_frame(spark, docs), it)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, *_ in docs} - {i for i, _ in want}


def test_containment_edges(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(docs_frame(spark), none).count() == 0
    assert D.contaminated(empty_docs(spark), none).count() == 0
    assert D.without_leaks(docs_frame(spark), none).count() == len(awkward_docs())
    assert D.extra_bits(1, 0.8, 1e-9) > 25 and D.extra_bits(40, 0.8, 1e-9) <= 4


def test_no_python_in_native_plans(spark):
    docs = docs_frame(spark)
    for df in (P.fingerprints(docs), D.contaminated(docs, spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string"))):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_fingerprints_edit_and_likeness(spark):
    rows = [r for r in awkward_docs() if r[0] is not None and r[0] != 18] + [(18, "two words", "en", "c")]
    out = {r["doc_id"]: r for r in collected(P.fingerprints(docs_frame(spark, rows)))}
    order = sorted(rows, key=lambda r: -r[0])
    for n, (i, t, *_) in enumerate(order):
        t, nxt = t or "", order[(n + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        r = out[i]
        assert r["n_chars"] == len(t) and r["edited"] == edited
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (t == edited)
        if t == edited:
            assert r["near_edited"] == 1
    by_text = {}
    for i, t, *_ in rows:
        by_text.setdefault(t or "", set()).add(out[i]["fingerprint"])
    assert all(len(s) == 1 for s in by_text.values()) and len(set().union(*by_text.values())) == len(by_text)


def test_root_covers_paragraphs_and_edits_are_located(spark):
    a = "\n".join(f"Paragraph {i} says something. And then {i} more." for i in range(60))
    b = a.replace("Paragraph 31 says", "Paragraph 31 hides")
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        P.fingerprint(F.col("a")).alias("fa"), P.fingerprint(F.col("b")).alias("fb"))
    r = df.select("fa", "fb", P.likeness(F.col("fa"), F.col("fb")).alias("near"),
                  P.locate_edits(F.col("fa"), F.col("fb")).alias("edits"),
                  P.locate_edits(F.col("fa"), F.col("fa")).alias("none")).first()
    digests = "".join(hashlib.md5(p.encode()).hexdigest() for p in a.split("\n"))
    assert r["fa"].split("#")[0] == hashlib.sha256(digests.encode()).hexdigest()
    assert 0.95 < r["near"] < 1 and r["none"] == []
    assert len(r["edits"]) == 1 and len(r["edits"][0]["leaves"]) == 1
    leaf = hashlib.md5("Paragraph 31 says something.".encode()).hexdigest()[:8]
    assert r["edits"][0]["leaves"][0].startswith(leaf)


def test_fingerprints_of_repeated_and_null_ids_and_no_rows(spark):
    out = collected(P.fingerprints(docs_frame(spark)))
    assert len(out) == len(awkward_docs())                 # repeated rows each keep theirs
    low = [r for r in out if r["doc_id"] is None][0]       # null is last; its next is the first
    first = max((r for r in awkward_docs() if r[0] is not None), key=lambda r: r[0])[1]
    assert low["edited"].endswith(first[:low["n_chars"] // 2])
    assert P.fingerprints(empty_docs(spark)).count() == 0
    one = collected(P.fingerprints(docs_frame(spark, [(5, "abcd", "en", "a")])))
    assert one[0]["edited"] == "abab"


def test_license_windows_find_planted_notices(spark):
    rng = random.Random(1)
    rows = awkward_docs()
    vocab = [f"v{i}" for i in range(300)]
    want = set()
    for n, (name, t) in enumerate(sorted(L.TEMPLATES.items())):
        for rep in range(4):
            w = [rng.choice(vocab) for _ in range(rng.choice([0, 3, 50, 700]))]
            body = t.upper() if rep == 1 else t.replace(" ", "\n  ") if rep == 2 else t
            if rep == 3 and len(t.split()) > 20:
                body = body.replace("is hereby", "is herewith").replace("in writing,", "on paper,")
            at = rng.randint(0, len(w))
            rows.append((3000 + 10 * n + rep, " ".join(w[:at] + [body] + w[at:]), "en", "a"))
            want.add((3000 + 10 * n + rep, name))
    docs = docs_frame(spark, rows)
    got = collected(L.scan(docs))
    assert {(r["doc_id"], r["license"]) for r in got} == want | {
        (r["doc_id"], r["license"]) for r in got if r["license"] == "Apache-2.0 line" and (r["doc_id"], "Apache-2.0 notice") in want}
    text = {i: (t or "").encode() for i, t, *_ in rows}
    for r in got:
        found = shingles(text[r["doc_id"]][r["start"]:r["end"]].decode(), min(5, len(words(L.TEMPLATES[r["license"]]))))
        q = shingles(L.TEMPLATES[r["license"]], 5)
        assert len(found & q) >= 0.8 * len(q) - 1e-9
    assert L.scan(empty_docs(spark)).count() == 0


def test_band_count_bounds_the_miss():
    for least, window in ((1, 2), (36, 90), (120, 240)):
        n = L.bands_needed(least, window, 0.8, 1e-9)
        shared = -(-8 * least // 10)
        j = shared / (window + least - shared)
        assert (1 - j) ** n <= 1.0001e-9
