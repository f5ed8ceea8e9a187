"""Code lengths against a plain PPM, held-out accuracy, ordinal regression."""

import math
import random
from collections import Counter, defaultdict

import numpy as np

from llm_fixtures import collected, docs_frame, empty_docs
from stayscope.llm import langid as L
from stayscope.llm import toxicity as X

SYLLABLES = {"xx": ["ka", "to", "mi", "ren", "sol"], "yy": ["sch", "ung", "ber", "zu", "ich"],
             "zz": ["eau", "oux", "ent", "le", "ç"]}


def corpus(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        text = " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3)))
                        for _ in range(rng.randint(4, 60)))
        rows.append((i, text, lang, "a"))
    return rows


def plain_bits(train, text, order=L.ORDER):
    """Escape method C over dictionaries, straight from the definition."""
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    pad = b"\0" * order
    for t in train:
        b = pad + t.encode()
        for i in range(order, len(b)):
            for k in range(order + 1):
                counts[k][b[i - k:i]][b[i]] += 1
    bits, b = 0.0, pad + text.encode()
    for i in range(order, len(b)):
        for k in range(order, -1, -1):
            seen = counts[k].get(b[i - k:i])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if b[i] in seen:
                bits += math.log2((total + kinds) / seen[b[i]])
                break
            bits += math.log2((total + kinds) / kinds)
        else:
            bits += 8
    return bits


def test_code_lengths_match_the_definition(spark):
    rows = corpus(60)
    rows += [(900, "kato zu ☃ unseen bytes \x00\x7f", None, "a"), (901, "q", None, "a")]
    out = {r["doc_id"]: r for r in collected(L.identify(docs_frame(spark, rows)))}
    for i in (0, 1, 2, 900, 901):
        text = rows[i][1] if i < 900 else dict((r[0], r[1]) for r in rows)[i]
        best = {}
        for lang in SYLLABLES:
            train = [t for _, t, la, _ in rows if la == lang]
            share = len(train) / 60
            best[lang] = plain_bits(train, text) - math.log2(share)
        want = min(sorted(best), key=best.get)
        assert out[i]["lang_pred"] == want
        bits = best[want] + math.log2(len([1 for r in rows if r[2] == want]) / 60)
        assert abs(out[i]["bits_per_byte"] * len(text.encode()) - bits) < 1e-6 * max(1, bits)
        post = 1 / sum(2 ** (best[want] - best[x]) for x in best)
        assert abs(out[i]["score"] - post) < 1e-9


def test_held_out_accuracy_chunks_and_und(spark):
    from pyspark.sql import functions as F
    rows = corpus(300, 1) + [(1000, None, "xx", "a"), (1001, "12 34 ---", "xx", "a"), (1002, "", "yy", "a"),
                             (None, "kato miren", "xx", "a")]
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    docs = docs_frame(spark, rows)
    out = collected(L.identify(docs, held_out=held))
    assert len(out) == len(rows)
    got = {r["doc_id"]: r["lang_pred"] for r in out}
    assert all(got[i] == "und" for i in (1000, 1001, 1002)) and got[None] == "xx"
    hold = {r["doc_id"] for r in docs.where(held).select("doc_id").collect()}
    right = [got[i] == la for i, t, la, _ in rows if i in hold and i < 1000]
    assert sum(right) / len(right) >= 0.97
    fit = docs.where(~F.coalesce(held, F.lit(False)))
    model = L.train(fit, "doc_id", "text", "lang")     # scoring in small pieces changes nothing
    again = {r["doc_id"]: r["bits_per_byte"] for r in collected(L.predict(docs, model, chunk=37))}
    want = {r["doc_id"]: r["bits_per_byte"] for r in out}
    assert all(abs(again[i] - want[i]) < 1e-9 for i in want if i is not None)


def test_no_training_documents(spark):
    rows = [(1, "abc", None, "a"), (2, None, "en", "a")]
    assert {r["lang_pred"] for r in collected(L.identify(docs_frame(spark, rows)))} == {"und"}
    assert L.identify(empty_docs(spark)).count() == 0


def toxic_table(n, seed=0):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(20, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.choice([2, 3, 8, 12])):
                w.insert(rng.randrange(len(w)), rng.choice(["Zorg", "blarg", "quux"]))
        docs.append((i, " ".join(w), "en", "a"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_severity_separates_and_is_ordered(spark):
    docs, labels = toxic_table(600)
    docs += [(5000, None, "en", "a"), (5001, "", "en", "a"), (None, "zorg zorg", "en", "a")]
    labels += [(5000, None, 1), (7777, 0, 1), (8, 1, None)]
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    frame = docs_frame(spark, docs)
    model = X.train(frame, lab.where("doc_id % 3 <> 0"))
    assert model.theta[0] < model.theta[1]
    out = {r["doc_id"]: r for r in collected(X.severity(frame, model))}
    assert len(out) == len(docs)
    hold = [i for i in range(600) if i % 3 == 0]
    assert all(out[i]["toxic"] == (i % 5 == 0) for i in hold)
    assert all(0 <= r["severity"] <= 2 for r in out.values()) and out[None]["toxic"]
    few = X.severity(docs_frame(spark, [(1, "zorg blarg", "en", "a"), (2, "zorg blarg " * 8, "en", "a")]), model)
    few = {r["doc_id"]: r["severity"] for r in few.collect()}
    assert few[1] < few[2]


def test_one_class_and_empty_tables(spark):
    docs, labels = toxic_table(20)
    lab = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    frame = docs_frame(spark, docs)
    assert X.train(frame, lab) is None
    assert {r["severity"] for r in X.severity(frame, None).collect()} == {0.0}
    assert X.severity(empty_docs(spark), None).count() == 0


def test_fit_gradient_finds_planted_weights():
    rng = np.random.default_rng(0)
    n, p = 3000, 4
    x = rng.random((n, p))
    s = x @ np.array([4.0, -2.0, 1.0, 0.0])
    u = rng.logistic(size=n)
    grade = np.digitize(s + u, [1.0, 3.0])
    row, col = np.nonzero(np.ones((n, p)))
    w, theta = X.fit_ordinal(row, col, x.ravel(), grade, np.ones(n), p, steps=1500)
    assert np.allclose(w, [4, -2, 1, 0], atol=0.5) and np.allclose(theta, [1, 3], atol=0.4)
