"""License scans and severities against plain Python, the first over a whole test table."""

import math
import os
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from llm_fixtures import FOLD, awkward_docs, collected, docs_frame
from test_langid_toxicity import toxic_table
from stayscope.llm import licenses as L
from stayscope.llm import toxicity as X

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _bare_shingles(text, k):
    w = [x.strip(PUNCTUATION) for x in re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))]
    w = [x for x in w if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}, len(w)


@pytest.mark.skipif(not os.path.exists(DOCUMENTS), reason="the test table is not here")
def test_licenses_of_a_whole_table(spark):
    """Every document that holds 0.8 of a template's shingles is found, and no other;
    a form inside a longer form of its license may go unmentioned."""
    table = pq.read_table(DOCUMENTS, columns=["doc_id", "text"]).to_pylist()
    got = {(r["doc_id"], r["license"]) for r in collected(L.scan(spark.read.parquet(DOCUMENTS)))}
    templates = L.licenses()
    want = set()
    size = {n: min(5, _bare_shingles(t, 1)[1]) for n, t in templates.items()}
    grams = {n: _bare_shingles(t, size[n])[0] for n, t in templates.items()}
    for d in table:
        own = {k: _bare_shingles(d["text"], k)[0] for k in set(size.values())}
        want |= {(d["doc_id"], n) for n, q in grams.items() if q and len(q & own[size[n]]) >= 0.8 * len(q) - 1e-9}
    assert len(want) > 20 and got <= want
    longer = {(i, L._license(n)) for i, n in got}
    assert all((i, L._license(n)) in longer for i, n in want - got)


def test_severities_follow_from_the_weights(spark):
    docs, labels = toxic_table(300)
    docs += awkward_docs()
    lab = spark.createDataFrame([(i, 1, t) for i, _, t in labels], "doc_id long, quality int, toxic int")
    docs = [(j, *rest) for j, (_, *rest) in enumerate(docs)]                 # toxic_table's ids are 0 to 299
    frame = docs_frame(spark, docs)
    model = X.train(frame, lab)

    def word_hash(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return int(X.counts(data, np.array([0, len(data)]))[1][0])
    weight = dict(zip(map(int, model.words), model.weight))
    out = {r["doc_id"]: r for r in collected(X.severity(frame, model))}
    sig = lambda x: 1 / (1 + math.exp(-x))
    for i, text, *_ in docs:
        n = Counter(re.findall(r"[A-Za-z\u0080-\U0010ffff]+", (text or "").translate(FOLD)))
        score = sum(weight.get(word_hash(w), 0.0) * math.log1p(c) for w, c in n.items())
        below = [0.0, *[sig(t - score) for t in model.theta], 1.0]
        grades = [b - a for a, b in zip(below, below[1:])]
        assert out[i]["severity"] == pytest.approx(sum(k * p for k, p in enumerate(grades)), abs=1e-9)
        assert out[i]["p_toxic"] == pytest.approx(1 - grades[0], abs=1e-9)
        assert out[i]["toxic"] == (grades[0] < 0.5)
