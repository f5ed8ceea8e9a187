"""Toxicity severity by cumulative-link ordinal regression (dealt operator 6).

P(grade <= k) = sigmoid(theta_k - w.x): one weight vector for all ordered
thresholds theta_1 < theta_2 < ...  Features are words (runs of letters, A-Z
folded) with value log(1 + count); the sparse vocabulary is the ``vocabulary``
words whose presence differs most between labelled classes, if chi-square is
at least ``chi_least`` in at least ``min_docs`` documents.  The two classes
weigh alike in the fit.  The labels say toxic or not; grades of toxic
training documents come from how much of the toxic vocabulary they hold (words
at least ``odds`` times likelier in toxic documents): grade 1 up to the median
count, 2 above.  Clean documents are grade 0, and so are documents labelled
toxic without any such word: nothing in them could teach the model, and as
grade 1 they would only move its thresholds.  The output is the expected
severity, sum of k * P(grade = k).

Fitting reads at most ``sample_docs`` labelled documents a class, whole, those
with the least hash of their id; scoring reads every document.

Edge cases: null or empty texts and texts without known words get the
thresholds' base severity; null labels and labels of missing documents do not
train; conflicting labels of an id count as toxic; without both classes every
severity is 0; ties of the hash are broken by id; repeated rows each get their
row; empty tables give an empty result; only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .store import stored
from .text import Words, flat, row_slices

SAMPLE_DOCS = 2000       # labelled documents a class for the fit, at most
VOCABULARY = 2048        # words with a weight, at most
MIN_DOCS = 4
ODDS = 8.0
CHI_LEAST = 18.0
GRADES = 3
STEPS, RATE, RIDGE = 600, 0.05, 1e-5
# a word is a run of ASCII letters and bytes of non-ASCII characters
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


@dataclass
class Model:
    words: np.ndarray        # sorted 64-bit word hashes
    weight: np.ndarray
    theta: np.ndarray        # increasing

    def grades(self, score: np.ndarray) -> np.ndarray:
        """P(grade = k) for each score w.x: [rows, grades]."""
        below = 1 / (1 + np.exp(np.clip(score[:, None] - self.theta[None], -50, 50)))
        edge = np.hstack([np.zeros((len(score), 1)), below, np.ones((len(score), 1))])
        return np.diff(edge, axis=1)


def counts(data: np.ndarray, off: np.ndarray):
    """(row, word hash, count) of a slice, sorted by row and word."""
    w = Words(data, off, space=NOT_LETTER)
    by = np.lexsort((w.hash, w.doc))
    row, h = w.doc[by], w.hash[by]
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, np.int64)
    return row[first], h[first], np.diff(np.append(first, len(h)))


def fit_ordinal(row, col, value, grade, each, n_words, grades=GRADES, steps=STEPS, rate=RATE, ridge=RIDGE):
    """(weights, thresholds) by Adam on the mean log-likelihood, documents
    weighed by ``each``.  Thresholds are theta_1 and positive steps, so they stay ordered."""
    n = len(grade)
    w, t = np.zeros(n_words), np.concatenate([[0.0], np.zeros(grades - 2)])
    each = each * n / each.sum()
    m = np.zeros(n_words + grades - 1)
    v = m.copy()
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -50, 50)))
    for step in range(1, steps + 1):
        theta = np.concatenate([[t[0]], t[0] + np.cumsum(np.exp(t[1:]))])
        s = np.bincount(row, weights=value * w[col], minlength=n)
        hi = np.where(grade < grades - 1, sig(theta[np.minimum(grade, grades - 2)] - s), 1.0)
        lo = np.where(grade > 0, sig(theta[np.maximum(grade - 1, 0)] - s), 0.0)
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi), lo * (1 - lo)
        ds = each * (dhi - dlo) / p / n                              # d(-loglik)/ds
        dtheta = np.bincount(np.minimum(grade, grades - 2), weights=-each * dhi / p / n, minlength=grades - 1)
        dtheta += np.bincount(np.maximum(grade - 1, 0), weights=each * dlo / p / n, minlength=grades - 1)
        gw = np.bincount(col, weights=value * ds[row], minlength=n_words) + ridge * w
        gt = np.concatenate([[dtheta.sum()], np.exp(t[1:]) * np.cumsum(dtheta[::-1])[::-1][1:]])
        g = np.concatenate([gw, gt])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, t = w - move[:n_words], t - move[n_words:]
    return w, np.concatenate([[t[0]], t[0] + np.cumsum(np.exp(t[1:]))])


def _sample(docs: DataFrame, labels: DataFrame, sample_docs: int) -> DataFrame | None:
    """(id, text, toxic): per class at most ``sample_docs`` documents."""
    lab = labels.where("toxic is not null").groupBy("id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    h = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(23)), F.lit(1 << 20))
    n = {r["toxic"]: r["n"] for r in lab.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if set(n) != {0, 1}:
        return None
    share = F.when(F.col("toxic") == 1, min(1.0, sample_docs / n[1])).otherwise(min(1.0, sample_docs / n[0]))
    lab = lab.where(h < F.ceil(share * (1 << 20)))
    # the threshold leaves sample_docs in expectation; twice that is the hard bound
    picked = F.broadcast(lab.orderBy(h, "id").limit(4 * sample_docs))
    return docs.join(picked, "id").select("id", "text", "toxic")


def _sample_counts(batches):
    for batch in batches:
        data, off = flat(batch.column("text"))
        for lo, hi in row_slices(off):
            row, h, c = counts(data[off[lo]:off[hi]], off[lo:hi + 1])
            at = pa.array(row + lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("toxic").take(at),
                 pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["id", "toxic", "word", "n"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          toxic_col: str = "toxic", sample_docs: int = SAMPLE_DOCS, vocabulary: int = VOCABULARY,
          min_docs: int = MIN_DOCS, odds: float = ODDS,
          chi_least: float = CHI_LEAST) -> Model | None:
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ship(docs.sparkSession)
    lab = labels.select(F.col(id_col).alias("id"), F.col(toxic_col).alias("toxic"))
    sample = _sample(d, lab, sample_docs)
    if sample is None:
        return None
    t = d.schema["id"].dataType.simpleString()
    found = stored(sample.mapInArrow(_sample_counts, f"id {t}, toxic int, word long, n long"), "sample-words")
    docs_of = {r["toxic"]: r["n"] for r in found.groupBy("toxic").agg(F.countDistinct("id").alias("n")).collect()}
    pos, neg = max(1, docs_of.get(1, 0)), max(1, docs_of.get(0, 0))
    # words of enough sample documents; chi-square of each against the label
    seen = (found.groupBy("word").agg(F.count("*").alias("docs"), F.sum("toxic").alias("toxic"))
            .where(F.col("docs") >= min_docs).toArrow())
    word, both, a = (seen.column(c).to_numpy() for c in ("word", "docs", "toxic"))
    expect = both * pos / (pos + neg)
    chi = (a - expect) ** 2 / np.maximum(expect, 1e-9)
    best = np.argsort(-chi, kind="stable")[:min(vocabulary, int((chi >= chi_least).sum()))]
    if not len(best):
        return None
    best = best[np.argsort(word[best].view(np.uint64))]
    words = word[best].view(np.uint64)
    harsh = ((a[best] + 0.5) / (pos + 1)) / ((both[best] - a[best] + 0.5) / (neg + 1)) >= odds
    # counts of these words alone; documents without any are only counted
    vocab = F.broadcast(d.sparkSession.createDataFrame([(int(x),) for x in word[best]], "word long"))
    rows = found.join(vocab, "word").select("id", "toxic", "word", "n").toArrow()
    doc = np.unique(rows.column("id").to_numpy(zero_copy_only=False), return_inverse=True)[1]
    n = rows.column("n").to_numpy()
    col = np.searchsorted(words, rows.column("word").to_numpy().view(np.uint64))
    n_docs = pos + neg
    label = np.zeros(n_docs, np.int64)
    label[doc] = rows.column("toxic").to_numpy()
    amount = np.bincount(doc, weights=n * harsh[col], minlength=n_docs)
    grade = np.where((label == 1) & (amount > 0), 1, 0)
    if grade.any():
        grade[(grade == 1) & (amount > np.median(amount[grade == 1]))] = 2
    each = np.where(grade > 0, 1 / max(1, (grade > 0).sum()), 1 / max(1, (grade == 0).sum()))
    weight, theta = fit_ordinal(doc, col, np.log1p(n), grade, each, len(words))
    return Model(words, weight, theta)


def severity(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, severity, grade, p_toxic, toxic) for every row."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if model is None:
        return d.select(F.col("id").alias(id_col), F.lit(0.0).alias("severity"), F.lit(0).alias("grade"),
                        F.lit(0.0).alias("p_toxic"), F.lit(False).alias("toxic"))
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)     # at most VOCABULARY weights

    def run(batches):
        m = held.value
        for batch in batches:
            data, off = flat(batch.column("text"))
            score = np.zeros(len(batch))
            for lo, hi in row_slices(off):
                w = Words(data[off[lo]:off[hi]], off[lo:hi + 1], space=NOT_LETTER)
                at = np.minimum(np.searchsorted(m.words, w.hash), len(m.words) - 1)
                known = m.words[at] == w.hash
                pair, n = np.unique(w.doc[known] * len(m.words) + at[known], return_counts=True)
                score[lo:hi] = np.bincount(pair // len(m.words), weights=np.log1p(n) * m.weight[pair % len(m.words)],
                                           minlength=hi - lo)
            p = m.grades(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(p @ np.arange(p.shape[1])), pa.array(p.argmax(axis=1).astype(np.int32)),
                 pa.array(1 - p[:, 0]), pa.array(p[:, 0] < 0.5)], ["id", "severity", "grade", "p_toxic", "toxic"])

    t = d.schema["id"].dataType.simpleString()
    return d.mapInArrow(run, f"id {t}, severity double, grade int, p_toxic double, toxic boolean").withColumnRenamed("id", id_col)
