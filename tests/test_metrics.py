import numpy as np
import pytest

from stayscope.operators import metrics as M


def _brute_auc(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(y, s):
    y, s = np.asarray(y), np.asarray(s)
    P = y.sum()
    ap = 0.0
    for t in sorted(set(s.tolist()), reverse=True):
        sel = s >= t
        tp = (y[sel] == 1).sum()
        prec = tp / sel.sum()
        ap += ((y[s == t] == 1).sum() / P) * prec
    return ap


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, size=600)
    s = np.round(rng.normal(size=600) + y * 0.7, 1)          # many ties
    df = spark.createDataFrame([(int(a), float(b), int(b > 0.3)) for a, b in zip(y, s)],
                               "label int, score double, prediction int")
    return df, y, s


@pytest.mark.parametrize("rows_per_bucket", [5, 1_000_000])
def test_auc_and_ap_exact(scored, rows_per_bucket):
    df, y, s = scored
    kw = {"rows_per_bucket": rows_per_bucket}
    assert M.roc_auc(df, **kw).first()[0] == pytest.approx(_brute_auc(y, s), abs=1e-12)
    assert M.average_precision(df, **kw).first()[0] == pytest.approx(_brute_ap(y, s), abs=1e-12)
    roc = sorted((r.fpr, r.tpr) for r in M.roc_points(df, **kw).collect())
    assert roc[-1] == (1.0, 1.0)


def test_curves_monotone(scored):
    df, y, s = scored
    roc = sorted((r.fpr, r.tpr) for r in M.roc_points(df).collect())
    assert roc[0] == (0.0, 0.0) and roc[-1] == (1.0, 1.0)
    assert all(b[1] >= a[1] for a, b in zip(roc, roc[1:]))
    pr = M.pr_points(df).collect()
    assert len(pr) == len(set(s.tolist())) + 1
    assert all(r.baseline == pytest.approx(y.mean()) for r in pr)


def test_single_class_auc_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label int, score double")
    assert M.roc_auc(df).first()[0] is None


def test_report_and_confusion(spark, scored):
    df, y, s = scored
    cm = {(r.label, r.prediction): r["count"] for r in M.confusion_matrix(df).collect()}
    assert sum(cm.values()) == len(y)
    rep = {r["class"]: r for r in M.classification_report(df).collect()}
    tp, fp = cm[(1, 1)], cm[(0, 1)]
    assert rep["1"].precision == pytest.approx(tp / (tp + fp))
    none_pred = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    rep = {r["class"]: r for r in M.classification_report(none_pred).collect()}
    assert rep["1"].precision == 0.0 and rep["1"].f1_score == 0.0
    assert rep["accuracy"].f1_score == 0.5


def _sklearn_style_corners(y, s):
    """Reference rule: cumulative fps/tps per distinct threshold (descending),
    keep first, last and points where the second difference is non-zero."""
    order = sorted(set(s.tolist()), reverse=True)
    pos = np.array([((s == t) & (y == 1)).sum() for t in order])
    neg = np.array([((s == t) & (y == 0)).sum() for t in order])
    tps, fps = np.cumsum(pos), np.cumsum(neg)
    keep = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
    return sorted(zip(np.array(order)[keep].tolist(), (fps[keep] / neg.sum()).tolist(),
                      (tps[keep] / pos.sum()).tolist()))


@pytest.mark.parametrize("rows_per_bucket", [5, 1_000_000])
def test_roc_corner_points(spark, rows_per_bucket):
    rng = np.random.default_rng(17)
    y = rng.integers(0, 2, size=400)
    s = np.round(rng.normal(size=400) + y, 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = sorted((r.threshold, r.fpr, r.tpr) for r in
                 M.roc_points(df, drop_intermediate=True, rows_per_bucket=rows_per_bucket).collect() if r.threshold != float("inf"))
    exp = _sklearn_style_corners(y, s)
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        assert g == pytest.approx(e)
