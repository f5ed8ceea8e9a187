"""Ranking and classification metrics over (label, score[, prediction]) rows:
exact ROC-AUC (ties averaged), step-wise average precision, ROC and PR
points, per-class report and confusion matrix.

Scores are first collapsed to one row per distinct score with positive and
negative counts (partial aggregation), then cumulative counts come from
``running_totals`` — bucketed prefix sums, never a single-partition window
over all scores.  Every quantity is an exact integer count until the final
division, so results are independent of summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .stats import running_totals


def score_groups(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(score, pos, neg) per distinct score; NULL labels/scores dropped."""
    return (df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
            .groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"),
                 F.sum((F.col(label) != 1).cast("long")).alias("neg")))


def cumulative_counts(df: DataFrame, label: str = "label", score: str = "score", **kw
                      ) -> DataFrame:
    """Per distinct score: pos, neg, tp / fp at threshold ``score >= s``, and
    totals P / N."""
    return _cumulative(_stored_groups(df, label, score), **kw)


def _stored_groups(df: DataFrame, label: str, score: str) -> DataFrame:
    # read several times (count, bounds, range totals, ranges, curve ends): written once
    return stored(score_groups(df, label, score), "score-groups")


def _cumulative(groups: DataFrame, **kw) -> DataFrame:
    rt = running_totals(groups, "score", ["pos", "neg"], **kw)
    return rt.select(
        "score", "pos", "neg",
        (F.col("pos_total") - F.col("pos_cum") + F.col("pos")).alias("tp"),
        (F.col("neg_total") - F.col("neg_cum") + F.col("neg")).alias("fp"),
        F.col("pos_cum").alias("pos_le"), F.col("neg_cum").alias("neg_le"),
        F.col("pos_total").alias("P"), F.col("neg_total").alias("N"),
        *[f"{c}_prev" for c in kw.get("previous", ())])


def _totals(groups: DataFrame) -> DataFrame:
    return groups.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", **kw) -> DataFrame:
    """Exact ROC-AUC with tied scores counted half (one row; NULL when only
    one class is present)."""
    cc = cumulative_counts(df, label, score, **kw)
    neg_below = (F.col("neg_le") - F.col("neg")).cast("double")
    u = F.sum(F.col("pos").cast("double") * (neg_below + F.lit(0.5) * F.col("neg").cast("double")))
    pn = F.first("P").cast("double") * F.first("N").cast("double")
    return cc.agg(F.when(pn > 0, u / pn).alias("roc_auc"))


def average_precision(df: DataFrame, label: str = "label", score: str = "score", **kw
                      ) -> DataFrame:
    """Step-wise average precision: sum over distinct thresholds (descending)
    of (recall increase) x precision — not the trapezoidal area."""
    cc = cumulative_counts(df, label, score, **kw)
    prec = F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")
    term = F.col("pos").cast("double") / F.col("P").cast("double") * prec
    return cc.agg(F.when(F.first("P") > 0, F.sum(term)).alias("average_precision"))


def _corner_points(cc: DataFrame) -> DataFrame:
    """Keep the thresholds where the ROC polyline turns: the first and last
    distinct score, and every score whose (positives, negatives) differ from
    those of the next lower score (collinear points dropped)."""
    last = F.col("pos_le") + F.col("neg_le") == F.col("P") + F.col("N")
    return cc.where(F.col("pos_prev").isNull() | last | (F.col("pos") != F.col("pos_prev"))
                    | (F.col("neg") != F.col("neg_prev")))


def roc_points(df: DataFrame, label: str = "label", score: str = "score",
               drop_intermediate: bool = False, **kw) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score (or, with
    ``drop_intermediate``, only the corner points) plus the (0, 0) start at
    threshold +inf."""
    groups = _stored_groups(df, label, score)
    if drop_intermediate:
        cc = _corner_points(_cumulative(groups, previous=["pos", "neg"], **kw))
    else:
        cc = _cumulative(groups, **kw)
    pts = cc.select(F.col("score").alias("threshold"),
                    F.try_divide(F.col("fp").cast("double"), F.col("N").cast("double")).alias("fpr"),
                    F.try_divide(F.col("tp").cast("double"), F.col("P").cast("double")).alias("tpr"))
    start = _totals(groups).select(F.lit(float("inf")).alias("threshold"),
                                   F.when(F.col("N") > 0, F.lit(0.0)).alias("fpr"),
                                   F.when(F.col("P") > 0, F.lit(0.0)).alias("tpr"))
    return pts.unionByName(start)


def pr_points(df: DataFrame, label: str = "label", score: str = "score", **kw) -> DataFrame:
    """(threshold, precision, recall, baseline) for every distinct score plus
    the (precision 1, recall 0) end point; ``baseline`` is the positive
    rate."""
    groups = _stored_groups(df, label, score)
    base = F.col("P").cast("double") / (F.col("P") + F.col("N")).cast("double")
    pts = _cumulative(groups, **kw).select(
        F.col("score").alias("threshold"),
        (F.col("tp").cast("double") / (F.col("tp") + F.col("fp")).cast("double")).alias("precision"),
        F.when(F.col("P") > 0, F.col("tp").cast("double") / F.col("P").cast("double"))
        .otherwise(F.lit(1.0)).alias("recall"), base.alias("baseline"))
    end = _totals(groups).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                                 F.lit(0.0).alias("recall"), base.alias("baseline"))
    return pts.unionByName(end)


def _confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    cnt = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    return df.where(y.isNotNull() & p.isNotNull()).agg(
        cnt((y == 0) & (p == 0)).alias("tn"), cnt((y == 0) & (p == 1)).alias("fp"),
        cnt((y == 1) & (p == 0)).alias("fn"), cnt((y == 1) & (p == 1)).alias("tp"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction"
                     ) -> DataFrame:
    """Binary confusion matrix as four (label, prediction, count) cells, zero
    cells included."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    arr = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"),
                             F.col(c).alias("count")) for a, b, c in cells])
    return _confusion_counts(df, label, prediction).select(F.inline(arr))


def _safe_div(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          names: tuple[str, str] = ("0", "1")) -> DataFrame:
    """Per-class precision / recall / F1 / support, accuracy, macro and
    support-weighted averages; zero denominators give 0."""
    c = _confusion_counts(df, label, prediction)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    f = lambda p, r: F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))
    s0, s1 = tn + fp, fn + tp
    w0, w1 = _safe_div(s0, n), _safe_div(s1, n)
    acc = _safe_div(tn + tp, n)
    rows = [
        (names[0], p0, r0, f(p0, r0), s0),
        (names[1], p1, r1, f(p1, r1), s1),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
        ("macro avg", (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f(p0, r0) + f(p1, r1)) / 2.0, n),
        ("weighted avg", p0 * w0 + p1 * w1, r0 * w0 + r1 * w1, f(p0, r0) * w0 + f(p1, r1) * w1, n),
    ]
    arr = F.array(*[F.struct(F.lit(k).alias("class"), p.alias("precision"), r.alias("recall"),
                             f1.alias("f1_score"), s.cast("long").alias("support"))
                    for k, p, r, f1, s in rows])
    return c.select(F.inline(arr))
