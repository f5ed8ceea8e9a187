"""Class-weighted logistic regression (Newton steps, ``logistic``) and random
forest (Spark ML), with a population-std scaler, fold-correct cross-validation,
hold-out scoring, metrics table and importances.

Every fit derives its scaler statistics, balanced class weights and (for the
logistic model) the regularisation strength from *its own* training rows: a
penalty of 1 / (C * sum of weights), which makes the averaged objective
equal to the C-parametrised one.  Only bounded scalars (per-feature moments,
per-class counts) travel to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_stored, stored
from . import metrics as M
from .logistic import LogisticFit, fit_logistic
from .sampling import with_weights

# Modelling defaults of the analysed project (fixed values).
RANDOM_SEED = 42
TEST_SIZE = 0.2
LR_C = 0.1
LR_MAX_ITER = 1000
RF_TREES = 300
RF_MAX_DEPTH = 8
RF_MIN_LEAF = 20
CV_FOLDS = 5
ID_AND_OUTCOME_COLS = ["subject_id", "hadm_id", "icustay_id", "admittime",
                       "hospital_expire_flag", "prolonged_los", "age_band", "gender",
                       "admission_type", "first_careunit", "insurance", "ethnicity",
                       "icu_los_days"]

# The forest's learner keeps some 4 KB a row (a count and a node for each of 300 trees).
FOREST_TASK_ROWS = 100_000      # rows of one task of a forest's fit at most
CONCURRENT_ROWS = 2_000_000     # training rows of the folds that are fitted at the same time
_FEATURES_VEC = "__features"
_WEIGHT = "__weight"


@dataclass
class ModelSpec:
    kind: str                       # "lr" | "rf"
    name: str
    C: float = LR_C
    max_iter: int = LR_MAX_ITER
    num_trees: int = RF_TREES
    max_depth: int = RF_MAX_DEPTH
    min_leaf: int = RF_MIN_LEAF
    max_bins: int = 128
    seed: int = RANDOM_SEED


def default_specs(num_trees: int = RF_TREES, max_depth: int = RF_MAX_DEPTH) -> list[ModelSpec]:
    return [ModelSpec("lr", "Logistic Regression"),
            ModelSpec("rf", "Random Forest", num_trees=num_trees, max_depth=max_depth)]


@dataclass
class FittedModel:
    spec: ModelSpec
    features: list[str]
    scaler: dict[str, tuple[float, float]]
    model: Any
    weights: dict = field(default_factory=dict)

    def scale(self, df: DataFrame) -> DataFrame:
        """Scale with the training moments (constant column -> 0)."""
        scaled = {}
        for c in self.features:
            m, s = self.scaler[c]
            m = 0.0 if m is None else float(m)
            s = 1.0 if (s is None or s == 0.0) else float(s)
            scaled[c] = (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
        return df.withColumns(scaled)

    def prepare(self, df: DataFrame) -> DataFrame:
        """Scale and assemble the feature vector."""
        return VectorAssembler(inputCols=self.features, outputCol=_FEATURES_VEC).transform(self.scale(df))

    def score(self, df: DataFrame, id_col: str, label_col: str) -> DataFrame:
        """(id, label, score = P(class 1), prediction at 0.5)."""
        if isinstance(self.model, LogisticFit):
            return self.scale(df).withColumn("score", self.model.probability()).select(
                id_col, F.col(label_col).cast("int").alias("label"), "score",
                (F.col("score") > 0.5).cast("int").alias("prediction"))
        pred = self.model.transform(self.prepare(df))
        return pred.select(id_col, F.col(label_col).cast("int").alias("label"),
                           vector_to_array("probability")[1].alias("score"),
                           F.col("prediction").cast("int").alias("prediction"))


def model_features(df: DataFrame, drop: Sequence[str] = ID_AND_OUTCOME_COLS) -> tuple[list, list]:
    """Numeric columns not in ``drop`` (first occurrence of each name), and
    the non-numeric ones that were dropped."""
    from ..sources.tables import numeric_columns
    keep, dropped = numeric_columns(df, exclude=drop)
    return list(dict.fromkeys(keep)), dropped


def _statistics_by(train: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] = ()) -> list:
    """One aggregation pass: per class (and ``keys``) count, mean and
    population variance of every feature; NULL labels are left out."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(features):
        aggs += [F.avg(c).alias(f"m{i}"), F.var_pop(c).alias(f"v{i}"), F.count(c).alias(f"n{i}")]
    return train.where(F.col(label).isNotNull()).groupBy(label, *keys).agg(*aggs).collect()


def _combined(rows: list, features: Sequence[str], label: str) -> tuple[dict, list[tuple]]:
    """Scaler moments by the pairwise variance formula, and balanced weights
    (label, count, weight) from the classes' counts."""
    scaler = {}
    for i, c in enumerate(features):
        n, mean, m2 = 0, 0.0, 0.0
        for r in rows:
            nb, mb, vb = r[f"n{i}"], r[f"m{i}"], r[f"v{i}"]
            if not nb:
                continue
            delta = mb - mean
            tot = n + nb
            mean += delta * nb / tot
            m2 += vb * nb + delta * delta * n * nb / tot
            n = tot
        scaler[c] = (mean if n else None, float(np.sqrt(m2 / n)) if n else None)
    counts: dict = {}
    for r in rows:
        counts[r[label]] = counts.get(r[label], 0) + r["__n"]
    total, k = sum(counts.values()), len(counts)
    return scaler, [(lab, n, total / (k * n)) for lab, n in counts.items()]


def train_statistics(train: DataFrame, features: Sequence[str], label: str
                     ) -> tuple[dict, list[tuple]]:
    """Scaler moments and balanced class weights from one pass over the
    training rows (classes x features scalars reach the driver)."""
    return _combined(_statistics_by(train, features, label), features, label)


def fold_statistics(train: DataFrame, features: Sequence[str], label: str, fold_col: str = "fold",
                    k: int = CV_FOLDS) -> dict[int, tuple[dict, list[tuple]]]:
    """``train_statistics`` of every fold's training part (all rows but the
    fold's), for all folds from one pass: statistics are taken by (fold, class)
    once, and a fold's training part is the other folds' statistics combined."""
    rows = _statistics_by(train.where(F.col(fold_col).isNotNull()), features, label, [fold_col])
    return {i: _combined([r for r in rows if r[fold_col] != i], features, label) for i in range(k)}


def forest_rows(ready: DataFrame, rows: int) -> DataFrame:
    """``ready`` in partitions of about ``FOREST_TASK_ROWS`` rows at most: as it
    is where these already hold, else dealt anew, in an order that a repeated
    task finds again (bagging draws by place in the partition)."""
    if rows <= FOREST_TASK_ROWS * ready.rdd.getNumPartitions():
        return ready
    return ready.repartition(-(-rows // FOREST_TASK_ROWS)).sortWithinPartitions(*ready.columns)


def concurrent_folds(rows: int, k: int) -> int:
    """How many of ``k`` folds to fit at a time: what their fits hold in memory
    must not grow with the number of folds once one fit fills the cluster."""
    return max(1, min(k, CONCURRENT_ROWS // max(1, rows)))


def fit(spec: ModelSpec, train: DataFrame, features: Sequence[str], label: str,
        statistics: tuple[dict, list[tuple]] | None = None) -> FittedModel:
    """Fit on ``train``; ``statistics`` of its rows may be handed in."""
    feats = list(features)
    scaler, counts = statistics or train_statistics(train, feats, label)
    weights = {lab: w for lab, _, w in counts}
    total_w = float(sum(n * w for _, n, w in counts))
    fm = FittedModel(spec, feats, scaler, None, weights)
    if spec.kind not in ("lr", "rf"):
        raise ValueError(spec.kind)
    if spec.kind == "lr":
        ready = fm.scale(train.where(F.col(label).isNotNull()))
    else:
        rows = train.select(*feats, label)
        ready = fm.prepare(forest_rows(rows, sum(n for _, n, _ in counts)))
    data = with_weights(ready, label, weights, _WEIGHT).withColumn(label, F.col(label).cast("double"))
    data = data.select(*(feats if spec.kind == "lr" else [_FEATURES_VEC]), label, _WEIGHT).persist()
    try:
        if spec.kind == "lr":
            fm.model = fit_logistic(data, feats, label, _WEIGHT, 1.0 / (spec.C * total_w), spec.max_iter)
        else:
            fm.model = RandomForestClassifier(
                featuresCol=_FEATURES_VEC, labelCol=label, weightCol=_WEIGHT,
                numTrees=spec.num_trees, maxDepth=spec.max_depth, minInstancesPerNode=spec.min_leaf,
                featureSubsetStrategy="sqrt", maxBins=spec.max_bins, seed=spec.seed, cacheNodeIds=True,
                checkpointInterval=10, maxMemoryInMB=512).fit(data)
    finally:
        data.unpersist()
    return fm


def cross_validate(spec: ModelSpec, train: DataFrame, features: Sequence[str], label: str,
                   id_col: str, fold_col: str = "fold", k: int = CV_FOLDS,
                   parallelism: int | None = None, statistics: dict | None = None) -> list[float]:
    """Exact ROC-AUC of each fold's model on its held-out fold.  Each fold has
    scaler, weights and regularisation of its own training part, all from one
    pass (``fold_statistics``, which may be handed in for several models);
    folds run concurrently (driver threads submitting Spark jobs), as many at a
    time as ``concurrent_folds`` of their training rows or ``parallelism`` says."""
    by_fold = statistics or fold_statistics(train, features, label, fold_col, k)
    rows = max(sum(n for _, n, _ in counts) for _, counts in by_fold.values())
    parallelism = parallelism or concurrent_folds(rows, k)

    def one(i: int) -> float:
        tr = train.where(F.col(fold_col) != i)
        va = train.where(F.col(fold_col) == i)
        fm = fit(spec, tr, features, label, by_fold[i])
        scored = stored(fm.score(va, id_col, label), "fold-scores")     # scored once
        auc = M.roc_auc(scored).first()["roc_auc"]
        drop_stored(scored)
        return auc
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(one, range(k)))


def importances(fm: FittedModel) -> list[tuple[str, float]]:
    """Impurity importances of a forest, named (bounded by the feature count)."""
    vec = fm.model.featureImportances.toArray()
    return list(zip(fm.features, [float(v) for v in vec]))


def metrics_row(spec: ModelSpec, cv_aucs: Sequence[float], scored: DataFrame) -> dict:
    auc = M.roc_auc(scored).first()["roc_auc"]
    ap = M.average_precision(scored).first()["average_precision"]
    rep = {r["class"]: r for r in M.classification_report(scored).collect()}
    died = rep.get("1")
    return {"model": spec.name,
            "cv_auc_mean": float(np.mean(cv_aucs)) if cv_aucs else None,
            "cv_auc_std": float(np.std(cv_aucs)) if cv_aucs else None,
            "test_roc_auc": auc, "test_avg_precision": ap,
            "precision_died": died["precision"] if died else None,
            "recall_died": died["recall"] if died else None,
            "f1_died": died["f1_score"] if died else None}


METRICS_SCHEMA = ("model string, cv_auc_mean double, cv_auc_std double, test_roc_auc double, "
                  "test_avg_precision double, precision_died double, recall_died double, "
                  "f1_died double")
