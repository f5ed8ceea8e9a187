"""The three stages of the analysed workflow as library calls over any
subject / episode / stay / measurement tables:

1. ``cohort_stage``  — first-stay adult cohort, first-window vitals and labs
   pivoted to min / max / mean, engineered columns, missingness report,
   median imputation (the model-ready table);
2. ``model_stage``   — stratified split and folds, class-weighted logistic
   regression and random forest, cross-validated and hold-out metrics,
   importances, tree explanations, best-model confusion matrix;
3. ``report_stage``  — the reporting tables, published one dataset per
   table (row-level table kept local unless asked).

``run_on_tables`` wires them to the star-schema test tables through the role
mapping and writes every output under one folder.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import cohort as C
from ..operators import events as EV
from ..operators import explain as X
from ..operators import metrics as M
from ..operators import model as MD
from ..operators import report as R
from ..operators import sampling as SP
from ..operators import stats as ST
from ..session import stored
from ..sources import publish
from ..sources.tables import columns_with_prefix


def build_master(cohort: DataFrame, chart: DataFrame, labs: DataFrame,
                 vital_items: Mapping, lab_items: Mapping, anchors: DataFrame | None = None,
                 window_hours: float | None = 24, chart_error_col: str | None = "error",
                 male_value: str = "M", emergency_value: str = "EMERGENCY") -> DataFrame:
    """Cohort left-joined to its first-window vital and lab features.

    chart: icustay_id, itemid, charttime, valuenum [, error]
    labs:  hadm_id, itemid, charttime, valuenum
    anchors: icustay_id, hadm_id, intime (default: the cohort's ICU in-time)
    """
    if anchors is None:
        anchors = cohort.select("icustay_id", "hadm_id", F.col("icu_intime").alias("intime"))
    vnames = list(dict.fromkeys(vital_items.values()))
    lnames = list(dict.fromkeys(lab_items.values()))
    v = EV.filter_measurements(chart, vital_items,
                               error_col=chart_error_col if chart_error_col in chart.columns
                               else None)
    v = EV.window_join(v.drop(*[c for c in ("hadm_id",) if c in v.columns]), anchors,
                       "icustay_id", "icustay_id", window_hours=window_hours)
    lb = EV.filter_measurements(labs, lab_items)
    lb = EV.window_join(lb.drop(*[c for c in ("icustay_id",) if c in lb.columns]), anchors,
                        "hadm_id", "hadm_id", window_hours=window_hours,
                        anchor_cols=["icustay_id"])
    wide_v = EV.wide_stats(EV.name_items(v, vital_items), "icustay_id", vnames)
    wide_l = EV.wide_stats(EV.name_items(lb, lab_items), "icustay_id", lnames)
    m = EV.master_join(cohort, wide_v, wide_l, key="icustay_id")
    return C.add_engineered(m, male_value=male_value, emergency_value=emergency_value)


def feature_columns(master: DataFrame) -> list[str]:
    """min_ / max_ / mean_ columns plus pulse pressure, each once."""
    return columns_with_prefix(master, ("min_", "max_", "mean_"), also=["pulse_pressure"])


def cohort_stage(cohort: DataFrame, chart: DataFrame, labs: DataFrame, vital_items: Mapping,
                 lab_items: Mapping, anchors=None,
                 window_hours: float | None = 24, with_flags: bool = False,
                 emergency_value: str = "EMERGENCY") -> dict[str, DataFrame]:
    """Model-ready table (median-imputed features; flags taken before the
    fill when ``with_flags``) and the missingness summary.  ``anchors`` is a
    DataFrame or a function of the (materialised) cohort."""
    co = stored(cohort, "cohort")               # read as base table and by both anchors
    a = anchors(co) if callable(anchors) else anchors
    master = build_master(co, chart, labs, vital_items, lab_items, a, window_hours,
                          emergency_value=emergency_value)
    master = stored(master, "master")
    feats = feature_columns(master)
    missing = ST.missing_summary(master, feats)
    model_ready = ST.impute_median(master, feats, with_flags=with_flags)
    return {"model_ready": model_ready, "missing_summary": missing,
            "missing_top10": missing.orderBy(F.desc("missing_frac"), "feature").limit(10)}


def model_stage(model_ready: DataFrame, label: str = "hospital_expire_flag",
                key: str = "icustay_id", specs: Sequence[MD.ModelSpec] | None = None,
                cv: bool = True) -> dict[str, DataFrame]:
    """Split, (cross-)validate and fit every spec; metrics table, scored test
    rows, importances, explanation ranking and best-model confusion matrix."""
    spark = model_ready.sparkSession
    feats, dropped = MD.model_features(model_ready)
    meds = ST.collect_medians(model_ready, feats)            # residual NULLs, as a guard
    feats = [c for c in feats if meds.get(c) is not None]
    mat = ST.impute_median(model_ready.select(key, label, *feats), feats, medians=meds)
    mat = stored(SP.split_and_folds(mat, label, key, test_fraction=MD.TEST_SIZE, k=MD.CV_FOLDS,
                                    seed=MD.RANDOM_SEED, allocation="largest_remainder"), "matrix")
    train, test = mat.where("is_test = 0"), mat.where("is_test = 1")
    rows, scored, fits = [], {}, {}
    for spec in specs or MD.default_specs():
        aucs = MD.cross_validate(spec, train, feats, label, key) if cv else []
        fm = MD.fit(spec, train, feats, label)
        fits[spec.kind] = fm
        scored[spec.name] = stored(fm.score(test, key, label), "test-scores")
        rows.append(MD.metrics_row(spec, aucs, scored[spec.name]))
    metrics = spark.createDataFrame(rows, MD.METRICS_SCHEMA)
    best = max(rows, key=lambda r: r["test_roc_auc"] or 0.0)["model"]
    out = {"model_metrics": metrics,
           "confusion_matrix": M.confusion_matrix(scored[best]).withColumn("model", F.lit(best)),
           "scored_test": scored[best].withColumn("model", F.lit(best))}
    if "rf" in fits:
        fm = fits["rf"]
        imp = spark.createDataFrame(MD.importances(fm), "feature string, importance double")
        out["importances"] = (imp.orderBy(F.desc("importance"), "feature")
                              .withColumn("feature_label",
                                          S.feature_label("feature", report_style=False)))
        rows = test.repartition(spark.sparkContext.defaultParallelism, key)
        shap = X.shap_values(fm.scale(rows).select(key, *fm.features), key, fm.features, fm.model)
        out["shap_ranking"] = X.shap_ranking(shap, top=12)
    return out


def report_stage(model_ready: DataFrame, emergency_value: str = "EMERGENCY",
                 model_auc: float | None = None, importances: DataFrame | None = None,
                 categories: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """The reporting tables; importances get a category column when a
    feature -> category map is given."""
    imp = None
    if importances is not None:
        cat = categories or {}
        kv = []
        for k, v in cat.items():
            kv += [F.lit(k), F.lit(v)]
        category = F.create_map(*kv)[F.col("feature")] if kv else F.lit(None).cast("string")
        imp = importances.select("feature", "importance", category.alias("category"))
    return R.reporting_tables(model_ready, emergency_value, model_auc, imp)


def run_on_tables(spark, root: str, out_dir: str, num_trees: int = MD.RF_TREES,
                  max_depth: int = MD.RF_MAX_DEPTH, cv: bool = True) -> dict[str, str]:
    """All three stages over the star-schema test tables (role mapping in
    ``plans.roles``); every output table is written under ``out_dir``."""
    from . import roles
    cohort = roles.cohort(spark, root)
    meas = roles.measurements(spark, root)
    st1 = cohort_stage(cohort, meas, meas, roles.VITAL_CODES, roles.LAB_CODES,
                       anchors=roles.cohort_anchors, emergency_value=roles.EMERGENCY_TYPE)
    specs = MD.default_specs(num_trees=num_trees, max_depth=max_depth)
    st2 = model_stage(st1["model_ready"], specs=specs, cv=cv)
    auc = st2["model_metrics"].agg(F.max("test_roc_auc")).first()[0]
    from .catalog import _category
    cats = {f: _category(f) for f in MD.model_features(st1["model_ready"])[0]}
    st3 = report_stage(st1["model_ready"], roles.EMERGENCY_TYPE, auc, st2.get("importances"),
                       categories=cats)
    written = {}
    written.update(publish({"model_ready": st1["model_ready"]}, os.path.join(out_dir, "cohort"),
                           include_row_level=True))
    written.update(publish(st1, os.path.join(out_dir, "cohort"),
                           aggregates=("missing_summary", "missing_top10")))
    written.update(publish(st2, os.path.join(out_dir, "model"), aggregates=(
        "model_metrics", "confusion_matrix", "importances", "shap_ranking")))
    written.update(publish(st3, os.path.join(out_dir, "report"), aggregates=R.AGGREGATE_TABLES))
    return written
