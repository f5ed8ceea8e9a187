import os

from stayscope.operators import model as MD
from stayscope.plans import stages

SF = "/root/testdata/sf0.001"


def test_three_stages_on_tables(spark, tmp_path):
    out = stages.run_on_tables(spark, SF, str(tmp_path / "run"), num_trees=5, max_depth=3,
                               cv=False)
    for name in ("model_ready", "missing_summary", "model_metrics", "importances",
                 "shap_ranking", "confusion_matrix", "kpi_summary", "mortality_by_age",
                 "los_by_careunit", "weekend_effect", "shift_analysis", "feature_importance"):
        assert name in out and os.path.isdir(out[name]), name
    assert "patient_level" not in out and "scored_test" not in out
    metrics = spark.read.parquet(out["model_metrics"]).collect()
    assert {r.model for r in metrics} == {s.name for s in MD.default_specs()}
    kpi = spark.read.parquet(out["kpi_summary"]).first()
    assert kpi.model_roc_auc == max(r.test_roc_auc for r in metrics)
    cm = spark.read.parquet(out["confusion_matrix"]).collect()
    assert len(cm) == 4
    fi = spark.read.parquet(out["feature_importance"]).collect()
    assert fi and all(r.category in {"Demographics", "Admission", "Vitals", "Labs"} for r in fi)
