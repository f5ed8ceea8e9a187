"""The README usage path: generic stages on clinical-role frames with the
default window anchor (the cohort's ICU in-time)."""

from stayscope.operators import model as MD
from stayscope.plans import roles
from stayscope.plans.stages import cohort_stage, model_stage, report_stage

SF = "/root/testdata/sf0.001"


def test_stages_with_default_anchor(spark):
    cohort = roles.cohort(spark, SF)
    meas = roles.measurements(spark, SF)
    st1 = cohort_stage(cohort, meas, meas, roles.VITAL_CODES, roles.LAB_CODES,
                       emergency_value=roles.EMERGENCY_TYPE)
    ready = st1["model_ready"]
    assert ready.count() == cohort.count()
    assert {"mean_heart_rate", "min_lactate", "pulse_pressure"} <= set(ready.columns)
    st2 = model_stage(ready, specs=MD.default_specs(num_trees=5, max_depth=3), cv=False)
    assert st2["model_metrics"].count() == 2
    auc = st2["model_metrics"].agg({"test_roc_auc": "max"}).first()[0]
    rep = report_stage(ready, roles.EMERGENCY_TYPE, auc, st2["importances"])
    assert rep["kpi_summary"].first().model_roc_auc == auc
    assert rep["mortality_by_age"].count() == 4
