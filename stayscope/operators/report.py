"""Grouped reporting tables over a cohort: outcome rates by band, category,
unit, weekday and shift; KPI row; overview; heatmap; risk ratios; shares.

All are hash aggregations with partial (map-side) combining; group keys are
low-cardinality, so results are tiny.  NULL group keys are dropped (the
reporting frames never show a NULL category) and an all-NULL outcome sums to
0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .stats import exact_medians


def outcome_table(df: DataFrame, keys: Sequence[str], id_col: str = "icustay_id",
                  outcome: str = "hospital_expire_flag", los: str = "icu_los_days",
                  prolonged: str | None = None, median: bool = False,
                  order_by=None) -> DataFrame:
    """Per group: total_patients (non-NULL ids), deaths, mean_los (2 dp),
    [median_los (2 dp, exact)], [pct_prolonged (1 dp)], mortality_rate_pct
    (1 dp).  Rounding is half-even."""
    keys = list(keys)
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    src = df.where(cond)
    aggs = [F.count(id_col).alias("total_patients"),
            F.coalesce(F.sum(outcome), F.lit(0)).cast("long").alias("deaths"),
            F.avg(los).alias("mean_los")]
    if prolonged:
        aggs.append(F.avg(prolonged).alias("pct_prolonged"))
    out = src.groupBy(*keys).agg(*aggs)
    cols = [*keys, "total_patients", "deaths",
            S.round_half_even("mean_los", 2).alias("mean_los")]
    if median:
        med = exact_medians(src.select(*keys, los), los, keys, out_col="median_los")
        out = out.join(med, keys, "left")
        cols.append(S.round_half_even("median_los", 2).alias("median_los"))
    if prolonged:
        cols.append(S.round_half_even(F.col("pct_prolonged") * 100.0, 1).alias("pct_prolonged"))
    cols.append(S.round_half_even(S.pct(F.col("deaths"), F.col("total_patients")), 1)
                .alias("mortality_rate_pct"))
    out = out.select(*cols)
    return out.orderBy(order_by) if order_by is not None else out


def mortality_by_age(cohort: DataFrame) -> DataFrame:
    df = cohort if "age_band" in cohort.columns else cohort.withColumn("age_band", S.age_band())
    return outcome_table(df, ["age_band"],
                         order_by=S.band_ordinal("age_band", S.AGE_BAND_LABELS))


def mortality_by_admtype(cohort: DataFrame) -> DataFrame:
    return outcome_table(cohort, ["admission_type"], prolonged="prolonged_los",
                         order_by="admission_type")


def los_by_careunit(cohort: DataFrame) -> DataFrame:
    return outcome_table(cohort, ["first_careunit"], prolonged="prolonged_los", median=True,
                         order_by="first_careunit")


def weekend_effect(cohort: DataFrame, time_col: str = "admittime") -> DataFrame:
    df = cohort.withColumns({"admit_dow": S.day_name(time_col),
                             "weekend_admission": S.weekend_flag(time_col)})
    out = outcome_table(df, ["admit_dow", "weekend_admission"])
    return (out.withColumn("day_type", S.day_type("weekend_admission"))
            .orderBy(S.day_order("admit_dow")))


def shift_analysis(cohort: DataFrame, time_col: str = "admittime") -> DataFrame:
    df = cohort.withColumn("shift", S.shift_band(F.hour(time_col)))
    return outcome_table(df, ["shift"], order_by=S.band_ordinal("shift", S.SHIFT_LABELS))


def kpi_summary(cohort: DataFrame, model_auc: float | None, emergency_value: str,
                time_col: str = "admittime") -> DataFrame:
    """Single-row KPI card.  ``model_auc`` comes from actual model/metric
    output (or a caller-supplied fallback)."""
    r1 = lambda c: S.round_half_even(c, 1)
    return cohort.agg(
        F.count(F.lit(1)).alias("total_patients"),
        F.coalesce(F.sum("hospital_expire_flag"), F.lit(0)).cast("long").alias("total_deaths"),
        r1(F.avg("hospital_expire_flag") * 100.0).alias("mortality_rate_pct"),
        r1(F.avg("icu_los_days")).alias("mean_icu_los_days"),
        r1(F.avg("prolonged_los") * 100.0).alias("pct_prolonged_los"),
        r1(F.avg(S.eq_flag("admission_type", emergency_value)) * 100.0).alias("pct_emergency"),
        r1(F.avg(S.weekend_flag(time_col)) * 100.0).alias("pct_weekend"),
        F.lit(model_auc).cast("double").alias("model_roc_auc"),
        F.count_distinct("first_careunit").alias("care_units_covered"))


def cohort_overview(cohort: DataFrame) -> DataFrame:
    """Row count, outcome rates and the age range (one row)."""
    return cohort.agg(F.count(F.lit(1)).alias("n_admissions"),
                      F.avg("hospital_expire_flag").alias("mortality_rate"),
                      F.avg("prolonged_los").alias("prolonged_rate"),
                      F.min("age").alias("age_min"), F.max("age").alias("age_max"))


def rate_by(cohort: DataFrame, dims: Sequence[str], outcome: str = "hospital_expire_flag"
            ) -> DataFrame:
    """Outcome % by each dimension separately, stacked as (dimension,
    category, n, rate_pct): one scan and one shuffle for all dimensions."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"),
                                        F.col(d).cast("string").alias("category")) for d in dims]))
    return (cohort.select(F.col(outcome).alias("__y"), each.alias("__d"))
            .select("__y", "__d.dimension", "__d.category").where(F.col("category").isNotNull())
            .groupBy("dimension", "category")
            .agg(F.count(F.lit(1)).alias("n"), (F.avg("__y") * 100.0).alias("rate_pct")))


def mean_by(cohort: DataFrame, key: str, value: str, out_col: str) -> DataFrame:
    return cohort.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias(out_col))


def heatmap(cohort: DataFrame, row_key: str, col_key: str, col_values: Sequence[str],
            outcome: str = "hospital_expire_flag") -> DataFrame:
    """Outcome % (1 dp) for row_key x col_key, pivoted to one column per
    listed ``col_values`` entry (explicit values: no extra distinct job)."""
    return (cohort.where(F.col(row_key).isNotNull())
            .groupBy(row_key).pivot(col_key, list(col_values))
            .agg(S.round_half_even(F.avg(outcome) * 100.0, 1)))


def relative_risk(cohort: DataFrame, col: str, exposed: str, reference: str,
                  outcome: str = "hospital_expire_flag") -> DataFrame:
    """Outcome rate of ``exposed`` over that of ``reference`` (one row)."""
    e = F.avg(F.when(F.col(col) == exposed, F.col(outcome)))
    r = F.avg(F.when(F.col(col) == reference, F.col(outcome)))
    return cohort.agg((e * 100.0).alias("exposed_rate_pct"), (r * 100.0).alias("reference_rate_pct"),
                      F.try_divide(e, r).alias("relative_risk"))


def outcome_gap(cohort: DataFrame, time_col: str = "admittime",
                outcome: str = "hospital_expire_flag", los: str = "icu_los_days") -> DataFrame:
    """Weekend - weekday mortality (percentage points) and night- vs day-shift
    mean LOS ratio (one row)."""
    wk = S.weekend_flag(time_col)
    sh = S.shift_band(F.hour(time_col))
    we = F.avg(F.when(wk == 1, F.col(outcome))) * 100.0
    wd = F.avg(F.when(wk == 0, F.col(outcome))) * 100.0
    nl = F.avg(F.when(sh == S.SHIFT_LABELS[0], F.col(los)))
    dl = F.avg(F.when(sh == S.SHIFT_LABELS[1], F.col(los)))
    return cohort.agg(we.alias("weekend_mortality_pct"), wd.alias("weekday_mortality_pct"),
                      (we - wd).alias("gap_pp"), nl.alias("night_mean_los"),
                      dl.alias("day_mean_los"), F.try_divide(nl, dl).alias("night_day_los_ratio"))


def share_of_total(df: DataFrame, key: str, value: str, digits: int = 1) -> DataFrame:
    """value / sum(value) * 100 per row (half-even).  Meant for small,
    already-grouped tables: the total is an unpartitioned window."""
    w = Window.partitionBy()
    return df.withColumn(f"{value}_pct",
                         S.round_half_even(F.col(value) / F.sum(value).over(w) * 100.0, digits))


def patient_level(cohort: DataFrame, time_col: str = "admittime",
                  columns: Sequence[str] = S.PATIENT_LEVEL_COLUMNS) -> DataFrame:
    """Row-level reporting projection (kept local: never published by
    default)."""
    from ..sources.tables import select_existing
    from .cohort import add_report_columns
    return select_existing(add_report_columns(cohort, time_col), list(columns))


# Reporting tables that may be shared; ``patient_level`` is row-level.
AGGREGATE_TABLES = ("kpi_summary", "mortality_by_age", "mortality_by_admtype", "los_by_careunit",
                    "weekend_effect", "shift_analysis", "feature_importance")


def reporting_tables(cohort: DataFrame, emergency_value: str, model_auc: float | None = None,
                     importances: DataFrame | None = None, time_col: str = "admittime"
                     ) -> dict[str, DataFrame]:
    """The whole reporting bundle from one cohort/master frame: KPI card,
    outcome tables by age band, admission type, care unit, weekday and shift,
    feature importance (when given: feature, importance, category) and the
    row-level table.  Pass it to ``sources.publish``; the row-level table is
    kept local unless asked for."""
    tables = {
        "kpi_summary": kpi_summary(cohort, model_auc, emergency_value, time_col),
        "mortality_by_age": mortality_by_age(cohort),
        "mortality_by_admtype": mortality_by_admtype(cohort),
        "los_by_careunit": los_by_careunit(cohort),
        "weekend_effect": weekend_effect(cohort, time_col),
        "shift_analysis": shift_analysis(cohort, time_col),
        "patient_level": patient_level(cohort, time_col),
    }
    if importances is not None:
        tables["feature_importance"] = share_of_total(importances, "feature", "importance") \
            .withColumn("feature_label", S.feature_label("feature"))
    return tables
