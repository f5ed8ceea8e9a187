"""Cohort construction: first stay per episode, subject/episode/stay joins,
age and outcome columns, engineered flags and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def _order_col(c: Column | str, nulls_first: bool = True) -> Column:
    if isinstance(c, Column):
        return c
    return F.asc_nulls_first(c) if nulls_first else F.asc_nulls_last(c)


def first_per_group(df: DataFrame, key: str | Sequence[str],
                    order_cols: Sequence[Column | str], rn_col: str | None = None
                    ) -> DataFrame:
    """Keep the first row per ``key`` under ``order_cols`` (ascending, NULLs
    first, like ``ROW_NUMBER() ... = 1``).  Pass a total order — ties are
    otherwise nondeterministic.

    Plain column names (ascending, NULLs first) plan as one aggregation of
    ``min(struct(order..., payload...))``: the partial aggregate keeps one
    row per key per task before the shuffle, no window is evaluated.  Other
    orders use ``row_number() = 1``, which Catalyst also limits map-side
    (partial WindowGroupLimit).  Either way a hot key cannot pile its rows
    into one reducer.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if rn_col is None and all(isinstance(c, str) for c in order_cols):
        order = list(order_cols)
        payload = [c for c in df.columns if c not in keys and c not in order]
        fields = [F.col(c).alias(f"__o{i}") for i, c in enumerate(order)] + \
                 [F.col(c) for c in payload]
        firsts = df.groupBy(*keys).agg(F.min(F.struct(*fields)).alias("__first"))
        return firsts.select(*keys, *[F.col(f"__first.__o{i}").alias(c) for i, c in enumerate(order)],
                             *[F.col(f"__first.{c}") for c in payload]).select(*df.columns)
    w = Window.partitionBy(*keys).orderBy(*[_order_col(c) for c in order_cols])
    rn = rn_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1)
    return out if rn_col else out.drop(rn)


def age_at(admit: Column | str, dob: Column | str) -> Column:
    """Age as a calendar-year difference of the two dates."""
    a = F.col(admit) if isinstance(admit, str) else admit
    d = F.col(dob) if isinstance(dob, str) else dob
    return S.calendar_year_diff(F.to_date(a), F.to_date(d))


def build_cohort(admissions: DataFrame, patients: DataFrame, stays: DataFrame,
                 stay_order: Sequence[str] = ("intime", "icustay_id"),
                 min_age: int = 18, max_age: int = 100,
                 exclude_units: Sequence[str] = ("NICU",),
                 los_days: float = S.PROLONGED_LOS_DAYS) -> DataFrame:
    """First ICU stay per admission, joined to the admission and the patient,
    restricted to adults and to non-excluded units.

    Inputs (column roles):
      admissions: subject_id, hadm_id, admittime, admission_type,
                  hospital_expire_flag [, dischtime, insurance, ethnicity]
      patients:   subject_id, gender, dob
      stays:      hadm_id, icustay_id, first_careunit, los, intime [, outtime]
                  plus any tie-break columns named in ``stay_order``.
    ``NOT IN`` drops NULL care units too (three-valued logic).
    """
    first = first_per_group(stays, "hadm_id", list(stay_order))
    stay_cols = [F.col("icustay_id"), F.col("first_careunit"),
                 F.col("los").alias("icu_los_days"), F.col("intime").alias("icu_intime")]
    if "outtime" in stays.columns:
        stay_cols.append(F.col("outtime").alias("icu_outtime"))
    first = first.select("hadm_id", *stay_cols).where(~F.col("first_careunit").isin(*exclude_units))

    adm_cols = [c for c in ("subject_id", "hadm_id", "admittime", "dischtime", "admission_type",
                            "insurance", "ethnicity", "hospital_expire_flag")
                if c in admissions.columns]
    base = (admissions.select(*adm_cols)
            .join(first, "hadm_id")
            .join(patients.select("subject_id", "gender", "dob"), "subject_id"))
    base = base.withColumns({
        "prolonged_los": S.prolonged_flag("icu_los_days", los_days),
        "age": age_at("admittime", "dob"),
    })
    ordered = [c for c in ("subject_id", "hadm_id", "icustay_id", "admittime", "dischtime",
                           "admission_type", "insurance", "ethnicity", "hospital_expire_flag",
                           "prolonged_los", "icu_los_days", "first_careunit", "icu_intime",
                           "icu_outtime", "gender", "age") if c in base.columns]
    return base.select(*ordered).where(F.col("age").between(min_age, max_age))


def add_engineered(df: DataFrame, male_value: str = "M", emergency_value: str = "EMERGENCY",
                   time_col: str = "admittime") -> DataFrame:
    """Encoded flags (NULL compares as 0), age band and pulse pressure (when
    mean SBP and mean DBP both exist)."""
    cols = {
        "gender_enc": S.eq_flag("gender", male_value),
        "emergency_admission": S.eq_flag("admission_type", emergency_value),
        "weekend_admission": S.weekend_flag(time_col),
        "night_admission": S.night_flag(time_col),
        "age_band": S.age_band("age"),
    }
    if "mean_sbp" in df.columns and "mean_dbp" in df.columns:
        cols["pulse_pressure"] = F.col("mean_sbp") - F.col("mean_dbp")
    return df.withColumns(cols)


def add_report_columns(df: DataFrame, time_col: str = "admittime") -> DataFrame:
    """Calendar parts, shift, age band and LOS band used by the reporting
    tables."""
    cols = S.calendar_columns(time_col)
    cols["age_band"] = S.age_band("age")
    cols["los_band"] = S.los_band("icu_los_days")
    return df.withColumns(cols)
