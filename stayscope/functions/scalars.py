"""Column expressions: bands, half-even rounding, calendar parts, encodings,
labels and formatting.  All are Catalyst expressions (whole-stage codegen);
nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the analysed project's for identical results.
# Band edges are right-closed intervals (a, b]; values outside -> NULL.
AGE_BAND_EDGES = [17, 40, 60, 75, 100]
AGE_BAND_LABELS = ["18–40", "41–60", "61–75", "76+"]
SHIFT_EDGES = [-1, 7, 15, 23]
SHIFT_LABELS = ["Night (00–07)", "Day (08–15)", "Evening (16–23)"]
LOS_BAND_EDGES = [-0.1, 1, 3, 7, 14, 999]
LOS_BAND_LABELS = ["<1 day", "1–3 days", "3–7 days", "7–14 days", ">14 days"]
DAY_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DAY_TYPE_LABELS = {0: "Weekday", 1: "Weekend"}
WEEKEND_DAYS = [5, 6]          # Monday = 0
NIGHT_HOURS = (0, 7)           # inclusive
PROLONGED_LOS_DAYS = 7
# Feature-name display rules, applied in this order.
REPORT_LABEL_REPLACEMENTS = [("mean_", "Avg "), ("min_", "Min "), ("max_", "Max "), ("_", " ")]
MODEL_LABEL_REPLACEMENTS = [("mean_", "avg "), ("min_", "min "), ("max_", "max "), ("_", " ")]
# Measurement dictionaries (item code -> feature name).
VITAL_ITEMS = {220045: "heart_rate", 220179: "sbp", 220180: "dbp", 220277: "spo2",
               223762: "temperature_c", 220210: "resp_rate"}
LAB_ITEMS = {50912: "creatinine", 50813: "lactate", 51301: "wbc", 51222: "haemoglobin",
             50931: "glucose", 50882: "bicarbonate", 50885: "bilirubin"}
# Columns of the row-level reporting table, in order.
PATIENT_LEVEL_COLUMNS = (
    "icustay_id", "age", "age_band", "gender", "admission_type", "first_careunit",
    "hospital_expire_flag", "prolonged_los", "icu_los_days", "weekend_admission",
    "night_admission", "emergency_admission", "admit_hour", "admit_dow", "admit_month",
    "admit_year", "shift", "los_band", "mean_heart_rate", "mean_sbp", "mean_spo2",
    "mean_creatinine", "mean_lactate", "mean_wbc")
# Importances that the analysed project's report writes as literals.
REPORTED_IMPORTANCES = [
    ("age", 0.1028, "Demographics"), ("mean_lactate", 0.0780, "Labs"), ("mean_creatinine", 0.0651, "Labs"),
    ("min_spo2", 0.0629, "Vitals"), ("mean_heart_rate", 0.0541, "Vitals"), ("min_sbp", 0.0419, "Vitals"),
    ("mean_wbc", 0.0412, "Labs"), ("mean_bicarbonate", 0.0401, "Labs"), ("emergency_admission", 0.0393, "Admission"),
    ("mean_glucose", 0.0387, "Labs"), ("min_heart_rate", 0.0383, "Vitals"), ("max_creatinine", 0.0300, "Labs"),
    ("night_admission", 0.0298, "Admission"), ("mean_bilirubin", 0.0276, "Labs"), ("weekend_admission", 0.0221, "Admission")]
# Early-warning thresholds (first hours of a stay).
ALERT_THRESHOLDS = {"lactate": 2.5, "creatinine": 2.0}
ALERT_WINDOW_HOURS = 6
# ---------------------------------------------------------------------------


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_even(col: Column | str, digits: int = 0) -> Column:
    """numpy-style rounding: scale, round half to even on the binary product,
    unscale.  (``F.round`` is HALF_UP and differs on ties: 12.25 -> 12.3.)"""
    scale = float(10 ** digits)
    return F.rint(_c(col) * F.lit(scale)) / F.lit(scale)


def right_closed_band(col: Column | str, edges: Sequence[float], labels: Sequence[str]
                      ) -> Column:
    """Label of the interval (edges[i], edges[i+1]] holding ``col``; NULL when
    outside every interval or NULL."""
    assert len(edges) == len(labels) + 1
    c = _c(col)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def band_ordinal(col: Column | str, labels: Sequence[str]) -> Column:
    """Integer position of a band label (for ordering grouped output)."""
    c = _c(col)
    expr = None
    for i, lab in enumerate(labels):
        expr = F.when(c == lab, F.lit(i)) if expr is None else expr.when(c == lab, F.lit(i))
    return expr


def age_band(col: Column | str = "age") -> Column:
    return right_closed_band(col, AGE_BAND_EDGES, AGE_BAND_LABELS)


def shift_band(hour_col: Column | str) -> Column:
    return right_closed_band(hour_col, SHIFT_EDGES, SHIFT_LABELS)


def los_band(col: Column | str) -> Column:
    return right_closed_band(col, LOS_BAND_EDGES, LOS_BAND_LABELS)


def calendar_year_diff(later: Column | str, earlier: Column | str) -> Column:
    """Calendar-year boundary count between two dates/timestamps (2000-12-31 ->
    2001-01-01 is 1, unlike a completed-years difference)."""
    return F.year(_c(later)) - F.year(_c(earlier))


def weekday0(ts: Column | str) -> Column:
    """Day of week, Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(ts))


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 where NULL counts as 0 (pandas ``astype(int)`` of a
    comparison)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def eq_flag(col: Column | str, value) -> Column:
    return flag(_c(col) == F.lit(value))


def weekend_flag(ts: Column | str) -> Column:
    return flag(weekday0(ts).isin(*WEEKEND_DAYS))


def night_flag(ts: Column | str) -> Column:
    lo, hi = NIGHT_HOURS
    return flag(F.hour(_c(ts)).between(lo, hi))


def prolonged_flag(los: Column | str, days: float = PROLONGED_LOS_DAYS) -> Column:
    """1 when LOS exceeds ``days``; NULL LOS gives 0 (CASE falls to ELSE)."""
    return F.when(_c(los) > F.lit(days), F.lit(1)).otherwise(F.lit(0))


def day_name(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "EEEE")


def month_text(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM")


def day_type(weekend_col: Column | str) -> Column:
    c = _c(weekend_col)
    return F.when(c == 0, F.lit(DAY_TYPE_LABELS[0])).when(c == 1, F.lit(DAY_TYPE_LABELS[1]))


def day_order(day_col: Column | str) -> Column:
    return band_ordinal(day_col, DAY_ORDER)


def calendar_columns(ts: Column | str, prefix: str = "admit") -> dict[str, Column]:
    """hour / day name / yyyy-MM month / year / shift of a timestamp."""
    t = _c(ts)
    return {
        f"{prefix}_hour": F.hour(t),
        f"{prefix}_dow": day_name(t),
        f"{prefix}_month": month_text(t),
        f"{prefix}_year": F.year(t),
        "shift": shift_band(F.hour(t)),
    }


def pct(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator * 100; NULL instead of a divide-by-zero error."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double")) * F.lit(100.0)


def clip_upper(col: Column | str, upper: float) -> Column:
    """Upper clip that keeps NULL (``least`` alone skips NULLs)."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(F.least(c, F.lit(upper)))


def replace_chain(col: Column | str, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal (non-regex) substring replacements, applied in order."""
    out = _c(col)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def title_case(col: Column | str) -> Column:
    """Capitalise each space-separated word, lower-case the rest."""
    return F.initcap(_c(col))


def feature_label(col: Column | str, report_style: bool = True) -> Column:
    """Display label of a feature name: ``mean_heart_rate`` -> ``Avg Heart
    Rate`` (report) or ``avg heart rate`` (model plot)."""
    if report_style:
        return title_case(replace_chain(col, REPORT_LABEL_REPLACEMENTS))
    return replace_chain(col, MODEL_LABEL_REPLACEMENTS)


def percent_text(fraction: Column | str, digits: int = 1) -> Column:
    """``0.1234`` -> ``'12.3%'`` (half-even at ``digits``)."""
    return F.format_string(f"%.{digits}f%%", round_half_even(_c(fraction) * 100.0, digits))


def thousands_text(col: Column | str) -> Column:
    """``58976`` -> ``'58,976'``."""
    return F.format_number(_c(col).cast("double"), 0)


def code_lookup(col: Column | str, mapping: Mapping) -> Column:
    """Dictionary lookup as a literal map (unmapped codes -> NULL)."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)[_c(col)]
