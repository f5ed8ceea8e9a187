"""Registered queries over the star-schema test tables, each with its DuckDB
oracle SQL (where one exists).

``QUERIES[name](spark, root)`` returns a DataFrame; ``ORACLE[name]`` is SQL
over the pre-registered views ``customer orders lineitem events labels
documents ...``.  Column names and types agree on both sides; doubles that
come out of floating sums are rounded half-even on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import cohort as C
from ..operators import events as EV
from ..operators import explain as X
from ..operators import forest as FO
from ..operators import logistic as LG
from ..operators import metrics as M
from ..operators import model as MD
from ..operators import report as R
from ..operators import sampling as SP
from ..operators import stats as ST
from ..session import scratch_path, stored
from ..sources.layout import lay_out
from ..sources.sinks import publish_bundle, write_table
from ..sources.tables import inline_relation, literal_table, parse_timestamps, read_csv_with_rejects, read_in_order, read_table
from . import roles, stages

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def sql_r(expr: str, digits: int) -> str:
    """Half-even rounding in DuckDB, same arithmetic as ``round_half_even``."""
    scale = float(10 ** digits)
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def sql_band(col: str, edges, labels) -> str:
    parts = [f"WHEN {col} > {lo} AND {col} <= {hi} THEN '{lab}'"
             for lo, hi, lab in zip(edges[:-1], edges[1:], labels)]
    return "CASE " + " ".join(parts) + " END"


SQL_AGE_BAND = sql_band("age", S.AGE_BAND_EDGES, S.AGE_BAND_LABELS)
SQL_LOS_BAND = sql_band("icu_los_days", S.LOS_BAND_EDGES, S.LOS_BAND_LABELS)
SQL_SHIFT = sql_band("CAST(hour(admittime) AS INTEGER)", S.SHIFT_EDGES, S.SHIFT_LABELS)
SQL_WEEKEND = "CASE WHEN isodow(admittime) IN (6, 7) THEN 1 ELSE 0 END"
SQL_NIGHT = "CASE WHEN hour(admittime) BETWEEN 0 AND 7 THEN 1 ELSE 0 END"


# ---------------------------------------------------------------- cohort ---

@register("first_stay", _with(roles.SQL_ICUSTAYS) + """
SELECT hadm_id, icustay_id, first_careunit, los, intime FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY hadm_id ORDER BY intime ASC NULLS FIRST,
         l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn FROM icustays) t
WHERE rn = 1""")
def q_first_stay(spark, root):
    st = roles.icustays(spark, root)
    return C.first_per_group(st, "hadm_id", list(roles.STAY_ORDER)) \
        .select("hadm_id", "icustay_id", "first_careunit", "los", "intime")


@register("not_in_filter", _with(roles.SQL_ICUSTAYS) + """
SELECT hadm_id, first_careunit, los FROM icustays WHERE first_careunit NOT IN ('N')""")
def q_not_in_filter(spark, root):
    return roles.icustays(spark, root).where(~F.col("first_careunit").isin(*roles.EXCLUDED_UNITS)) \
        .select("hadm_id", "first_careunit", "los")


_COHORT_COLS = ("subject_id, hadm_id, icustay_id, admittime, admission_type, hospital_expire_flag, "
                "prolonged_los, icu_los_days, first_careunit, icu_intime, gender, age")


@register("cohort", _with(roles.SQL_ROLES) + f"SELECT {_COHORT_COLS} FROM cohort")
def q_cohort(spark, root):
    return roles.cohort(spark, root)


@register("age_years", _with(roles.SQL_PATIENTS, roles.SQL_ADMISSIONS) + """
SELECT a.hadm_id, a.subject_id,
       CAST(year(CAST(a.admittime AS DATE)) - year(p.dob) AS INTEGER) AS age
FROM admissions a JOIN patients p ON a.subject_id = p.subject_id""")
def q_age_years(spark, root):
    a, p = roles.admissions(spark, root), roles.patients(spark, root)
    return a.join(p, "subject_id").select("hadm_id", "subject_id",
                                          C.age_at("admittime", "dob").alias("age"))


@register("banding", _with(roles.SQL_ROLES) + f"""
SELECT icustay_id, age, {SQL_AGE_BAND} AS age_band,
       CAST(hour(admittime) AS INTEGER) AS admit_hour, {SQL_SHIFT} AS shift,
       icu_los_days, {SQL_LOS_BAND} AS los_band
FROM cohort""")
def q_banding(spark, root):
    co = roles.cohort(spark, root)
    return co.select("icustay_id", "age", S.age_band("age").alias("age_band"),
                     F.hour("admittime").alias("admit_hour"),
                     S.shift_band(F.hour("admittime")).alias("shift"),
                     "icu_los_days", S.los_band("icu_los_days").alias("los_band"))


def _sql_outcome(keys: str, src: str = "cohort", prolonged: bool = False, median: bool = False,
                 where: str | None = None) -> str:
    cols = [keys, "count(icustay_id) AS total_patients",
            "CAST(coalesce(sum(hospital_expire_flag), 0) AS BIGINT) AS deaths",
            f"{sql_r('avg(icu_los_days)', 2)} AS mean_los"]
    if median:
        cols.append(f"{sql_r('median(icu_los_days)', 2)} AS median_los")
    if prolonged:
        cols.append(f"{sql_r('avg(prolonged_los) * 100.0', 1)} AS pct_prolonged")
    cols.append(f"{sql_r('CAST(sum(hospital_expire_flag) AS DOUBLE) / count(icustay_id) * 100.0', 1)}"
                " AS mortality_rate_pct")
    nn = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    w = f"WHERE {nn}" + (f" AND {where}" if where else "")
    return f"SELECT {', '.join(cols)} FROM {src} {w} GROUP BY {keys}"


@register("mortality_by_age", _with(roles.SQL_ROLES) + _sql_outcome(
    "age_band", src=f"(SELECT *, {SQL_AGE_BAND} AS age_band FROM cohort) c"))
def q_mortality_by_age(spark, root):
    return R.mortality_by_age(roles.cohort(spark, root))


# ------------------------------------------------------- measurement logs ---


_LOG_BUCKETS = 16               # of the test tables' log; some 100 MB a bucket on real ones
VITAL_NAMES = list(dict.fromkeys(roles.VITAL_CODES.values()))
LAB_NAMES = list(dict.fromkeys(roles.LAB_CODES.values()))
VITAL_FEATURES = EV.feature_names(VITAL_NAMES)
LAB_FEATURES = EV.feature_names(LAB_NAMES)
FEATURES = VITAL_FEATURES + LAB_FEATURES + ["pulse_pressure"]


def _in_list(codes) -> str:
    return ", ".join(f"'{c}'" for c in codes)


_VITAL_FILTER = (f"m.itemid IN ({_in_list(roles.VITAL_CODES)}) AND m.valuenum IS NOT NULL "
                 "AND m.valuenum > 0 AND m.error IS DISTINCT FROM 1")
_LAB_FILTER = (f"m.itemid IN ({_in_list(roles.LAB_CODES)}) AND m.valuenum IS NOT NULL "
               "AND m.valuenum > 0")


def _sql_window(anchor_key: str, hours: int = 24) -> str:
    a = roles.SQL_ANCHOR.format(key=anchor_key)
    return f"m.charttime BETWEEN {a} AND {a} + INTERVAL {hours} HOUR"


def vitals(spark, root, anchors=None, window_hours=24):
    """Chart measurements passing the plausibility filters, windowed on the
    stay anchor (all stays when ``anchors`` is None)."""
    m = EV.filter_measurements(roles.measurements(spark, root, roles.VITAL_CODES), roles.VITAL_CODES,
                               error_col="error")
    a = anchors if anchors is not None else roles.stay_anchors(spark, root)
    return EV.window_join(m.drop("hadm_id"), a, "icustay_id", "icustay_id",
                          window_hours=window_hours)


def labs(spark, root, anchors, window_hours=24):
    """Lab measurements joined by episode to the anchor stays, windowed on
    the stay's anchor time; the stay id comes from the anchor."""
    m = EV.filter_measurements(roles.measurements(spark, root, roles.LAB_CODES), roles.LAB_CODES)
    return EV.window_join(m.drop("icustay_id"), anchors, "hadm_id", "hadm_id",
                          window_hours=window_hours, anchor_cols=["icustay_id"])


@register("null_safe_filter", _with(roles.SQL_MEASUREMENTS) + """
SELECT event_id, itemid, error FROM measurements WHERE error IS DISTINCT FROM 1""")
def q_null_safe_filter(spark, root):
    m = roles.measurements(spark, root)
    return EV.filter_measurements(m, error_col="error", positive_only=False) \
        .select("event_id", "itemid", "error")


@register("window_events_by_stay", _with(roles.SQL_MEASUREMENTS) + f"""
SELECT m.icustay_id, m.itemid, m.charttime, m.valuenum
FROM measurements m JOIN orders o ON m.icustay_id = o.o_orderkey
WHERE {_VITAL_FILTER} AND {_sql_window('o.o_orderkey')}""")
def q_window_events_by_stay(spark, root):
    return vitals(spark, root).select("icustay_id", "itemid", "charttime", "valuenum")


@register("window_events_by_episode", _with(roles.SQL_ROLES, roles.SQL_MEASUREMENTS) + f"""
SELECT c.icustay_id, m.itemid, m.charttime, m.valuenum
FROM measurements m JOIN cohort c ON m.hadm_id = c.hadm_id
WHERE {_LAB_FILTER} AND {_sql_window('c.icustay_id')}""")
def q_window_events_by_episode(spark, root):
    anchors = roles.cohort_anchors(roles.cohort(spark, root))
    return labs(spark, root, anchors).select("icustay_id", "itemid", "charttime", "valuenum")


@register("time_bucket_join", ORACLE["window_events_by_episode"])
def q_time_bucket_join(spark, root):
    """Labs in their stays' first day, joined by episode and time bucket."""
    m = EV.filter_measurements(roles.measurements(spark, root, roles.LAB_CODES), roles.LAB_CODES)
    out = EV.window_join_by_time(m.drop("icustay_id"), roles.cohort_anchors(roles.cohort(spark, root)),
                                 "hadm_id", "hadm_id", anchor_cols=["icustay_id"])
    return out.select("icustay_id", "itemid", "charttime", "valuenum")


@register("laid_out_window_join", ORACLE["window_events_by_stay"])
def q_laid_out_window_join(spark, root):
    """Vitals of a log that is laid out by stay, joined without shuffling it."""
    m = EV.filter_measurements(roles.measurements(spark, root, roles.VITAL_CODES), roles.VITAL_CODES, error_col="error")
    log = lay_out(m.drop("hadm_id"), "icustay_id", _LOG_BUCKETS, ["itemid"], name="vitals_log")
    out = EV.window_join(log, roles.stay_anchors(spark, root), "icustay_id", "icustay_id")
    return out.select("icustay_id", "itemid", "charttime", "valuenum")


@register("cohort_semi_join", _with(roles.SQL_ROLES, roles.SQL_MEASUREMENTS) + f"""
SELECT m.icustay_id, m.itemid, m.valuenum FROM measurements m
WHERE m.icustay_id IN (SELECT icustay_id FROM cohort) AND {_VITAL_FILTER}""")
def q_cohort_semi_join(spark, root):
    m = EV.filter_measurements(roles.measurements(spark, root, roles.VITAL_CODES), roles.VITAL_CODES,
                               error_col="error")
    return EV.restrict_to(m, roles.cohort(spark, root), "icustay_id", "icustay_id") \
        .select("icustay_id", "itemid", "valuenum")


@register("code_lookup", _with(roles.SQL_MEASUREMENTS) + f"""
SELECT event_id, itemid, {roles.sql_vital_name('itemid')} AS item_name FROM measurements""")
def q_code_lookup(spark, root):
    m = roles.measurements(spark, root)
    return EV.name_items(m, roles.VITAL_CODES).select("event_id", "itemid", "item_name")


@register("long_stats", _with(roles.SQL_MEASUREMENTS) + f"""
SELECT icustay_id, item_name, min(valuenum) AS min, max(valuenum) AS max,
       {sql_r('avg(valuenum)', 6)} AS mean
FROM (SELECT m.icustay_id, {roles.sql_vital_name('m.itemid')} AS item_name, m.valuenum
      FROM measurements m JOIN orders o ON m.icustay_id = o.o_orderkey
      WHERE {_VITAL_FILTER} AND {_sql_window('o.o_orderkey')}) v
GROUP BY icustay_id, item_name""")
def q_long_stats(spark, root):
    v = EV.name_items(vitals(spark, root), roles.VITAL_CODES)
    return ST.rounded(EV.long_stats(v, "icustay_id"), ["mean"])


def _sql_wide(src: str, names, key: str = "icustay_id") -> str:
    cols = []
    for s, fn in (("min", "min"), ("max", "max"), ("mean", "avg")):
        for n in names:
            e = f"{fn}(CASE WHEN item_name = '{n}' THEN valuenum END)"
            cols.append(f"{sql_r(e, 6) if s == 'mean' else e} AS {s}_{n}")
    return f"SELECT {key}, {', '.join(cols)} FROM {src} GROUP BY {key}"


_SQL_VITALS_NAMED = f"""(SELECT m.icustay_id, {roles.sql_vital_name('m.itemid')} AS item_name, m.valuenum
      FROM measurements m JOIN orders o ON m.icustay_id = o.o_orderkey
      WHERE {_VITAL_FILTER} AND {_sql_window('o.o_orderkey')}) v"""


@register("wide_stats", _with(roles.SQL_MEASUREMENTS) + _sql_wide(_SQL_VITALS_NAMED, VITAL_NAMES))
def q_wide_stats(spark, root):
    v = EV.name_items(vitals(spark, root), roles.VITAL_CODES)
    w = EV.wide_stats(v, "icustay_id", VITAL_NAMES)
    return ST.rounded(w, [f"mean_{n}" for n in VITAL_NAMES])


@register("measurement_union", _with(roles.SQL_ROLES, roles.SQL_MEASUREMENTS) + f"""
SELECT m.icustay_id, m.itemid, m.charttime, m.valuenum, 'vitals' AS source
FROM measurements m JOIN cohort c ON m.icustay_id = c.icustay_id
WHERE {_VITAL_FILTER} AND {_sql_window('c.icustay_id')}
UNION ALL
SELECT c.icustay_id, m.itemid, m.charttime, m.valuenum, 'labs' AS source
FROM measurements m JOIN cohort c ON m.hadm_id = c.hadm_id
WHERE {_LAB_FILTER} AND {_sql_window('c.icustay_id')}""")
def q_measurement_union(spark, root):
    anchors = roles.cohort_anchors(roles.cohort(spark, root))   # read by both branches
    cols = ["icustay_id", "itemid", "charttime", "valuenum"]
    v = vitals(spark, root, anchors).select(*cols, F.lit("vitals").alias("source"))
    lb = labs(spark, root, anchors).select(*cols, F.lit("labs").alias("source"))
    return EV.union_measurements(v, lb)


# ------------------------------------------------------ master / imputation ---

def master(spark, root, window_hours=24, materialize: bool = False):
    """Cohort + first-window vitals and labs (wide) + engineered columns.
    ``materialize`` writes the result for callers that make several passes
    over it; otherwise nothing runs before the query does."""
    co = roles.cohort(spark, root)
    meas = roles.measurements(spark, root)
    m = stages.build_master(co, meas, meas, roles.VITAL_CODES, roles.LAB_CODES,
                     anchors=roles.cohort_anchors(co), window_hours=window_hours,
                     male_value="M", emergency_value=roles.EMERGENCY_TYPE)
    return stored(m, "master") if materialize else m


_ENGINEERED = ["gender_enc", "emergency_admission", "weekend_admission", "night_admission"]
_MASTER_COLS = (_COHORT_COLS.split(", ") + _ENGINEERED + ["age_band"] + FEATURES)

_SQL_VIT_C = f"""(SELECT m.icustay_id, {roles.sql_vital_name('m.itemid')} AS item_name, m.valuenum
   FROM measurements m JOIN cohort c ON m.icustay_id = c.icustay_id
   WHERE {_VITAL_FILTER} AND {_sql_window('c.icustay_id')}) v"""
_SQL_LAB_C = f"""(SELECT c.icustay_id, {roles.sql_lab_name('m.itemid')} AS item_name, m.valuenum
   FROM measurements m JOIN cohort c ON m.hadm_id = c.hadm_id
   WHERE {_LAB_FILTER} AND {_sql_window('c.icustay_id')}) l"""


def _raw_wide(src: str, names) -> str:
    cols = [f"{fn}(CASE WHEN item_name = '{n}' THEN valuenum END) AS {s}_{n}"
            for s, fn in (("min", "min"), ("max", "max"), ("mean", "avg")) for n in names]
    return f"SELECT icustay_id, {', '.join(cols)} FROM {src} GROUP BY icustay_id"


_SQL_MASTER = _with(roles.SQL_ROLES, roles.SQL_MEASUREMENTS, f"vit_w AS ({_raw_wide(_SQL_VIT_C, VITAL_NAMES)})",
                    f"lab_w AS ({_raw_wide(_SQL_LAB_C, LAB_NAMES)})",
                    f"""master AS (
  SELECT c.*, {', '.join('v.' + f for f in VITAL_FEATURES)}, {', '.join('l.' + f for f in LAB_FEATURES)},
         CASE WHEN c.gender = 'M' THEN 1 ELSE 0 END AS gender_enc,
         CASE WHEN c.admission_type = '{roles.EMERGENCY_TYPE}' THEN 1 ELSE 0 END AS emergency_admission,
         CASE WHEN isodow(c.admittime) IN (6, 7) THEN 1 ELSE 0 END AS weekend_admission,
         CASE WHEN hour(c.admittime) BETWEEN 0 AND 7 THEN 1 ELSE 0 END AS night_admission,
         {SQL_AGE_BAND.replace('age', 'c.age')} AS age_band,
         v.mean_sbp - v.mean_dbp AS pulse_pressure
  FROM cohort c LEFT JOIN vit_w v ON c.icustay_id = v.icustay_id
  LEFT JOIN lab_w l ON c.icustay_id = l.icustay_id)""")

_NON_EXACT = [f for f in FEATURES if f.startswith("mean_")] + ["pulse_pressure"]


def _sql_cols(cols, round6=()) -> str:
    return ", ".join(f"{sql_r(c, 6)} AS {c}" if c in round6 else c for c in cols)


@register("master_features", _SQL_MASTER + f"SELECT {_sql_cols(_MASTER_COLS, _NON_EXACT)} FROM master")
def q_master_features(spark, root):
    return ST.rounded(master(spark, root).select(*_MASTER_COLS), _NON_EXACT)


@register("derived_difference", _SQL_MASTER + f"""
SELECT icustay_id, {sql_r('mean_sbp', 6)} AS mean_sbp, {sql_r('mean_dbp', 6)} AS mean_dbp,
       {sql_r('pulse_pressure', 6)} AS pulse_pressure FROM master""")
def q_derived_difference(spark, root):
    return ST.rounded(master(spark, root).select("icustay_id", "mean_sbp", "mean_dbp",
                                                 "pulse_pressure"),
                      ["mean_sbp", "mean_dbp", "pulse_pressure"])


def _sql_unpivot_stat(stat_sql: str, alias: str, cols=FEATURES) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, {stat_sql.format(c=c)} AS {alias} FROM master"
                                for c in cols)


@register("feature_medians", _SQL_MASTER + _sql_unpivot_stat(sql_r("median({c})", 6), "median"))
def q_feature_medians(spark, root):
    return ST.rounded(ST.column_medians(master(spark, root, materialize=True), FEATURES),
                      ["median"])


_SQL_MISSING = _sql_unpivot_stat("avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)", "missing_frac")


@register("missing_summary", _SQL_MASTER + _SQL_MISSING)
def q_missing_summary(spark, root):
    return ST.missing_summary(master(spark, root), FEATURES)


@register("missing_top10", _SQL_MASTER + f"""
SELECT feature, missing_frac FROM ({_SQL_MISSING}) t ORDER BY missing_frac DESC, feature LIMIT 10""")
def q_missing_top10(spark, root):
    return ST.missing_summary(master(spark, root), FEATURES) \
        .orderBy(F.desc("missing_frac"), "feature").limit(10)


@register("percent_format", _SQL_MASTER + f"""
SELECT feature, printf('%.1f%%', {sql_r('missing_frac * 100.0', 1)}) AS missing_pct
FROM ({_SQL_MISSING}) t""")
def q_percent_format(spark, root):
    return ST.missing_summary(master(spark, root), FEATURES) \
        .select("feature", S.percent_text("missing_frac").alias("missing_pct"))


@register("null_total", _SQL_MASTER + "SELECT CAST(" + " + ".join(
    f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in FEATURES) + " AS BIGINT) AS null_total FROM master")
def q_null_total(spark, root):
    return ST.null_total(master(spark, root), FEATURES)


@register("missing_flags", _SQL_MASTER + "SELECT icustay_id, " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_missing" for c in FEATURES) + " FROM master")
def q_missing_flags(spark, root):
    m = master(spark, root)
    return ST.missing_flags(m, FEATURES).select("icustay_id", *[f"{c}_missing" for c in FEATURES])


@register("median_impute", _SQL_MASTER + "SELECT icustay_id, " + ", ".join(
    f"{sql_r(f'coalesce({c}, (SELECT median({c}) FROM master))', 6)} AS {c}" for c in FEATURES)
    + " FROM master")
def q_median_impute(spark, root):
    m = master(spark, root, materialize=True).select("icustay_id", *FEATURES)
    return ST.rounded(ST.impute_median(m, FEATURES), FEATURES)


def _sql_replace_chain(col: str, rules) -> str:
    for old, new in rules:
        col = f"replace({col}, '{old}', '{new}')"
    return col


@register("feature_labels", _SQL_MASTER + f"""
SELECT feature, missing_frac,
  array_to_string(list_transform(string_split(
    {_sql_replace_chain('feature', S.REPORT_LABEL_REPLACEMENTS)},
    ' '), lambda w: upper(w[1:1]) || lower(w[2:])), ' ') AS feature_label,
  {_sql_replace_chain('feature', S.MODEL_LABEL_REPLACEMENTS)} AS model_label
FROM ({_SQL_MISSING}) t""")
def q_feature_labels(spark, root):
    ms = ST.missing_summary(master(spark, root), FEATURES)
    return ms.select("feature", "missing_frac",
                     S.feature_label("feature").alias("feature_label"),
                     S.feature_label("feature", report_style=False).alias("model_label"))


_SQL_INVENTORY = [(c, "feature" if c in FEATURES else "model input" if c in ("age", *_ENGINEERED) else
                   "id or outcome" if c in MD.ID_AND_OUTCOME_COLS else "not numeric") for c in _MASTER_COLS]


@register("column_inventory", _SQL_MASTER + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{role}' AS role, count({c}) AS "values" FROM master""" for c, role in _SQL_INVENTORY))
def q_column_inventory(spark, root):
    """What becomes of every column of the master table: features are chosen by
    name prefix, ids and outcomes are dropped, other numeric columns are model
    inputs; with the number of values of each."""
    m = stored(master(spark, root).select(*_MASTER_COLS), "master")
    feats = stages.feature_columns(m)
    keep, dropped = MD.model_features(m)
    role = {**{c: "id or outcome" for c in m.columns if c in MD.ID_AND_OUTCOME_COLS},
            **{c: "not numeric" for c in dropped}, **{c: "model input" for c in keep}, **{c: "feature" for c in feats}}
    counts = m.agg(*[F.count(c).alias(c) for c in m.columns]).unpivot([], m.columns, "column", "values")
    return counts.select("column", F.create_map(*[F.lit(x) for c in m.columns for x in (c, role[c])])[F.col("column")].alias("role"),
                         "values")


@register("inline_dictionary", _with(roles.SQL_MEASUREMENTS) + f"""
, dict AS (SELECT * FROM (VALUES {', '.join(f"('{k}', '{v}', 'vital')" for k, v in roles.VITAL_CODES.items())},
  {', '.join(f"('{k}', '{v}', 'lab')" for k, v in roles.LAB_CODES.items())}) t(itemid, item_name, kind))
SELECT item_name, kind, count(event_id) AS n, min(valuenum) AS least, max(valuenum) AS most
FROM dict LEFT JOIN measurements USING (itemid) GROUP BY item_name, kind""")
def q_inline_dictionary(spark, root):
    """The item dictionary as an inline array of structs, opened as a relation
    and joined to the measurement log."""
    rows = [(k, v, "vital") for k, v in roles.VITAL_CODES.items()] + [(k, v, "lab") for k, v in roles.LAB_CODES.items()]
    d = inline_relation(spark, rows, "itemid string, item_name string, kind string")
    return (d.join(roles.measurements(spark, root), "itemid", "left").groupBy("item_name", "kind")
            .agg(F.count("event_id").alias("n"), F.min("valuenum").alias("least"), F.max("valuenum").alias("most")))


@register("reported_importances", _SQL_MASTER + f"""
, rep AS (SELECT * FROM (VALUES {', '.join(f"('{f}', {v}::DOUBLE, '{c}')" for f, v, c in S.REPORTED_IMPORTANCES)}) t(feature, importance, category)),
have AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, count({f}) AS stays_with_value FROM master" for f, _, _ in S.REPORTED_IMPORTANCES)})
SELECT feature, importance, category, {sql_r('importance / sum(importance) OVER () * 100.0', 1)} AS importance_pct,
  array_to_string(list_transform(string_split({_sql_replace_chain('feature', S.REPORT_LABEL_REPLACEMENTS)}, ' '),
                  lambda w: upper(w[1:1]) || lower(w[2:])), ' ') AS feature_label, stays_with_value
FROM rep JOIN have USING (feature)""")
def q_reported_importances(spark, root):
    """The reported importances, a literal table, beside the number of stays
    that have a value of each feature."""
    rep = literal_table(spark, S.REPORTED_IMPORTANCES, "feature string, importance double, category string")
    m, names = master(spark, root), [f for f, _, _ in S.REPORTED_IMPORTANCES]
    have = m.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "stays_with_value")
    out = R.share_of_total(rep, "feature", "importance").withColumn("feature_label", S.feature_label("feature"))
    return out.join(have, "feature")


# ---------------------------------------------------------------- reports ---

@register("mortality_by_admtype", _with(roles.SQL_ROLES) + _sql_outcome(
    "admission_type", prolonged=True))
def q_mortality_by_admtype(spark, root):
    return R.mortality_by_admtype(roles.cohort(spark, root))


@register("los_by_careunit", _with(roles.SQL_ROLES) + _sql_outcome(
    "first_careunit", prolonged=True, median=True))
def q_los_by_careunit(spark, root):
    return R.los_by_careunit(roles.cohort(spark, root))


@register("weekend_effect", _with(roles.SQL_ROLES) + "SELECT *, CASE weekend_admission WHEN 0 THEN "
          "'Weekday' WHEN 1 THEN 'Weekend' END AS day_type FROM (" + _sql_outcome(
              "admit_dow, weekend_admission",
              src=f"(SELECT *, dayname(admittime) AS admit_dow, {SQL_WEEKEND} AS weekend_admission "
                  "FROM cohort) c") + ") t")
def q_weekend_effect(spark, root):
    return R.weekend_effect(roles.cohort(spark, root))


@register("shift_analysis", _with(roles.SQL_ROLES) + _sql_outcome(
    "shift", src=f"(SELECT *, {SQL_SHIFT} AS shift FROM cohort) c"))
def q_shift_analysis(spark, root):
    return R.shift_analysis(roles.cohort(spark, root))


_SQL_AUC = f"""auc_g AS (SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
                    sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
             FROM scored WHERE label IS NOT NULL AND score IS NOT NULL GROUP BY score),
auc_c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                            AND 1 PRECEDING), 0) AS neg_below FROM auc_g),
auc AS (SELECT CASE WHEN sum(pos) * sum(neg) > 0 THEN
          sum(CAST(pos AS DOUBLE) * (CAST(neg_below AS DOUBLE) + 0.5 * CAST(neg AS DOUBLE)))
          / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS roc_auc FROM auc_c)"""


@register("cohort_overview", _with(roles.SQL_ROLES) + """
SELECT count(*) AS n_admissions, avg(hospital_expire_flag) AS mortality_rate,
       avg(prolonged_los) AS prolonged_rate, min(age) AS age_min, max(age) AS age_max FROM cohort""")
def q_cohort_overview(spark, root):
    return R.cohort_overview(roles.cohort(spark, root))


@register("mortality_rate_by", _with(roles.SQL_ROLES) + f"""
SELECT 'age_band' AS dimension, age_band AS category, count(*) AS n,
       avg(hospital_expire_flag) * 100.0 AS rate_pct
FROM (SELECT *, {SQL_AGE_BAND} AS age_band FROM cohort) c WHERE age_band IS NOT NULL GROUP BY age_band
UNION ALL
SELECT 'admission_type', admission_type, count(*), avg(hospital_expire_flag) * 100.0
FROM cohort WHERE admission_type IS NOT NULL GROUP BY admission_type""")
def q_mortality_rate_by(spark, root):
    co = roles.cohort(spark, root).withColumn("age_band", S.age_band())   # two groupings
    return R.rate_by(co, ["age_band", "admission_type"])


@register("los_by_weekend", _with(roles.SQL_ROLES) + f"""
SELECT weekend_admission, avg(icu_los_days) AS mean_los
FROM (SELECT *, {SQL_WEEKEND} AS weekend_admission FROM cohort) c GROUP BY weekend_admission""")
def q_los_by_weekend(spark, root):
    co = roles.cohort(spark, root).withColumn("weekend_admission", S.weekend_flag("admittime"))
    return R.mean_by(co, "weekend_admission", "icu_los_days", "mean_los")


@register("los_histogram", _with(roles.SQL_ROLES) + """,
x AS (SELECT CASE WHEN icu_los_days IS NULL THEN NULL ELSE least(icu_los_days, 30.0) END AS x
      FROM cohort),
r AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
      FROM x WHERE x IS NOT NULL AND NOT isnan(x)),
i0 AS (SELECT x.x, r.lo, r.hi, (r.hi - r.lo) / 40 AS step,
              least(CAST(floor((x.x - r.lo) * (40 / (r.hi - r.lo))) AS INTEGER), 39) AS b0
       FROM x, r WHERE x.x IS NOT NULL AND NOT isnan(x.x)),
i AS (SELECT CASE WHEN x < CAST(b0 AS DOUBLE) * step + lo THEN b0 - 1
                  WHEN b0 <> 39 AND x >= CAST(b0 + 1 AS DOUBLE) * step + lo THEN b0 + 1
                  ELSE b0 END AS bin FROM i0),
c AS (SELECT bin, count(*) AS cnt FROM i GROUP BY bin)
SELECT CAST(g.bin AS INTEGER) AS bin, CAST(g.bin AS DOUBLE) * ((r.hi - r.lo) / 40) + r.lo AS bin_lo,
       CAST(g.bin + 1 AS DOUBLE) * ((r.hi - r.lo) / 40) + r.lo AS bin_hi,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM range(40) g(bin) CROSS JOIN r LEFT JOIN c ON c.bin = g.bin""".replace("WITH ", "WITH ", 1))
def q_los_histogram(spark, root):
    # two passes (range, then counts) over the cohort: read it materialised
    return ST.histogram(roles.cohort(spark, root), "icu_los_days", bins=40, clip=30.0)


_UNITS = ["A", "R"]


@register("age_unit_heatmap", _with(roles.SQL_ROLES) + "SELECT age_band, " + ", ".join(
    f"{sql_r(f'avg(CASE WHEN first_careunit = {chr(39)}{u}{chr(39)} THEN hospital_expire_flag END) * 100.0', 1)} AS {u}"
    for u in _UNITS) + f"""
FROM (SELECT *, {SQL_AGE_BAND} AS age_band FROM cohort) c WHERE age_band IS NOT NULL GROUP BY age_band""")
def q_age_unit_heatmap(spark, root):
    co = roles.cohort(spark, root).withColumn("age_band", S.age_band())
    return R.heatmap(co, "age_band", "first_careunit", _UNITS)


@register("relative_risk", _with(roles.SQL_ROLES) + f"""
SELECT avg(CASE WHEN admission_type = '{roles.EMERGENCY_TYPE}' THEN hospital_expire_flag END) * 100.0
         AS exposed_rate_pct,
       avg(CASE WHEN admission_type = '{roles.ELECTIVE_TYPE}' THEN hospital_expire_flag END) * 100.0
         AS reference_rate_pct,
       avg(CASE WHEN admission_type = '{roles.EMERGENCY_TYPE}' THEN hospital_expire_flag END)
       / avg(CASE WHEN admission_type = '{roles.ELECTIVE_TYPE}' THEN hospital_expire_flag END)
         AS relative_risk
FROM cohort""")
def q_relative_risk(spark, root):
    return R.relative_risk(roles.cohort(spark, root), "admission_type", roles.EMERGENCY_TYPE,
                           roles.ELECTIVE_TYPE)


@register("outcome_gap", _with(roles.SQL_ROLES) + f"""
SELECT we AS weekend_mortality_pct, wd AS weekday_mortality_pct, we - wd AS gap_pp,
       nl AS night_mean_los, dl AS day_mean_los, nl / dl AS night_day_los_ratio FROM (
  SELECT avg(CASE WHEN {SQL_WEEKEND} = 1 THEN hospital_expire_flag END) * 100.0 AS we,
         avg(CASE WHEN {SQL_WEEKEND} = 0 THEN hospital_expire_flag END) * 100.0 AS wd,
         avg(CASE WHEN {SQL_SHIFT} = '{S.SHIFT_LABELS[0]}' THEN icu_los_days END) AS nl,
         avg(CASE WHEN {SQL_SHIFT} = '{S.SHIFT_LABELS[1]}' THEN icu_los_days END) AS dl
  FROM cohort) t""")
def q_outcome_gap(spark, root):
    return R.outcome_gap(roles.cohort(spark, root))


@register("share_of_total", _with(roles.SQL_MEASUREMENTS) + f"""
SELECT itemid, n, {sql_r('n / sum(n) OVER () * 100.0', 1)} AS n_pct
FROM (SELECT itemid, count(*) AS n FROM measurements GROUP BY itemid) t""")
def q_share_of_total(spark, root):
    counts = roles.measurements(spark, root).groupBy("itemid").agg(F.count(F.lit(1)).alias("n"))
    return R.share_of_total(counts, "itemid", "n")


@register("calendar_features", _with(roles.SQL_MEASUREMENTS) + f"""
SELECT CAST(isodow(charttime) - 1 AS INTEGER) AS weekday,
       CASE WHEN isodow(charttime) IN (6, 7) THEN 1 ELSE 0 END AS weekend,
       dayname(charttime) AS day_name,
       {sql_band('CAST(hour(charttime) AS INTEGER)', S.SHIFT_EDGES, S.SHIFT_LABELS)} AS shift,
       CASE WHEN hour(charttime) BETWEEN 0 AND 7 THEN 1 ELSE 0 END AS night,
       strftime(charttime, '%Y-%m') AS month, CAST(year(charttime) AS INTEGER) AS year,
       count(*) AS n
FROM measurements GROUP BY ALL""")
def q_calendar_features(spark, root):
    t = F.col("charttime")
    m = roles.measurements(spark, root)
    return m.groupBy(S.weekday0(t).alias("weekday"), S.weekend_flag(t).alias("weekend"),
                     S.day_name(t).alias("day_name"), S.shift_band(F.hour(t)).alias("shift"),
                     S.night_flag(t).alias("night"), S.month_text(t).alias("month"),
                     F.year(t).alias("year")).agg(F.count(F.lit(1)).alias("n"))


@register("encoded_flags", _with(roles.SQL_ROLES) + f"""
SELECT icustay_id, CASE WHEN gender = 'M' THEN 1 ELSE 0 END AS gender_enc,
       CASE WHEN admission_type = '{roles.EMERGENCY_TYPE}' THEN 1 ELSE 0 END AS emergency_admission,
       {SQL_WEEKEND} AS weekend_admission, {SQL_NIGHT} AS night_admission
FROM cohort""")
def q_encoded_flags(spark, root):
    co = C.add_engineered(roles.cohort(spark, root), emergency_value=roles.EMERGENCY_TYPE)
    return co.select("icustay_id", "gender_enc", "emergency_admission", "weekend_admission",
                     "night_admission")


@register("half_even_round", _with(roles.SQL_MEASUREMENTS) + f"""
SELECT event_id, valuenum, {sql_r('valuenum', 1)} AS value_1dp,
       {sql_r('valuenum / 8.0', 2)} AS eighth_2dp FROM measurements""")
def q_half_even_round(spark, root):
    m = roles.measurements(spark, root)
    return m.select("event_id", "valuenum", S.round_half_even("valuenum", 1).alias("value_1dp"),
                    S.round_half_even(F.col("valuenum") / 8.0, 2).alias("eighth_2dp"))


@register("threshold_alert", _with(roles.SQL_ROLES, roles.SQL_MEASUREMENTS) + f""",
hits AS (
  SELECT c.icustay_id, count(*) AS n_breaches, min(m.charttime) AS first_breach
  FROM measurements m JOIN cohort c ON m.hadm_id = c.hadm_id
  WHERE {_LAB_FILTER} AND {_sql_window('c.icustay_id', S.ALERT_WINDOW_HOURS)}
    AND (""" + " OR ".join(
    f"({roles.sql_lab_name('m.itemid')} = '{n}' AND m.valuenum > {float(t)})"
    for n, t in roles.ROLE_ALERT_THRESHOLDS.items()) + """)
  GROUP BY c.icustay_id)
SELECT c.icustay_id, CASE WHEN h.n_breaches > 0 THEN 1 ELSE 0 END AS alert,
       coalesce(h.n_breaches, 0) AS n_breaches, h.first_breach
FROM cohort c LEFT JOIN hits h ON c.icustay_id = h.icustay_id""")
def q_threshold_alert(spark, root):
    co = roles.cohort(spark, root)        # anchors and the left-join base
    anchors = roles.cohort_anchors(co)
    m = EV.filter_measurements(roles.measurements(spark, root, roles.LAB_CODES), roles.LAB_CODES)
    m = EV.name_items(m, roles.LAB_CODES)
    return EV.threshold_alert(m, anchors, "hadm_id", "hadm_id", roles.ROLE_ALERT_THRESHOLDS,
                              out_key="icustay_id")


@register("patient_level", _SQL_MASTER + f"""
SELECT icustay_id, age, age_band, gender, admission_type, first_careunit, hospital_expire_flag,
       prolonged_los, icu_los_days, weekend_admission, night_admission, emergency_admission,
       CAST(hour(admittime) AS INTEGER) AS admit_hour, dayname(admittime) AS admit_dow,
       strftime(admittime, '%Y-%m') AS admit_month, CAST(year(admittime) AS INTEGER) AS admit_year,
       {SQL_SHIFT} AS shift, {SQL_LOS_BAND} AS los_band,
       {sql_r('mean_heart_rate', 6)} AS mean_heart_rate, {sql_r('mean_sbp', 6)} AS mean_sbp,
       {sql_r('mean_spo2', 6)} AS mean_spo2, {sql_r('mean_creatinine', 6)} AS mean_creatinine,
       {sql_r('mean_lactate', 6)} AS mean_lactate, {sql_r('mean_wbc', 6)} AS mean_wbc
FROM master""")
def q_patient_level(spark, root):
    pl = R.patient_level(master(spark, root))
    return ST.rounded(pl, [c for c in pl.columns if c.startswith("mean_")])


# ---------------------------------------------------------------- metrics ---

_SQL_CUM = """cum_g AS (SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
                     sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
              FROM scored WHERE label IS NOT NULL AND score IS NOT NULL GROUP BY score),
cum AS (SELECT score, pos, neg,
          sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
          sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
          sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM cum_g)"""


@register("roc_auc", _with(roles.SQL_SCORED, _SQL_AUC) + "SELECT roc_auc FROM auc")
def q_roc_auc(spark, root):
    return M.roc_auc(roles.scored_rows(spark, root))


@register("average_precision", _with(roles.SQL_SCORED, _SQL_CUM) + f"""
SELECT CASE WHEN max(P) > 0 THEN {sql_r('sum(CAST(pos AS DOUBLE) / CAST(P AS DOUBLE) * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)))', 9)} END
       AS average_precision FROM cum""")
def q_average_precision(spark, root):
    return ST.rounded(M.average_precision(roles.scored_rows(spark, root)), ["average_precision"], 9)


@register("roc_points", _with(roles.SQL_SCORED, _SQL_CUM) + """
SELECT score AS threshold, CASE WHEN N > 0 THEN CAST(fp AS DOUBLE) / CAST(N AS DOUBLE) END AS fpr,
       CASE WHEN P > 0 THEN CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) END AS tpr FROM cum
UNION ALL
SELECT 'inf'::DOUBLE, CASE WHEN sum(neg) > 0 THEN 0.0 END, CASE WHEN sum(pos) > 0 THEN 0.0 END FROM cum_g""")
def q_roc_points(spark, root):
    return M.roc_points(roles.scored_rows(spark, root))


@register("pr_points", _with(roles.SQL_SCORED, _SQL_CUM) + """
SELECT score AS threshold, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
       CASE WHEN P > 0 THEN CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) ELSE 1.0 END AS recall,
       CAST(P AS DOUBLE) / CAST(P + N AS DOUBLE) AS baseline FROM cum
UNION ALL
SELECT NULL, 1.0, 0.0, CAST(sum(pos) AS DOUBLE) / CAST(sum(pos) + sum(neg) AS DOUBLE) FROM cum_g""")
def q_pr_points(spark, root):
    return M.pr_points(roles.scored_rows(spark, root))


@register("roc_curve", _with(roles.SQL_SCORED, _SQL_CUM) + """,
cum2 AS (SELECT *, lead(pos) OVER (ORDER BY score DESC) AS pos_n,
                lead(neg) OVER (ORDER BY score DESC) AS neg_n,
                row_number() OVER (ORDER BY score DESC) AS k, count(*) OVER () AS cnt FROM cum)
SELECT score AS threshold, CASE WHEN N > 0 THEN CAST(fp AS DOUBLE) / CAST(N AS DOUBLE) END AS fpr,
       CASE WHEN P > 0 THEN CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) END AS tpr FROM cum2
WHERE k = 1 OR k = cnt OR pos <> pos_n OR neg <> neg_n
UNION ALL
SELECT 'inf'::DOUBLE, CASE WHEN sum(neg) > 0 THEN 0.0 END, CASE WHEN sum(pos) > 0 THEN 0.0 END FROM cum_g""")
def q_roc_curve(spark, root):
    """ROC curve as the analysed code draws it: corner points only."""
    return M.roc_points(roles.scored_rows(spark, root), drop_intermediate=True)


_SQL_CONF = """conf AS (SELECT
  CAST(sum(CASE WHEN label = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
  FROM scored WHERE label IS NOT NULL AND prediction IS NOT NULL)"""


@register("confusion_matrix", _with(roles.SQL_SCORED, _SQL_CONF) + """
SELECT 0 AS label, 0 AS prediction, tn AS count FROM conf UNION ALL
SELECT 0, 1, fp FROM conf UNION ALL SELECT 1, 0, fn FROM conf UNION ALL SELECT 1, 1, tp FROM conf""")
def q_confusion_matrix(spark, root):
    return M.confusion_matrix(roles.scored_rows(spark, root))


def _sd(a: str, b: str) -> str:
    return f"coalesce(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 0.0)"


_P0, _R0, _P1, _R1 = _sd("tn", "tn + fn"), _sd("tn", "tn + fp"), _sd("tp", "tp + fp"), _sd("tp", "tp + fn")


def _f1(p: str, r: str) -> str:
    return f"CASE WHEN {p} + {r} > 0 THEN 2.0 * {p} * {r} / ({p} + {r}) ELSE 0.0 END"


_W0, _W1 = _sd("tn + fp", "tn + fp + fn + tp"), _sd("fn + tp", "tn + fp + fn + tp")
_R9 = lambda e: sql_r(e, 9)


@register("classification_report", _with(roles.SQL_SCORED, _SQL_CONF) + f"""
SELECT '0' AS class, {_R9(_P0)} AS precision, {_R9(_R0)} AS recall, {_R9(_f1(_P0, _R0))} AS f1_score,
       tn + fp AS support FROM conf UNION ALL
SELECT '1', {_R9(_P1)}, {_R9(_R1)}, {_R9(_f1(_P1, _R1))}, fn + tp FROM conf UNION ALL
SELECT 'accuracy', NULL, NULL, {_R9(_sd('tn + tp', 'tn + fp + fn + tp'))}, tn + fp + fn + tp FROM conf
UNION ALL
SELECT 'macro avg', {_R9(f'({_P0} + {_P1}) / 2.0')}, {_R9(f'({_R0} + {_R1}) / 2.0')},
       {_R9(f'({_f1(_P0, _R0)} + {_f1(_P1, _R1)}) / 2.0')}, tn + fp + fn + tp FROM conf UNION ALL
SELECT 'weighted avg', {_R9(f'{_P0} * {_W0} + {_P1} * {_W1}')}, {_R9(f'{_R0} * {_W0} + {_R1} * {_W1}')},
       {_R9(f'{_f1(_P0, _R0)} * {_W0} + {_f1(_P1, _R1)} * {_W1}')}, tn + fp + fn + tp FROM conf""")
def q_classification_report(spark, root):
    rep = M.classification_report(roles.scored_rows(spark, root))
    return ST.rounded(rep, ["precision", "recall", "f1_score"], 9)


# ---------------------------------------------------------------- hand-offs ---

@register("csv_round_trip", _with(roles.SQL_ROLES) + f"""SELECT {_COHORT_COLS},
  row_number() OVER (ORDER BY admittime NULLS FIRST, icustay_id) - 1 AS position FROM cohort""")
def q_csv_round_trip(spark, root):
    """The cohort written as CSV, ordered by admission, and scanned back with
    every row's place in the files."""
    co = roles.cohort(spark, root).select(*_COHORT_COLS.split(", "))
    path = write_table(co, scratch_path(spark, "cohort-csv"), fmt="csv", sort_by=["admittime", "icustay_id"])
    return read_in_order(spark, path, co.schema)


_EXPORT_COLS = (["subject_id", "hadm_id", "icustay_id", "admittime", "hospital_expire_flag", "prolonged_los",
                 "age", "age_band", "gender", "admission_type", "first_careunit", "icu_los_days", "insurance",
                 "ethnicity", "gender_enc", "emergency_admission", "weekend_admission", "night_admission",
                 "pulse_pressure"] + VITAL_FEATURES + LAB_FEATURES)


@register("stage1_export", _SQL_MASTER + f""", filled AS (SELECT * EXCLUDE ({', '.join(FEATURES)}), 'plan-' || (hadm_id % 4) AS insurance,
  'group-' || (subject_id % 5) AS ethnicity, {', '.join(f"coalesce({c}, (SELECT median({c}) FROM master)) AS {c}" for c in FEATURES)} FROM master)
SELECT {', '.join(sql_r(c, 6) + f' AS {c}' if c in FEATURES else c for c in _EXPORT_COLS)},
  row_number() OVER (ORDER BY admittime NULLS FIRST, icustay_id) - 1 AS position FROM filled""")
def q_stage1_export(spark, root):
    """The model-ready export of stage 1: 58 columns in order, features
    imputed, rows ordered by admission, written as CSV and scanned back."""
    out = stages.cohort_stage(roles.cohort(spark, root, payer=True), roles.measurements(spark, root),
                              roles.measurements(spark, root), roles.VITAL_CODES, roles.LAB_CODES,
                              anchors=roles.cohort_anchors, emergency_value=roles.EMERGENCY_TYPE)["model_ready"]
    out = ST.rounded(out.select(*_EXPORT_COLS), FEATURES)
    path = write_table(out, scratch_path(spark, "stage1-csv"), fmt="csv", sort_by=["admittime", "icustay_id"])
    return read_in_order(spark, path, out.schema)


@register("csv_rejects", """
WITH lines AS (
  SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) AS v FROM events)
SELECT 'accepted' AS status, event_id, event_type AS itemid, CAST(t AS TIMESTAMP) AS charttime, CAST(v AS BIGINT) AS value_cents,
       CAST(NULL AS VARCHAR) AS text
FROM lines WHERE event_id % 7 NOT IN (0, 1, 2) OR v IS NULL AND event_id % 7 = 0
UNION ALL SELECT 'rejected', NULL, NULL, NULL, NULL,
       CASE event_id % 7 WHEN 0 THEN event_id || ',' || event_type || ',' || t || ',about ' || v
                         WHEN 1 THEN event_id || ',' || event_type || ',' || t
                         ELSE event_id || ',' || event_type || ',soon,' || coalesce(v, '') END
FROM lines WHERE event_id % 7 IN (1, 2) OR v IS NOT NULL AND event_id % 7 = 0""")
def q_csv_rejects(spark, root):
    """A measurement log that arrives as CSV with words for numbers, missing
    fields and words for times: good rows typed, bad lines set aside as text."""
    e = read_table(spark, root, "events", ["event_id", "event_type", "ts", "value"])
    v = F.floor(F.col("value") * 100).cast("long").cast("string")
    t, kind = F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("event_id") % 7
    head = F.concat_ws(",", "event_id", "event_type")
    line = (F.when(kind == 0, F.concat_ws(",", head, t, F.coalesce(F.concat(F.lit("about "), v), F.lit(""))))
            .when(kind == 1, F.concat_ws(",", head, t))
            .when(kind == 2, F.concat_ws(",", head, F.lit("soon"), F.coalesce(v, F.lit(""))))
            .otherwise(F.concat_ws(",", head, t, F.coalesce(v, F.lit("")))))
    path = scratch_path(spark, "log-csv")
    e.select(line.alias("value")).write.text(path)
    good, bad = read_csv_with_rejects(spark, path, T.StructType.fromDDL(
        "event_id long, itemid string, charttime timestamp_ntz, value_cents long"), header=False)
    return good.select(F.lit("accepted").alias("status"), "*", F.lit(None).cast("string").alias("text")).unionByName(
        bad.select(F.lit("rejected").alias("status"), "text"), allowMissingColumns=True)


_BUNDLE_LEAST = 50
_SQL_CELLS = {"mortality_by_age": "age_band", "mortality_by_admtype": "admission_type", "los_by_careunit": "first_careunit",
              "weekend_effect": "dayname(admittime)", "outcome_cells": "age_band, admission_type, first_careunit, "
              "isodow(admittime), hour(admittime)"}


@register("bundle_manifest", _with(roles.SQL_ROLES) + f", banded AS (SELECT *, {SQL_AGE_BAND} AS age_band FROM cohort)\n" + " UNION ALL ".join(
    f"""SELECT '{name}' AS "table", count_if(n >= {_BUNDLE_LEAST}) AS "rows", count_if(n < {_BUNDLE_LEAST}) AS withheld_rows,
  {_BUNDLE_LEAST}::BIGINT AS least_group FROM (SELECT count(*) AS n FROM banded WHERE age_band IS NOT NULL OR '{name}' NOT IN ('mortality_by_age', 'outcome_cells') GROUP BY {keys})"""
    for name, keys in _SQL_CELLS.items()))
def q_bundle_manifest(spark, root):
    """The reporting tables published as one bundle whose small groups are
    withheld: the manifest, counted from the published files."""
    co = stored(roles.cohort(spark, root), "cohort").withColumns(
        {"age_band": S.age_band(), "dow": S.weekday0("admittime"), "admit_hour": F.hour("admittime")})
    tables = {"mortality_by_age": R.mortality_by_age(co), "mortality_by_admtype": R.mortality_by_admtype(co),
              "los_by_careunit": R.los_by_careunit(co), "weekend_effect": R.weekend_effect(co),
              "outcome_cells": R.outcome_table(co, ["age_band", "admission_type", "first_careunit", "dow", "admit_hour"]),
              "patient_level": R.patient_level(co)}
    manifest = publish_bundle(spark, tables, scratch_path(spark, "bundles"), aggregates=list(_SQL_CELLS),
                              least_group=_BUNDLE_LEAST)
    return manifest.select("table", "rows", "withheld_rows", "least_group")


@register("text_timestamps", """
SELECT event_id, TRY_CAST(CASE WHEN event_id % 10 = 0 THEN 'at noon' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END
                          AS TIMESTAMP) AS charttime
FROM events""")
def q_text_timestamps(spark, root):
    """Charting times that arrive as text, every tenth of them malformed."""
    m = roles.measurements(spark, root)
    text = F.when(F.col("event_id") % 10 == 0, F.lit("at noon")).otherwise(
        F.date_format("charttime", "yyyy-MM-dd HH:mm:ss"))
    return parse_timestamps(m.select("event_id", text.alias("charttime")), ["charttime"])


@register("whole_stay_vitals", _with(roles.SQL_MEASUREMENTS) + f"""
SELECT icustay_id, item_name, min(valuenum) AS min, max(valuenum) AS max,
       {sql_r('avg(valuenum)', 6)} AS mean
FROM (SELECT m.icustay_id, {roles.sql_vital_name('m.itemid')} AS item_name, m.valuenum
      FROM measurements m JOIN orders o ON m.icustay_id = o.o_orderkey WHERE {_VITAL_FILTER}) v
GROUP BY icustay_id, item_name""")
def q_whole_stay_vitals(spark, root):
    """Vitals over the whole stay, without the first-day window."""
    m = EV.filter_measurements(roles.measurements(spark, root, roles.VITAL_CODES), roles.VITAL_CODES, error_col="error")
    v = EV.window_join(m.drop("hadm_id"), roles.stay_anchors(spark, root), "icustay_id", "icustay_id",
                       window_hours=None)
    return ST.rounded(EV.long_stats(EV.name_items(v, roles.VITAL_CODES), "icustay_id"), ["mean"])


# --------------------------------------------------------------- sampling ---

def _sql_rank(src: str, label: str, key: str, seed: int = 42) -> str:
    h = f"md5(CAST({key} AS VARCHAR) || '|{seed}')"
    return (f"SELECT *, ROW_NUMBER() OVER (PARTITION BY {label} ORDER BY {h} || '|' || "
            f"CAST({key} AS VARCHAR)) AS rnk, count(*) OVER (PARTITION BY {label}) AS n_c FROM {src}")


@register("stratified_split", _with(roles.SQL_SCORED) + f"""
SELECT id, label, CAST(rnk <= ceil(n_c * 0.2) AS INTEGER) AS is_test
FROM ({_sql_rank('scored', 'label', 'id')}) t""")
def q_stratified_split(spark, root):
    return SP.stratified_split(roles.scored_rows(spark, root), "label", "id") \
        .select("id", "label", "is_test")


@register("grouped_split", _with(roles.SQL_ROLES) + """
SELECT c.icustay_id, c.subject_id, g.is_test FROM cohort c JOIN (
  SELECT subject_id, CAST(row_number() OVER (ORDER BY md5(CAST(subject_id AS VARCHAR) || '|42') || '|' ||
         CAST(subject_id AS VARCHAR)) <= ceil(count(*) OVER () * 0.2) AS INTEGER) AS is_test
  FROM (SELECT DISTINCT subject_id FROM cohort) s) g ON c.subject_id = g.subject_id""")
def q_grouped_split(spark, root):
    """Hold-out by person: no subject has stays on both sides."""
    return SP.grouped_split(roles.cohort(spark, root), "subject_id") \
        .select("icustay_id", "subject_id", "is_test")


@register("train_only_impute", _with(roles.SQL_SCORED) + f"""
, s AS (SELECT id, label, CASE WHEN id % 4 = 0 THEN NULL ELSE score END AS score,
               CAST(rnk <= ceil(n_c * 0.2) AS INTEGER) AS is_test
        FROM ({_sql_rank('scored', 'label', 'id')}) t)
SELECT id, is_test, {sql_r('coalesce(score, (SELECT median(score) FROM s WHERE is_test = 0))', 6)} AS score
FROM s""")
def q_train_only_impute(spark, root):
    """Missing scores filled with the median of the training rows alone."""
    rows = SP.stratified_split(roles.scored_rows(spark, root), "label", "id") \
        .withColumn("score", F.when(F.col("id") % 4 != 0, F.col("score")))
    meds = ST.collect_medians(rows.where("is_test = 0"), ["score"])
    out = ST.impute_median(rows, ["score"], medians=meds)
    return ST.rounded(out.select("id", "is_test", "score"), ["score"])


@register("stratified_folds", _with(roles.SQL_SCORED) + f"""
SELECT id, label, CAST((rnk - 1) % 5 AS INTEGER) AS fold
FROM ({_sql_rank('scored', 'label', 'id')}) t""")
def q_stratified_folds(spark, root):
    return SP.stratified_folds(roles.scored_rows(spark, root), "label", "id", k=5) \
        .select("id", "label", "fold")


@register("hash_split", _with(roles.SQL_ROLES) + """
SELECT icustay_id, CAST(substr(md5(CAST(icustay_id AS VARCHAR) || '|42'), 1, 8) < '33333333' AS INTEGER)
       AS is_test FROM cohort""")
def q_hash_split(spark, root):
    co = roles.cohort(spark, root)
    return SP.stratified_split(co, "hospital_expire_flag", "icustay_id", exact=False) \
        .select("icustay_id", "is_test")


@register("hash_sample", _with(roles.SQL_ROLES) + """
SELECT icustay_id, hospital_expire_flag, age FROM cohort
ORDER BY md5(CAST(icustay_id AS VARCHAR) || '|42'), icustay_id LIMIT 500""")
def q_hash_sample(spark, root):
    co = roles.cohort(spark, root).select("icustay_id", "hospital_expire_flag", "age")
    return SP.hash_sample(co, "icustay_id", n=500)


@register("class_weights", _with(roles.SQL_SCORED) + """
SELECT label, n, CAST(sum(n) OVER () AS DOUBLE) / CAST(count(*) OVER () * n AS DOUBLE) AS weight
FROM (SELECT label, count(*) AS n FROM scored WHERE label IS NOT NULL GROUP BY label) t""")
def q_class_weights(spark, root):
    return SP.class_weight_table(roles.scored_rows(spark, root), "label")


@register("standardize", _with(roles.SQL_MEASUREMENTS) + f"""
SELECT event_id, {sql_r('CASE WHEN s > 0 THEN (valuenum - m) / s ELSE valuenum - m END', 6)} AS value_z
FROM measurements, (SELECT avg(valuenum) AS m, stddev_pop(valuenum) AS s FROM measurements) st""")
def q_standardize(spark, root):
    m = roles.measurements(spark, root).select("event_id", "valuenum")
    z = ST.standardize(m, ["valuenum"], suffix="_z").select("event_id", "valuenum_z")
    return ST.rounded(z.withColumnRenamed("valuenum_z", "value_z"), ["value_z"])


# ------------------------------------------------------------ saved models ---
# A forest and a logistic model that were saved earlier score the cohort; their
# tables are read off the test tables (``roles``), so everything has an oracle.

_SAVED = list(roles.SAVED_FEATURES)
_SQL_X = "[" + ", ".join(_SAVED) + "]::DOUBLE[]"
_SQL_SAVED = "WITH RECURSIVE " + ",\n".join([roles.SQL_ROLES, roles.SQL_SAVED_INPUTS, roles.SQL_SAVED_FOREST])
_SQL_WALK = f""",
walk AS (SELECT icustay_id, {_SQL_X} AS x, tree, 0 AS at FROM saved, (SELECT DISTINCT tree FROM nodes) t
         UNION ALL
         SELECT w.icustay_id, w.x, w.tree, CASE WHEN w.x[n.feature + 1] <= n.threshold THEN n."left" ELSE n."right" END
         FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.at WHERE n."left" >= 0),
forest_scores AS (SELECT w.icustay_id, avg(n.value) AS score FROM walk w
                  JOIN nodes n ON n.tree = w.tree AND n.node = w.at AND n."left" < 0 GROUP BY w.icustay_id)"""
_SQL_LOGIT = "(" + " + ".join([str(roles.SAVED_INTERCEPT),
                               *[f"{b} * {c}" for c, b in roles.SAVED_COEFFICIENTS.items()]]) + ")"


@register("saved_forest_scores", _SQL_SAVED + _SQL_WALK + f"""
SELECT icustay_id, {sql_r('score', 9)} AS score FROM forest_scores""")
def q_saved_forest_scores(spark, root):
    """A saved forest's class-1 probabilities, by a walk of joins with its node table."""
    out = FO.forest_scores(roles.saved_inputs(spark, root), "icustay_id", _SAVED, roles.saved_forest(spark, root))
    return ST.rounded(out, ["score"], 9)


@register("saved_forest_paths", "WITH RECURSIVE " + roles.SQL_SAVED_FOREST + """,
up AS (SELECT tree, node AS leaf, value, node AS child FROM nodes WHERE "left" < 0
       UNION ALL SELECT tree, leaf, value, (child - 1) // 2 FROM up WHERE child > 0),
steps AS (SELECT u.tree, u.leaf, u.value, n.feature, c.cover / n.cover AS ratio,
                 CASE WHEN n."right" = u.child THEN n.threshold END AS low,
                 CASE WHEN n."left" = u.child THEN n.threshold END AS high
          FROM up u JOIN nodes n ON u.child > 0 AND n.tree = u.tree AND n.node = (u.child - 1) // 2
          JOIN nodes c ON c.tree = u.tree AND c.node = u.child)
SELECT tree, leaf, value, feature, max(low) AS low, min(high) AS high, """ + sql_r("product(ratio)", 9) + """ AS ratio
FROM steps GROUP BY tree, leaf, value, feature""")
def q_saved_forest_paths(spark, root):
    """The leaf paths of a saved forest: interval and cover ratio per feature."""
    return ST.rounded(FO.leaf_paths(roles.saved_forest(spark, root)), ["ratio"], 9)


def _sql_shapley() -> str:
    points = FO.quadrature(min(len(_SAVED), roles.FOREST_LEVELS))
    grid = ", ".join(f"({t!r}::DOUBLE, {w!r}::DOUBLE)" for t, w in points)
    return f""",
up AS (SELECT tree, node AS leaf, value, node AS child FROM nodes WHERE "left" < 0
       UNION ALL SELECT tree, leaf, value, (child - 1) // 2 FROM up WHERE child > 0),
el AS (SELECT u.tree, u.leaf, u.value, n.feature, product(c.cover / n.cover) AS z,
              max(CASE WHEN n."right" = u.child THEN n.threshold END) AS low,
              min(CASE WHEN n."left" = u.child THEN n.threshold END) AS high
       FROM up u JOIN nodes n ON u.child > 0 AND n.tree = u.tree AND n.node = (u.child - 1) // 2
       JOIN nodes c ON c.tree = u.tree AND c.node = u.child GROUP BY ALL),
hit AS (SELECT icustay_id, tree, leaf, value, feature, z,
               CASE WHEN coalesce(x[feature + 1] > low, true) AND coalesce(x[feature + 1] <= high, true) THEN 1.0 ELSE 0.0 END AS o
        FROM (SELECT icustay_id, {_SQL_X} AS x FROM saved) s, el),
grid(t, w) AS (VALUES {grid}),
whole AS (SELECT icustay_id, tree, leaf, t, w, product(t * o + (1 - t) * z) AS p FROM hit, grid GROUP BY ALL),
phi AS (SELECT h.icustay_id, h.feature, sum(h.value * (h.o - h.z) * g.w * g.p / (g.t * h.o + (1 - g.t) * h.z)) / {float(roles.FOREST_TREES)} AS phi
        FROM hit h JOIN whole g USING (icustay_id, tree, leaf) GROUP BY ALL),
base AS (SELECT avg(m) AS base FROM (SELECT sum(CASE WHEN "left" < 0 THEN cover * value END)
                                            / max(CASE WHEN node = 0 THEN cover END) AS m FROM nodes GROUP BY tree))
SELECT s.icustay_id AS id, f.name AS feature, f.x AS feature_value, {sql_r('coalesce(phi, 0.0)', 7)} AS shap_value,
       {sql_r('base', 7)} AS base_value, {sql_r('score', 7)} AS model_output
FROM (SELECT icustay_id, unnest(range({len(_SAVED)})) AS i, unnest([{', '.join(f"'{c}'" for c in _SAVED)}]) AS name,
             unnest({_SQL_X}) AS x FROM saved) f
JOIN saved s ON s.icustay_id = f.icustay_id JOIN forest_scores fs ON fs.icustay_id = f.icustay_id
LEFT JOIN phi ON phi.icustay_id = f.icustay_id AND phi.feature = f.i CROSS JOIN base"""


@register("saved_forest_shapley", _SQL_SAVED + _SQL_WALK + _sql_shapley())
def q_saved_forest_shapley(spark, root):
    """Path-dependent Shapley values of a saved forest for every stay of the cohort."""
    out = FO.forest_shapley(roles.saved_inputs(spark, root), "icustay_id", _SAVED, roles.saved_forest(spark, root))
    return ST.rounded(out, ["shap_value", "base_value", "model_output"], 7)


def _saved_scores(spark, root) -> dict[str, DataFrame]:
    """Score tables (icustay_id, label, score, prediction) of the saved models."""
    rows = stored(roles.saved_inputs(spark, root), "saved-inputs")
    logit = F.lit(roles.SAVED_INTERCEPT)
    for c, b in roles.SAVED_COEFFICIENTS.items():
        logit = logit + F.lit(b) * F.col(c)
    forest = FO.forest_scores(rows, "icustay_id", _SAVED, roles.saved_forest(spark, root))
    tables = {"Logistic Regression": rows.select("icustay_id", "label", S.round_half_even(
                  F.lit(1.0) / (F.lit(1.0) + F.exp(-logit)), 9).alias("score")),
              "Random Forest": rows.select("icustay_id", "label").join(
                  ST.rounded(forest, ["score"], 9), "icustay_id")}
    return {name: stored(t.withColumn("prediction", (F.col("score") > 0.5).cast("int")), "saved-scores")
            for name, t in tables.items()}


_SQL_SCORE_TABLES = _SQL_SAVED + _SQL_WALK + f""",
all_scores AS (
  SELECT 'Logistic Regression' AS model, label, {sql_r(f'1.0 / (1.0 + exp(-{_SQL_LOGIT}))', 9)} AS score FROM saved
  UNION ALL SELECT 'Random Forest', label, {sql_r('score', 9)} FROM forest_scores JOIN saved USING (icustay_id)),
grp AS (SELECT model, score, sum(label)::BIGINT AS pos, sum(1 - label)::BIGINT AS neg FROM all_scores GROUP BY ALL),
run AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score) - neg AS neg_below,
               sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
               sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fp,
               sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n FROM grp),
ranked AS (SELECT model, sum(pos::DOUBLE * (neg_below::DOUBLE + 0.5 * neg::DOUBLE)) / (max(p)::DOUBLE * max(n)::DOUBLE) AS auc,
                  sum(pos::DOUBLE / p::DOUBLE * (tp::DOUBLE / (tp + fp)::DOUBLE)) AS ap FROM run GROUP BY model),
cells AS (SELECT model, count_if(label = 0 AND score <= 0.5) AS tn, count_if(label = 0 AND score > 0.5) AS fp,
                 count_if(label = 1 AND score <= 0.5) AS fn, count_if(label = 1 AND score > 0.5) AS tp
          FROM all_scores GROUP BY model),
metrics AS (SELECT model, {sql_r('auc', 9)} AS test_roc_auc, {sql_r('ap', 9)} AS test_avg_precision,
                   coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0.0) AS prec, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0.0) AS rec
            FROM ranked JOIN cells USING (model))"""


@register("saved_model_metrics", _SQL_SCORE_TABLES + f"""
SELECT model, test_roc_auc, test_avg_precision, {sql_r('prec', 9)} AS precision_died, {sql_r('rec', 9)} AS recall_died,
       {sql_r('CASE WHEN prec + rec > 0 THEN 2.0 * prec * rec / (prec + rec) ELSE 0.0 END', 9)} AS f1_died
FROM metrics""")
def q_saved_model_metrics(spark, root):
    """The metrics table, one row a model, from the models' score tables."""
    rows = [MD.metrics_row(MD.ModelSpec("saved", name), [], t) for name, t in _saved_scores(spark, root).items()]
    out = spark.createDataFrame(rows, MD.METRICS_SCHEMA).drop("cv_auc_mean", "cv_auc_std")
    return ST.rounded(out, [c for c in out.columns if c != "model"], 9)


@register("saved_best_confusion", _SQL_SCORE_TABLES + """
, best AS (SELECT model, tn, fp, fn, tp FROM cells JOIN metrics USING (model) ORDER BY test_roc_auc DESC, model LIMIT 1)
SELECT model, unnest([0, 0, 1, 1]) AS label, unnest([0, 1, 0, 1]) AS prediction, unnest([tn, fp, fn, tp]) AS count FROM best""")
def q_saved_best_confusion(spark, root):
    """Confusion matrix of the model with the highest area under the curve."""
    tables = _saved_scores(spark, root)
    auc = {name: M.roc_auc(t).first()["roc_auc"] for name, t in tables.items()}
    best = min(auc, key=lambda name: (-(auc[name] or 0.0), name))
    return M.confusion_matrix(tables[best]).select(F.lit(best).alias("model"), "label", "prediction", "count")


@register("kpi_summary", _SQL_SCORE_TABLES + f"""
SELECT count(*) AS total_patients,
       CAST(coalesce(sum(hospital_expire_flag), 0) AS BIGINT) AS total_deaths,
       {sql_r('avg(hospital_expire_flag) * 100.0', 1)} AS mortality_rate_pct,
       {sql_r('avg(icu_los_days)', 1)} AS mean_icu_los_days,
       {sql_r('avg(prolonged_los) * 100.0', 1)} AS pct_prolonged_los,
       {sql_r(f"avg(CASE WHEN admission_type = '{roles.EMERGENCY_TYPE}' THEN 1 ELSE 0 END) * 100.0", 1)} AS pct_emergency,
       {sql_r(f'avg({SQL_WEEKEND}) * 100.0', 1)} AS pct_weekend,
       (SELECT test_roc_auc FROM metrics WHERE model = 'Random Forest') AS model_roc_auc,
       count(DISTINCT first_careunit) AS care_units_covered
FROM cohort""")
def q_kpi_summary(spark, root):
    """The KPI row, with the area under the curve of the saved forest's scores."""
    scores = FO.forest_scores(roles.saved_inputs(spark, root), "icustay_id", _SAVED, roles.saved_forest(spark, root))
    scored = roles.saved_inputs(spark, root).select("icustay_id", "label").join(
        ST.rounded(scores, ["score"], 9), "icustay_id")
    auc = M.roc_auc(scored).first()["roc_auc"]
    return ST.rounded(R.kpi_summary(roles.cohort(spark, root), auc, roles.EMERGENCY_TYPE), ["model_roc_auc"], 9)


_SQL_GRAM = _with(roles.SQL_ROLES, roles.SQL_SAVED_INPUTS) + f""",
cls AS (SELECT label, (SELECT count(*) FROM saved)::DOUBLE / (2 * count(*))::DOUBLE AS w FROM saved GROUP BY label),
pr AS (SELECT list_concat({_SQL_X}, [1.0::DOUBLE]) AS x, s.label AS y, w, 1.0 / (1.0 + exp(-{_SQL_LOGIT})) AS p
       FROM saved s JOIN cls USING (label)),
g AS (SELECT i, sum(w * (p - y) * x[i + 1]) / sum(w) AS v FROM pr, range({len(_SAVED) + 1}) r(i) GROUP BY i),
h AS (SELECT i, j, sum(w * p * (1 - p) * x[i + 1] * x[j + 1]) / sum(w) AS v
      FROM pr, range({len(_SAVED) + 1}) r(i), range({len(_SAVED) + 1}) c(j) GROUP BY i, j),
b AS (SELECT list_concat([{', '.join(f'{b}' for b in roles.SAVED_COEFFICIENTS.values())}]::DOUBLE[], [{roles.SAVED_INTERCEPT}::DOUBLE]) AS b)"""
_PENALTY = 0.01


@register("logistic_derivatives", _SQL_GRAM + f"""
SELECT CAST(i AS INTEGER) AS i, -1 AS j, {sql_r(f'v + CASE WHEN i < {len(_SAVED)} THEN {_PENALTY} * b[i + 1] ELSE 0.0 END', 7)} AS value FROM g, b
UNION ALL SELECT CAST(i AS INTEGER), CAST(j AS INTEGER),
       {sql_r(f'v + CASE WHEN i = j AND i < {len(_SAVED)} THEN {_PENALTY} ELSE 0.0 END', 7)} FROM h""")
def q_logistic_derivatives(spark, root):
    """Gradient (j = -1) and Hessian of the penalised weighted log loss at the
    saved logistic model's coefficients."""
    rows = roles.saved_inputs(spark, root)
    weights = {r["label"]: r["weight"] for r in SP.class_weight_table(rows, "label").collect()}
    data = SP.with_weights(rows, "label", weights)
    d = LG.derivatives(data, _SAVED, "label", "weight",
                       [*roles.SAVED_COEFFICIENTS.values(), roles.SAVED_INTERCEPT], _PENALTY)
    p = len(_SAVED) + 1
    cells = [(i, -1, float(d.gradient[i])) for i in range(p)]
    cells += [(i, j, float(d.hessian[i, j])) for i in range(p) for j in range(p)]
    return ST.rounded(spark.createDataFrame(cells, "i int, j int, value double"), ["value"], 7)


@register("fold_moments", _with(roles.SQL_ROLES, roles.SQL_SAVED_INPUTS) + f"""
, f AS (SELECT *, CAST((rnk - 1) % 5 AS INTEGER) AS fold FROM ({_sql_rank('saved', 'label', 'icustay_id')}) t),
t AS (SELECT CAST(k AS INTEGER) AS held_out_fold, f.* FROM f, range(5) r(k) WHERE f.fold <> k),
n AS (SELECT held_out_fold, count(*) AS n_rows, sum(label)::BIGINT AS n_positive FROM t GROUP BY 1)
""" + " UNION ALL ".join(f"""SELECT held_out_fold, '{c}' AS feature, {sql_r(f'avg({c})', 9)} AS mean, {sql_r(f'stddev_pop({c})', 9)} AS std,
  any_value(n_rows) AS n_rows, {sql_r('any_value(n_rows)::DOUBLE / (2 * any_value(n_positive))::DOUBLE', 9)} AS positive_weight
FROM t JOIN n USING (held_out_fold) GROUP BY held_out_fold""" for c in roles.SAVED_FEATURES))
def q_fold_moments(spark, root):
    """Scaler moments and class weights of every fold's training part, all from
    one pass of statistics by (fold, class)."""
    rows = SP.stratified_folds(roles.saved_inputs(spark, root), "label", "icustay_id", k=5)
    out = []
    for fold, (scaler, counts) in MD.fold_statistics(rows, _SAVED, "label").items():
        n = sum(c for _, c, _ in counts)
        weight = {label: w for label, _, w in counts}.get(1)
        out += [(fold, c, *scaler[c], n, weight) for c in _SAVED]
    df = spark.createDataFrame(out, "held_out_fold int, feature string, mean double, std double, n_rows long, positive_weight double")
    return ST.rounded(df, ["mean", "std", "positive_weight"], 9)


# -------------------------------------------------------------- modelling ---
# Rows-only checks (no SQL oracle): model fits are Spark ML jobs with the
# analysed project's settings (300 trees, depth 8).  Every key fits for itself.

LABEL, KEY = "hospital_expire_flag", "icustay_id"

# Categories of features in the importance table.
FEATURE_CATEGORY = {"age": "Demographics", "gender_enc": "Demographics",
                    "emergency_admission": "Admission", "weekend_admission": "Admission",
                    "night_admission": "Admission", "pulse_pressure": "Vitals"}


def _category(name: str) -> str:
    if name in FEATURE_CATEGORY:
        return FEATURE_CATEGORY[name]
    return "Labs" if any(name.endswith("_" + n) for n in LAB_NAMES) else "Vitals"


def model_matrix(spark, root, label: str = LABEL):
    """Imputed cohort feature matrix with split and fold columns (stratified
    on ``label``), written to the checkpoint folder (cuts the lineage every
    fit would replay).  Both outcomes and the LOS itself are excluded from
    the features, whichever is the target."""
    m = master(spark, root, materialize=True)    # read by the medians pass and the fill
    feats, _ = MD.model_features(m)
    meds = ST.collect_medians(m, feats)
    feats = [c for c in feats if meds.get(c) is not None]     # all-NULL columns carry nothing
    mat = ST.impute_median(m.select(KEY, label, *feats), feats, medians=meds)
    mat = SP.split_and_folds(mat, label, KEY, test_fraction=MD.TEST_SIZE, k=MD.CV_FOLDS,
                             seed=MD.RANDOM_SEED, allocation="largest_remainder")
    return stored(mat, "matrix"), feats


def model_run(spark, root, kinds=("lr", "rf"), cv: bool = True, label: str = LABEL):
    """Fit (and optionally cross-validate) the requested models."""
    full, feats = model_matrix(spark, root, label)
    train, test = full.where("is_test = 0"), full.where("is_test = 1")
    run = {"matrix": full, "features": feats, "train": train, "test": test, "fits": {},
           "scored": {}, "cv": {}}
    by_fold = MD.fold_statistics(train, feats, label) if cv else None      # shared by the models
    for spec in MD.default_specs():
        if spec.kind not in kinds:
            continue
        fm = MD.fit(spec, train, feats, label)
        run["fits"][spec.kind] = fm
        run["scored"][spec.kind] = stored(fm.score(test, KEY, label), "test-scores")
        if cv:
            run["cv"][spec.kind] = MD.cross_validate(spec, train, feats, label, KEY, statistics=by_fold)
    return run


@register("prolonged_los_scores")
def q_prolonged_los_scores(spark, root):
    """The same forest on the other outcome: ICU stay longer than 7 days."""
    return model_run(spark, root, kinds=("rf",), cv=False, label="prolonged_los")["scored"]["rf"]


@register("lr_scores")
def q_lr_scores(spark, root):
    return model_run(spark, root, kinds=("lr",), cv=False)["scored"]["lr"]


@register("rf_scores")
def q_rf_scores(spark, root):
    return model_run(spark, root, kinds=("rf",), cv=False)["scored"]["rf"]


@register("lr_certificate")
def q_lr_certificate(spark, root):
    """The logistic fit pass by pass: loss, largest gradient component, largest
    component of the Newton step that was left, seconds."""
    fm = model_run(spark, root, kinds=("lr",), cv=False)["fits"]["lr"]
    return spark.createDataFrame(fm.model.history, LG.HISTORY_SCHEMA)


@register("cv_metrics")
def q_cv_metrics(spark, root):
    run = model_run(spark, root)
    rows = []
    for spec in MD.default_specs():
        aucs = run["cv"][spec.kind]
        rows += [(spec.name, i, float(a)) for i, a in enumerate(aucs)]
    folds = spark.createDataFrame(rows, "model string, fold int, auc double")
    return folds.groupBy("model").agg(F.avg("auc").alias("cv_auc_mean"),
                                      F.stddev_pop("auc").alias("cv_auc_std"),
                                      F.count(F.lit(1)).alias("folds"))


def _metrics_table(spark, run):
    rows = [MD.metrics_row(spec, run["cv"][spec.kind], run["scored"][spec.kind])
            for spec in MD.default_specs()]
    return spark.createDataFrame(rows, MD.METRICS_SCHEMA)


@register("model_metrics")
def q_model_metrics(spark, root):
    return _metrics_table(spark, model_run(spark, root))


@register("top_importances")
def q_top_importances(spark, root):
    fm = model_run(spark, root, kinds=("rf",), cv=False)["fits"]["rf"]
    imp = spark.createDataFrame([(f, v, _category(f)) for f, v in MD.importances(fm)],
                                "feature string, importance double, category string")
    shares = R.share_of_total(imp, "feature", "importance")        # of all features
    return shares.orderBy(F.desc("importance"), "feature").limit(20).select(
        "feature", "importance", "category", "importance_pct",
        S.feature_label("feature").alias("feature_label"))


def _shap_long(spark, root):
    run = model_run(spark, root, kinds=("rf",), cv=False)
    fm = run["fits"]["rf"]
    # every test row, dealt evenly: explaining costs far more than the shuffle
    rows = run["test"].repartition(spark.sparkContext.defaultParallelism, KEY)
    return X.shap_values(fm.scale(rows).select(KEY, *fm.features), KEY, fm.features, fm.model)


@register("shap_values")
def q_shap_values(spark, root):
    return _shap_long(spark, root)


@register("shap_ranking")
def q_shap_ranking(spark, root):
    return X.shap_ranking(_shap_long(spark, root), top=12)


@register("best_confusion_matrix")
def q_best_confusion_matrix(spark, root):
    run = model_run(spark, root, cv=False)
    best = max(run["scored"], key=lambda k: M.roc_auc(run["scored"][k]).first()["roc_auc"] or 0)
    return M.confusion_matrix(run["scored"][best]).withColumn("model", F.lit(best))


@register("model_summary")
def q_model_summary(spark, root):
    run = model_run(spark, root)
    mt = _metrics_table(spark, run)
    best = mt.orderBy(F.desc("test_roc_auc")).limit(1)
    stats = run["matrix"].agg(F.count(F.lit(1)).alias("n_rows"),
                              F.avg(LABEL).alias("positive_rate"))
    n_feat = len(run["features"])
    row = best.select(F.col("model").alias("best_model"), "test_roc_auc", "precision_died",
                      "recall_died").first()
    return stats.select("n_rows", "positive_rate", F.lit(n_feat).alias("n_features"),
                        F.lit(row["best_model"]).alias("best_model"),
                        F.lit(row["test_roc_auc"]).cast("double").alias("test_roc_auc"),
                        F.lit(row["precision_died"]).cast("double").alias("precision_died"),
                        F.lit(row["recall_died"]).cast("double").alias("recall_died"))


# -------------------------------------------------------------- streaming ---

@register("threshold_alert_stream", _with(roles.SQL_ROLES, roles.SQL_MEASUREMENTS) + f"""
SELECT c.icustay_id, min(m.charttime) AS first_breach, count(*) AS n_breaches
FROM measurements m JOIN cohort c ON m.hadm_id = c.hadm_id
WHERE {_LAB_FILTER} AND {_sql_window('c.icustay_id', S.ALERT_WINDOW_HOURS)}
  AND (""" + " OR ".join(
    f"({roles.sql_lab_name('m.itemid')} = '{n}' AND m.valuenum > {float(t)})"
    for n, t in roles.ROLE_ALERT_THRESHOLDS.items()) + """)
GROUP BY c.icustay_id""")
def q_threshold_alert_stream(spark, root):
    """The alert rule as a streaming job over the measurement file (run to
    completion with availableNow); the alerts table is read back."""
    from ..sources.tables import TABLE_SCHEMAS
    from ..streaming import alerts as A
    ev = A.file_stream(spark, root, TABLE_SCHEMAS["events"], file_glob="events.parquet")
    m = ev.select(F.col("user_id").alias("hadm_id"), roles.item_code().alias("itemid"),
                  F.col("ts").alias("charttime"), F.col("value").alias("valuenum"))
    m = EV.name_items(EV.filter_measurements(m, roles.LAB_CODES), roles.LAB_CODES)
    anchors = roles.cohort_anchors(roles.cohort(spark, root))
    breaches = A.breach_stream(m, anchors, "hadm_id", "hadm_id", roles.ROLE_ALERT_THRESHOLDS,
                               out_key="icustay_id")
    out = scratch_path(spark, "alerts")
    q = A.start_alerts(breaches, out, scratch_path(spark, "alerts-progress"))
    q.awaitTermination()
    return A.read_alerts(spark, out).select("icustay_id", "first_breach", "n_breaches")
