"""Role mapping: the clinical roles (patients, admissions, ICU stays,
measurement logs, scored rows) expressed over the star-schema test tables.

Each role is given twice — as a Spark DataFrame and as DuckDB SQL — so that
every registered query has an independent SQL oracle over the same Parquet
files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.cohort import build_cohort
from ..sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed role parameters (the mapping itself).
MALE_SEGMENT = "BUILDING"                 # c_mktsegment that encodes gender 'M'
DOB_ORIGIN = "1900-01-01"                 # dob = origin + (c_custkey * 7919) % 36500 days
DOB_MULT, DOB_MOD = 7919, 36500
EMERGENCY_TYPE = "1-URGENT"               # o_orderpriority playing 'EMERGENCY'
ELECTIVE_TYPE = "5-LOW"                   # o_orderpriority playing 'ELECTIVE'
DIED_STATUS = "F"                         # o_orderstatus meaning in-hospital death
EXCLUDED_UNITS = ("N",)                   # l_returnflag playing 'NICU'
STAY_ORDER = ("intime", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
ADMIT_HOUR_MOD = 24                       # admittime = o_orderdate + (o_orderkey % 24) h
ANCHOR_ORIGIN = "2024-01-01 00:00:00"     # event anchor = origin + (o_orderkey % 600) h
ANCHOR_HOUR_MOD = 600
ERROR_TYPE = "error"                      # event_type flagged as charting error
ITEM_PARTS = 3                            # item code = event_type || '-' || event_id % 3
# Measurement dictionaries over these codes: the analysed project's six vitals
# and seven labs.
VITAL_CODES = {"click-0": "heart_rate", "click-1": "sbp", "click-2": "dbp", "view-0": "spo2",
               "view-1": "temperature_c", "view-2": "resp_rate", "error-0": "heart_rate"}
LAB_CODES = {"purchase-0": "creatinine", "purchase-1": "lactate", "purchase-2": "wbc",
             "signup-0": "haemoglobin", "signup-1": "glucose", "signup-2": "bicarbonate",
             "error-1": "bilirubin"}
# Alert thresholds: the analysed project's own (lactate > 2.5, creatinine > 2.0).
ROLE_ALERT_THRESHOLDS = dict(S.ALERT_THRESHOLDS)
PREDICTION_CUTOFF = 2000                  # scored rows: prediction = n_chars >= cutoff
# A saved forest's node table read off the part table: full binary trees, node n
# has children 2n+1 and 2n+2; tree t's node n is the part with key 63 t + n + 1.
FOREST_TREES, FOREST_INNER, FOREST_LEVELS = 10, 31, 5
# Inputs of the saved models, each with the range of its thresholds.
SAVED_FEATURES = {"age": (18, 100), "admit_hour": (0, 23), "icu_los_days": (0, 25),
                  "admit_month": (1, 12), "weekday": (0, 6)}
# A saved logistic model: intercept and coefficients over the same inputs.
SAVED_INTERCEPT = -0.4
SAVED_COEFFICIENTS = {"age": 0.004, "admit_hour": -0.01, "icu_los_days": 0.02,
                      "admit_month": 0.015, "weekday": -0.03}
# ---------------------------------------------------------------------------


def patients(spark: SparkSession, root: str) -> DataFrame:
    c = read_table(spark, root, "customer", ["c_custkey", "c_mktsegment"])
    dob_days = ((F.col("c_custkey") * DOB_MULT) % DOB_MOD).cast("int")
    return c.select(
        F.col("c_custkey").alias("subject_id"),
        F.when(F.col("c_mktsegment") == MALE_SEGMENT, F.lit("M")).otherwise(F.lit("F"))
        .alias("gender"),
        F.date_add(F.lit(DOB_ORIGIN).cast("date"), dob_days).alias("dob"))


def admissions(spark: SparkSession, root: str, payer: bool = False) -> DataFrame:
    """Admissions; with ``payer`` also insurance and ethnicity."""
    o = read_table(spark, root, "orders",
                   ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"])
    hours = (F.col("o_orderkey") % ADMIT_HOUR_MOD).cast("int")
    return o.select(
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_custkey").alias("subject_id"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hours)).alias("admittime"),
        F.col("o_orderpriority").alias("admission_type"),
        *([F.concat(F.lit("plan-"), F.col("o_orderkey") % 4).alias("insurance"),
           F.concat(F.lit("group-"), F.col("o_custkey") % 5).alias("ethnicity")] if payer else []),
        F.when(F.col("o_orderstatus") == DIED_STATUS, F.lit(1)).otherwise(F.lit(0))
        .alias("hospital_expire_flag"))


def icustays(spark: SparkSession, root: str) -> DataFrame:
    li = read_table(spark, root, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_returnflag", "l_shipdate"])
    return li.select(
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_orderkey").alias("icustay_id"),
        F.col("l_returnflag").alias("first_careunit"),
        (F.col("l_quantity") / F.lit(2.0)).alias("los"),
        F.col("l_shipdate").alias("intime"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def anchor_time(key_col: str) -> F.Column:
    hours = (F.col(key_col) % ANCHOR_HOUR_MOD).cast("int")
    return F.lit(ANCHOR_ORIGIN).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hours)


def stay_anchors(spark: SparkSession, root: str) -> DataFrame:
    """Every stay's event-window anchor (one row per stay)."""
    o = read_table(spark, root, "orders", ["o_orderkey"])
    return o.select(F.col("o_orderkey").alias("icustay_id"),
                    F.col("o_orderkey").alias("hadm_id"),
                    anchor_time("o_orderkey").alias("intime"))


def item_code(event_type: str = "event_type", event_id: str = "event_id") -> F.Column:
    return F.concat(F.col(event_type), F.lit("-"), F.col(event_id) % ITEM_PARTS)


def measurements(spark: SparkSession, root: str, codes=None) -> DataFrame:
    """Tall measurement log: stay/episode id, item code, time, value, error.
    With ``codes`` the scan reads only the event types that these come from."""
    e = read_table(spark, root, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    if codes is not None:
        e = e.where(F.col("event_type").isin(*sorted({c.rsplit("-", 1)[0] for c in codes})))
    return e.select(
        "event_id",
        F.col("user_id").alias("icustay_id"),
        F.col("user_id").alias("hadm_id"),
        item_code().alias("itemid"),
        F.col("ts").alias("charttime"),
        F.col("value").alias("valuenum"),
        F.when(F.col("event_type") == ERROR_TYPE, F.lit(1)).alias("error"))


def cohort(spark: SparkSession, root: str, payer: bool = False) -> DataFrame:
    return build_cohort(admissions(spark, root, payer), patients(spark, root), icustays(spark, root),
                        stay_order=STAY_ORDER, exclude_units=EXCLUDED_UNITS)


def cohort_anchors(cohort_df: DataFrame) -> DataFrame:
    """Event-window anchors of the cohort's stays."""
    return cohort_df.select("icustay_id", "hadm_id", anchor_time("icustay_id").alias("intime"))


def scored_rows(spark: SparkSession, root: str) -> DataFrame:
    """(id, label, score, prediction) rows: labels joined to documents."""
    lab = read_table(spark, root, "labels", ["doc_id", "quality"])
    doc = read_table(spark, root, "documents", ["doc_id", "n_chars"])
    return (lab.join(doc, "doc_id")
            .select(F.col("doc_id").alias("id"), F.col("quality").alias("label"),
                    F.col("n_chars").cast("double").alias("score"),
                    F.when(F.col("n_chars") >= PREDICTION_CUTOFF, F.lit(1)).otherwise(F.lit(0))
                    .alias("prediction")))


def saved_inputs(spark: SparkSession, root: str) -> DataFrame:
    """(icustay_id, label, the saved models' inputs) of the cohort."""
    return cohort(spark, root).select(
        "icustay_id", F.col("hospital_expire_flag").alias("label"), F.col("age").cast("double").alias("age"),
        F.hour("admittime").cast("double").alias("admit_hour"), F.col("icu_los_days").alias("icu_los_days"),
        F.month("admittime").cast("double").alias("admit_month"),
        F.weekday("admittime").cast("double").alias("weekday"))


def saved_forest(spark: SparkSession, root: str) -> DataFrame:
    """Node table of a saved forest (schema of ``forest.NODE_COLUMNS``)."""
    per_tree = 2 * FOREST_INNER + 1
    part = read_table(spark, root, "part", ["p_partkey", "p_size", "p_retailprice"])
    rows = spark.range(FOREST_TREES * per_tree).join(part, F.col("id") + 1 == F.col("p_partkey"), "left")
    node = (F.col("id") % per_tree).cast("int")
    size = F.coalesce("p_size", F.lit(1))
    where = F.coalesce(F.floor(F.col("p_retailprice") * 10) % 100, F.lit(50)) / 100.0
    low = F.element_at(F.lit([float(a) for a, _ in SAVED_FEATURES.values()]), F.col("feature") + 1)
    span = F.element_at(F.lit([float(b - a) for a, b in SAVED_FEATURES.values()]), F.col("feature") + 1)
    rows = rows.select((F.col("id") / per_tree).cast("int").alias("tree"), node.alias("node"),
                       (size % len(SAVED_FEATURES)).cast("int").alias("feature"), where.alias("frac"),
                       (size / 50.0).alias("value"), size.cast("double").alias("size"))
    # an inner node covers what its leaves cover
    leaf = rows.where(F.col("node") >= FOREST_INNER).select("tree", F.col("node").alias("at"), "size")
    over, up = [], F.col("at")
    for _ in range(FOREST_LEVELS + 1):
        over.append(up)
        up = F.floor((up - 1) / 2).cast("int")
    cover = (leaf.select("tree", F.explode(F.array(*over)).alias("node"), "size")
             .groupBy("tree", "node").agg(F.sum("size").alias("cover")))
    inner = F.col("node") < FOREST_INNER
    return rows.join(cover, ["tree", "node"]).select(
        "tree", "node", F.when(inner, 2 * F.col("node") + 1).otherwise(-1).alias("left"),
        F.when(inner, 2 * F.col("node") + 2).otherwise(-1).alias("right"),
        F.when(inner, F.col("feature")).otherwise(-1).alias("feature"),
        F.when(inner, low + F.col("frac") * span).alias("threshold"), "value", "cover")


# ---------------------------------------------------------------------------
# The same roles in DuckDB SQL (common table expressions).

def _sql_map(col: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


SQL_PATIENTS = f"""patients AS (
  SELECT c_custkey AS subject_id,
         CASE WHEN c_mktsegment = '{MALE_SEGMENT}' THEN 'M' ELSE 'F' END AS gender,
         CAST(DATE '{DOB_ORIGIN}' + CAST((c_custkey * {DOB_MULT}) % {DOB_MOD} AS INTEGER) AS DATE) AS dob
  FROM customer)"""

SQL_ADMISSIONS = f"""admissions AS (
  SELECT o_orderkey AS hadm_id, o_custkey AS subject_id,
         o_orderdate + to_hours(CAST(o_orderkey % {ADMIT_HOUR_MOD} AS BIGINT)) AS admittime,
         o_orderpriority AS admission_type,
         CASE WHEN o_orderstatus = '{DIED_STATUS}' THEN 1 ELSE 0 END AS hospital_expire_flag
  FROM orders)"""

SQL_ICUSTAYS = """icustays AS (
  SELECT l_orderkey AS hadm_id, l_orderkey AS icustay_id, l_returnflag AS first_careunit,
         l_quantity / 2.0 AS los, l_shipdate AS intime,
         l_linenumber, l_partkey, l_suppkey, l_quantity
  FROM lineitem)"""

SQL_ANCHOR = (f"(TIMESTAMP '{ANCHOR_ORIGIN}' + "
              f"to_hours(CAST({{key}} % {ANCHOR_HOUR_MOD} AS BIGINT)))")

SQL_MEASUREMENTS = f"""measurements AS (
  SELECT event_id, user_id AS icustay_id, user_id AS hadm_id,
         event_type || '-' || (event_id % {ITEM_PARTS}) AS itemid,
         ts AS charttime, value AS valuenum,
         CASE WHEN event_type = '{ERROR_TYPE}' THEN 1 END AS error
  FROM events)"""

_excl = ", ".join(f"'{u}'" for u in EXCLUDED_UNITS)
SQL_COHORT = f"""first_icu AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY hadm_id ORDER BY intime ASC NULLS FIRST,
         l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn
  FROM icustays),
cohort AS (
  SELECT * FROM (
    SELECT a.subject_id, a.hadm_id, fi.icustay_id, a.admittime, a.admission_type,
           a.hospital_expire_flag,
           CASE WHEN fi.los > 7 THEN 1 ELSE 0 END AS prolonged_los,
           fi.los AS icu_los_days, fi.first_careunit, fi.intime AS icu_intime, p.gender,
           CAST(year(CAST(a.admittime AS DATE)) - year(p.dob) AS INTEGER) AS age
    FROM admissions a
    JOIN first_icu fi ON a.hadm_id = fi.hadm_id
    JOIN patients p ON a.subject_id = p.subject_id
    WHERE fi.rn = 1 AND fi.first_careunit NOT IN ({_excl})) b
  WHERE age BETWEEN 18 AND 100)"""

SQL_SCORED = f"""scored AS (
  SELECT l.doc_id AS id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score,
         CASE WHEN d.n_chars >= {PREDICTION_CUTOFF} THEN 1 ELSE 0 END AS prediction
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

SQL_SAVED_INPUTS = """saved AS (
  SELECT icustay_id, hospital_expire_flag AS label, CAST(age AS DOUBLE) AS age,
         CAST(hour(admittime) AS DOUBLE) AS admit_hour, icu_los_days, CAST(month(admittime) AS DOUBLE) AS admit_month,
         CAST(isodow(admittime) - 1 AS DOUBLE) AS weekday FROM cohort)"""

_per_tree = 2 * FOREST_INNER + 1
_lows = ", ".join(f"{float(a)}" for a, _ in SAVED_FEATURES.values())
_spans = ", ".join(f"{float(b - a)}" for a, b in SAVED_FEATURES.values())
SQL_SAVED_FOREST = f"""node_rows AS (
  SELECT CAST(r.id // {_per_tree} AS INTEGER) AS tree, CAST(r.id % {_per_tree} AS INTEGER) AS node,
         CAST(coalesce(p_size, 1) % {len(SAVED_FEATURES)} AS INTEGER) AS feature,
         coalesce(floor(p_retailprice * 10) % 100, 50) / 100.0::DOUBLE AS frac,
         coalesce(p_size, 1) / 50.0::DOUBLE AS value, CAST(coalesce(p_size, 1) AS DOUBLE) AS size
  FROM range({FOREST_TREES * _per_tree}) r(id) LEFT JOIN part ON p_partkey = r.id + 1),
covers AS (
  SELECT tree, unnest([{", ".join(f"((node + 1) >> {k}) - 1" for k in range(FOREST_LEVELS + 1))}]) AS node, size
  FROM node_rows WHERE node >= {FOREST_INNER}),
nodes AS (
  SELECT r.tree, r.node, CASE WHEN r.node < {FOREST_INNER} THEN 2 * r.node + 1 ELSE -1 END AS "left",
         CASE WHEN r.node < {FOREST_INNER} THEN 2 * r.node + 2 ELSE -1 END AS "right",
         CASE WHEN r.node < {FOREST_INNER} THEN feature ELSE -1 END AS feature,
         CASE WHEN r.node < {FOREST_INNER} THEN ([{_lows}]::DOUBLE[])[feature + 1]
              + frac * ([{_spans}]::DOUBLE[])[feature + 1] END AS threshold,
         value, c.cover
  FROM node_rows r JOIN (SELECT tree, node, sum(size) AS cover FROM covers GROUP BY ALL) c
    ON c.tree = r.tree AND c.node = r.node)"""

SQL_ROLES = ",\n".join([SQL_PATIENTS, SQL_ADMISSIONS, SQL_ICUSTAYS, SQL_COHORT])


def sql_vital_name(col: str = "itemid") -> str:
    return _sql_map(col, VITAL_CODES)


def sql_lab_name(col: str = "itemid") -> str:
    return _sql_map(col, LAB_CODES)
