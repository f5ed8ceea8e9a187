import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from stayscope.functions import scalars as S


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_age_bands_right_closed(spark):
    ages = [17, 18, 40, 41, 60, 61, 75, 76, 100, 101, None]
    got = _one(spark, [(a,) for a in ages], "age int", S.age_band("age"))
    assert got == [None, "18–40", "18–40", "41–60", "41–60", "61–75", "61–75", "76+", "76+",
                   None, None]


def test_los_bands_and_shift(spark):
    los = [0.0, 1.0, 1.0001, 3.0, 7.0, 14.0, 14.1, 1000.0, -1.0]
    got = _one(spark, [(x,) for x in los], "x double", S.los_band("x"))
    assert got == ["<1 day", "<1 day", "1–3 days", "1–3 days", "3–7 days", "7–14 days",
                   ">14 days", None, None]
    hours = [0, 7, 8, 15, 16, 23]
    got = _one(spark, [(h,) for h in hours], "h int", S.shift_band("h"))
    assert [g.split(" ")[0] for g in got] == ["Night", "Night", "Day", "Day", "Evening", "Evening"]


def test_half_even_matches_numpy(spark):
    xs = [12.25, 12.35, 0.05, 2.5, -2.5, 0.125, 1.005]
    got = _one(spark, [(x,) for x in xs], "x double", S.round_half_even("x", 1))
    assert got == [float(np.round(x, 1)) for x in xs]
    assert _one(spark, [(12.25,)], "x double", S.round_half_even("x", 1)) == [12.2]


def test_calendar_year_age(spark):
    rows = [(dt.date(2001, 1, 1), dt.date(2000, 12, 31))]
    assert _one(spark, rows, "a date, b date", S.calendar_year_diff("a", "b")) == [1]


def test_weekend_night_flags_null_is_zero(spark):
    rows = [(dt.datetime(2024, 1, 6, 3),), (dt.datetime(2024, 1, 7, 8),),
            (dt.datetime(2024, 1, 8, 7, 59),), (None,)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = df.select(S.weekend_flag("t"), S.night_flag("t")).collect()
    assert [tuple(r) for r in got] == [(1, 1), (1, 0), (0, 1), (0, 0)]


def test_encoded_flags_and_prolonged(spark):
    df = spark.createDataFrame([("M", 7.0001), ("F", 7.0), (None, None)], "g string, los double")
    got = df.select(S.eq_flag("g", "M"), S.prolonged_flag("los")).collect()
    assert [tuple(r) for r in got] == [(1, 1), (0, 0), (0, 0)]


def test_feature_labels(spark):
    names = ["mean_heart_rate", "min_spo2", "max_creatinine", "age", "night_admission"]
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = df.select(S.feature_label("f"), S.feature_label("f", report_style=False)).collect()
    assert [r[0] for r in got] == ["Avg Heart Rate", "Min Spo2", "Max Creatinine", "Age",
                                   "Night Admission"]
    assert got[0][1] == "avg heart rate"


def test_clip_keeps_null_and_percent_text(spark):
    df = spark.createDataFrame([(None,), (45.0,), (3.0,)], "x double")
    assert [r[0] for r in df.select(S.clip_upper("x", 30.0)).collect()] == [None, 30.0, 3.0]
    df = spark.createDataFrame([(0.1234,), (0.00049,)], "x double")
    assert [r[0] for r in df.select(S.percent_text("x")).collect()] == ["12.3%", "0.0%"]
    assert spark.range(1).select(S.thousands_text(F.lit(58976))).first()[0] == "58,976"
