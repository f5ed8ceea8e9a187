import datetime as dt

from stayscope.operators import cohort as C

D = dt.datetime


def _frames(spark):
    adm = spark.createDataFrame([
        (1, 10, D(2001, 1, 1, 3), "EMERGENCY", 1),
        (2, 20, D(2001, 1, 6, 10), "ELECTIVE", 0),
        (3, 30, D(2001, 1, 7, 20), None, 0),
        (4, 40, D(2001, 1, 8, 12), "URGENT", 1),
        (5, 50, D(2001, 1, 9, 12), "URGENT", 0),
    ], "subject_id long, hadm_id long, admittime timestamp_ntz, admission_type string, "
       "hospital_expire_flag int")
    pat = spark.createDataFrame([
        (1, "M", dt.date(1960, 5, 1)), (2, "F", dt.date(2000, 12, 31)),
        (3, None, dt.date(1950, 1, 1)), (4, "F", dt.date(1890, 1, 1)),
        (5, "M", dt.date(1970, 1, 1)),
    ], "subject_id long, gender string, dob date")
    stays = spark.createDataFrame([
        (10, 101, "MICU", 7.0001, D(2001, 1, 1, 5)),
        (10, 100, "SICU", 2.0, D(2001, 1, 1, 5)),       # tie on intime -> lower id
        (20, 200, "CCU", 3.0, None),                    # NULL intime sorts first
        (20, 201, "MICU", 9.0, D(2001, 1, 6, 11)),
        (30, 300, "NICU", 1.0, D(2001, 1, 7, 21)),
        (40, 400, "MICU", 8.0, D(2001, 1, 8, 13)),      # age 111 -> dropped
        (50, 500, None, 8.0, D(2001, 1, 9, 13)),         # NULL unit -> dropped
    ], "hadm_id long, icustay_id long, first_careunit string, los double, intime timestamp_ntz")
    return adm, pat, stays


def test_first_per_group_ties_and_nulls(spark):
    _, _, stays = _frames(spark)
    first = C.first_per_group(stays, "hadm_id", ["intime", "icustay_id"])
    got = {r.hadm_id: r.icustay_id for r in first.collect()}
    assert got == {10: 100, 20: 200, 30: 300, 40: 400, 50: 500}


def test_build_cohort_filters(spark):
    adm, pat, stays = _frames(spark)
    co = C.build_cohort(adm, pat, stays, min_age=18, max_age=100)
    rows = {r.hadm_id: r for r in co.collect()}
    # hadm 20: subject born 2000-12-31 -> age 1 -> dropped; 30: NICU; 40: age 111;
    # 50: NULL unit (NOT IN drops NULL)
    assert set(rows) == {10}
    r = rows[10]
    assert r.icustay_id == 100 and r.age == 41 and r.prolonged_los == 0
    assert co.columns[:3] == ["subject_id", "hadm_id", "icustay_id"]


def test_first_per_group_plans(spark, capsys):
    from pyspark.sql import functions as F
    _, _, stays = _frames(spark)
    first = C.first_per_group(stays, "hadm_id", ["intime", "icustay_id"])
    first.explain("formatted")
    plan = capsys.readouterr().out
    assert "Aggregate" in plan and "Window" not in plan
    byw = C.first_per_group(stays, "hadm_id", [F.asc_nulls_first("intime"), "icustay_id"])
    byw.explain("formatted")
    assert "WindowGroupLimit" in capsys.readouterr().out
    assert sorted(byw.collect()) == sorted(first.collect())
