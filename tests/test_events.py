import datetime as dt

from stayscope.operators import events as EV

D = dt.datetime
T0 = D(2024, 1, 1, 0, 0, 0)


def test_window_bounds_and_filters(spark):
    anchors = spark.createDataFrame([(1, T0), (2, T0)], "icustay_id long, intime timestamp_ntz")
    ev = spark.createDataFrame([
        (1, "hr", T0, 80.0, None),                               # at intime -> in
        (1, "hr", D(2024, 1, 2, 0, 0, 0), 90.0, 0),              # +24h -> in
        (1, "hr", D(2024, 1, 2, 0, 0, 1), 95.0, None),           # +24h+1s -> out
        (1, "hr", D(2023, 12, 31, 23, 59, 59), 70.0, None),      # -1s -> out
        (1, "hr", T0, 0.0, None), (1, "hr", T0, -1.0, None),     # non-positive -> out
        (1, "hr", T0, None, None),                                # NULL -> out
        (1, "hr", T0, 85.0, 1),                                   # error -> out
        (2, "sbp", T0, 120.0, None), (3, "hr", T0, 60.0, None),  # 3 has no anchor
        (2, "other", T0, 5.0, None),                              # not a listed code
    ], "icustay_id long, itemid string, charttime timestamp_ntz, valuenum double, error int")
    f = EV.filter_measurements(ev, ["hr", "sbp"], error_col="error")
    w = EV.window_join(f, anchors, "icustay_id", "icustay_id", window_hours=24)
    got = sorted((r.icustay_id, r.valuenum) for r in w.collect())
    assert got == [(1, 80.0), (1, 90.0), (2, 120.0)]
    whole = EV.window_join(f, anchors, "icustay_id", "icustay_id", window_hours=None)
    assert whole.count() == 5


def test_wide_stats_fixed_schema_and_master(spark):
    ev = spark.createDataFrame([(1, "hr", 80.0), (1, "hr", 100.0), (2, "sbp", 120.0)],
                               "icustay_id long, item_name string, valuenum double")
    wide = EV.wide_stats(ev, "icustay_id", ["hr", "sbp", "absent"])
    assert wide.columns == ["icustay_id"] + EV.feature_names(["hr", "sbp", "absent"])
    cohort = spark.createDataFrame([(1,), (2,), (3,)], "icustay_id long")
    m = {r.icustay_id: r for r in EV.master_join(cohort, wide).collect()}
    assert m[1].mean_hr == 90.0 and m[1].min_hr == 80.0 and m[1].max_sbp is None
    assert m[3].mean_hr is None and m[2].mean_absent is None


def test_semi_join_and_lookup(spark):
    ev = spark.createDataFrame([(1, 220045), (2, 1), (None, 220045)], "icustay_id long, itemid int")
    keys = spark.createDataFrame([(1,), (None,)], "k long")
    assert [r.icustay_id for r in EV.restrict_to(ev, keys, "icustay_id", "k").collect()] == [1]
    named = EV.name_items(ev, {220045: "heart_rate"}).orderBy("icustay_id").collect()
    assert [r.item_name for r in named] == ["heart_rate", "heart_rate", None]


def test_threshold_alert(spark):
    anchors = spark.createDataFrame([(1, T0), (2, T0)], "icustay_id long, intime timestamp_ntz")
    ev = spark.createDataFrame([
        (1, "lactate", D(2024, 1, 1, 5), 3.0), (1, "lactate", D(2024, 1, 1, 7), 9.0),
        (2, "creatinine", D(2024, 1, 1, 1), 1.5)],
        "icustay_id long, item_name string, charttime timestamp_ntz, valuenum double")
    out = {r.icustay_id: r for r in EV.threshold_alert(
        ev, anchors, "icustay_id", "icustay_id", {"lactate": 2.5, "creatinine": 2.0}).collect()}
    assert out[1].alert == 1 and out[1].n_breaches == 1
    assert out[1].first_breach == D(2024, 1, 1, 5)
    assert out[2].alert == 0 and out[2].n_breaches == 0
