"""A single key holding a third of all rows must not change results (and is
pre-combined map-side; AQE splits skewed join partitions)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayscope.operators import cohort as C
from stayscope.operators import events as EV
from stayscope.operators import stats as ST

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(2)
    n = 30000
    keys = np.where(np.arange(n) % 3 == 0, 7, rng.integers(0, 500, size=n))   # key 7: 1/3 of rows
    secs = rng.integers(0, 3 * 86400, size=n)
    vals = np.round(rng.uniform(0.1, 200, size=n), 2)
    rows = [(int(k), "hr" if i % 2 else "sbp", T0 + dt.timedelta(seconds=int(s)), float(v))
            for i, (k, s, v) in enumerate(zip(keys, secs, vals))]
    ev = spark.createDataFrame(rows, "icustay_id long, item_name string, "
                                     "charttime timestamp_ntz, valuenum double")
    anchors = spark.range(500).select(F.col("id").alias("icustay_id"),
                                      F.lit(T0).cast("timestamp_ntz").alias("intime"))
    return ev, anchors, rows


def test_window_join_and_wide_stats_hot_key(spark, skewed):
    ev, anchors, rows = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # force a shuffle join
    try:
        w = EV.window_join(ev, anchors, "icustay_id", "icustay_id", window_hours=24)
        wide = {r.icustay_id: r for r in EV.wide_stats(w, "icustay_id", ["hr", "sbp"]).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    inwin = [r for r in rows if r[2] <= T0 + dt.timedelta(hours=24)]
    hot = [r[3] for r in inwin if r[0] == 7 and r[1] == "hr"]
    assert wide[7].max_hr == max(hot) and wide[7].min_hr == min(hot)
    assert wide[7].mean_hr == pytest.approx(sum(hot) / len(hot))
    assert len(wide) == len({r[0] for r in inwin})


def test_first_per_group_hot_key(spark, skewed):
    ev, _, rows = skewed
    first = {r.icustay_id: r for r in
             C.first_per_group(ev, "icustay_id", ["charttime", "valuenum", "item_name"]).collect()}
    hot = min((r for r in rows if r[0] == 7), key=lambda r: (r[2], r[3], r[1]))
    assert (first[7].charttime, first[7].valuenum) == (hot[2], hot[3])


def test_grouped_median_hot_key(spark, skewed):
    ev, _, rows = skewed
    med = {r.icustay_id: r.median for r in
           ST.exact_medians(ev, "valuenum", ["icustay_id"], bracket_values=1).collect()}
    hot = [r[3] for r in rows if r[0] == 7]
    assert med[7] == pytest.approx(float(np.median(hot)), abs=1e-12)


def test_salted_window_join_same_result(spark, skewed):
    ev, anchors, _ = skewed
    plain = EV.window_join(ev, anchors, "icustay_id", "icustay_id", window_hours=24)
    salted = EV.window_join(ev, anchors, "icustay_id", "icustay_id", window_hours=24, salt=8)
    assert salted.columns == plain.columns
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_hot_stay_is_split_below_the_aggregate(spark, skewed):
    ev, anchors, _ = skewed
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        w = EV.window_join(ev.repartition(16), anchors, "icustay_id", "icustay_id", window_hours=24)
        wide = EV.wide_stats(w, "icustay_id", ["hr", "sbp"])
        wide.collect()
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan            # the hot stay's partition is read in parts
        final = plan[:plan.index("Initial Plan")]
        assert "partial_" in final            # and pre-aggregated before the next shuffle
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
