"""Rejected CSV lines, ordered files, laid-out logs, time-bucket joins, bundles."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayscope.operators import events as EV
from stayscope.session import scratch_path
from stayscope.sources import (lay_out, order_manifest, publish_bundle, read_bundle, read_csv_with_rejects,
                               read_in_order, write_table)
from stayscope.sources.sinks import withhold_small_groups

T0 = dt.datetime(2024, 3, 1)


def test_rejected_lines_are_kept_as_text(spark):
    lines = ["id,v,t", "1,2.5,2024-01-01 10:00:00", "2,abc,2024-01-01 10:00:00", "3,1.5", "4,1,noon",
             "5,,", "6,1.5,2024-01-01 10:00:00,more", "x,1,", "7,3.5,2024-02-30 10:00:00"]
    path = scratch_path(spark, "bad-csv")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    good, bad = read_csv_with_rejects(spark, path, T.StructType.fromDDL("id long, v double, t timestamp_ntz"))
    assert sorted(map(tuple, good.collect())) == [(1, 2.5, dt.datetime(2024, 1, 1, 10)), (5, None, None)]
    assert sorted(r["text"] for r in bad.collect()) == sorted(lines[i] for i in (2, 3, 4, 6, 7, 8))
    assert {r["file"] for r in bad.collect()} and good.columns == ["id", "v", "t"]
    # a narrower read sees the same rows
    assert good.select("id").count() == 2 and bad.count() == 6


def test_rows_come_back_in_their_order(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")          # many blocks a file
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = spark.range(3000).select(((F.col("id") * 7919) % 3000).alias("k"), F.concat(F.lit("v"), "id").alias("v"))
        path = write_table(df.repartition(5), scratch_path(spark, "ordered"), fmt="csv", sort_by=["k"])
        back = read_in_order(spark, path, df.schema)
        got = {r["k"]: r["position"] for r in back.collect()}
        assert got == {i: i for i in range(3000)}
        parts = order_manifest(back, ["k"], rows_per_range=700).orderBy("part").collect()
        assert [r["rows"] for r in parts] == [700] * 4 + [200] and all(r["in_order"] for r in parts)
        assert [(r["first"]["k"], r["last"]["k"]) for r in parts][1] == (700, 1399)
        loose = back.withColumn("position", F.when(F.col("k") == 5, 1400).when(F.col("k") == 1400, 5)
                                .otherwise(F.col("position")))
        assert [r["in_order"] for r in order_manifest(loose, ["k"], rows_per_range=700).orderBy("part").collect()] == [
            False, True, False, True, True]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_laid_out_log_is_not_shuffled(spark):
    ev = spark.range(4000).select((F.col("id") % 97).alias("icustay_id"), (F.col("id") % 5).cast("string").alias("itemid"),
                                  (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") % 3000).cast("int"))).alias("charttime"),
                                  F.col("id").cast("double").alias("valuenum"))
    anchors = spark.range(90).select(F.col("id").alias("icustay_id"), F.lit(T0).cast("timestamp_ntz").alias("intime"))
    log = lay_out(ev, "icustay_id", 6, ["itemid"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = EV.wide_stats(EV.window_join(log, anchors, "icustay_id", "icustay_id").withColumnRenamed("itemid", "item_name"),
                            "icustay_id", ["0", "1"])
        plan = out._jdf.queryExecution().sparkPlan().toString()
        physical = out._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(str, out.collect()))
        want = EV.wide_stats(EV.window_join(ev, anchors, "icustay_id", "icustay_id").withColumnRenamed("itemid", "item_name"),
                             "icustay_id", ["0", "1"])
        assert got == sorted(map(str, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in physical and "Exchange" not in plan
    assert physical.count("Exchange hashpartitioning") == 1            # the anchors' side alone
    scan = physical[physical.index("Bucketed: true") - 400:]
    assert "Exchange" not in scan[:scan.index("Bucketed: true")].split("\n")[-1]


def _hot(spark, stays=300, events=4000):
    """One episode that holds all stays and events, spread over 75 days, plus edges."""
    a = [(1, i, T0 + dt.timedelta(hours=6 * i)) for i in range(stays)] + [(2, 900, T0), (3, 901, None)]
    e = [(1, T0 + dt.timedelta(minutes=27 * i), float(i)) for i in range(events)]
    e += [(2, T0, 1.0), (2, T0 + dt.timedelta(hours=24), 2.0), (2, T0 + dt.timedelta(hours=24, seconds=1), 3.0),
          (2, T0 - dt.timedelta(seconds=1), 4.0), (3, T0, 5.0), (2, None, 6.0), (None, T0, 7.0)]
    return (spark.createDataFrame(e, "hadm_id long, charttime timestamp_ntz, valuenum double"),
            spark.createDataFrame(a, "hadm_id long, icustay_id long, intime timestamp_ntz"))


@pytest.mark.parametrize("hours", [6, 24, 100])
def test_time_bucket_join_equals_window_join(spark, hours):
    ev, anchors = _hot(spark, 60, 600)
    args = dict(window_hours=hours, anchor_cols=["icustay_id"])
    plain = EV.window_join(ev, anchors, "hadm_id", "hadm_id", **args)
    fast = EV.window_join_by_time(ev, anchors, "hadm_id", "hadm_id", **args)
    assert sorted(map(tuple, plain.select(fast.columns).collect())) == sorted(map(tuple, fast.collect()))
    assert fast.columns == [*ev.columns, "icustay_id"]


def test_hot_episode_reads_near_its_result(spark):
    ev, anchors = _hot(spark)
    sides = EV.bucketed_sides(ev, anchors, "hadm_id", "hadm_id", "charttime", "intime", 24, 6, ["icustay_id"])
    read = sides[0].join(sides[1], sides[2]).count()                   # rows that the interval test reads
    result = EV.window_join_by_time(ev, anchors, "hadm_id", "hadm_id", anchor_cols=["icustay_id"]).count()
    assert result > 10_000 and read <= 1.6 * result
    assert read < 300 * 4000 / 50
    with pytest.raises(ValueError):
        EV.bucketed_sides(ev, anchors, "hadm_id", "hadm_id", "charttime", "intime", 24, 5)


def test_bundle_is_all_or_none(spark):
    root = scratch_path(spark, "bundles")
    good = spark.createDataFrame([("a", 12), ("b", 3), ("c", None)], "k string, total_patients long")
    rows = spark.createDataFrame([(1,)], "subject_id long")
    manifest = publish_bundle(spark, {"By K": good, "plain": rows, "people": rows}, root, ["By K", "plain"], least_group=11)
    got = {r["table"]: r for r in manifest.collect()}
    assert set(got) == {"By K", "plain"}
    assert (got["By K"]["rows"], got["By K"]["withheld_rows"], got["plain"]["rows"]) == (1, 2, 1)
    assert [tuple(r) for r in read_bundle(spark, root)["By K"].collect()] == [("a", 12)]

    broken = good.withColumn("k", F.raise_error(F.lit("no such table")).cast("string"))
    with pytest.raises(Exception, match="no such table"):
        publish_bundle(spark, {"plain": rows.union(rows), "By K": broken}, root, ["plain", "By K"])
    assert len(os.listdir(os.path.join(root, "_manifests"))) == 1
    assert read_bundle(spark, root)["plain"].count() == 1              # still the first bundle

    publish_bundle(spark, {"plain": rows.union(rows)}, root, ["plain"])
    now = read_bundle(spark, root)
    assert set(now) == {"plain"} and now["plain"].count() == 2


def test_small_groups(spark):
    df = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "k long, n long")
    shown, small = withhold_small_groups(df, 11, "n")
    assert [r["k"] for r in shown.collect()] == [2] and sorted(r["k"] for r in small.collect()) == [1, 3]
