import datetime as dt
import os

from pyspark.sql import types as T

from stayscope.operators import report as R
from stayscope.sources import literal_table, publish, read_csv, select_existing, write_table


def _cohort(spark):
    rows = [(i, 20 + i * 7 % 70, "M" if i % 2 else "F", "EMERGENCY" if i % 3 else "ELECTIVE",
             "MICU" if i % 4 else "SICU", i % 5 == 0 and 1 or 0, int(i % 9 > 6), 1.0 + i % 11,
             dt.datetime(2001, 1, 1 + i % 28, i % 24))
            for i in range(200)]
    return spark.createDataFrame(rows, "icustay_id long, age int, gender string, "
                                       "admission_type string, first_careunit string, "
                                       "hospital_expire_flag int, prolonged_los int, "
                                       "icu_los_days double, admittime timestamp_ntz")


def test_publish_bundle_keeps_row_level_local(spark, tmp_path):
    co = _cohort(spark)
    imp = literal_table(spark, [("age", 0.1028, "Demographics"), ("mean_lactate", 0.078, "Labs")],
                        "feature string, importance double, category string")
    tables = R.reporting_tables(co, "EMERGENCY", model_auc=0.5, importances=imp)
    tables["scored_test"] = co.repartition(3).select("icustay_id", "hospital_expire_flag")
    out = publish(tables, str(tmp_path / "bundle"), aggregates=R.AGGREGATE_TABLES)
    assert set(out) == set(R.AGGREGATE_TABLES)       # unlisted tables stay private
    assert publish(tables, str(tmp_path / "none")) == {}
    every = publish(tables, str(tmp_path / "every"), include_row_level=True)
    assert set(every) == set(tables)
    assert spark.read.parquet(every["scored_test"]).rdd.getNumPartitions() >= 1
    assert len(list((tmp_path / "every" / "scored_test").glob("part-*"))) == 3
    kpi = spark.read.parquet(out["kpi_summary"]).first()
    assert kpi.total_patients == 200 and kpi.care_units_covered == 2
    fi = {r.feature: r for r in spark.read.parquet(out["feature_importance"]).collect()}
    assert fi["mean_lactate"].feature_label == "Avg Lactate"
    assert fi["age"].importance_pct == 56.9
    out2 = publish({"patient_level": tables["patient_level"]}, str(tmp_path / "local"),
                   include_row_level=True)
    assert spark.read.parquet(out2["patient_level"]).count() == 200


def test_csv_round_trip_typed(spark, tmp_path):
    co = _cohort(spark)
    path = write_table(select_existing(co, ["icustay_id", "admittime", "age", "nope", "age"]),
                       str(tmp_path / "c.csv"), fmt="csv")
    schema = T.StructType([T.StructField("icustay_id", T.LongType()),
                           T.StructField("admittime", T.TimestampNTZType()),
                           T.StructField("age", T.IntegerType())])
    back = read_csv(spark, path, schema)
    assert back.count() == 200
    assert back.where("admittime IS NULL").count() == 0
    assert sorted(back.collect()) == sorted(co.select("icustay_id", "admittime", "age").collect())
    data_lines = [ln for f in sorted(os.listdir(path)) if f.endswith(".csv")
                  for ln in open(os.path.join(path, f)).read().splitlines()[1:]]
    assert data_lines and all(ln.count(":") == 2 and "T" not in ln for ln in data_lines)
    assert os.path.isdir(path)
