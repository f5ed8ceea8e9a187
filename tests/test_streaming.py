import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayscope.operators import events as EV
from stayscope.streaming import alerts as A

T0 = dt.datetime(2024, 1, 1)
SCHEMA = T.StructType([T.StructField("hadm_id", T.LongType()),
                       T.StructField("item_name", T.StringType()),
                       T.StructField("charttime", T.TimestampNTZType()),
                       T.StructField("valuenum", T.DoubleType())])
THR = {"lactate": 2.5, "creatinine": 2.0}


def test_stream_alerts_match_batch_and_replay_is_idempotent(spark, tmp_path):
    src = tmp_path / "src"
    part1 = [(1, "lactate", T0 + dt.timedelta(hours=1), 3.0),     # breach
             (1, "lactate", T0 + dt.timedelta(hours=2), 4.0),     # breach
             (2, "creatinine", T0 + dt.timedelta(hours=1), 1.0),  # no breach
             (3, "lactate", T0 + dt.timedelta(hours=9), 9.0)]     # outside 6 h
    part2 = [(2, "creatinine", T0 + dt.timedelta(hours=5), 2.5),  # breach (2nd batch)
             (1, "lactate", T0 + dt.timedelta(minutes=5), 5.0)]   # stay 1 again, and earlier
    spark.createDataFrame(part1, SCHEMA).coalesce(1).write.parquet(str(src / "a"))
    spark.createDataFrame(part2, SCHEMA).coalesce(1).write.parquet(str(src / "b"))
    anchors = spark.createDataFrame([(i, i + 100, T0) for i in (1, 2, 3)],
                                    "hadm_id long, icustay_id long, intime timestamp_ntz")

    def run(out, progress):
        stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
                  .option("recursiveFileLookup", True).parquet(str(src)))
        b = A.breach_stream(stream, anchors, "hadm_id", "hadm_id", THR, out_key="icustay_id")
        A.start_alerts(b, out, progress).awaitTermination()
        return A.read_alerts(spark, out)

    out, progress = str(tmp_path / "alerts"), str(tmp_path / "progress")
    got = run(out, progress)
    assert sorted(r.icustay_id for r in got.collect()) == [101, 102]
    batch_ev = spark.createDataFrame(part1 + part2, SCHEMA)
    batch = EV.threshold_alert(batch_ev, anchors, "hadm_id", "hadm_id", THR,
                               out_key="icustay_id").where("alert = 1")
    assert sorted(r.icustay_id for r in batch.collect()) == [101, 102]
    full = lambda df: sorted((r.icustay_id, r.first_breach, r.n_breaches) for r in df.collect())
    assert full(got) == full(batch) and full(got)[0][1:] == (T0 + dt.timedelta(minutes=5), 3)
    # restart on the same progress folder: nothing new, nothing duplicated
    again = run(out, progress)
    assert full(again) == full(batch)
    assert again.groupBy("icustay_id").count().where(F.col("count") > 1).count() == 0
