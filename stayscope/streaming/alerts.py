"""Early-warning alerts as a Structured Streaming job.

The batch operator ``events.threshold_alert`` answers "which stays breached
a threshold in their first hours"; here the same rule runs incrementally
over an arriving measurement log:

  readStream (files) -> breach filter (stateless) -> stream-static window
  join to the stay anchors -> foreachBatch: per stay the earliest breach and
  the number of breaches of the micro-batch, in a folder of the epoch.

``read_alerts`` combines the epochs: earliest breach and total count per stay,
equal to the batch operator over all files in whatever order they arrive.
The sink is idempotent: a replayed epoch overwrites its own folder, so a lost
executor or a restarted query does not count a breach twice, and no epoch
rereads another's.  Progress lives in ``checkpointLocation`` on the shared
checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators.events import window_join


def file_stream(spark: SparkSession, directory: str, schema: T.StructType,
                file_glob: str = "*.parquet", max_files_per_trigger: int | None = None
                ) -> DataFrame:
    """Parquet files arriving in ``directory`` (typed, no inference)."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(directory)


def breach_stream(events: DataFrame, anchors: DataFrame, event_key: str, anchor_key: str,
                  thresholds: Mapping[str, float], out_key: str = "icustay_id",
                  name_col: str = "item_name", value_col: str = "valuenum",
                  time_col: str = "charttime", anchor_time: str = "intime",
                  window_hours: float = S.ALERT_WINDOW_HOURS) -> DataFrame:
    """Streaming rows (out_key, charttime, item, value) that breach a
    threshold inside the anchor window (stateless; static anchors)."""
    breach = None
    for name, thr in thresholds.items():
        c = (F.col(name_col) == F.lit(name)) & (F.col(value_col) > F.lit(float(thr)))
        breach = c if breach is None else (breach | c)
    ev = events.where(breach)
    ev = ev.drop(*[c for c in (out_key,) if c != event_key and c in ev.columns])
    extra = [out_key] if out_key != anchor_key else []
    joined = window_join(ev, anchors, event_key, anchor_key, time_col=time_col,
                         anchor_time=anchor_time, window_hours=window_hours, anchor_cols=extra)
    return joined.select(out_key, time_col, name_col, value_col)


def start_alerts(breaches: DataFrame, out_path: str, checkpoint_location: str,
                 out_key: str = "icustay_id", time_col: str = "charttime",
                 available_now: bool = True):
    """Start the alert query: one folder ``epoch=N`` of partial alerts a
    micro-batch under ``out_path``."""

    def emit(batch: DataFrame, epoch_id: int) -> None:
        batch.groupBy(out_key).agg(F.min(time_col).alias("first_breach"),
                                   F.count(F.lit(1)).alias("n_breaches")) \
            .write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")

    writer = (breaches.writeStream.foreachBatch(emit)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_alerts(spark: SparkSession, out_path: str, out_key: str = "icustay_id") -> DataFrame:
    """(out_key, first_breach, n_breaches) over all epochs written so far."""
    return spark.read.parquet(out_path).groupBy(out_key).agg(
        F.min("first_breach").alias("first_breach"), F.sum("n_breaches").alias("n_breaches"))
