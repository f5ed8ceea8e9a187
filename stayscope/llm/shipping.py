"""Prepares a session for the Arrow tasks: the package's source goes to the
executors, so that tasks can import it wherever the driver was started from,
and Arrow batches hold fewer rows, since the rows are whole texts."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"
PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """The package as a zip file through ``addPyFile``, once an application;
    a smaller batch size unless the session sets its own."""
    sc = spark.sparkContext
    if spark.conf.get(BATCH, "10000") == "10000":        # Spark's default
        spark.conf.set(BATCH, BATCH_ROWS)
    if getattr(sc, "_stayscope_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="stayscope-source-")        # read by the driver only
    path = os.path.join(folder, "stayscope_source.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for here, _, names in os.walk(PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(here, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    sc.addPyFile(path)
    sc._stayscope_shipped = True
