"""A measurement log laid out by its join key, written once and joined often."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..session import scratch_path


def lay_out(df: DataFrame, key: str, buckets: int, sort_by: Sequence[str] = (), name: str = "measurements",
            path: str | None = None) -> DataFrame:
    """``df`` as a table bucketed by ``key`` (rows of a key share a bucket, and
    are sorted by ``sort_by`` within it), read back.

    A join or an aggregation on the key then reads the buckets as they are: only
    the other side of a join is shuffled, to the same ``buckets``, and the log never.
    Choose buckets of some 100 to 200 MB.  ``path`` defaults to the shared folder;
    the table's name, unique to the run, lives in the session's catalog.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    table = "".join(c if c.isalnum() else "_" for c in path.rstrip("/").rsplit("/", 1)[-1])
    # one task a bucket, so that a bucket is one file
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.format("parquet").option("path", path).saveAsTable(table)
    return spark.table(table)
