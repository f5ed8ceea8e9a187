"""Sinks: write one table, or publish a bundle of named reporting tables."""

from __future__ import annotations

import os
import re
import time
import uuid
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> str:
    """Distributed write (one file per task).  CSV gets a header line.
    ``sort_by`` writes globally ordered files (range-partitioned sort, e.g.
    the cohort by admission time then id)."""
    if sort_by:
        df = df.orderBy(*sort_by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        # header line and plain "yyyy-MM-dd HH:mm:ss" timestamps, as read by read_csv
        writer = (writer.option("header", True)
                  .option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
                  .option("timestampFormat", CSV_TIMESTAMP_FORMAT))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def order_manifest(ordered: DataFrame, sort_by: Sequence[str], position_col: str = "position",
                   rows_per_range: int = 1_000_000) -> DataFrame:
    """(part, rows, first, last, in_order) of a table read back by
    ``read_in_order``: for each range of positions its row count and first and
    last sort keys, and whether no row precedes the row before it, across the
    ranges' borders too.  The table is in order if every range is."""
    key = F.struct(*sort_by)
    rows = ordered.select(F.floor(F.col(position_col) / rows_per_range).alias("part"),
                          F.col(position_col).alias("__p"), key.alias("__k"))
    inside = Window.partitionBy("part").orderBy("__p")
    steps = rows.withColumn("__back", F.coalesce(F.lag("__k").over(inside) > F.col("__k"), F.lit(False)))
    parts = steps.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.min_by("__k", "__p").alias("first"),
                                      F.max_by("__k", "__p").alias("last"), F.max("__back").alias("__back"))
    border = F.lag("last").over(Window.orderBy("part"))          # one row a range
    return parts.select("part", "rows", "first", "last",
                        (~F.col("__back") & F.coalesce(border <= F.col("first"), F.lit(True))).alias("in_order"))


def _slug(name: str) -> str:
    return re.sub(r"[^0-9a-zA-Z]+", "_", name).strip("_").lower()


def publish(tables: dict[str, DataFrame], root: str, aggregates: Collection[str] = (),
            fmt: str = "parquet", include_row_level: bool = False) -> dict[str, str]:
    """Publish named tables, each as its own dataset directory under ``root``.

    Every table is taken to be row-level, and is skipped unless
    ``include_row_level``, except those the caller names in ``aggregates``:
    only aggregates are meant to be shared, and a table nobody vouched for
    stays private.  All tables keep their partitions.
    """
    written: dict[str, str] = {}
    for name, df in tables.items():
        if name in aggregates or include_row_level:
            written[name] = write_table(df, os.path.join(root, _slug(name)), fmt=fmt)
    return written


MANIFESTS = "_manifests"
MANIFEST_SCHEMA = ("bundle string, committed_at double, table string, folder string, format string, rows long, "
                   "withheld_rows long, least_group long")


def withhold_small_groups(df: DataFrame, least_group: int, count_col: str = "total_patients"
                          ) -> tuple[DataFrame, DataFrame]:
    """(shown, withheld) rows of an aggregate: a group of fewer than
    ``least_group`` members (or of an unknown number) is not shown."""
    enough = F.coalesce(F.col(count_col) >= least_group, F.lit(False))
    return df.where(enough), df.where(~enough)


def publish_bundle(spark: SparkSession, tables: Mapping[str, DataFrame], root: str,
                   aggregates: Collection[str], least_group: int = 1, count_col: str = "total_patients",
                   fmt: str = "parquet") -> DataFrame:
    """Publish the named aggregates of ``tables`` as one bundle, all or none;
    returns the bundle's manifest, one row a table.

    Tables are written to a folder of their own under ``root``; the bundle
    exists once its manifest is written, a single small dataset, after the last
    table.  A failure before that leaves the published bundle as it was, and
    readers (``read_bundle``) never see a folder without a manifest.  Of
    aggregates that count members in ``count_col``, groups below ``least_group``
    are withheld and counted in the manifest.  Row-level tables are not shared.
    """
    bundle = f"bundle-{uuid.uuid4().hex[:12]}"
    entries = []
    for name, df in tables.items():
        if name not in aggregates:
            continue
        folder, withheld = os.path.join(bundle, _slug(name)), 0
        if count_col in df.columns and least_group > 1:
            df, small = withhold_small_groups(df, least_group, count_col)
            withheld = small.count()
        path = write_table(df, os.path.join(root, folder), fmt=fmt, mode="error")
        entries.append((name, folder, spark.read.schema(df.schema).format(fmt).option("header", True)
                        .load(path).count(), withheld))
    now = time.time()
    manifest = spark.createDataFrame([(bundle, now, name, folder, fmt, rows, withheld, least_group)
                                      for name, folder, rows, withheld in entries], MANIFEST_SCHEMA)
    manifest.coalesce(1).write.mode("error").parquet(os.path.join(root, MANIFESTS, bundle))
    return spark.read.schema(MANIFEST_SCHEMA).parquet(os.path.join(root, MANIFESTS, bundle))


def read_bundle(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the bundle that was committed last."""
    rows = (spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True)
            .parquet(os.path.join(root, MANIFESTS)).collect())          # a row a published table
    last = max(((r["committed_at"], r["bundle"]) for r in rows), default=(0, ""))[1]
    return {r["table"]: spark.read.format(r["format"]).option("header", True).load(os.path.join(root, r["folder"]))
            for r in rows if r["bundle"] == last}
