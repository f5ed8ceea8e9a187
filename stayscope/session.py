"""Session helpers: sane defaults for local runs, shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every stayscope job relies on.  Timestamps are wall-clock
# (TIMESTAMP_NTZ) values, UTC keeps string rendering stable; AQE re-plans
# joins (broadcast only under the size threshold) and splits skewed
# partitions at run time.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's join partition even where the group-by above it then
    # needs one more (pre-aggregated) shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Suggested settings for a large cluster (hundreds of executors, ~100 TB of
# input).  AQE sizes shuffle partitions from the data (start high, coalesce
# to ~256 MB), splits skewed join partitions, and broadcasts only sides
# measured under the threshold at run time.
CLUSTER_CONF = {
    **{k: v for k, v in DEFAULT_CONF.items() if k != "spark.ui.enabled"},
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app: str = "stayscope", extra_conf: dict | None = None) -> SparkSession:
    """A local session for tests and benches (one JVM, ``cores`` threads)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_session(app: str = "stayscope", overrides: dict | None = None) -> SparkSession:
    """A session for a cluster launch (master and resources come from the
    launcher).  Applies ``CLUSTER_CONF``; the shared checkpoint folder must be
    configured by the cluster as ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.appName(app)
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the operator (a shared file
    system), and an unset one is an error; only a local master gets a fresh
    scratch folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local") or "-cluster" in spark.sparkContext.master:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="stayscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder (never machine-local
    on a cluster) for intermediate tables and saved models."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


_written: list[str] = []           # folders that ``stored`` wrote in this process, in order

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleanup_lock, _cleanups = threading.Lock(), {"now": 0, "before": None}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of the queries that run here when each
    ends, instead of when the driver happens to collect its garbage.  The
    session's own setting holds again when the last thread leaves."""
    with _cleanup_lock:
        if not _cleanups["now"]:
            _cleanups["before"] = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _cleanups["now"] += 1
    try:
        yield
    finally:
        with _cleanup_lock:
            _cleanups["now"] -= 1
            if not _cleanups["now"]:
                if _cleanups["before"] is None:
                    spark.conf.unset(SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP, _cleanups["before"])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: its
    lineage ends there, and readers scan only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_so_far() -> int:
    """A mark for ``remove_written``: how many tables were stored until now."""
    return len(_written)


def remove_written(spark: SparkSession, since: int, keep: DataFrame) -> None:
    """Delete the tables stored after the mark ``since``, except those that
    ``keep`` reads.  For when a job's result has been stored: nothing reads its
    intermediate tables again."""
    held = _folders(keep)
    kept = [f for f in _written[since:] if os.path.basename(f) in held]
    _delete(spark, [f for f in _written[since:] if os.path.basename(f) not in held])
    _written[since:] = kept


def drop_stored(table: DataFrame) -> None:
    """Delete a stored table whose readers have all been stored themselves."""
    held = _folders(table)
    _delete(table.sparkSession, [f for f in _written if os.path.basename(f) in held])


def _folders(table: DataFrame) -> set[str]:
    # a stored folder's own name is unique, whatever scheme its path is given by
    return {f.rsplit("/", 2)[-2] for f in table.inputFiles()}


def _delete(spark: SparkSession, folders: list[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
