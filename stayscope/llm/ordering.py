"""Row numbers of a distributed order: ranges are numbered by themselves and
the ranges' counts give the offsets."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import stored


def _number(group: str):
    def run(batches):
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            runs = pc.run_end_encode(batch.column(group))
            local, start = np.arange(len(batch), dtype=np.int64), 0
            for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if value != last:
                    last, seen = value, 0
                local[start:end] += seen - start
                seen, start = seen + end - start, end
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(batch), part, np.int32)), pa.array(local)],
                [*batch.schema.names, "part", "local"])
    return run


def numbered(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``pos``, the row's place from 0 in ``order`` within its
    ``group`` (a non-null string), and ``n``, the group's rows.

    Rows are dealt by ranges of (group, order), so a group that holds most of
    the rows is cut into many ranges; only one count a (range, group) is
    ordered as a whole.  Rows that agree in all of ``order`` are numbered in any
    order.  ``df`` must not have columns ``part``, ``local``, ``pos`` or ``n``.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType()),
                           T.StructField("local", T.LongType())])
    placed = stored(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                    .mapInArrow(_number(group), schema), "placed")
    whole = Window.partitionBy(group)
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = placed.groupBy("part", group).count().select(
        "part", group, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"),
        F.sum("count").over(whole).alias("n"))
    return placed.join(offset, ["part", group]).select(
        *df.columns, (F.col("offset") + F.col("local")).alias("pos"), "n")
