"""Sources: typed Parquet / CSV scans and literal relations.

Scans always carry an explicit schema (no inference pass over the data) and
are projected as early as possible so that Catalyst prunes columns and pushes
filters into the Parquet reader.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

_L, _I, _D, _S = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
_TS = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Schemas of the star-schema test tables (Parquet, one file per table).
TABLE_SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I),
                        ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
    "documents": _schema(("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S),
                         ("n_chars", _L)),
    "embeddings": _schema(("vec_id", _L), ("embedding", T.ArrayType(T.FloatType())),
                          ("label", _I)),
    "pages": _schema(("page_id", _L), ("url", _S), ("html", _S)),
    "benchmark": _schema(("item_id", _L), ("text", _S)),
    "labels": _schema(("doc_id", _L), ("quality", _I), ("toxic", _I)),
    "conversations": _schema(("conv_id", _L), ("turn", _L), ("role", _S), ("text", _S)),
}


def table_path(root: str, name: str) -> str:
    return os.path.join(root, f"{name}.parquet")


def read_table(spark: SparkSession, root: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Scan ``{root}/{name}.parquet`` with its declared schema.

    ``columns`` projects immediately (ReadSchema shrinks to those columns).
    """
    schema = TABLE_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(table_path(root, name))
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
             header: bool = True) -> DataFrame:
    """Typed CSV scan (no inference); timestamp columns parse with
    ``timestamp_format``.  Covers the inter-stage CSV hand-offs."""
    return (spark.read.schema(schema)
            .option("header", header)
            .option("timestampNTZFormat", timestamp_format)
            .option("timestampFormat", timestamp_format)
            .option("mode", "FAILFAST")
            .csv(path))


REJECT_COLUMN = "_rejected_text"


def read_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType,
                          timestamp_format: str = "yyyy-MM-dd HH:mm:ss", header: bool = True
                          ) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): a typed CSV scan that does not stop at bad lines.

    A line is rejected if a field does not parse as its column's type or their
    number is not the schema's; ``rejected`` holds its text and its file.  The
    file is parsed once, all columns together (a narrower scan would not see bad
    fields of other columns), and written to the shared folder, which both
    tables read.
    """
    whole = T.StructType([*schema.fields, T.StructField(REJECT_COLUMN, T.StringType(), True)])
    rows = (spark.read.schema(whole)
            .option("header", header)
            .option("timestampNTZFormat", timestamp_format)
            .option("timestampFormat", timestamp_format)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", REJECT_COLUMN)
            .csv(path))
    rows = stored(rows.withColumn("_rejected_file", F.col("_metadata.file_name")), "csv-rows")
    accepted = rows.where(F.col(REJECT_COLUMN).isNull()).select(*schema.names)
    rejected = rows.where(F.col(REJECT_COLUMN).isNotNull()).select(
        F.col(REJECT_COLUMN).alias("text"), F.col("_rejected_file").alias("file"))
    return accepted, rejected


def read_in_order(spark: SparkSession, path: str, schema: T.StructType, position_col: str = "position",
                  timestamp_format: str = "yyyy-MM-dd HH:mm:ss", header: bool = True) -> DataFrame:
    """A CSV dataset with every row's place, from 0, in the order of its files
    and of the lines in them.

    A scan reads a file in blocks, and within one block rows come in line order;
    the blocks' row counts, a small table, give the offsets.  Nothing is sorted
    but rows of one block by their running number.
    """
    rows = (spark.read.schema(schema)
            .option("header", header)
            .option("timestampNTZFormat", timestamp_format)
            .option("timestampFormat", timestamp_format)
            .option("mode", "FAILFAST")
            .csv(path))
    rows = stored(rows.select("*", F.col("_metadata.file_name").alias("__file"),
                              F.col("_metadata.file_block_start").alias("__block"),
                              F.monotonically_increasing_id().alias("__line")), "csv-lines")
    # part numbers grow a digit after part-99999
    before = Window.orderBy(F.length("__file"), "__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    offset = rows.groupBy("__file", "__block").count().select(
        "__file", "__block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"))
    line = F.row_number().over(Window.partitionBy("__file", "__block").orderBy("__line")) - 1
    return (rows.withColumn("__line", line).join(offset, ["__file", "__block"])
            .select(*schema.names, (F.col("__offset") + F.col("__line")).alias(position_col)))


def parse_timestamps(df: DataFrame, cols: Sequence[str], fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """String columns to timestamps; text that does not follow ``fmt``
    becomes NULL."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(fmt)).cast("timestamp_ntz") for c in cols})


def literal_table(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str
                  ) -> DataFrame:
    """A small literal relation (dictionaries, fallback KPI literals)."""
    return spark.createDataFrame(list(rows), schema)


def inline_relation(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """A literal array of structs opened as a relation inside the query: it is
    part of the plan, so the optimiser sees its values and size."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def columns_with_prefix(df: DataFrame, prefixes: Sequence[str], also: Iterable[str] = ()) -> list[str]:
    """Column names that start with one of ``prefixes``, in schema order, then
    those of ``also`` that exist; each once."""
    found = [c for c in df.columns if c.startswith(tuple(prefixes))]
    return list(dict.fromkeys([*found, *[c for c in also if c in df.columns]]))


def select_existing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Select the listed columns that exist, first occurrence only (schema-
    tolerant projection; a repeated name is kept once)."""
    have = set(df.columns)
    seen: list[str] = []
    for c in columns:
        if c in have and c not in seen:
            seen.append(c)
    return df.select(*seen)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """Split the schema into (numeric, dropped non-numeric) column names."""
    skip = set(exclude)
    keep, dropped = [], []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        (keep if isinstance(f.dataType, T.NumericType) else dropped).append(f.name)
    return keep, dropped
