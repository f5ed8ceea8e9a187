"""Distributed order statistics and table-level cleaning: running totals,
exact medians, missingness, median imputation, standardisation, histogram.

Each exact order statistic has one path at every size.  A median first takes
a bracket around the middle from a bounded sketch (``percentile_approx``),
counts what lies below it and orders only the distinct values inside; values
outside the bracket never reach the ordered step.  The medians of many columns
share these passes, and the table stays wide in them.  Running totals order inside
ranges whose bounds come from the same kind of sketch; only the small
(group, range) totals table is ordered as a whole.  Group keys are compared
null-safely, so a NULL group is a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clip_upper, round_half_even
from ..session import stored

ROWS_PER_BUCKET = 250_000      # rows one range of a running total should hold
MAX_BUCKETS = 4096             # ranges at most; beyond, ranges grow (and spill)
DEFAULT_ACCURACY = 10_000      # sketch accuracy at least
BRACKET_VALUES = 1_000_000     # values a median's bracket should hold at most


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; the keys come from
    ``left``."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        on = c if on is None else on & c
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def _with_quantile_bucket(df: DataFrame, group_cols: Sequence[str], order_col: str,
                          buckets: int, accuracy: int) -> DataFrame:
    """Tag each row with a bucket id in [0, buckets): the number of
    approximate quantile bounds (of its group) strictly below its value.
    Monotone in the value, so buckets are ordered ranges.

    Grouped: the (group -> bounds) table is written once and equi-joined on
    the group keys (one row per group; AQE broadcasts it by size).  Ungrouped: the
    ``buckets - 1`` bounds are one bounded scalar result, inlined as a
    literal array — no join at all."""
    gcols = list(group_cols)
    probs = [i / buckets for i in range(1, buckets)] or [0.5]
    approx = F.percentile_approx(order_col, probs, accuracy)
    if not gcols:
        return _bucket_from_bounds(df, order_col, df.agg(approx.alias("b")).first()["b"] or [])
    # Sketch merging is order dependent, so the bounds must be computed once
    # and read by every branch that buckets rows: store them (reliably).
    bounds = stored(df.groupBy(*gcols).agg(approx.alias("__bounds")), "bounds")
    tagged = _count_below(join_null_safe(df, bounds, gcols), "__bounds", order_col, len(probs), "__bucket")
    return tagged.drop("__bounds")


def _bucket_from_bounds(df: DataFrame, order_col: str, bounds: Sequence[float]) -> DataFrame:
    """Bucket id from a (bounded) list of sorted bounds inlined as literals."""
    if not bounds:
        return df.withColumn("__bucket", F.lit(0))
    arr = F.lit([float(b) for b in bounds])
    return _count_below(df.withColumn("__bounds", arr), "__bounds", order_col,
                        len(bounds), "__bucket").drop("__bounds")


def _count_below(df: DataFrame, arr: str, x: str, m: int, out: str) -> DataFrame:
    """Number of elements of the sorted array ``arr`` (length ``m``) that are
    strictly below ``x``: binary lifting in log2(m) compare steps, each a
    plain codegen'd expression (kept as separate projections)."""
    pos = "__pos"
    df = df.withColumn(pos, F.lit(0))
    step = 1
    while step * 2 <= m:
        step *= 2
    while step >= 1:
        cand = F.col(pos) + F.lit(step)
        df = df.withColumn(pos, F.when((cand <= F.lit(m)) &
                                       (F.try_element_at(F.col(arr), cand) < F.col(x)), cand)
                           .otherwise(F.col(pos)))
        step //= 2
    return df.withColumnRenamed(pos, out)


def _bucket_offsets(tagged: DataFrame, group_cols: Sequence[str], sum_cols: Sequence[str],
                    order_col: str, previous: Sequence[str] = ()) -> DataFrame:
    """Per (group, bucket): exclusive prefix offsets ``__off_c``, group totals
    ``__all_c`` and the last value ``__last_c`` of the bucket before.  The table
    has at most ``buckets`` rows per group, so ordering it whole is cheap."""
    g = list(group_cols)
    tot = tagged.groupBy(*g, "__bucket").agg(
        *[F.sum(c).alias(f"__tot_{c}") for c in sum_cols],
        *[F.max_by(c, order_col).alias(f"__end_{c}") for c in previous])
    part = Window.partitionBy(*g) if g else Window.partitionBy()
    w = part.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    return tot.select(*g, "__bucket",
                      *[F.lag(f"__end_{c}").over(part.orderBy("__bucket")).alias(f"__last_{c}") for c in previous],
                      *[F.coalesce(F.sum(f"__tot_{c}").over(w), F.lit(0)).alias(f"__off_{c}")
                        for c in sum_cols],
                      *[F.sum(f"__tot_{c}").over(part).alias(f"__all_{c}") for c in sum_cols])


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                   group_cols: Sequence[str] = (), bucket_col: Column | None = None,
                   rows_per_bucket: int = ROWS_PER_BUCKET,
                   accuracy: int = DEFAULT_ACCURACY, previous: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums ``{c}_cum`` of ``sum_cols`` in ascending
    ``order_col`` within each group, plus ``{c}_total`` per group and, for the
    columns ``previous``, ``{c}_prev`` of the row before (NULL for the first).
    ``order_col`` must be unique within a group (collapse ties first).

    ``bucket_col`` may supply a ready-made monotone bucket (e.g. a uniform
    hash prefix).  Otherwise rows are cut into quantile ranges, as many as
    their number asks for (one counting action); each range is ordered by
    itself and the ranges' totals supply the prefix offsets.
    """
    g = list(group_cols)
    if bucket_col is not None:
        tagged = df.withColumn("__bucket", bucket_col)
    else:
        n = df.count()
        buckets = max(2, min(MAX_BUCKETS, -(-n // rows_per_bucket)))
        tagged = _with_quantile_bucket(df, g, order_col, buckets, max(accuracy, 4 * buckets))
    off = _bucket_offsets(tagged, g, sum_cols, order_col, previous)
    ordered = Window.partitionBy(*g, "__bucket").orderBy(order_col)
    w_in = Window.partitionBy(*g, "__bucket").orderBy(order_col) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # (group, bucket) offsets are a small table: AQE broadcasts it by size
    out = join_null_safe(tagged, off, g + ["__bucket"])
    out = out.withColumns({**{f"{c}_cum": F.col(f"__off_{c}") + F.sum(c).over(w_in)
                              for c in sum_cols},
                           **{f"{c}_total": F.col(f"__all_{c}") for c in sum_cols},
                           **{f"{c}_prev": F.when(F.row_number().over(ordered) > 1, F.lag(c).over(ordered))
                              .otherwise(F.col(f"__last_{c}")) for c in previous}})
    return out.drop("__bucket", *[f"__off_{c}" for c in sum_cols], *[f"__all_{c}" for c in sum_cols],
                    *[f"__last_{c}" for c in previous])


def exact_medians(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                  out_col: str = "median", accuracy: int = DEFAULT_ACCURACY,
                  bracket_values: int = BRACKET_VALUES) -> DataFrame:
    """Exact median of ``value_col`` per group (NULL and NaN skipped): the
    mean of the values at 0-based ranks floor((n-1)/2) and ceil((n-1)/2), or
    that value where both are equal.  Groups without values get no row; a NULL
    group key is a group.

    Pass 1 sketches each group's quantiles just below and above one half; the
    sketch is accurate enough, by the row count, that at most about
    ``bracket_values`` rows lie between them.  Pass 2 collapses all rows
    below the bracket into one count and the rows inside it to (value, count),
    by partial aggregation before the shuffle; rows above are dropped there.
    Only these few values are ordered.
    """
    g = list(group_cols)
    v = F.col(value_col)
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*g, v.cast("double").alias("__v"))
    n_rows = rows.count()
    accuracy = max(accuracy, -(-6 * n_rows // bracket_values))
    eps = 2.0 / accuracy
    around = rows.groupBy(*g).agg(                   # one row a group
        F.count(F.lit(1)).alias("__n"),
        F.percentile_approx("__v", [0.5 - eps, 0.5 + eps], accuracy).alias("__b"))
    if g:
        near = join_null_safe(rows, around, g)
    else:                                            # one bounded row, inlined
        one = around.first()
        near = rows.withColumns({"__n": F.lit(one["__n"]), "__b": F.lit(one["__b"] or [0.0, 0.0])})
    kept = (near.where(F.col("__v") <= F.col("__b")[1])
            .withColumn("__v", F.when(F.col("__v") >= F.col("__b")[0], F.col("__v")))
            .groupBy(*g, "__n", "__v").agg(F.count(F.lit(1)).alias("__cnt")))
    w = Window.partitionBy(*g).orderBy(F.col("__v").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = kept.withColumn("__upto", F.sum("__cnt").over(w))
    at = lambda k: (k >= F.col("__upto") - F.col("__cnt")) & (k < F.col("__upto"))
    k_lo, k_hi = F.floor((F.col("__n") - 1) / 2), F.ceil((F.col("__n") - 1) / 2)
    lo, hi = F.max(F.when(at(k_lo), F.col("__v"))), F.max(F.when(at(k_hi), F.col("__v")))
    picked = upto.groupBy(*g).agg(lo.alias("__vlo"), hi.alias("__vhi"))
    return (picked if g else picked.where(F.col("__vlo").isNotNull())).select(
        *g, F.when(F.col("__vlo") == F.col("__vhi"), F.col("__vlo"))
        .otherwise((F.col("__vlo") + F.col("__vhi")) / 2).alias(out_col))


def unpivot_features(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str] = (),
                     name_col: str = "feature", value_col: str = "value") -> DataFrame:
    """Wide -> long (feature, value) over ``cols`` (values cast to double)."""
    cast = df.select(*id_cols, *[F.col(c).cast("double").alias(c) for c in cols])
    return cast.unpivot(list(id_cols), list(cols), name_col, value_col)


def _brackets(wide: DataFrame, m: int, accuracy: int) -> list[tuple[int, float, float] | None]:
    """Per column (values, low, high): bounds just below and above the middle
    of its values, from one aggregate with a sketch a column."""
    eps = 2.0 / accuracy
    row = wide.agg(*[F.count(f"c{i}").alias(f"n{i}") for i in range(m)],
                   *[F.percentile_approx(f"c{i}", [0.5 - eps, 0.5 + eps], accuracy).alias(f"b{i}")
                     for i in range(m)]).first()
    return [(row[f"n{i}"], *row[f"b{i}"]) if row[f"n{i}"] else None for i in range(m)]


def _middle_values(wide: DataFrame, spans: dict[int, tuple[int, float, float]]) -> dict[int, float]:
    """Exact medians from (values, low, high) by column number: one pass counts
    what lies below, one hands on the cells inside, and these few are ordered."""
    below = wide.agg(*[F.sum((F.col(f"c{i}") < F.lit(low)).cast("long")).alias(f"n{i}")
                       for i, (_, low, _) in spans.items()]).first()
    inside = {i: F.col(f"c{i}").between(F.lit(low), F.lit(high)) for i, (_, low, high) in spans.items()}
    some = F.lit(False)
    for cond in inside.values():
        some = some | F.coalesce(cond, F.lit(False))
    cells = F.array(*[F.when(cond, F.struct(F.lit(i).alias("i"), F.col(f"c{i}").alias("v")))
                      for i, cond in inside.items()])
    found = (wide.where(some).select(F.explode(F.filter(cells, lambda c: c.isNotNull())).alias("c"))
             .groupBy("c.i", "c.v").agg(F.count(F.lit(1)).alias("cnt")))
    counts = F.create_map(*[F.lit(x) for i in spans for x in (i, below[f"n{i}"])])
    total = F.create_map(*[F.lit(x) for i, (n, _, _) in spans.items() for x in (i, n)])
    w = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = found.withColumn("upto", counts[F.col("i")] + F.sum("cnt").over(w))
    at = lambda k: (k >= F.col("upto") - F.col("cnt")) & (k < F.col("upto"))
    n = total[F.col("i")]
    got = upto.groupBy("i").agg(F.max(F.when(at(F.floor((n - 1) / 2)), F.col("v"))).alias("lo"),
                                F.max(F.when(at(F.ceil((n - 1) / 2)), F.col("v"))).alias("hi")).collect()
    return {r["i"]: r["lo"] if r["lo"] == r["hi"] else (r["lo"] + r["hi"]) / 2
            for r in got if r["lo"] is not None and r["hi"] is not None}


def collect_medians(df: DataFrame, cols: Sequence[str], accuracy: int = DEFAULT_ACCURACY,
                    bracket_values: int = BRACKET_VALUES) -> dict[str, float | None]:
    """Exact median of every column at once (bounded result: one value a
    column; NULL and NaN skipped, None for a column without values).

    The table stays wide: one aggregate sketches all columns' middles, one
    counts what lies below these brackets, and only cells inside a bracket leave
    their row to be ordered.  Where a bracket would hold more than
    ``bracket_values`` rows the sketch is taken again, finer, by the counts that
    the first gave."""
    m = len(cols)
    if not m:
        return {}
    wide = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"c{i}")
                       for i, c in enumerate(cols)])
    spans = _brackets(wide, m, accuracy)
    most = max((s[0] for s in spans if s), default=0)
    if most * 6 > accuracy * bracket_values:
        spans = _brackets(wide, m, -(-6 * most // bracket_values))
    known = {i: s for i, s in enumerate(spans) if s}
    found = _middle_values(wide, known) if known else {}
    for i in known.keys() - found.keys():             # a sketch missed the middle: the column by itself
        found[i] = exact_medians(wide.select(F.col(f"c{i}").alias("v")), "v").first()["median"]
    return {c: found.get(i) for i, c in enumerate(cols)}


def column_medians(df: DataFrame, cols: Sequence[str], **kw) -> DataFrame:
    """Exact median of each column: (feature, median); all-NULL columns give
    a NULL median."""
    return df.sparkSession.createDataFrame(list(collect_medians(df, cols, **kw).items()),
                                           "feature string, median double")


def missing_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Null fraction per column: one aggregation pass, then the one-row
    result is unpivoted to (feature, missing_frac)."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])
    return one.unpivot([], list(cols), "feature", "missing_frac")


def null_total(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Total number of NULL cells over ``cols`` (one row)."""
    total = None
    for c in cols:
        term = F.sum(F.col(c).isNull().cast("long"))
        total = term if total is None else total + term
    return df.agg(F.coalesce(total, F.lit(0)).cast("long").alias("null_total"))


def missing_flags(df: DataFrame, cols: Sequence[str], suffix: str = "_missing") -> DataFrame:
    """``{col}_missing`` = 1 where the value is NULL — computed before any
    filling, so the flags carry information."""
    return df.withColumns({f"{c}{suffix}": F.col(c).isNull().cast("int") for c in cols})


def impute_median(df: DataFrame, cols: Sequence[str], medians: dict | None = None,
                  with_flags: bool = False, suffix: str = "_missing") -> DataFrame:
    """Fill NULLs with each column's exact median (a column with no values
    stays NULL).  ``medians`` lets a caller pass training-set medians; with
    ``with_flags`` missingness flags are added *before* filling."""
    meds = medians if medians is not None else collect_medians(df, cols)
    out = missing_flags(df, cols, suffix) if with_flags else df
    fills = {c: F.coalesce(F.col(c), F.lit(meds.get(c)).cast("double"))
             for c in cols if meds.get(c) is not None}
    return out.withColumns(fills) if fills else out


def moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population std) per column — one aggregation, bounded result."""
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m_{i}"], row[f"s_{i}"]) for i, c in enumerate(cols)}


def standardize(df: DataFrame, cols: Sequence[str], stats: dict | None = None,
                suffix: str = "") -> DataFrame:
    """(x - mean) / population std; a constant column (std 0) becomes 0."""
    st = stats if stats is not None else moments(df, cols)
    exprs = {}
    for c in cols:
        m, s = st[c]
        m = 0.0 if m is None else float(m)
        s = 1.0 if (s is None or s == 0) else float(s)
        exprs[f"{c}{suffix}"] = (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
    return df.withColumns(exprs)


def histogram(df: DataFrame, col: str, bins: int = 40, clip: float | None = 30.0
              ) -> DataFrame:
    """Equal-width histogram over [min, max] of the (clipped) values, the last
    bin closed on the right; every bin is present (zero-filled).

    One bounded action fetches (min, max); the bin index is then a scalar
    expression and counts are a partial aggregation on ``bins`` keys.
    """
    x = F.col(col).cast("double")
    if clip is not None:
        x = clip_upper(x, clip)
    vals = df.select(x.alias("__x")).where(F.col("__x").isNotNull() & ~F.isnan("__x"))
    lo, hi = vals.agg(F.min("__x"), F.max("__x")).first()
    spark = df.sparkSession
    if lo is None:
        return spark.range(bins).select(F.col("id").cast("int").alias("bin"),
                                        F.lit(None).cast("double").alias("bin_lo"),
                                        F.lit(None).cast("double").alias("bin_hi"),
                                        F.lit(0).cast("long").alias("count"))
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins
    norm = bins / (hi - lo)
    idx0 = F.least(F.floor((F.col("__x") - F.lit(lo)) * F.lit(norm)).cast("int"),
                   F.lit(bins - 1))
    edge = lambda i: i.cast("double") * F.lit(step) + F.lit(lo)
    idx = (F.when(F.col("__x") < edge(idx0), idx0 - 1)
           .when((idx0 != bins - 1) & (F.col("__x") >= edge(idx0 + 1)), idx0 + 1)
           .otherwise(idx0))
    counts = vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(counts, "bin", "left")
            .select("bin", edge(F.col("bin")).alias("bin_lo"),
                    edge(F.col("bin") + 1).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Half-even rounding of several double columns (stable value hashes)."""
    return df.withColumns({c: round_half_even(c, digits) for c in cols})
