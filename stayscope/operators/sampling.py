"""Deterministic, shuffle-light sampling: md5-hash split and folds, hash
sample, balanced class weights.

Row order never matters: every decision is a function of md5(key | seed), so
a recomputed partition (lost executor) makes the same choices.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import running_totals

HASH_BUCKET_CHARS = 4      # 16**4 = 65536 uniform buckets per class for exact ranks


def _approximate_mode(counts: list[int], draws: int) -> list[int]:
    """Largest-remainder allocation of ``draws`` over classes in proportion
    to ``counts`` (ties go to the earlier class)."""
    total = sum(counts)
    cont = [c / total * draws if total else 0.0 for c in counts]
    alloc = [int(math.floor(x)) for x in cont]
    need = draws - sum(alloc)
    order = sorted(range(len(counts)), key=lambda i: (-(cont[i] - alloc[i]), i))
    for i in order[:max(0, need)]:
        alloc[i] += 1
    return alloc


def test_allocation(counts: dict, test_fraction: float) -> dict:
    """Per-class test counts of a stratified hold-out: test size
    ceil(fraction * n); training counts allocated first by largest remainder,
    test counts from what remains (the rule of common stratified splitters,
    with deterministic tie-breaks)."""
    labels = sorted(counts)
    c = [counts[k] for k in labels]
    n = sum(c)
    n_test = math.ceil(test_fraction * n)
    train = _approximate_mode(c, n - n_test)
    test = _approximate_mode([a - b for a, b in zip(c, train)], n_test)
    return dict(zip(labels, test))


def row_hash(key: str, seed: int = 42) -> Column:
    """Lower-case md5 hex of ``key | seed`` (same text in DuckDB)."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def class_rank(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """Adds ``__h`` (hash), ``__rank`` (1-based rank of the hash within the
    label, ties by key) and ``__n`` (label size).

    The md5 prefix is a uniform bucket, so the per-(label, bucket) windows
    are evenly sized whatever the key distribution; bucket offsets are a
    small (labels x 65536) table."""
    h = df.withColumn("__h", row_hash(key, seed))
    ones = h.withColumn("__one", F.lit(1).cast("long"))
    bucket = F.substring("__h", 1, HASH_BUCKET_CHARS)
    # order within a bucket by (hash, key): make it one sortable unique value
    ones = ones.withColumn("__ord", F.concat("__h", F.lit("|"), F.col(key).cast("string")))
    rt = running_totals(ones, "__ord", ["__one"], group_cols=[label], bucket_col=bucket)
    return (rt.withColumnRenamed("__one_cum", "__rank").withColumnRenamed("__one_total", "__n")
            .drop("__one", "__ord"))


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.2,
                     seed: int = 42, exact: bool = True, split_col: str = "is_test"
                     ) -> DataFrame:
    """Adds ``is_test`` (0/1).

    exact=True: in each class the ceil(test_fraction * n_class) rows with the
    smallest md5(key|seed) go to test — exact stratification.
    exact=False: md5 prefix below the fraction threshold — no shuffle at
    all, stratified in expectation.
    Rows with a NULL label stay, with a NULL ``is_test``, in both forms.
    """
    known = F.col(label).isNotNull()
    if not exact:
        thr = format(int(test_fraction * 16 ** 8), "08x")
        return df.withColumn(split_col, F.when(known, (
            F.substring(row_hash(key, seed), 1, 8) < F.lit(thr)).cast("int")))
    r = class_rank(df, label, key, seed)
    n_test = F.ceil(F.col("__n") * F.lit(float(test_fraction)))
    return r.withColumn(split_col, F.when(known, (F.col("__rank") <= n_test).cast("int"))) \
        .drop("__h", "__rank", "__n")


def grouped_split(df: DataFrame, group: str, test_fraction: float = 0.2, seed: int = 42,
                  split_col: str = "is_test") -> DataFrame:
    """Adds ``is_test`` so that all rows of a group (say, one person's stays)
    fall on one side: the ceil(test_fraction * n_groups) groups with the
    smallest md5(group|seed) go to test.  Rows with a NULL group stay, with a
    NULL ``is_test``."""
    groups = df.where(F.col(group).isNotNull()).select(F.col(group).alias("__g")).distinct()
    one = groups.withColumn("__all", F.lit(1))
    split = stratified_split(one, "__all", "__g", test_fraction, seed, split_col=split_col)
    return df.join(split.drop("__all"), F.col(group) == F.col("__g"), "left").drop("__g")


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     fold_col: str = "fold") -> DataFrame:
    """Adds ``fold`` in [0, k): (rank of md5(key|seed) within the class - 1)
    mod k — every class is spread over the folds within one row.  Rows with a
    NULL label stay, with a NULL fold."""
    r = class_rank(df, label, key, seed)
    return r.withColumn(fold_col, F.when(F.col(label).isNotNull(), ((F.col("__rank") - 1) % k).cast("int"))) \
        .drop("__h", "__rank", "__n")


def split_and_folds(df: DataFrame, label: str, key: str, test_fraction: float = 0.2,
                    k: int = 5, seed: int = 42, allocation: str = "per_class_ceil"
                    ) -> DataFrame:
    """``is_test`` and ``fold`` from one ranking pass: the same rows as
    ``stratified_split`` followed by ``stratified_folds`` on the training part
    (training ranks are the class ranks shifted by the class's test count);
    test rows get fold -1.

    allocation: "per_class_ceil" — ceil(fraction * n_class) per class;
    "largest_remainder" — total ceil(fraction * n) split over classes by
    ``test_allocation`` (one small action: the class counts)."""
    r = class_rank(df, label, key, seed)
    if allocation == "largest_remainder":
        counts = {row[label]: row["n"] for row in
                  df.where(F.col(label).isNotNull()).groupBy(label)
                  .agg(F.count(F.lit(1)).alias("n")).collect()}
        kv = []
        for lab, t in test_allocation(counts, test_fraction).items():
            kv += [F.lit(lab), F.lit(int(t))]
        n_test = F.create_map(*kv)[F.col(label)]
    else:
        n_test = F.ceil(F.col("__n") * F.lit(float(test_fraction)))
    is_test = F.col("__rank") <= n_test
    known = F.col(label).isNotNull()                  # NULL labels stay, on no side
    return (r.withColumns({
        "is_test": F.when(known, is_test.cast("int")),
        "fold": F.when(known & is_test, F.lit(-1)).when(known, ((F.col("__rank") - n_test - 1) % k)
                                                        .cast("int"))})
            .drop("__h", "__rank", "__n"))


def hash_sample(df: DataFrame, key: str, n: int = 500, seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest md5(key|seed): a deterministic sample
    (distributed top-k: each task keeps n rows, one merge)."""
    return df.withColumn("__h", row_hash(key, seed)).orderBy("__h", key).limit(n).drop("__h")


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight = n_total / (k * n_label).  One row per
    class; the total is an unpartitioned window over that tiny table."""
    w = Window.partitionBy()
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(label, "n", (F.sum("n").over(w).cast("double")
                                      / (F.count(F.lit(1)).over(w) * F.col("n")).cast("double"))
                         .alias("weight"))


def class_weights(df: DataFrame, label: str) -> dict:
    """Balanced weights as a dict (bounded by the number of classes)."""
    return {r[label]: r["weight"] for r in class_weight_table(df, label).collect()}


def with_weights(df: DataFrame, label: str, weights: dict, weight_col: str = "weight"
                 ) -> DataFrame:
    kv = []
    for k, v in weights.items():
        kv += [F.lit(k), F.lit(float(v))]
    return df.withColumn(weight_col, F.create_map(*kv)[F.col(label)])
