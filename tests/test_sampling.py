import math

from pyspark.sql import functions as F

from stayscope.operators import sampling as SP


def test_split_exact_and_folds_balanced(spark):
    df = spark.range(5003).select(F.col("id"), (F.col("id") % 9 == 0).cast("int").alias("y"))
    s = SP.stratified_split(df, "y", "id", test_fraction=0.2)
    counts = {(r.y, r.is_test): r["count"] for r in s.groupBy("y", "is_test").count().collect()}
    for y in (0, 1):
        n = counts[(y, 0)] + counts[(y, 1)]
        assert counts[(y, 1)] == math.ceil(0.2 * n)
    assert s.count() == 5003 and s.select("id").distinct().count() == 5003
    again = SP.stratified_split(df, "y", "id").where("is_test = 1").select("id")
    assert again.exceptAll(s.where("is_test = 1").select("id")).count() == 0
    f = SP.stratified_folds(df, "y", "id", k=5)
    sizes = {}
    for r in f.groupBy("y", "fold").count().collect():
        sizes.setdefault(r.y, []).append(r["count"])
    for v in sizes.values():
        assert len(v) == 5 and max(v) - min(v) <= 1


def test_hash_sample_and_weights(spark):
    df = spark.range(2000).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    a = [r.id for r in SP.hash_sample(df, "id", n=100).collect()]
    b = [r.id for r in SP.hash_sample(df.repartition(7), "id", n=100).collect()]
    assert a == b and len(a) == 100
    w = SP.class_weights(df, "y")
    assert w[1] == 2000 / (2 * 500) and w[0] == 2000 / (2 * 1500)


def test_largest_remainder_allocation(spark):
    assert SP.test_allocation({0: 70, 1: 30}, 0.2) == {0: 14, 1: 6}
    assert SP.test_allocation({0: 7, 1: 3}, 0.2) == {0: 1, 1: 1}
    alloc = SP.test_allocation({0: 333, 1: 101, 2: 7}, 0.2)
    assert sum(alloc.values()) == math.ceil(0.2 * 441)
    df = spark.range(441).select("id", (F.col("id") % 5 == 0).cast("int").alias("y"))
    out = SP.split_and_folds(df, "y", "id", allocation="largest_remainder")
    exp = SP.test_allocation({0: 352, 1: 89}, 0.2)
    got = {r.y: r["count"] for r in out.where("is_test = 1").groupBy("y").count().collect()}
    assert got == exp
    folds = out.where("is_test = 0").groupBy("y", "fold").count().collect()
    assert {r.fold for r in folds} == {0, 1, 2, 3, 4}


def test_null_labels_stay_without_a_side(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 10 != 0, (F.col("id") % 3 == 0).cast("int")).alias("y"))
    for exact in (True, False):
        out = SP.stratified_split(df, "y", "id", exact=exact).collect()
        assert len(out) == 100 and all((r.y is None) == (r.is_test is None) for r in out)
    folds = SP.stratified_folds(df, "y", "id").collect()
    assert len(folds) == 100 and all((r.y is None) == (r.fold is None) for r in folds)
    for allocation in ("per_class_ceil", "largest_remainder"):
        both = SP.split_and_folds(df, "y", "id", allocation=allocation).collect()
        assert len(both) == 100
        assert all((r.y is None) == (r.is_test is None) == (r.fold is None) for r in both)


def test_grouped_split_keeps_groups_together(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") >= 20, F.col("id") % 37).alias("person"))
    out = SP.grouped_split(df, "person", test_fraction=0.25)
    sides = out.groupBy("person").agg(F.countDistinct("is_test").alias("n"), F.max("is_test").alias("t")).collect()
    assert out.count() == 1000 and all(r.n == (0 if r.person is None else 1) for r in sides)
    assert sum(r.t or 0 for r in sides) == math.ceil(0.25 * 37)
