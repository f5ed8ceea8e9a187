import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stayscope.operators import explain as X
from stayscope.operators import forest as FO

NAMES = ["f0", "f1", "f2", "f3", "f4"]
NODES = "tree int, node int, left int, right int, feature int, threshold double, value double, cover double"


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 5)).round(2)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] - 0.3 * x[:, 4]) > 0).astype(float)
    train = spark.createDataFrame([(float(a), Vectors.dense(b.tolist())) for a, b in zip(y, x)], ["label", "features"])
    model = RandomForestClassifier(numTrees=7, maxDepth=6, seed=5, minInstancesPerNode=3).fit(train)
    rows = spark.createDataFrame([(i, *map(float, x[i])) for i in range(120)],
                                 "id long, " + ", ".join(f"{c} double" for c in NAMES))
    return model, x[:120], rows


def test_node_table_and_scores(spark, fitted):
    model, x, rows = fitted
    nodes = FO.node_table(spark, model)
    trees = X.forest_arrays(spark, model)
    assert nodes.count() == sum((t["cover"] > 0).sum() for t in trees)
    got = {r["id"]: r["score"] for r in FO.forest_scores(rows, "id", NAMES, nodes).collect()}
    want = X.forest_predict(x, trees)
    assert [got[i] for i in range(len(x))] == pytest.approx(want, abs=1e-12)


def test_shapley_equals_recursion(spark, fitted):
    """The quadrature over leaf paths gives what the recursive algorithm gives."""
    model, x, rows = fitted
    out = FO.forest_shapley(rows, "id", NAMES, FO.node_table(spark, model)).toPandas()
    phi, base = X.forest_shap(x, X.forest_arrays(spark, model))
    got = out.pivot(index="id", columns="feature", values="shap_value")[NAMES].to_numpy()
    assert np.abs(got - phi).max() < 1e-9
    assert out["base_value"].to_numpy() == pytest.approx(np.full(len(out), base), abs=1e-12)
    total = out.groupby("id").agg(s=("shap_value", "sum"), o=("model_output", "first"))
    assert (total["s"] + base - total["o"]).abs().max() < 1e-9
    values = out.pivot(index="id", columns="feature", values="feature_value")[NAMES].to_numpy()
    assert (values == x).all()


def test_no_python_worker_and_one_pass(spark, fitted):
    model, _, rows = fitted
    out = FO.forest_shapley(rows, "id", NAMES, FO.node_table(spark, model))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert plan.count("BroadcastNestedLoopJoin") == 1


def test_leaf_paths_merge_repeated_features(spark):
    # x0 <= 5, then x0 <= 2 below it: the leaf between has the interval (2, 5]
    rows = [(0, 0, 1, 2, 0, 5.0, 0.0, 10.0), (0, 1, 3, 4, 0, 2.0, 0.0, 8.0), (0, 2, -1, -1, -1, None, 0.9, 2.0),
            (0, 3, -1, -1, -1, None, 0.1, 6.0), (0, 4, -1, -1, -1, None, 0.5, 2.0), (1, 0, -1, -1, -1, None, 0.3, 4.0)]
    paths = {(r["tree"], r["leaf"]): r for r in FO.leaf_paths(spark.createDataFrame(rows, NODES)).collect()}
    assert len(paths) == 4
    mid = paths[0, 4]
    assert (mid["low"], mid["high"], mid["feature"]) == (2.0, 5.0, 0) and mid["ratio"] == pytest.approx(0.2)
    assert paths[0, 3]["low"] is None and paths[0, 2]["high"] is None
    assert paths[1, 0]["feature"] is None


def test_missing_values_zero_cover_and_single_leaves(spark):
    """Null and NaN go right; a side that no training row took has weight 0;
    every leaf is judged by definition (all subsets)."""
    rows = [(0, 0, 1, 2, 0, 5.0, 0.0, 10.0), (0, 1, 3, 4, 1, 2.0, 0.0, 10.0), (0, 2, -1, -1, -1, None, 0.9, 0.0),
            (0, 3, -1, -1, -1, None, 0.1, 6.0), (0, 4, -1, -1, -1, None, 0.5, 4.0), (1, 0, -1, -1, -1, None, 0.3, 4.0)]
    nodes = spark.createDataFrame(rows, NODES)
    data = [(1, 4.0, 1.0), (2, 6.0, 1.0), (3, None, 3.0), (4, float("nan"), None), (5, 5.0, 2.0)]
    df = spark.createDataFrame(data, "id long, a double, b double")
    score = {r["id"]: r["score"] for r in FO.forest_scores(df, "id", ["a", "b"], nodes).collect()}
    leaf = {1: 0.1, 2: 0.9, 3: 0.9, 4: 0.9, 5: 0.1}
    assert score == pytest.approx({i: (v + 0.3) / 2 for i, v in leaf.items()})
    out = FO.forest_shapley(df, "id", ["a", "b"], nodes).toPandas()
    tree = {"left": np.array([1, 3, -1, -1, -1]), "right": np.array([2, 4, -1, -1, -1]),
            "feature": np.array([0, 1, -1, -1, -1]), "threshold": np.array([5.0, 2.0, 0, 0, 0]),
            "value": np.array([0, 0, 0.9, 0.1, 0.5]), "cover": np.array([10.0, 10, 0, 6, 4])}

    def expect(x, known, j=0):
        if tree["left"][j] < 0:
            return tree["value"][j]
        d, lo, hi = tree["feature"][j], tree["left"][j], tree["right"][j]
        if d in known:
            return expect(x, known, lo if x[d] is not None and x[d] <= tree["threshold"][j] else hi)
        c = tree["cover"]
        return (c[lo] * expect(x, known, lo) + c[hi] * expect(x, known, hi)) / c[j]
    for i, a, b in data:
        x = (a, b)
        whole = [expect(x, s) for s in (set(), {0}, {1}, {0, 1})]
        want = [((whole[1] - whole[0]) + (whole[3] - whole[2])) / 4, ((whole[2] - whole[0]) + (whole[3] - whole[1])) / 4]
        got = out[out["id"] == i].set_index("feature")["shap_value"]
        assert [got["a"], got["b"]] == pytest.approx(want, abs=1e-12)


def test_many_trees_beyond_the_broadcast_bound(spark, fitted, monkeypatch):
    model, x, rows = fitted
    want = {r["id"]: r["score"] for r in FO.forest_scores(rows, "id", NAMES, FO.node_table(spark, model)).collect()}
    monkeypatch.setattr(FO, "MAX_BROADCAST_ROWS", 0)
    got = {r["id"]: r["score"] for r in FO.forest_scores(rows, "id", NAMES, FO.node_table(spark, model)).collect()}
    assert got == pytest.approx(want, abs=1e-15)


def test_ranking_of_the_paths(spark, fitted):
    model, _, rows = fitted
    long = FO.forest_shapley(rows, "id", NAMES, FO.node_table(spark, model))
    rank = [r["feature"] for r in X.shap_ranking(long, top=5, fold_rest=False).collect()]
    want = (long.groupBy("feature").agg(F.avg(F.abs("shap_value")).alias("m")).orderBy(F.desc("m")).collect())
    assert rank == [r["feature"] for r in want]
