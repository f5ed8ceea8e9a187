import numpy as np
import pytest

from stayscope.operators import metrics as M
from stayscope.operators import model as MD
from stayscope.operators import report as R


def _newton_lr(X, y, w, C):
    """min 0.5*||b||^2 + C * sum w_i * logloss_i (intercept not penalised)."""
    n, k = X.shape
    Xa = np.hstack([X, np.ones((n, 1))])
    beta = np.zeros(k + 1)
    reg = np.eye(k + 1)
    reg[k, k] = 0.0
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-Xa @ beta))
        grad = C * Xa.T @ (w * (p - y)) + reg @ beta
        hess = C * (Xa * (w * p * (1 - p))[:, None]).T @ Xa + reg
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-12:
            break
    return beta


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(21)
    n = 3000
    X = rng.normal(size=(n, 3)) * np.array([1.0, 3.0, 0.5]) + np.array([0.0, 5.0, -1.0])
    logit = 1.5 * (X[:, 0]) - 0.4 * (X[:, 1] - 5.0) - 2.2
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-logit))).astype(int)
    rows = [(i, int(y[i]), *map(float, X[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c double")
    return df, X, y


def test_lr_matches_c_parametrised_newton_solution(planted):
    df, X, y = planted
    spec = MD.ModelSpec("lr", "Logistic Regression", C=0.1)
    fm = MD.fit(spec, df, ["a", "b", "c"], "y")
    Xs = (X - X.mean(0)) / X.std(0)
    n1 = y.sum()
    w = np.where(y == 1, len(y) / (2 * n1), len(y) / (2 * (len(y) - n1)))
    beta = _newton_lr(Xs, y, w, 0.1)
    got = np.append(fm.model.coefficients, fm.model.intercept)
    assert got == pytest.approx(beta, abs=1e-8)


def test_planted_signal_auc_floor(planted):
    df, _, _ = planted
    for spec in MD.default_specs(num_trees=20, max_depth=5):
        fm = MD.fit(spec, df, ["a", "b", "c"], "y")
        auc = M.roc_auc(fm.score(df, "id", "y")).first()["roc_auc"]
        assert auc > 0.8, spec.name


def test_outcome_table_null_keys_and_all_null_outcome(spark):
    df = spark.createDataFrame([(1, "A", None, 2.0), (2, "A", None, 4.0), (3, None, 1, 1.0),
                                (4, "B", 1, None)],
                               "icustay_id long, k string, hospital_expire_flag int, "
                               "icu_los_days double")
    out = {r.k: r for r in R.outcome_table(df, ["k"]).collect()}
    assert set(out) == {"A", "B"}
    assert out["A"].deaths == 0 and out["A"].total_patients == 2 and out["A"].mean_los == 3.0
    assert out["B"].mortality_rate_pct == 100.0 and out["B"].mean_los is None


def test_forest_tasks_and_concurrent_folds_are_bounded_by_rows(spark, planted, monkeypatch):
    df, _, _ = planted
    rows = df.coalesce(2)
    assert MD.forest_rows(rows, 3000) is rows            # small partitions stay as they are
    monkeypatch.setattr(MD, "FOREST_TASK_ROWS", 400)
    dealt = MD.forest_rows(rows, 3000)
    sizes = dealt.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
    assert sum(sizes) == 3000 and len(sizes) == 8 and max(sizes) <= 400 * 1.1
    first, again = (MD.forest_rows(rows, 3000).rdd.glom().collect() for _ in range(2))
    assert first == again and sorted(r for p in first for r in p) == sorted(df.collect())
    assert [MD.concurrent_folds(n, 5) for n in (0, 1000, 900_000, 3_000_000)] == [5, 5, 2, 1]


def test_large_forest_fit_runs_on_bounded_tasks_one_fold_at_a_time(spark, planted, monkeypatch):
    df, _, _ = planted
    monkeypatch.setattr(MD, "FOREST_TASK_ROWS", 400)
    monkeypatch.setattr(MD, "CONCURRENT_ROWS", 1000)
    spec = MD.ModelSpec("rf", "Random Forest", num_trees=5, max_depth=3)
    seen, running = [], []
    fit = MD.RandomForestClassifier.fit

    def watched(self, data):
        running.append(data.rdd.getNumPartitions())
        seen.append((len(running), running[-1]))
        model = fit(self, data)
        running.pop()
        return model
    monkeypatch.setattr(MD.RandomForestClassifier, "fit", watched)
    folded = df.coalesce(1).selectExpr("*", "cast(id % 3 as int) as fold")
    assert min(MD.cross_validate(spec, folded, ["a", "b", "c"], "y", "id", k=3)) > 0.7
    assert seen == [(1, 5)] * 3                          # 2000 rows a fit, 400 a task
