import numpy as np
import pytest

from stayscope.operators import stats as ST


@pytest.mark.parametrize("bracket_values", [1, 1_000_000])
def test_exact_medians_vs_numpy(spark, bracket_values):
    rng = np.random.default_rng(7)
    rows = []
    for g, n in (("a", 1001), ("b", 1000), ("c", 1), ("d", 2)):
        vals = np.round(rng.lognormal(size=n), 2)
        vals[: n // 3] = 1.0                      # a hot value holding a third of the rows
        rows += [(g, float(v)) for v in vals]
    rows += [("a", None), ("e", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in ST.exact_medians(df, "v", ["g"], bracket_values=bracket_values).collect()}
    for g in "abcd":
        vals = [v for gg, v in rows if gg == g and v is not None]
        assert got[g] == pytest.approx(float(np.median(vals)), abs=1e-12)
    assert "e" not in got


def test_even_count_median_and_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (10.0, None), (20.0, None)],
                               "x double, y double")
    med = ST.collect_medians(df, ["x", "y"], bracket_values=1)
    assert med == {"x": 6.0, "y": None}
    filled = ST.impute_median(df, ["x", "y"], with_flags=True, medians=med)
    assert [r.y_missing for r in filled.collect()] == [1, 1, 1, 1]


def test_missing_summary_flags_and_impute(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, 4.0, None), (3, 6.0, None), (4, None, None)],
                               "id long, a double, b double")
    ms = {r.feature: r.missing_frac for r in ST.missing_summary(df, ["a", "b"]).collect()}
    assert ms == {"a": 0.5, "b": 0.75}
    assert ST.null_total(df, ["a", "b"]).first()[0] == 5
    out = ST.impute_median(df, ["a", "b"], with_flags=True).orderBy("id").collect()
    assert [r.a for r in out] == [5.0, 4.0, 6.0, 5.0]
    assert [r.a_missing for r in out] == [1, 0, 0, 1]


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    xs = np.round(rng.exponential(6.0, size=2000), 3)
    df = spark.createDataFrame([(float(x),) for x in xs] + [(None,)], "x double")
    h = ST.histogram(df, "x", bins=40, clip=30.0).orderBy("bin").collect()
    counts, edges = np.histogram(np.minimum(xs, 30.0), bins=40)
    assert [r["count"] for r in h] == counts.tolist()
    assert [r.bin_lo for r in h] == pytest.approx(edges[:-1].tolist())


def test_running_totals_vs_cumsum(spark):
    rng = np.random.default_rng(5)
    vals = rng.permutation(3000).astype(float)
    df = spark.createDataFrame([(float(v), 1, int(v) % 3) for v in vals], "o double, one long, g long")
    rt = ST.running_totals(df, "o", ["one"], group_cols=["g"], rows_per_bucket=5).collect()
    for r in rt:
        expect = sum(1 for v in vals if int(v) % 3 == r.g and v <= r.o)
        assert r.one_cum == expect
    assert {r.one_total for r in rt} == {1000}


def test_standardize_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (3.0, 3.0)], "x double, c double")
    out = ST.standardize(df, ["x", "c"]).collect()
    xs = np.array([1.0, 2.0, 3.0])
    assert [r.x for r in out] == pytest.approx(((xs - xs.mean()) / xs.std()).tolist())
    assert [r.c for r in out] == [0.0, 0.0, 0.0]


def test_ungrouped_bucketed_median(spark):
    rng = np.random.default_rng(9)
    vals = np.round(rng.normal(size=999), 3)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = ST.exact_medians(df, "v", [], bracket_values=1).first()["median"]
    assert got == pytest.approx(float(np.median(vals)), abs=1e-12)


@pytest.mark.parametrize("bracket_values", [1, 1_000_000])
def test_median_null_group_infinity_and_bits(spark, bracket_values):
    inf = float("inf")
    rows = [(None, 1.0), (None, 4.0), ("i", inf), ("i", inf), ("j", 1.0), ("j", inf), ("k", -inf),
            ("k", -inf), ("k", 2.0), ("n", float("nan")), ("n", 3.0), ("m", None)]
    rows += [("h", 5.0)] * 5000 + [("h", float(v)) for v in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in ST.exact_medians(df, "v", ["g"], bracket_values=bracket_values).collect()}
    assert got == {None: 2.5, "i": inf, "j": inf, "k": -inf, "n": 3.0, "h": 5.0}
    rng = np.random.default_rng(0)
    pairs = [(str(i), float(v)) for i in range(200) for v in rng.random(2)]
    two = spark.createDataFrame(pairs, "g string, v double")
    got = {r.g: r.median for r in ST.exact_medians(two, "v", ["g"], bracket_values=bracket_values).collect()}
    for i in range(200):
        a, b = (v for g, v in pairs if g == str(i))
        assert got[str(i)] == (a + b) / 2


def test_running_totals_keep_null_groups(spark):
    df = spark.createDataFrame([(float(i), 1, None if i % 2 else "x") for i in range(100)],
                               "o double, one long, g string")
    for rows_per_bucket in (7, 1000):
        rt = ST.running_totals(df, "o", ["one"], group_cols=["g"], rows_per_bucket=rows_per_bucket).collect()
        assert len(rt) == 100 and all(r.one_cum == int(r.o) // 2 + 1 and r.one_total == 50 for r in rt)


def test_medians_of_many_columns_stay_wide(spark, monkeypatch):
    rng = np.random.default_rng(6)
    n = 3000
    cols = {"a": rng.normal(size=n), "b": rng.integers(0, 4, n).astype(float), "c": np.where(rng.uniform(size=n) < .7, np.nan, 1.5),
            "d": np.full(n, 2.0), "e": rng.exponential(size=n) * 1e6}
    rows = [[None if (i + j) % 11 == 0 else float(v[i]) for j, v in enumerate(cols.values())] for i in range(n)]
    df = spark.createDataFrame([(*r, None) for r in rows], ", ".join(f"{c} double" for c in [*cols, "none"])).repartition(7)
    want = {c: float(np.nanmedian([np.nan if r[j] is None else r[j] for r in rows])) for j, c in enumerate(cols)}
    for kw in ({}, {"accuracy": 50}, {"accuracy": 20, "bracket_values": 100}):
        assert ST.collect_medians(df, [*cols, "none"], **kw) == {**want, "none": None}
    monkeypatch.setattr(ST, "unpivot_features", lambda *a, **k: pytest.fail("the table was unpivoted"))
    assert ST.collect_medians(df.limit(0), ["a", "b"]) == {"a": None, "b": None}
    assert ST.collect_medians(df, []) == {}
    got = {r["feature"]: r["median"] for r in ST.column_medians(df, [*cols, "none"]).collect()}
    assert got == {**want, "none": None}


def test_a_missed_bracket_falls_back(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "a double")
    monkeypatch.setattr(ST, "_brackets", lambda wide, m, accuracy: [(101, 90.0, 95.0)])
    assert ST.collect_medians(df, ["a"]) == {"a": 50.0}


def test_previous_row_across_ranges(spark):
    df = spark.createDataFrame([(float(i), i * i) for i in range(200)], "s double, v long").repartition(5)
    out = ST.running_totals(df, "s", ["v"], rows_per_bucket=9, previous=["v"]).orderBy("s").collect()
    assert [r["v_prev"] for r in out] == [None] + [i * i for i in range(199)]
    assert out[-1]["v_cum"] == out[0]["v_total"] == sum(i * i for i in range(200))
