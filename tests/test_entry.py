import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_and_registry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["age_band", "total_patients", "deaths", "mean_los", "mortality_rate_pct"]
    assert len(rows) > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 59


def _duck():
    con = duckdb.connect()
    for t in ("customer", "orders", "lineitem", "part", "events", "labels", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_oracle_agreement_small(spark):
    con = _duck()
    q, o = E.queries(), E.oracle_sql()
    for name in ("cohort", "mortality_by_age", "los_by_careunit", "wide_stats", "roc_auc",
                 "roc_curve", "stratified_split", "feature_medians", "kpi_summary",
                 "threshold_alert", "threshold_alert_stream", "mortality_rate_by",
                 "measurement_union"):
        sdf = q[name](spark, SF)
        cols = sorted(sdf.columns)
        got = sorted(tuple(str(r[c]) for c in cols) for r in sdf.collect())
        cur = con.execute(o[name])
        names = [d[0] for d in cur.description]
        idx = [names.index(c) for c in cols]
        exp = sorted(tuple(str(r[i]) for i in idx) for r in cur.fetchall())
        assert len(got) == len(exp), name
        assert got == exp, name
