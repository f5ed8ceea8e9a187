"""Plan properties of registered queries: no Cartesian / nested-loop joins,
filters pushed into the Parquet scans, projections pruned."""

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_cartesian_and_pushdown(spark):
    q = E.queries()
    for name in ("cohort", "window_events_by_stay", "window_events_by_episode", "long_stats",
                 "roc_auc", "roc_curve", "feature_medians", "threshold_alert",
                 "stratified_split", "los_histogram", "kpi_summary", "measurement_union"):
        plan = _plan(q[name](spark, SF))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name
    ev = _plan(q["window_events_by_stay"](spark, SF))
    assert "PushedFilters: [In(event_type" in ev
    assert "GreaterThan(value,0.0)" in ev
    assert "props" not in ev.split("ReadSchema:")[1].split("\n")[0]
    co = _plan(q["cohort"](spark, SF))
    li = [ln for ln in co.splitlines() if ln.startswith("ReadSchema: struct<l_orderkey")]
    assert li and "l_extendedprice" not in li[0] and "l_tax" not in li[0]
