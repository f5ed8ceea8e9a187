"""Command line: run the three stages over a folder of star-schema tables.

    python -m stayscope --tables /root/testdata/sf0.01 --out /path/to/outputs \
        [--trees 300 --depth 8] [--no-cv] [--master local[8]]

Writes the model-ready table, missingness summary, model metrics,
importances, explanation ranking, confusion matrix and the reporting tables
(one dataset per table; row-level tables only under cohort/).
"""

from __future__ import annotations

import argparse
import json

from .operators import model as MD
from .plans.stages import run_on_tables
from .session import cluster_session, local_session


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="stayscope")
    ap.add_argument("--tables", required=True, help="folder with <table>.parquet files")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--trees", type=int, default=MD.RF_TREES)
    ap.add_argument("--depth", type=int, default=MD.RF_MAX_DEPTH)
    ap.add_argument("--no-cv", action="store_true")
    ap.add_argument("--master", default=None, help="e.g. local[8]; default: from the launcher")
    a = ap.parse_args(argv)
    if a.master and a.master.startswith("local["):
        spark = local_session(cores=a.master[6:-1])
    else:
        spark = cluster_session(overrides={"spark.master": a.master} if a.master else None)
    written = run_on_tables(spark, a.tables, a.out, num_trees=a.trees, max_depth=a.depth,
                            cv=not a.no_cv)
    print(json.dumps(written, indent=2, sort_keys=True))
    spark.stop()


if __name__ == "__main__":
    main()
