"""Stored tables leave no shuffle files behind, and the session's setting stays."""

from __future__ import annotations

import json
import subprocess
import sys
import textwrap
from pathlib import Path

RUN = textwrap.dedent("""
    import glob, json, sys, time
    from pyspark.sql import functions as F
    from stayscope import session as SE
    spark = SE.local_session("2", 4, extra_conf={"spark.local.dir": sys.argv[1], "spark.driver.host": "127.0.0.1",
                                                  "spark.driver.memory": "1g"})
    left = lambda: len(glob.glob(sys.argv[1] + "/**/shuffle_*.data", recursive=True))
    df = spark.range(20000).withColumn("k", F.xxhash64("id")).repartition(4, "k")
    out = SE.stored(df.groupBy("k").count(), "grouped")
    for _ in range(40):
        if not left():
            break
        time.sleep(0.25)
    print(json.dumps([left(), out.count(), spark.conf.get(SE.SHUFFLE_CLEANUP), df.count()]))
""")


def test_a_stored_tables_shuffle_files_go_with_its_job(tmp_path):
    repo = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", RUN, str(tmp_path)], cwd=repo, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert json.loads(done.stdout.strip().splitlines()[-1]) == [0, 20000, "false", 20000]
