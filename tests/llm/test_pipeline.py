"""The corpus pipeline: every stage against a brute-force version."""

import importlib

import numpy as np

from llm_fixtures import awkward_docs, collected, docs_frame
from test_jaccard import components
from test_suffix import brute

import corpus_pipeline as P
from stayscope.llm import queries as Q

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def tables(spark, folder, rows, items):
    docs_frame(spark, rows).select(*COLUMNS).coalesce(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_stages_in_order_match_brute_force(spark, tmp_path):
    rows = [r for r in awkward_docs() if r[0] is not None]
    rows.append((500, "\x01\x02" * 40 + "x" + "\x03\x04\x7f" * 40, "en", "a"))      # letters, but no language
    item = rows[14][1].split(" ")[50:70]
    tables(spark, tmp_path, rows, [(1, " ".join(item)), (2, None)])
    assert [n for n, _ in P.STAGES] == ["language_id", "jaccard_join", "suffix_array", "decontamination", "mix_sources"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    have = {i: (t, la, s) for i, t, la, s in rows}
    alive = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == COLUMNS
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        got = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "language_id":
            assert set(got) <= {r[0] for r in alive} and {r[0] for r in alive} - set(got) <= {500, 19}
            alive = [r for r in alive if r[0] in got]
        elif name == "jaccard_join":
            keep = {i for i, _, c in components(alive) if i == c}
            assert set(got) == keep
            alive = [r for r in alive if r[0] in keep]
        elif name == "suffix_array":
            want = {i: k.decode("utf-8", "ignore") for i, _, _, k in brute(alive, 200)}
            assert got == want
            alive = [(i, got[i], la, s) for i, _, la, s in alive]
        else:
            q = {tuple(w.lower() for w in item[j:j + 5]) for j in range(len(item) - 4)}
            for i, t, *_ in alive:
                w = t.lower().split()
                own = {tuple(w[j:j + 5]) for j in range(len(w) - 4)}
                assert (i in got) == (len(q & own) < 0.8 * len(q))
        for r in docs.collect():
            assert r["n_chars"] == len(r["text"]) and (r["lang"], r["source"]) == have[r["doc_id"]][1:]
    mixed = collected(P.STAGES[-1][1](spark, docs, str(tmp_path)))
    assert {r["doc_id"] for r in mixed} == {r["doc_id"] for r in docs.collect()}
    whole = collected(P.run(spark, str(tmp_path)))
    key = lambda r: (r["doc_id"], r["size"], r["taken"], r["shards"])
    assert sorted(map(key, whole)) == sorted(map(key, mixed))


def test_pipeline_of_empty_tables(spark, tmp_path):
    tables(spark, tmp_path, [], [])
    assert P.run(spark, str(tmp_path)).count() == 0


def test_every_operator_has_a_query_and_the_entry_adds_them():
    entry = importlib.import_module("__spark_entry__")
    numbers = sorted(int(k[2:].split("_")[0]) for k in Q.QUERIES)
    assert numbers == list(range(1, 14)) and set(Q.ORACLE) <= set(Q.QUERIES)
    assert set(Q.QUERIES) | {"pipeline"} <= set(entry.queries()) and np.all([k in entry.oracle_sql() for k in Q.ORACLE])
