"""Sets of clusters are made from the texts where a block needs them: they are
not stored when each cluster is one block, and copies of a set come once."""

from __future__ import annotations

from stayscope.llm import clusters, jaccard_rtree


def _docs(spark):
    words = [f"w{i}" for i in range(60)]
    near = [" ".join(words[:50] + [f"x{i}"]) for i in range(4)]
    rows = list(enumerate(near)) + [(10 + i, near[0]) for i in range(5)] + [(20, "alone here and there"), (21, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_sets_of_one_block_clusters_are_not_stored(spark, monkeypatch):
    kept, stored = [], clusters.stored

    def seen(df, name):
        kept.append(df.columns)
        return stored(df, name)
    monkeypatch.setattr(clusters, "stored", seen)
    out = {r.doc_id: r.component_id for r in jaccard_rtree.jaccard_components(_docs(spark)).collect()}
    assert out == {**{i: 0 for i in (0, 1, 2, 3, 10, 11, 12, 13, 14)}, 20: 20, 21: 21}
    assert kept and not any("shingles" in columns for columns in kept)


def test_a_set_comes_once_to_its_block(spark):
    d = spark.createDataFrame([(1, "a b c d e")] * 6 + [(2, "a b c d e f"), (2, "another text")], "id long, text string")
    found = d.mapInArrow(jaccard_rtree._points(3), "id long, n_shingles long, sid long").where("n_shingles >= 3").distinct()
    first = spark.createDataFrame([tuple(r) for r in found.collect()], "id long, n_shingles long, sid long")
    cluster = first.selectExpr("sid AS node", "0L AS component")
    rows = clusters.block_sets(d, clusters.cluster_blocks(first, cluster), 3).collect()
    assert sorted(len(r.shingles) // 8 for r in rows) == [3, 4]
    assert {(r.cluster, r.blocks, r.block) for r in rows} == {(0, 1, 0)}


def test_texts_that_no_block_needs_are_left_out_before_the_join(spark):
    rows = [(i, f"text {i}") for i in range(2000)] + [(None, "no id"), (7, None), (7, "seven")]
    d = spark.createDataFrame(rows, "id long, text string")
    ids = spark.createDataFrame([(7,), (1500,), (None,), (99999,)], "id long")
    got = [tuple(r) for r in clusters.rows_wanted(d, ids).collect()]
    want = [r for r in rows if r[0] in (7, 1500, None)]
    assert set(want) <= set(got) and len([r for r in got if r in want]) == len(want)
    assert len(got) < 400
    assert clusters.rows_wanted(d, ids.limit(0)).count() == 0
    named = spark.createDataFrame([(f"k{i}", "t") for i in range(50)], "id string, text string")
    assert clusters.rows_wanted(named, named.select("id")).count() == 50
    first = spark.createDataFrame([(1, 5, 3)], "sid long, id long, n_shingles long")
    cluster = first.selectExpr("sid AS node", "0L AS component")
    plan = clusters.block_sets(d, clusters.cluster_blocks(first, cluster), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2         # the filter below the join, the sets above it
