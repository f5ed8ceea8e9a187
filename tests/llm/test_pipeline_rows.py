"""Stages of the pipeline: near copies by the general rule, and rows with null and repeated ids."""

import random

from llm_fixtures import awkward_docs, docs_frame, shingles
from test_jaccard import components

import corpus_pipeline as P

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_near_copies_of_five_words_and_four_fifths(spark, tmp_path):
    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    near = list(base)
    for i in range(20, 400, 50):
        near[i] = f"edit{i}"
    rows = [r for r in awkward_docs() if r[0] is not None]
    rows += [(700, " ".join(base), "en", "a"), (701, " ".join(near), "en", "a")]
    like = lambda k: len(shingles(rows[-2][1], k) & shingles(rows[-1][1], k)) / len(
        shingles(rows[-2][1], k) | shingles(rows[-1][1], k))
    assert 0.8 <= like(5) < 0.9 and like(3) < 0.9       # a link by this rule only
    docs = docs_frame(spark, rows).select(*COLUMNS)
    got = {r["doc_id"] for r in P.jaccard_join(spark, docs, str(tmp_path)).collect()}
    assert got == {i for i, _, c in components(rows, k=5, percent=80) if i == c}
    assert 700 in got and 701 not in got


def test_rows_are_judged_by_their_text_not_their_id(spark, tmp_path):
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(("stone", "river", "cloud", "field", "house", "green")) + str(rng.randrange(99)) for _ in range(n))
    a, b, c, d, e, item = (prose(60) for _ in range(6))
    leak = prose(20) + " " + item + " " + prose(20)
    rows = [(None, "", "en", "a"), (None, a, "en", "a"), (None, a, "en", "a"), (None, leak, "en", "a"), (None, b, "en", "b"),
            (5, "### 12", "en", "a"), (5, c, "en", "a"), (5, leak + " more", "en", "a"),
            (6, c, "en", "a"), (6, d, "en", "a"), (7, e, "en", "a"), (7, e, "en", "a"), (None, d, "en", "c")]
    docs_frame(spark, rows).select(*COLUMNS).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    have = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    pairs = sorted(((i, t) for i, t, *_ in rows), key=str)
    stages = dict(P.STAGES)
    assert have(stages["language_id"](spark, docs, str(tmp_path))) == [x for x in pairs if x not in ((None, ""), (5, "### 12"))]
    assert have(stages["decontamination"](spark, docs, str(tmp_path))) == [x for x in pairs if leak not in x[1]]
    out = stages["jaccard_join"](spark, docs, str(tmp_path))
    assert out.columns == COLUMNS
    one = [x for x in {x: 0 for x in pairs} if x not in ((6, c), (None, d), (None, leak))]
    assert have(out) == sorted(one, key=str)


def test_single_kept_texts_are_not_shuffled(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(400)), "en", "a") for i in range(300)]
    rows += [(900, rows[0][1], "en", "b"), (901, rows[1][1], "fr", "a"), (None, rows[2][1], "en", "a")]
    docs_frame(spark, rows).select(*COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # above the threshold, as on large tables
    try:
        for stage, keeps in ((P.language_id, 303), (P.jaccard_join, 300)):
            out = stage(spark, docs, str(tmp_path))
            assert len(out.collect()) == keeps and out.columns == COLUMNS
            assert shuffled_rows(out) < 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def shuffled_rows(df):
    """Rows written by the shuffles of a collected frame's final plan whose rows hold the texts."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if hasattr(p, "plan") and p.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(p.plan())
            continue
        if p.getClass().getSimpleName() == "ShuffleExchangeExec" and "text" in p.output().mkString(","):
            total += p.metrics().apply("shuffleRecordsWritten").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return total
