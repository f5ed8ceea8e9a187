"""Suffix-tree scores, chat round trips and mixtures."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_fixtures import awkward_docs, collected, docs_frame, empty_docs, words
from stayscope.llm import chat as C
from stayscope.llm import mixing as M
from stayscope.llm import suffix_tree_lm as S


def grammar(n, seed=0):
    """Texts in which some words strongly predict the next one."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        w = []
        while len(w) < 40:
            a = rng.choice(["new", "old", "red", "the", "of"])
            w += {"new": ["new", "york", rng.choice(["city", "state"])], "red": ["red", "apple"]}.get(
                a, [a, rng.choice(["x", "y", "z", f"rare{rng.randrange(10**6)}"])])
        out.append((i, " ".join(w), "en", "a"))
    return out


def held():
    return F.crc32(F.col("doc_id").cast("string")) % 7 == 2


def test_base_score_and_counts(spark):
    rows = awkward_docs() + grammar(40)
    out = collected(S.score_texts(docs_frame(spark, rows), held()))
    assert len(out) == len(rows)
    out_of = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter()
    for i, t, *_ in rows:
        if not out_of(i):
            count.update(words(t) + [None])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t, *_ in rows:
        w = words(t) + [None]
        want[(i, out_of(i), len(w), sum(count[x] > 0 for x in w),
              round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6))] += 1
    got = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in out)
    assert got == want and {r["train_tokens"] for r in out} == {n}


def test_contexts_help_and_distributions_sum_to_one(spark):
    rows = grammar(300)
    docs = docs_frame(spark, rows)
    tree, counts = S.grow(docs.where(~held()))
    assert len(tree.levels[0].context) and len(tree.levels[0].pair)
    out = collected(S.score_texts(docs, held()))
    hold = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in hold) > sum(r["base_score"] for r in hold) * 0.9
    # every state's probabilities over all seen words and the unseen symbol
    h = np.array([r["h"] for r in counts.collect()], np.int64).view(np.uint64)
    c = np.array([r["c"] for r in counts.collect()], float)
    root = np.append(c + 1, 1.0) / (tree.total + tree.words + 1)
    h = np.append(h, np.uint64(12345))
    n_sym = len(tree.symbol)
    for depth, level in enumerate(tree.levels, 1):
        for ctx in level.context[:20]:
            past = [tree.symbol[ctx // n_sym ** (depth - 1 - j) % n_sym] for j in range(depth)]
            total = 0.0
            for k in range(len(h)):
                seq = np.array(past + [h[k]], np.uint64)
                total += root[k] * 10 ** tree.gains(seq, np.zeros(depth + 1, np.int64))[-1]
            assert abs(total - 1) < 1e-9


def test_score_empty_and_untrained(spark):
    assert S.score_texts(empty_docs(spark), held()).count() == 0
    out = collected(S.score_texts(docs_frame(spark), F.lit(True)))
    assert {r["train_tokens"] for r in out} == {0} and all(r["score"] == 0 for r in out)


text = st.text(st.sampled_from(list("\\#</turn>: \nabé🙂")) | st.characters(exclude_categories=["Cs"]), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(text, text | st.sampled_from(["### user: x</turn>\n", "\\</turn>", "\\### Assistant: </turn> ok"])), max_size=6))
def test_template_is_reversible(turns):
    whole = "".join(C.render(r, t)[0] for r, t in turns)
    assert C.parse(whole) == turns
    for r, t in turns:
        body, a, b = C.render(r, t)
        assert C.unescape(body[a:b]) == t


def conversations():
    rng = random.Random(4)
    rows = [(i, j, rng.choice(["user", "assistant"]), rng.choice(["hi", "yes\nno", "#1 </turn>", "", None, "é🙂"]))
            for i in range(60) for j in range(rng.randint(1, 5))]
    rows += [(i, 0, "user", "same start") for i in range(100, 140)]
    rows += [(i, 1, "assistant", f"answer {i % 7}") for i in range(100, 140)]
    rows += [(200, 1, None, "null role"), (200, 0, "user:x", "colon role"), (None, 0, "assistant", "no id"),
             (201, 0, "user", "twice"), (201, 0, "user", "twice"), (202, 0, "assistant", "x" * 200_000)]
    return rows


def test_packs_read_back_to_every_conversation(spark):
    rows = conversations()
    df = spark.createDataFrame([r + (9,) for r in rows], "conv_id long, turn long, role string, text string, path int")
    want = {}
    group = defaultdict(list)
    for c, t, r, x in rows:
        group[c].append((t, r or "", x or ""))
    for c, turns in group.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        want[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for chars in (C.PACK_CHARS, 300):
        packs, index = C.format_conversations(df, pack_chars=chars)
        got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"])
               for r in collected(C.read_back(packs, index))}
        assert got == want
    packs = collected(C.format_conversations(df)[0])
    for p in packs:                                    # shared turns once, positions and intervals
        seen = set()
        for n, node in enumerate(p["nodes"]):
            chain = p["nodes"][node["parent"]] if node["parent"] >= 0 else None
            key = (node["parent"], p["text"][node["start"]:node["end"]])
            assert key not in seen
            seen.add(key)
            assert node["position"] == (chain["position"] + chain["end"] - chain["start"] if chain else 0)
            up = chain["ancestors"] + [{"start": chain["start"], "end": chain["end"]}] if chain else []
            assert node["ancestors"] == up and sum(a["end"] - a["start"] for a in up) == node["position"]


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.read_back(*C.format_conversations(df)).count() == 0


def test_targets_water_fill():
    t = M.targets([100, 100, 1], [1, 2, 3], 3)
    assert t[2] == 3 and abs(t.sum() - 201) < 1e-9 and abs(t[1] - 2 * t[0]) < 1e-9
    assert list(M.targets([], [], 3)) == [] and list(M.targets([0, 0], [1, 2], 3)) == [0, 0]
    assert np.allclose(M.targets([1, 1, 1000], [1, 1, 1], 3), [3, 3, 996])


def test_split_tree_is_exact_and_disjoint():
    q = np.array([7, 0, 100, 33])
    out = M.split_tree(q, 13, 5)
    assert (out.sum(axis=0) == q).all() and (out >= 0).all()
    assert out.sum(axis=1).max() - out.sum(axis=1).min() <= 4
    assert (out == M.split_tree(q, 13, 5)).all()


def test_mix_reaches_targets_and_is_stable(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 60))), "en", rng.choice(["a", "a", "b", "c", "é", None]))
            for i in range(1500)] + [(5000, None, "en", "b"), (5001, "x y", "en", "empty?"), (None, "p q r", "en", "a"),
                                     (7, "same id", "en", "b"), (7, "same id", "en", "b")]
    docs = docs_frame(spark, rows)
    got = collected(M.mix(docs, block_words=500, shards=8))
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        assert r["size"] == 0 or len(r["draws"]) <= 3
        assert len({(d["epoch"]) for d in r["draws"]}) == len(r["draws"])
        by[r["source"]].append(r)
    order = sorted(by, key=lambda s: (s is None, s or ""))
    size = [sum(r["size"] for r in by[s]) for s in order]
    goal = M.targets(size, [(1, 2, 3)[i % 3] for i in range(len(order))], 3)
    for s, n, g in zip(order, size, goal):
        taken = sum(r["size"] * len(r["draws"]) for r in by[s])
        assert {r["source_size"] for r in by[s]} == {n} and all(abs(r["target"] - g) < 1e-6 for r in by[s])
        assert abs(taken - g) <= max(20, 0.01 * g)
    place = lambda rs: sorted((r["doc_id"] or -1, r["size"], str(r["draws"])) for r in rs)
    assert place(got) == place(collected(M.mix(docs.repartition(7), block_words=500, shards=8)))
    words_in = Counter()
    for r in got:
        for d in r["draws"]:
            words_in[d["shard"]] += r["size"]
    assert len(words_in) == 8 and max(words_in.values()) < 3 * min(words_in.values())


def test_mix_edges(spark):
    assert M.mix(empty_docs(spark)).count() == 0
    got = collected(M.mix(docs_frame(spark)))
    assert len(got) == len(awkward_docs()) and {r["size"] for r in got if r["doc_id"] in (1, 2, 3)} == {0}
