from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from stayscope.llm import manifest
from llm_fixtures import awkward_docs, collected, docs_frame, empty_docs


def _h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _leaf(i, text, lang, source, n):
    said = ["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (i, source, lang, n, text)]
    return _h(*said)


def _levels(row):
    levels = [row]
    while len(row) > 1:
        row = [_h(*row[i:i + 2]) for i in range(0, len(row), 2)]
        levels.append(row)
    return levels


def _siblings(levels, at):
    out = []
    for row in levels[:-1]:
        out.append((at % 2, row[at ^ 1] if at ^ 1 < len(row) else None))
        at //= 2
    return out


def _fold(digest, steps):
    for right, other in steps:
        digest = _h(digest) if other is None else _h(other, digest) if right else _h(digest, other)
    return digest


def _brute(rows, tampered):
    """Row tuples (id, leaf, subroot, root, proof, folded, verified)."""
    groups = {}
    for i, text, lang, source in rows:
        n = len(text) if text is not None else None
        leaf = _leaf(i, text, lang, source, n)
        other = _leaf(i, text, lang, source, n + 1 if n is not None else None) if tampered(i) else leaf
        groups.setdefault(lang, []).append((i is not None, i or 0, leaf, other, i))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _levels([x[2] for x in sorted(groups[g])]) for g in langs}
    top = _levels([trees[g][-1][0] for g in langs])
    out = []
    for place, g in enumerate(langs):
        for at, (_, _, leaf, other, i) in enumerate(sorted(groups[g])):
            steps = _siblings(trees[g], at) + _siblings(top, place)
            folded = _fold(other, steps)
            out.append((i, leaf, trees[g][-1][0], top[-1][0], _h(*[s for _, s in steps if s]), folded,
                        folded == top[-1][0]))
    return out


def _order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("bits", [2, 10])
def test_equals_brute_force(spark, monkeypatch, bits):
    # workers import the module anew, so the small blocks are set where pages are cut and climbed
    rows = awkward_docs() + [(500 + i, f"t{i}", "de", None) for i in range(23)]
    made = manifest.build(docs_frame(spark, rows), where=F.col("doc_id") % 3 == 0,
                          changes={"n_chars": F.col("n_chars") + 1}, bits=bits)
    got = [tuple(r) for r in made.proofs().collect()]
    assert _order(got) == _order(_brute(rows, lambda i: i is not None and i % 3 == 0))
    assert {r["verified"] for r in collected(made.proofs())} == {True, False}


def test_versions_share_untouched_nodes(spark):
    rows = [(i, f"text {i}", "en" if i < 37 else None, "a") for i in range(40)]
    made = manifest.build(docs_frame(spark, rows), where=F.col("doc_id").isin(5, 36, 39),
                          changes={"text": F.concat("text", F.lit("!"))}, bits=2)
    proofs = {r["id"]: r for r in collected(made.proofs())}
    copied = {}
    for r in collected(made.versions()):
        copied.setdefault(r["id"], []).append(r)
    assert set(copied) == {5, 36, 39}
    roots = {r["group"]: r for r in collected(made.roots())}
    assert set(roots) == {"en", None} and len({r["root"] for r in roots.values()}) == 1
    for i, nodes in copied.items():
        nodes.sort(key=lambda r: r["level"])
        assert [r["level"] for r in nodes] == list(range(1, len(nodes) + 1))
        assert len(nodes) == (6 if i < 37 else 2) + 1          # one node a level, root included
        assert all(r["digest"] == _h(r["left"], r["right"] or "") for r in nodes)
        assert all(a["digest"] in (b["left"], b["right"]) for a, b in zip(nodes, nodes[1:]))
        assert nodes[-1]["digest"] == proofs[i]["folded_root"] != proofs[i]["root"]
    assert all(r["verified"] == (i not in copied) for i, r in proofs.items())


def test_path_tree_keeps_older_versions():
    leaves = [_h(str(i)) for i in range(11)]
    tree = manifest.PathTree(leaves, 4)
    first, size = tree.root, len(tree.digest)
    second = tree.update(10, _h("x"))
    assert len(tree.digest) == size + 5
    third = tree.update(0, _h("y"), second)
    assert tree.digest[first] == _levels(leaves)[-1][0]
    changed = leaves[:10] + [_h("x")]
    assert tree.digest[second] == _levels(changed)[-1][0]
    assert tree.digest[third] == _levels([_h("y")] + changed[1:])[-1][0]


def test_one_leaf_and_none(spark):
    made = manifest.build(docs_frame(spark, [(1, "only", None, None)]))
    (row,) = collected(made.proofs())
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"]
    assert row["proof_sha256"] == _h()
    assert manifest.build(empty_docs(spark)).proofs().collect() == []


def test_many_equal_rows(spark):
    rows = [(7, "same", "en", "a")] * 50 + [(None, None, None, None)] * 9
    got = [tuple(r) for r in manifest.build(docs_frame(spark, rows), bits=3).proofs().collect()]
    assert _order(got) == _order(_brute(rows, lambda i: False))
