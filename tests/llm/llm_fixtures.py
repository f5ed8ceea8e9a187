"""Small awkward tables and brute-force versions shared by the tests."""

from __future__ import annotations

import random
import re

UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FOLD = str.maketrans(UP, UP.lower())
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, h long, key string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


def shingles(text, k):
    w = words(text)
    if len(w) >= k:
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def awkward_docs(seed=3):
    """(doc_id, text, lang, source): nulls, empties, white space, one word,
    copies, near copies, repeated rows, a long text, non-ASCII and controls."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base = prose(220)
    near = base.split(" ")
    near[7] = "changed"
    far = base.split(" ")
    for i in range(0, 220, 9):
        far[i] = "other"
    passage = prose(60)
    rows = [
        (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n\x0b ", None, "b"), (4, "One", "en", "a"),
        (5, "one", "fr", "a"), (6, base, "en", "a"), (7, base, "en", "b"), (8, " ".join(near), "en", "a"),
        (9, " ".join(far), "en", "c"), (10, base.upper(), "en", "c"), (11, prose(6000), "en", None),
        (12, "Ünïcode ßtraße " * 40, "de", "b"), (13, "a" * 900, "en", "b"), (14, "ab " * 400, "en", "b"),
        (15, prose(40) + " " + passage + " " + prose(30), "en", "a"),
        (16, prose(25) + "\n" + passage + "\n" + prose(15), "en", "a"),
        (17, "### 123 --- !!", "en", "a"), (18, "two words", "en", "c"), (18, "two words", "en", "c"),
        (19, "日本語 テキスト 🙂🙂", "ja", "c"), (None, "no id here " + prose(20), "en", "c"),
    ]
    rows += [(100 + i, prose(rng.randint(1, 60)) + ".\n" + prose(rng.randint(5, 60)) + ".", "en",
              rng.choice("abc")) for i in range(30)]
    return rows


def docs_frame(spark, rows=None):
    """documents with extra columns whose names the operators use inside."""
    rows = awkward_docs() if rows is None else rows
    return spark.createDataFrame([(i, t, la, s, len(t) if t is not None else None, "x", 1, "y")
                                  for i, t, la, s in rows], DOC_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def collected(df):
    return [r.asDict(recursive=True) for r in df.collect()]
