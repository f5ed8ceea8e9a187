"""License scans: the default table's whole texts, and punctuation at words' edges."""

import random

from llm_fixtures import collected, docs_frame
from stayscope.llm import licenses as L


def test_whole_texts_are_found_and_edge_punctuation_does_not_count(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join(f"v{rng.randrange(300)}" for _ in range(n))
    table = L.licenses()
    assert set(table) >= set(L.TEMPLATES) | {
        "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0", "GPL-2", "GPL-3", "LGPL-2.1", "LGPL-3", "MPL-2.0",
        "AGPL-3.0-notice", "Unlicense", "CC0-1.0", "CC-BY-SA-4.0-line"}
    names = sorted(table)
    rows = [(i, f"{prose(30)}\n# " + table[n].replace("\n", "\n# ") + f"\n{prose(40)}", "en", "a") for i, n in enumerate(names)]
    lines = {1000: ("we have Released under the MIT License", "MIT line"), 1001: ("(Released under the MIT License, 2020)", "MIT line"),
             1002: ("so all rights reserved, they said", "Rights reserved"), 1003: ("\"Licensed under CC BY-NC 4.0\"!", "CC-BY-NC-4.0 line")}
    rows += [(i, f"{prose(20)} {t} {prose(20)}", "en", "a") for i, (t, _) in lines.items()]
    rows.append((2000, prose(900) + " ... --- (all) the rights", "en", "a"))
    got = collected(L.scan(docs_frame(spark, rows)))
    found = {(r["doc_id"], r["license"]) for r in got}
    assert {(i, n) for i, n in enumerate(names)} <= found
    assert {x for x in found if x[0] >= 1000} == {(i, n) for i, (_, n) in lines.items()}
    text = {i: t.encode() for i, t, *_ in rows}
    ranges = {r["doc_id"]: text[r["doc_id"]][r["start"]:r["end"]].decode() for r in got if r["doc_id"] >= 1000}
    assert ranges[1001] == "(Released under the MIT License," and ranges[1003] == lines[1003][0]
