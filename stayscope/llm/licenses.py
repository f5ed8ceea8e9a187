"""License scans (dealt operator 9).

Templates of m words are k-word shingle sets (k = 5, or m where m is less).
Texts are read in overlapping windows: the shingles that start in two
neighbouring runs of m words, so each place of a template lies whole inside
some window.  Templates of similar length form a class with one window grid.
A window and a template are a candidate where any MinHash band (one row)
agrees; the number of bands follows from the least Jaccard similarity that a
window with ``threshold`` of the template's shingles can have, so that such a
window is missed with probability at most ``miss``.  Candidates are verified
by exact containment of the shingles' words.  Reported is the range of bytes
from the first to the last shared shingle; a range inside another of the same
template, or of a longer form of the same license, is not repeated.

Only windows that hold as many shingles of the class's templates as the least
of these needs are hashed; no window that matches holds fewer.

Words are ``[^\\x20\\x09-\\x0D]+`` after folding A-Z, without the ASCII
punctuation at their edges (a word of nothing else is none); ranges include it.
The default table, ``licenses()``, is ``TEMPLATES`` and the whole texts and
notices in ``license_texts``.  Edge cases: null, empty and
white-space texts match nothing, nor do templates without words; very long
texts are processed whole; repeated rows each give their rows; an empty table
gives an empty result; only the id and text columns are read.
"""

from __future__ import annotations

import math
import os
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .text import IS_SPACE, Words, flat, mix64, row_slices

# Lines and short notices to look for, by name.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "MIT line": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    "Rights reserved": "All rights reserved.",
}
SHINGLE, THRESHOLD, MISS = 5, 0.8, 1e-9
FOLDER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "license_texts")    # read by the driver only
_U = np.uint64
IS_PUNCT = np.isin(np.arange(256), list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))


def licenses() -> dict[str, str]:
    """The default table: ``TEMPLATES`` and the files of ``license_texts``."""
    out = dict(TEMPLATES)
    for name in sorted(os.listdir(FOLDER)):
        if name.endswith(".txt"):
            with open(os.path.join(FOLDER, name), encoding="utf-8") as f:
                out[name.removesuffix(".txt")] = f.read()
    return out


def bare(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The texts with spaces in place of punctuation at the edges of words."""
    core = ~IS_SPACE[data] & ~IS_PUNCT[data]
    at = np.arange(len(data))
    begin, end = np.repeat(off[:-1], np.diff(off)), np.repeat(off[1:], np.diff(off))
    last = lambda x: np.maximum.accumulate(np.where(x, at, -1))
    back = lambda x: np.minimum.accumulate(np.where(x, at, len(data))[::-1])[::-1]
    lead = last(core) <= np.maximum(last(IS_SPACE[data]), begin - 1)
    trail = back(core) >= np.minimum(back(IS_SPACE[data]), end)
    return np.where(IS_PUNCT[data] & (lead | trail), np.uint8(0x20), data)


def bands_needed(least: int, window: int, threshold: float, miss: float) -> int:
    """One-row bands by which a window of at most ``window`` shingles that
    holds ``threshold`` of a set of ``least`` agrees but for ``miss``."""
    shared = math.ceil(threshold * least - 1e-9)
    j = shared / (window + least - shared)
    return max(1, math.ceil(math.log(miss) / math.log1p(-min(j, 1 - 1e-12))))


class _Class:
    """Templates of one shingle length and similar size, with their MinHashes."""

    def __init__(self, k: int, members: list[tuple[str, np.ndarray, np.ndarray]], threshold: float, miss: float):
        self.k, self.members = k, members
        self.run = max(len(h) for _, h, _ in members)             # words in half a window
        least = min(len(np.unique(h)) for _, h, _ in members)
        n = bands_needed(least, 2 * self.run, threshold, miss)
        self.need = math.ceil(threshold * least - 1e-9)           # shingles without which no window matches
        self.all = np.unique(np.concatenate([h for _, h, _ in members]))
        self.seeds = mix64(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)) | _U(1)
        self.least = np.stack([_least(h, self.seeds) for _, h, _ in members])


def _least(h: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """MinHashes of a set, one a seed."""
    return np.array([(h * seed).min() for seed in seeds])


def compile_templates(templates: Mapping[str, str], shingle: int = SHINGLE,
                      threshold: float = THRESHOLD, miss: float = MISS) -> list[_Class]:
    groups: dict[tuple[int, int], list] = {}
    for name in sorted(templates):
        data = np.frombuffer(templates[name].encode(), np.uint8)
        data = bare(data, np.array([0, len(data)]))
        w = Words(data, np.array([0, len(data)]))
        if not len(w.hash):
            continue
        k = min(shingle, len(w.hash))
        h, _ = w.shingles(k)
        groups.setdefault((k, len(h).bit_length()), []).append((name, h, _texts(data, w, 0, len(w.hash), k)))
    return [_Class(k, members, threshold, miss) for (k, _), members in sorted(groups.items())]


def _texts(data, w: Words, lo: int, hi: int, k: int) -> np.ndarray:
    """Shingles of words lo..hi as strings, A-Z folded."""
    body = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(w.start[lo:hi], w.end[lo:hi])]
    body = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in body]
    return np.array([" ".join(body[i:i + k]) for i in range(len(body) - k + 1)], object)


def scan_slice(data: np.ndarray, off: np.ndarray, classes: list[_Class], threshold: float):
    """(row, template, start, end, containment) of every match in the slice."""
    off = off - off[0]
    raw, data = Words(data, off), bare(data, off)
    w = Words(data, off)
    shingles = {k: w.shingles(k) for k in {c.k for c in classes}}
    every = {k: np.unique(np.concatenate([c.all for c in classes if c.k == k])) for k in shingles}
    known = {k: np.flatnonzero(_within(every[k], h)) for k, (h, _) in shingles.items()}
    out = []
    for c in classes:
        enough = np.diff(w.bounds) >= c.k
        h, b = shingles[c.k]
        at = known[c.k][_within(c.all, h[known[c.k]])]             # shingles of the class's templates
        n = np.where(enough, np.diff(b), 0)
        runs = -(-n // c.run)
        if not runs.sum() or not len(at):
            continue
        row = np.repeat(np.arange(len(n)), runs)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
        start = b[row] + nth * c.run
        stop = np.minimum(start + 2 * c.run, b[row] + n[row])      # shingles of a window
        hit = np.zeros((len(c.members), len(row)), bool)
        for r in np.flatnonzero(np.searchsorted(at, stop) - np.searchsorted(at, start) >= c.need):
            hit[:, r] = (c.least == _least(h[start[r]:stop[r]], c.seeds)).any(axis=1)
        for t, r in zip(*np.nonzero(hit)):
            name, _, want = c.members[t]
            first = w.bounds[row[r]] + (start[r] - b[row[r]])       # word of the window's first shingle
            have = _texts(data, w, first, first + (stop[r] - start[r]) + c.k - 1, c.k)
            shared = set(want) & set(have)
            if len(shared) >= threshold * len(set(want)) - 1e-9:
                place = np.flatnonzero(np.isin(have, list(shared)))
                begin = off[row[r]]
                whole = np.searchsorted(raw.start, w.start[[first + place[0], first + place[-1] + c.k - 1]], side="right") - 1
                out.append((int(row[r]), name, int(raw.start[whole[0]] - begin),
                            int(raw.end[whole[1]] - begin), len(shared) / len(set(want))))
    return _outer(out)


def _within(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(x), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


def _outer(found):
    """Without ranges that lie inside another of the same row and template, or
    inside a longer form (notice, whole text) of the same license."""
    keep = []
    for m in sorted(set(found), key=lambda m: (m[0], m[1], m[2], -m[3], -m[4])):
        if keep and keep[-1][:2] == m[:2] and m[3] <= keep[-1][3]:
            continue
        keep.append(m)
    forms: dict[tuple[int, str], dict[str, list]] = {}
    for m in keep:
        forms.setdefault((m[0], _license(m[1])), {}).setdefault(m[1], []).append(m)
    return [m for m in keep if not any(
        o[2] <= m[2] and m[3] <= o[3] and o[3] - o[2] > m[3] - m[2]
        for name, others in forms[m[0], _license(m[1])].items() if name != m[1] for o in others)]


def _license(name: str) -> str:
    """What a line, a notice and the whole text of one license share."""
    return name.replace("-notice", " notice").replace("-line", " line").removesuffix(" line").removesuffix(" notice")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: Mapping[str, str] | None = None, threshold: float = THRESHOLD,
         miss: float = MISS) -> DataFrame:
    """(id, license, start, end, containment): matches as byte ranges, of
    ``licenses()`` unless other ``templates`` are given."""
    ship(docs.sparkSession)
    classes = compile_templates(licenses() if templates is None else templates, threshold=threshold, miss=miss)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            data, off = flat(batch.column("text"))
            found = []
            for lo, hi in row_slices(off):
                found += [(lo + r, *m) for r, *m in scan_slice(data[off[lo]:off[hi]], off[lo:hi + 1], classes, threshold)]
            cols = list(zip(*found)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.float64())],
                ["id", "license", "start", "end", "containment"])

    t = d.schema["id"].dataType.simpleString()
    return d.mapInArrow(run, f"id {t}, license string, start long, end long, containment double").withColumnRenamed("id", id_col)
