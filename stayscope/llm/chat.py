"""Chat formatting into prefix trees of turns (dealt operator 3).

Template of a turn: ``### role: text</turn>`` and a line feed.  In roles and
texts a backslash, ``#`` and the string ``</turn>`` get a backslash before
them (in roles also ``:``), so control strings occur unescaped only where the
template puts them and dropping one backslash each restores the text.

Conversations that share their first turns share a path of a tree whose nodes
are turns.  Distinct conversations are range-partitioned and sorted by their
turns' hashes, which is depth-first order, and cut into packs of about
``pack_chars`` symbols: in a pack every node is emitted once, depth-first.
Attached per node: its symbols [start, end) in the pack, its parent, the
position id of its first symbol (its parent's last plus one; ids run on
inside the node), the intervals of its ancestors, which together with the
node's own earlier symbols are all that it may attend to, and the loss
interval (an assistant's text).  Symbols are code points of the pack's text.
A hot first turn is spread over ranges by the turns that follow; it is emitted
once in each pack that needs it.

Edge cases: null texts and roles are empty; turns are ordered by (turn, role,
text); repeated rows are repeated turns; conversations with equal turns are
one path, each keeps its own row of the index; a null conv_id is one
conversation; an empty table gives no pack; only the four named columns are
read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .store import stored

END = "</turn>"
PACK_CHARS = 1 << 16
ASSISTANT = "assistant"
_TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:(?:\\.|<(?!/turn>))[^\\<]*)*)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)

PACK_SCHEMA = ("pack long, text string, nodes array<struct<start:int,end:int,parent:int,position:int,"
               "ancestors:array<struct<start:int,end:int>>,loss_start:int,loss_end:int>>, "
               "paths array<struct<path:string,node:int>>")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("#", "\\#").replace(END, "\\" + END)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn and the interval of its text."""
    head = f"### {escape(role).replace(':', chr(92) + ':')}: "
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a formatted conversation; raises if anything is left over."""
    out, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError("not a formatted conversation")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


class _Pack:
    def __init__(self):
        self.text, self.size, self.nodes, self.paths, self.stack = [], 0, [], [], []

    def add(self, path: str, turns: list[tuple[str, str]]) -> None:
        same = 0
        while same < min(len(turns), len(self.stack)) and self.stack[same][0] == turns[same]:
            same += 1
        del self.stack[same:]
        for turn in turns[same:]:
            body, a, b = render(*turn)
            up = self.stack[-1][1] if self.stack else -1
            parent = self.nodes[up] if self.stack else None
            self.nodes.append({
                "start": self.size, "end": self.size + len(body), "parent": up,
                "position": parent["position"] + parent["end"] - parent["start"] if parent else 0,
                "ancestors": [{"start": self.nodes[n]["start"], "end": self.nodes[n]["end"]}
                              for _, n in self.stack],
                "loss_start": self.size + a if turn[0] == ASSISTANT else 0,
                "loss_end": self.size + b if turn[0] == ASSISTANT else 0})
            self.stack.append((turn, len(self.nodes) - 1))
            self.text.append(body)
            self.size += len(body)
        self.paths.append({"path": path, "node": self.stack[-1][1] if self.stack else -1})

    def row(self, pack: int) -> dict:
        return {"pack": pack, "text": "".join(self.text), "nodes": self.nodes, "paths": self.paths}


def _schema() -> pa.Schema:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    node = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("parent", pa.int32()),
                      ("position", pa.int32()), ("ancestors", pa.list_(span)),
                      ("loss_start", pa.int32()), ("loss_end", pa.int32())])
    return pa.schema([("pack", pa.int64()), ("text", pa.string()), ("nodes", pa.list_(node)),
                      ("paths", pa.list_(pa.struct([("path", pa.string()), ("node", pa.int32())])))])


def _packs(pack_chars: int):
    def run(batches):
        from pyspark import TaskContext
        part, seq, pack = TaskContext.get().partitionId(), 0, _Pack()
        for batch in batches:
            for path, turns in zip(batch.column("path").to_pylist(), batch.column("turns").to_pylist()):
                pack.add(path, [(t["role"], t["text"]) for t in turns])
                if pack.size >= pack_chars:
                    yield pa.RecordBatch.from_pylist([pack.row((part << 40) + seq)], schema=_schema())
                    seq, pack = seq + 1, _Pack()
        if pack.paths:
            yield pa.RecordBatch.from_pylist([pack.row((part << 40) + seq)], schema=_schema())
    return run


def format_conversations(rows: DataFrame, pack_chars: int = PACK_CHARS) -> tuple[DataFrame, DataFrame]:
    """(packs, index): packs as in PACK_SCHEMA; index (conv_id, path) says
    which path of the packs a conversation is."""
    ship(rows.sparkSession)
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    conv = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t")).select(
        "conv_id", F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))
    conv = stored(conv.withColumn("path", F.sha2(F.to_json("turns"), 256)), "conversations")
    order = F.transform("turns", lambda x: F.xxhash64(x["role"], x["text"]))
    packs = (conv.select("path", "turns").dropDuplicates(["path"]).withColumn("order", order)
             .repartitionByRange("order").sortWithinPartitions("order").select("path", "turns")
             .mapInArrow(_packs(pack_chars), PACK_SCHEMA))
    return packs, conv.select("conv_id", "path")


def _read_back(batches):
    """Digests of every path, from the packs alone."""
    schema = pa.schema([("path", pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    for batch in batches:
        out = []
        for text, nodes, paths in zip(*(batch.column(c).to_pylist() for c in ("text", "nodes", "paths"))):
            for p in paths:
                node = nodes[p["node"]] if p["node"] >= 0 else None
                spans = [(a["start"], a["end"]) for a in node["ancestors"]] + [(node["start"], node["end"])] if node else []
                up, losses = p["node"], []
                while up >= 0:
                    losses.append(unescape(text[nodes[up]["loss_start"]:nodes[up]["loss_end"]]))
                    up = nodes[up]["parent"]
                whole = "".join(text[a:b] for a, b in spans)
                turns, loss = parse(whole), "".join(reversed(losses))
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append({"path": p["path"], "n_turns": len(turns),
                            "turns_sha256": hashlib.sha256(said.encode()).hexdigest(),
                            "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
                            "formatted_chars": len(whole)})
        yield pa.RecordBatch.from_pylist(out, schema=schema)


def read_back(packs: DataFrame, index: DataFrame) -> DataFrame:
    """One row per conversation, read from the formatted output."""
    digests = packs.mapInArrow(_read_back, "path string, n_turns long, turns_sha256 string, loss_chars long, "
                                           "loss_sha256 string, formatted_chars long")
    return index.join(digests, "path").drop("path")
