"""Intermediate tables in the shared folder, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_stored, stored

__all__ = ["connected_components", "drop_stored", "free_name", "stored", "text_key"]


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names differ by more than case)."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base += "_"
    return base


def text_key(text_col: str) -> Column:
    """16 bytes by which rows of one text are known; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def _flat(up: DataFrame) -> DataFrame:
    """(node, parent) with every parent replaced by its tree's root."""
    was = None
    while True:
        over = up.select(F.col("node").alias("parent"), F.col("parent").alias("over"))
        up = stored(up.join(over, "parent").select("node", "parent", "over"), "parents")
        if was is not None:
            drop_stored(was)
        was = up
        if up.where("parent <> over").isEmpty():
            return up.select("node", "parent")
        up = up.select("node", F.col("over").alias("parent"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for undirected long pairs (a, b): component is the
    smallest node reachable.  Nulls and self loops are dropped.

    Each round hooks every node to its least neighbour, follows the hooks to
    their roots and keeps the edges between different roots; at least half of
    a component's nodes go, so rounds and rows fall geometrically, and a star
    is done after one.  The joins are on node keys, which adaptive execution
    splits where a hub is hot.  Nothing but "any left" reaches the driver.
    """
    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    e = stored(edges.where("a <> b").select(*pair("a", "b")).distinct(), "edges")
    rounds = []
    while not e.isEmpty():
        both = e.select(F.col("a").alias("node"), F.col("b").alias("near")).union(e.select("b", "a"))
        up = _flat(both.groupBy("node").agg(F.least("node", F.min("near")).alias("parent")))
        rounds.append(up)
        ends = [up.select(F.col("node").alias(x), F.col("parent").alias(f"to_{x}")) for x in ("a", "b")]
        was, e = e, stored(e.join(ends[0], "a").join(ends[1], "b").where("to_a <> to_b")
                           .select(*pair("to_a", "to_b")).distinct(), "edges")
        drop_stored(was)
    if not rounds:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = rounds[-1].withColumnRenamed("parent", "component")
    for up in rounds[-2::-1]:
        out = up.join(out.withColumnRenamed("node", "parent"), "parent", "left").select(
            "node", F.coalesce("component", "parent").alias("component"))
    return out if len(rounds) == 1 else stored(out, "labels")
