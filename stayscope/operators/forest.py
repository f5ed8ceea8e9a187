"""A fitted forest as a node table, scored and explained by joins.

The node table (tree, node, left, right, feature, threshold, value, cover) is
the model's saved form; root nodes have number 0, leaves ``left = -1``, a row
goes left where its feature is at most the threshold (a missing value goes
right), ``value`` is the class-1 share and ``cover`` the training weight of a node.
It is bounded by trees x nodes, however many rows are scored.

*Scores*: every row starts at each tree's root and takes one hash join with the
node table per level.

*Shapley values* (path-dependent, class 1): a leaf's path says, for each feature
on it, the interval that leads to the leaf and the share ``z`` of the training
weight that went that way.  With ``o`` = 1 where the row lies in the interval, the
leaf's game pays value x prod(o in S) x prod(z outside S), and the Shapley weights
are the integral of t^|S| (1-t)^rest, so feature i of the leaf gets

    value (o_i - z_i) * integral over [0, 1] of prod over j <> i of (t o_j + (1-t) z_j) dt,

a polynomial that Gauss-Legendre quadrature integrates exactly with half as many
nodes as the path has features.  Everything is column expressions over the join
of the rows with the leaf table: no recursion and no Python worker.  The work is
rows x leaves (some 3 microseconds a pair measured); ``explain`` has a faster
form for forests of very many leaves.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, stored

MAX_BROADCAST_ROWS = 1_000_000     # model rows that may be broadcast (leaf rows are 8 columns a feature)
PAIRS_PER_TASK = 100_000_000        # (row, leaf) pairs of one task of the Shapley job
NODE_COLUMNS = ("tree", "node", "left", "right", "feature", "threshold", "value", "cover")


def node_table(spark: SparkSession, forest_model) -> DataFrame:
    """The node table of a fitted Spark forest, read from its saved data."""
    path = scratch_path(spark, "forest")
    forest_model.write().overwrite().save(path)
    stats, split = F.col("nodeData.impurityStats"), F.col("nodeData.split")
    cover = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"),
        F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"),
        split["featureIndex"].alias("feature"), F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        F.coalesce(F.try_divide(F.get(stats, F.lit(1)), cover), F.lit(0.0)).alias("value"), cover.alias("cover"))


def _model_side(table: DataFrame) -> DataFrame:
    """A table of the model: broadcast if its checked size allows it."""
    return F.broadcast(table) if table.count() <= MAX_BROADCAST_ROWS else table


def tree_depth(nodes: DataFrame) -> int:
    """Levels below the roots; the walk down is over the model's nodes alone."""
    links = nodes.where("left >= 0").select("tree", "node", "left", "right").collect()
    depth, children = 0, {(r["tree"], r["node"]): (r["left"], r["right"]) for r in links}
    level = {tree for tree, node in children if node == 0}
    level = [(tree, 0) for tree in level]
    while level := [(tree, child) for tree, node in level for child in children.get((tree, node), ())]:
        depth += 1
    return depth


def _row_vectors(df: DataFrame, id_col: str, features: Sequence[str]) -> DataFrame:
    """(id, x): the features as one array; missing values are NaN."""
    return df.select(F.col(id_col).alias("id"), F.array(
        *[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features]).alias("x"))


def forest_scores(df: DataFrame, id_col: str, features: Sequence[str], nodes: DataFrame) -> DataFrame:
    """(id, score): the mean over trees of the value of the leaf that each row
    reaches.  Rows of one id are scored together, so ids must be unique."""
    nodes = stored(nodes.select(*NODE_COLUMNS), "nodes")
    depth = tree_depth(nodes)
    trees = [r["tree"] for r in nodes.where("node = 0").select("tree").distinct().collect()]
    side = _model_side(nodes.drop("cover").withColumnRenamed("node", "at"))
    walk = (_row_vectors(df, id_col, features)
            .withColumn("tree", F.explode(F.array(*[F.lit(t).cast(nodes.schema["tree"].dataType) for t in sorted(trees)])))
            .withColumn("at", F.lit(0)))
    for level in range(depth + 1):
        here = walk.join(side, ["tree", "at"])
        step = (F.when(F.col("left") < 0, F.col("at"))
                .when(F.get("x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right")))
        walk = here.select("id", "x", "tree", step.alias("at")) if level < depth else here
    return walk.groupBy("id").agg(F.avg("value").alias("score")).withColumnRenamed("id", id_col)


def leaf_paths(nodes: DataFrame) -> DataFrame:
    """(tree, leaf, value, feature, low, high, ratio): for each feature on a
    leaf's path the interval (low, high] that leads there (null: unbounded) and
    the product of the cover ratios of its splits.  A tree of one leaf has one
    row without a feature."""
    nodes = stored(nodes.select(*NODE_COLUMNS), "nodes")
    inner = nodes.where("left >= 0")
    cover = nodes.select("tree", F.col("node").alias("child"), F.col("cover").alias("child_cover"))
    none = F.lit(None).cast("double")
    sides = [inner.select("tree", F.col("node").alias("at"), F.col(child).alias("child"), F.struct(
                 "feature", low.alias("low"), high.alias("high"), F.col("cover").alias("ratio")).alias("step"))
             for child, low, high in (("left", none, F.col("threshold")), ("right", F.col("threshold"), none))]
    edges = sides[0].unionByName(sides[1]).join(cover, ["tree", "child"]).select(
        "tree", "at", "child", F.col("step").withField(
            "ratio", F.coalesce(F.try_divide(F.col("child_cover"), F.col("step.ratio")), F.lit(0.0))).alias("step"))
    edges = stored(edges, "edges")
    walk = nodes.where("node = 0").select(
        "tree", F.col("node").alias("at"), F.array().cast(f"array<{edges.schema['step'].dataType.simpleString()}>").alias("path"))
    for _ in range(tree_depth(nodes)):
        walk = walk.join(edges, ["tree", "at"], "left").select(
            "tree", F.coalesce("child", "at").alias("at"),
            F.when(F.col("child").isNull(), F.col("path")).otherwise(F.concat("path", F.array("step"))).alias("path"))
    leaf = walk.join(nodes.select("tree", F.col("node").alias("at"), "value"), ["tree", "at"])
    return (leaf.select("tree", F.col("at").alias("leaf"), "value", F.explode_outer("path").alias("s"))
            .groupBy("tree", "leaf", "value", F.col("s.feature").alias("feature"))
            .agg(F.max("s.low").alias("low"), F.min("s.high").alias("high"), F.product("s.ratio").alias("ratio")))


def quadrature(features_on_path: int) -> list[tuple[float, float]]:
    """(node, weight) on [0, 1], exact for the leaf polynomials of such paths."""
    t, w = np.polynomial.legendre.leggauss(max(1, -(-features_on_path // 2)))
    return [(float((a + 1) / 2), float(b / 2)) for a, b in zip(t, w)]


def base_value(nodes: DataFrame) -> DataFrame:
    """One row: the cover-weighted mean leaf value, averaged over the trees."""
    per_tree = nodes.groupBy("tree").agg(
        (F.sum(F.when(F.col("left") < 0, F.col("cover") * F.col("value")))
         / F.max(F.when(F.col("node") == 0, F.col("cover")))).alias("mean"))
    return per_tree.agg(F.avg("mean").alias("base_value"), F.count(F.lit(1)).alias("trees"))


def _leaf_table(paths: DataFrame) -> tuple[DataFrame, int]:
    """Paths as one row a leaf with one slot a feature, and the slots."""
    step = F.struct("feature", "low", "high", "ratio")
    leaves = stored(paths.groupBy("tree", "leaf", "value").agg(
        F.sort_array(F.collect_list(F.when(F.col("feature").isNotNull(), step))).alias("path")), "leaves")
    slots = leaves.agg(F.max(F.size("path"))).first()[0] or 0
    cols = ["value"]
    for j in range(slots):
        at = F.get("path", F.lit(j))
        # an empty slot holds every row and takes no weight: o = z = 1
        cols += [F.coalesce(at["feature"], F.lit(-1)).alias(f"f{j}"),
                 F.coalesce(at["low"], F.lit(float("-inf"))).alias(f"low{j}"),
                 F.coalesce(at["high"], F.lit(float("inf"))).alias(f"high{j}"),
                 at["high"].isNull().alias(f"open{j}"), F.coalesce(at["ratio"], F.lit(1.0)).alias(f"z{j}")]
    return leaves.select(*cols), slots


def _total(terms: Sequence[Column]) -> Column:
    out = terms[0]
    for term in terms[1:]:
        out = out + term
    return out


def _times(terms: Sequence[Column]) -> Column:
    out = terms[0]
    for term in terms[1:]:
        out = out * term
    return out


def forest_shapley(df: DataFrame, id_col: str, features: Sequence[str], nodes: DataFrame) -> DataFrame:
    """Long table (id, feature, feature_value, shap_value, base_value,
    model_output) of class-1 Shapley values for every row of ``df`` (whose ids
    are unique and whose ``features`` are on the model's scale).  base_value
    plus a row's shap values is its model_output, the forest's score."""
    spark = df.sparkSession
    nodes = stored(nodes.select(*NODE_COLUMNS), "nodes")
    base = base_value(nodes).first()
    table, slots = _leaf_table(leaf_paths(nodes))
    points = quadrature(slots)
    slot = range(slots)
    table = stored(table, "leaf-table")
    rows = stored(_row_vectors(df, id_col, features), "rows")
    # dealt by work, not by bytes: a task has so many (row, leaf) pairs, and an
    # id's pairs are summed where they are made
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() * table.count() // PAIRS_PER_TASK))
    # the model's leaves, a bounded set, against every row: one pass over the rows
    pair = rows.repartition(tasks, "id").join(_model_side(table))
    inside = {}
    for j in slot:
        x = F.coalesce(F.get("x", F.col(f"f{j}")), F.lit(float("nan")))
        inside[f"in{j}"] = ((F.col(f"f{j}") < 0) | (~(x <= F.col(f"low{j}"))
                            & (F.col(f"open{j}") | (x <= F.col(f"high{j}")))))
    pair = pair.withColumns(inside) if slots else pair
    factor = lambda j, t: (F.when(F.col(f"in{j}"), F.lit(t)).otherwise(F.lit(0.0))
                           + F.lit(1.0 - t) * F.col(f"z{j}"))
    pair = pair.withColumns({f"p{k}": F.lit(w) * _times([F.col("value"), *[factor(j, t) for j in slot]])
                             for k, (t, w) in enumerate(points)})
    share = {}
    for j in slot:
        rest = _total([F.coalesce(F.try_divide(F.col(f"p{k}"), factor(j, t)), F.lit(0.0))
                       for k, (t, _) in enumerate(points)])
        share[f"s{j}"] = (F.when(F.col(f"in{j}"), F.lit(1.0)).otherwise(F.lit(0.0)) - F.col(f"z{j}")) * rest
    pair = pair.withColumns(share) if slots else pair
    reached = F.lit(True)
    for j in slot:
        reached = reached & F.col(f"in{j}")
    zero = F.lit(0.0)
    of = lambda i: _total([zero, *[F.when(F.col(f"f{j}") == i, F.col(f"s{j}")).otherwise(zero) for j in slot]])
    wide = pair.groupBy("id").agg(
        F.sum(F.when(reached, F.col("value")).otherwise(zero)).alias("out"),
        *[F.sum(of(i)).alias(f"phi{i}") for i in range(len(features))])
    n = F.lit(float(base["trees"] or 1))
    long = wide.join(rows, "id").select("id", "out", F.explode(F.array(*[
        F.struct(F.lit(name).alias("feature"), F.get("x", F.lit(i)).alias("feature_value"),
                 (F.col(f"phi{i}") / n).alias("shap_value")) for i, name in enumerate(features)])).alias("e"))
    return long.select("id", "e.*", F.lit(base["base_value"]).cast("double").alias("base_value"),
                       (F.col("out") / n).alias("model_output"))
