"""Connected components of an edge table, by contraction with random priorities.

In each round every node moves to the node of smallest priority within two steps
of it, and edges are contracted; priorities are drawn anew each round, so the edges
left shrink by a constant factor whatever the shape (a chain of any length), and a
star or a crowd of any size takes one round. Each round is a few joins and
hash-partitioned aggregates; results are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few, store


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); equal labels, one component.
    ``rows``: about how many edges, if known."""
    live = edges.select("a", "b").filter("a != b").distinct()
    live = store(live if rows is None else few(live, rows), "edges")
    labels = live.select(F.col("a").alias("node"), F.col("b").alias("label"))  # of no edges: empty
    nodes = 0
    for turn in range(64):
        # a round has at most two rows per edge, the labels one per node of the first edges
        rows = 2 * live.count()
        if not rows:
            return labels
        nodes = max(nodes, rows)

        def ranked(c):
            return F.struct(F.xxhash64(F.lit(turn), c).alias("r"), F.col(c).alias("v"))

        sides = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        both = live.select(F.explode(sides).alias("e")).select("e.a", "e.b")
        # stored before the join, so that its sides are plain shuffles and a hub can be split
        near = both.groupBy("a").agg(F.min(ranked("b")).alias("m")).select(F.col("a").alias("node"), F.least("m", ranked("a")).alias("m"))
        near = store(few(near, rows), "nearest")
        # a node is a neighbour of its neighbours, so its own smallest is among theirs
        hop = both.join(near, F.col("b") == F.col("node")).groupBy("a").agg(F.min("m").alias("m"))
        hop = store(few(hop.select(F.col("a").alias("old"), F.col("m.v").alias("new")), rows), "hops")
        if turn:
            labels = store(few(labels.join(hop, F.col("label") == F.col("old"), "left").select("node", F.coalesce("new", "label").alias("label")), nodes), "labels")
        else:
            labels = hop.toDF("node", "label")
        moved = live.join(hop, F.col("a") == F.col("old")).select(F.col("new").alias("a"), "b")
        moved = moved.join(hop, F.col("b") == F.col("old")).select("a", F.col("new").alias("b"))
        moved = moved.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        live = store(few(moved.distinct(), rows), "edges")
    raise RuntimeError("components did not converge")


def merged(labels: DataFrame, edges: DataFrame, rows: int | None = None) -> DataFrame:
    """``labels`` (node, label) after further ``edges`` (a, b), new nodes included: what
    is one component already is one node, so only edges between components are contracted.
    ``rows``: about how many edges, if known."""
    of = labels.toDF("_node", "_label")
    between = edges.select("a", "b").join(of, F.col("a") == F.col("_node"), "left").select(F.coalesce("_label", "a").alias("a"), "b")
    between = between.join(of, F.col("b") == F.col("_node"), "left").select("a", F.coalesce("_label", "b").alias("b"))
    moved = components(between, rows).toDF("_old", "_new")
    known = labels.join(moved, F.col("label") == F.col("_old"), "left").select("node", F.coalesce("_new", "label").alias("label"))
    # a label is one of its nodes, so what is no node yet is new
    new = moved.join(of, F.col("_old") == F.col("_node"), "left_anti").select(F.col("_old").alias("node"), F.col("_new").alias("label"))
    both = known.union(new)
    return store(both if rows is None else few(both, labels.count() + 2 * rows), "labels")
