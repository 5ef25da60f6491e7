"""Approximate nearest neighbours (operator 9): a forest of random-projection trees.

The trees are fitted on a bounded sample (``SAMPLE`` vectors with the smallest
hash of their id); a split's direction joins two random points of the node, its
threshold is the median. Every row is routed to one leaf of every tree. A query
walks all trees through one shared priority queue, nearest split boundary first,
until it has visited a given number of leaves; that number is set on the sample:
the smallest that finds ``RECALL`` of the true neighbours there. (A larger table
has nearer neighbours in the same leaves, so recall only rises with its size.)
Leaves meet their visiting queries in groups cut to at most about ``ROWS`` rows
and ``QUERIES`` queries, where distances are computed; the best of all leaves
are reranked by exact distance on the original vectors.

Of equal vectors only the k + 1 smallest ids can be among the k nearest, so
the others are left out before anything is routed: results are the same.

Defined cases
* Rows whose id is NULL, whose vector is NULL, empty, zero or holds NULL or
  non-finite components, or has another length than most, take no part.
* A query with fewer than k candidates gets all of them; a table without any
  gives no rows. Equal distances go to the smaller id.
* Repeated rows count once. Rows that share an id are never each other's
  neighbours; as queries their lists are merged.
* Further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shuffle_key, store, table

SAMPLE, LEAF, TREES = 16_384, 128, 8
RECALL, PROBES = 0.96, 128
ROWS, QUERIES = 4096, 1024


# --- the forest -----------------------------------------------------------------


@dataclass
class Tree:
    """Inner nodes hold a unit normal and a threshold; child < 0 is leaf ~child."""

    normal: np.ndarray
    bound: np.ndarray
    child: np.ndarray  # (nodes, 2): at most the bound, over it
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64) if len(self.bound) else np.full(len(x), -1, np.int64)
        while (inner := at >= 0).any():
            n = at[inner]
            over = np.einsum("ij,ij->i", x[inner], self.normal[n]) > self.bound[n]
            at[inner] = self.child[n, over.astype(int)]
        return ~at


def grow(x: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    normal, bound, child, leaves = [], [], [], 0

    def split(rows: np.ndarray) -> int:
        nonlocal leaves
        for _ in range(4 if len(rows) > leaf else 0):
            a, b = x[rng.choice(rows, 2, replace=False)]
            length = np.linalg.norm(a - b)
            if not length:
                continue
            w = (a - b) / length
            p = x[rows] @ w
            t = np.median(p)
            over = p > t
            if over.any():
                k = len(bound)
                normal.append(w), bound.append(t), child.append([0, 0])
                child[k] = [split(rows[~over]), split(rows[over])]
                return k
        leaves += 1
        return -leaves

    split(np.arange(len(x)))
    width = x.shape[1]
    return Tree(np.array(normal, np.float64).reshape(-1, width), np.array(bound, np.float64), np.array(child, np.int64).reshape(-1, 2), leaves)


def visits(forest: list[Tree], x: np.ndarray, most: int) -> Iterator[list[tuple[int, int]]]:
    """For each query the (tree, leaf) pairs in the order of the shared queue."""
    sides = [x @ t.normal.T - t.bound for t in forest]
    for q in range(len(x)):
        queue = [(0.0, i, 0 if len(t.bound) else -1) for i, t in enumerate(forest)]
        heapq.heapify(queue)
        out: list[tuple[int, int]] = []
        while queue and len(out) < most:
            margin, i, at = heapq.heappop(queue)
            while at >= 0:
                s = sides[i][q, at]
                near, far = forest[i].child[at] if s <= 0 else forest[i].child[at][::-1]
                heapq.heappush(queue, (max(margin, abs(s)), i, int(far)))
                at = int(near)
            out.append((i, ~at))
        yield out


def calibrate(forest: list[Tree], x: np.ndarray, k: int, recall: float, probes: int) -> int:
    """The visits after which ``recall`` of the sample's true neighbours are found."""
    everything = sum(t.leaves for t in forest)
    queries = np.arange(0, len(x), max(1, len(x) // probes))
    leaf = [t.leaf_of(x) for t in forest]
    square = (x * x).sum(axis=1)
    found = []
    for q, order in zip(queries, visits(forest, x[queries], everything)):
        distance = square - 2 * (x @ x[q])
        distance[q] = np.inf
        true = np.argsort(distance)[: min(k, len(x) - 1)]
        turn = {v: n for n, v in enumerate(order, 1)}
        found += [min(turn[i, int(leaf[i][r])] for i in range(len(forest))) for r in true]
    if not found:
        return everything
    return int(np.sort(found)[min(len(found) - 1, math.ceil(recall * len(found)))])


def fit(vectors: DataFrame, k: int, sample: int, leaf: int, trees: int, recall: float, probes: int, seed: int) -> tuple[list[Tree], int]:
    picked = vectors.select("vec_id", "vector", shuffle_key(seed, "vec_id").alias("_key")).orderBy("_key", "vec_id").limit(sample)
    x = np.stack(picked.select("vector").toArrow().column(0).to_numpy()).astype(np.float64)
    rng = np.random.default_rng(seed)
    forest = [grow(x, leaf, rng) for _ in range(trees)]
    return forest, calibrate(forest, x, k, recall, probes)


# --- search -----------------------------------------------------------------------


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    v = F.col("vector")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull()).filter(fine)
    usual = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (usual["n"] if usual else 0)).withColumn("vector", v.cast("array<double>"))


def _routed(forest: list[Tree], kind: str):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column("vector").to_numpy(zero_copy_only=False))
                leaves = np.stack([t.leaf_of(x) for t in forest], axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(leaves.tolist(), pa.list_(pa.int32()))], ["vec_id", "vector", "leaves"])

    return route, f"vec_id {kind}, vector array<double>, leaves array<int>"


def _visiting(forest: list[Tree], most: int, kind: str):
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column("vector").to_numpy(zero_copy_only=False))
                stops = [[{"tree": t, "leaf": n} for t, n in order] for order in visits(forest, x, most)]
                stops = pa.array(stops, pa.list_(pa.struct([("tree", pa.int32()), ("leaf", pa.int32())])))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), stops], ["vec_id", "vector", "stops"])

    return visit, f"vec_id {kind}, vector array<double>, stops array<struct<tree:int,leaf:int>>"


def _nearest(k: int):
    def nearest(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(rows) and len(queries):
            ids, x, y = rows["vec_id"].to_numpy(), np.stack(rows["vector"]), np.stack(queries["vector"])
            a, b = (x * x).sum(axis=1), (y * y).sum(axis=1)
            rough = a[None, :] + b[:, None] - 2 * (y @ x.T)
            # what rounding may have put out of order is within this of the k-th
            slack = 1e-9 * (a.max() + b)
            for q, own in enumerate(queries["vec_id"].to_numpy()):
                near = np.where(ids == own, np.inf, rough[q])
                edge = np.partition(near, k - 1)[k - 1] if len(near) > k else np.inf
                pick = np.flatnonzero((near <= edge + slack[q]) & np.isfinite(near))
                score = np.sqrt(((x[pick] - y[q]) ** 2).sum(axis=1))
                best = np.lexsort((ids[pick], score))[:k]
                out["query_id"] += [own] * len(best)
                out["vec_id"] += ids[pick][best].tolist()
                out["score"] += score[best].tolist()
        return pd.DataFrame(out)

    return nearest


def search(
    vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
    sample: int = SAMPLE, leaf: int = LEAF, trees: int = TREES, recall: float = RECALL, probes: int = PROBES, seed: int = 3,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query row.
    ``is_query`` is a condition on the column ``vec_id``."""
    spark = vectors.sparkSession
    rows = store(usable(vectors, vec_id, embedding), "vectors")
    kind = rows.schema["vec_id"].dataType.simpleString()
    shape = f"query_id {kind}, vec_id {kind}, score double"
    n = rows.count()
    if not n:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    forest, most = fit(rows, k, sample, leaf, trees, recall, probes, seed)
    smallest = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = rows.distinct().withColumn("_copy", smallest).filter(F.col("_copy") <= k + 1).drop("_copy")
    queries = rows.filter(is_query).distinct()
    # groups: a leaf's rows and its queries are cut into parts of bounded size
    leaves = max(1, min(t.leaves for t in forest))
    row_parts = math.ceil(n / leaves / ROWS)
    query_parts = math.ceil(queries.count() / QUERIES)
    route, routed = _routed(forest, kind)
    visit, visiting = _visiting(forest, most, kind)

    def part(parts: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")

    def parts(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    keys = ["tree", "leaf", "row_part", "query_part"]
    members = (
        distinct.mapInArrow(route, routed)
        .select("vec_id", "vector", F.posexplode("leaves").alias("tree", "leaf"), part(row_parts).alias("row_part"))
        .select("*", parts(query_parts).alias("query_part"))
    )
    visitors = (
        queries.mapInArrow(visit, visiting)
        .select("vec_id", "vector", F.explode("stops").alias("s"), part(query_parts).alias("query_part"))
        .select("vec_id", "vector", "s.tree", "s.leaf", "query_part", parts(row_parts).alias("row_part"))
    )
    found = members.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInPandas(_nearest(k), shape).distinct()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every vector whose id is divisible by 100."""
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
