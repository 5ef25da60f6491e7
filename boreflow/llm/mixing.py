"""Mixing sources to target weights (operator 8): temperature mixing.

Token shares of the sources are raised to an exponent between 0 (all equal)
and 1 (as they are) and normalised. The exponent is bisected: the flattest
mixture that keeps the most repeated source within ``max_epochs``, or the one
whose entropy is ``entropy`` (nats). The weights are realised as token budgets:
each source is read in epochs, an epoch is a seeded permutation of its blocks,
and reading stops where the source's budget is used up, so at most one document
per source goes over it. Without ``budget`` the total is the smallest at which
every document of every source is used at least once.

A block is a set of documents with equal leading hash bits. Running totals are
taken over blocks (a small table) and inside a block, never over a source, so
a source that holds a third of all rows is read by as many tasks as it has
blocks. The driver holds one number per source.

Defined cases
* A document counts its words plus one, so NULL and empty texts count one.
* A NULL source is a source of its own. Rows with equal ids (repeated rows,
  NULL ids) share a block and are read one after another.
* One source: weight 1, one epoch. An empty table gives no rows. All columns of
  the input are kept by ``mix``; the added ones replace columns of those names.
* A ``budget`` that no exponent can spend within ``max_epochs`` raises ValueError.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, bucket_count, key_bucket, shuffle_key, store, table, wrapped

MAX_EPOCHS = 2.0
STEPS = 60


def word_count(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long") + 1


def tempered(sizes: dict[str, int], exponent: float) -> dict[str, float]:
    total = sum(sizes.values())
    raw = {s: (n / total) ** exponent for s, n in sizes.items()}
    norm = math.fsum(raw.values())
    return {s: x / norm for s, x in raw.items()}


def epochs(sizes: dict[str, int], weights: dict[str, float], budget: float | None) -> dict[str, float]:
    """How often each source is read; without a budget the least read one, once."""
    budget = budget or max(sizes[s] / weights[s] for s in sizes)
    return {s: weights[s] * budget / sizes[s] for s in sizes}


def entropy_of(weights: dict[str, float]) -> float:
    return -math.fsum(w * math.log(w) for w in weights.values() if w > 0)


def solve(sizes: dict[str, int], max_epochs: float | None = MAX_EPOCHS, entropy: float | None = None, budget: float | None = None) -> tuple[float, dict[str, float]]:
    """(exponent, weights). Both measures change in one direction with the exponent."""

    def flat_enough(exponent: float) -> bool:
        weights = tempered(sizes, exponent)
        if entropy is not None:
            return entropy_of(weights) <= entropy
        return max(epochs(sizes, weights, budget).values()) <= max_epochs * (1 + 1e-12)

    if flat_enough(0.0):
        return 0.0, tempered(sizes, 0.0)
    if not flat_enough(1.0):
        if entropy is None:
            raise ValueError("the budget needs more epochs than max_epochs")
        return 1.0, tempered(sizes, 1.0)
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if flat_enough(middle) else (middle, high)
    return high, tempered(sizes, high)


def mix(
    docs: DataFrame,
    max_epochs: float | None = MAX_EPOCHS,
    entropy: float | None = None,
    budget: float | None = None,
    seed: int = 11,
) -> DataFrame:
    """One row per reading of a document: its columns, mix_tokens, mix_epoch (from 0),
    mix_weight, mix_position (tokens of its source before it) and mix_at, the part of
    its source's budget before it; sorted by mix_at, any stretch has the mixture."""
    spark = docs.sparkSession
    added = ["mix_tokens", "mix_epoch", "mix_weight", "mix_position", "mix_at"]
    docs = docs.drop(*added)
    buckets = bucket_count(docs.count())
    rows = wrapped(docs).select(
        "row",
        F.coalesce(F.concat(F.lit("="), F.col("row.source")), F.lit("")).alias("_source"),
        shuffle_key(seed, "row.doc_id").alias("_key"),
        word_count("row.text").alias("mix_tokens"),
    ).withColumn("_block", key_bucket(F.col("_key"), buckets))
    blocks = store(rows.groupBy("_source", "_block").agg(F.sum("mix_tokens").alias("_tokens")), "mix-blocks")
    sizes = {r["_source"]: r["n"] for r in blocks.groupBy("_source").agg(F.sum("_tokens").alias("n")).collect()}
    if not sizes:
        return docs.select("*", *(F.lit(None).cast(t).alias(c) for c, t in zip(added, ("long", "int", "double", "long", "double")))).limit(0)
    _, weights = solve(sizes, max_epochs, entropy, budget)
    reads = epochs(sizes, weights, budget)
    # one row per source: the mixture itself
    targets = spark.createDataFrame(
        [(s, n, weights[s], reads[s] * n, math.ceil(reads[s] - 1e-9)) for s, n in sizes.items()],
        "_source string, _size long, mix_weight double, _target double, _epochs int",
    )
    read = blocks.join(targets, "_source").withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.col("_epochs") - 1)))
    order = Window.partitionBy("_source", "mix_epoch").orderBy(F.xxhash64(F.lit(seed), "mix_epoch", "_block"), "_block")
    before = F.sum("_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_tokens")
    read = read.withColumn("_before", F.col("mix_epoch") * F.col("_size") + before)
    read = read.groupBy("_source", "_block", "mix_weight", "_target").agg(F.collect_list(F.struct("mix_epoch", "_before")).alias("_reads"))
    inside = Window.partitionBy("_source", "_block").orderBy("_key", "mix_tokens")
    rows = rows.withColumn("_inside", F.sum("mix_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("mix_tokens"))
    out = rows.join(read, ["_source", "_block"]).withColumn("_read", F.explode("_reads"))
    out = out.withColumn("mix_position", F.col("_read._before") + F.col("_inside")).filter(F.col("mix_position") < F.col("_target") - 1e-6)
    return out.select(
        "row.*", "mix_tokens", F.col("_read.mix_epoch").alias("mix_epoch"), "mix_weight", "mix_position",
        (F.col("mix_position") / F.col("_target")).alias("mix_at"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading of every document in the mixture, at most ``MAX_EPOCHS`` epochs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = mix(docs)
    return out.select(
        "doc_id", "source", F.col("mix_epoch").alias("epoch"), F.col("mix_tokens").alias("tokens"),
        F.col("mix_weight").alias("weight"), F.col("mix_position").alias("position"), F.col("mix_at").alias("at"),
    )
