"""The corpus pipeline: five stages over ``documents``, each one operator of ``boreflow.llm``.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage before
has kept; its result is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``. The mixing
stage reads every remaining document at least once and documents of smaller
sources up to twice, so its result holds repeated rows; packing places each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boreflow.llm import exact_dedup, mixing, near_dedup, packing, toxicity
from boreflow.llm.common import store, table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays."""
    return near_dedup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target weights, in epochs of block permutations."""
    return mixing.mix(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.packed(docs)


STAGES = [("toxicity", clean), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack)]

#: A trained classifier and a tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
