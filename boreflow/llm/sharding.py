"""Sharding (operator 4): proportional stratified interleaving.

Rows are put in seeded-shuffled order within their source, each gets its
fractional rank (r - 1/2) / n there, and the rows of all sources, sorted by
that fraction, are cut into shards of equal row counts. Every shard, and every
stretch of a shard, so has the mixture of the whole table.

Law: ``rows`` (shard counts differ by one at most).

Neither a source nor the table is sorted in one task: the shuffle key is a
hash, so its leading bits, and later the fraction itself, cut the order into
even buckets that are numbered apart and shifted by running totals.

Defined cases
* A NULL text has size 1 and checksum 0; a NULL source is a source of its own.
* Rows with equal ids (repeated rows, NULL ids) are ordered by size and
  checksum; fully equal rows are interchangeable. Each row gets its own slot.
* With fewer rows than shards some shards are empty; an empty table gives no
  rows. Further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bucket_count, key_bucket, rank_in_buckets, shuffle_key, store, table


def interleave(docs: DataFrame, shards: int = 8, seed: int = 17, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, text_crc32, law, shard, slot,
    grown_shard (NULL under this law) and fraction."""
    n = docs.count()
    buckets = bucket_count(n)
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("_stratum"),
        (F.octet_length(content).cast("long") + 1).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        shuffle_key(seed, doc_id).alias("_key"),
    ).withColumn("_bucket", key_bucket(F.col("_key"), buckets))
    ranked = rank_in_buckets(rows, ["_stratum"], "_bucket", ["_key", "size", "text_crc32"], "_rank", "_total")
    ranked = ranked.withColumn("fraction", (F.col("_rank") * 2 - 1) / (F.col("_total") * 2)).drop("_bucket", "_rank", "_total")
    ranked = ranked.withColumn("_slice", F.floor(F.col("fraction") * buckets).cast("int"))
    # stored: the slices are counted and then numbered, both over the same rows
    placed = rank_in_buckets(store(ranked, "fractions"), [], "_slice", ["fraction", "_stratum"], "_place", "_all")
    place = F.col("_place") - 1
    shard = F.floor(place * shards / F.col("_all")).cast("int")
    first = F.ceil(F.col("shard") * F.col("_all") / F.lit(shards))
    return (
        placed.withColumn("shard", shard)
        .withColumn("slot", (place - first).cast("long"))
        .select(
            "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"), "fraction",
        )
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt over shards 0 to 7."""
    out = interleave(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source", "fraction")
