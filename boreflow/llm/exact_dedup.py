"""Exact dedup (operator 3): a persistent digest index, bucketed and sorted by hash.

The index is a Parquet table of (digest, keep_id), bucketed and sorted by
digest, in a folder that outlives the application. A batch is reduced to one
row per digest (a hash aggregate with map-side partials, so a text with very
many copies costs one row per task), anti-joined to the index by sort-merge
without shuffling the index, and the digests that are new are appended.
Adding a batch again, or after a crash, changes nothing.

Defined cases
* NULL text counts as empty; all empty texts are equal to each other and to
  texts that hold only nothing. White-space-only texts equal one space.
* Of equal texts in one batch the smallest ``doc_id`` stays; a text that the
  index holds already keeps the id stored there. NULL ids count as largest; if
  a text has only NULL ids, ``keep_id`` is NULL and its rows are kept.
* Repeated rows with the kept id are all marked kept; ``drop_copies`` returns
  one of them.
* An empty batch leaves the index as it is; further columns are carried by
  ``drop_copies`` untouched and ignored elsewhere.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, shared_path, store, table, temporary, wrapped


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with each run of white space made one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " "), 256)


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), text_digest(F.col(text)).alias("digest"))


class DigestIndex:
    """The stored index. Open it with the bucket count it was made with."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, id_type: str = "bigint"):
        self.spark, self.buckets = spark, buckets
        self.path = f"{path.rstrip('/')}/buckets-{buckets}"
        self.name = "digest_index_" + hashlib.sha1(self.path.encode()).hexdigest()[:16]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, batch: DataFrame) -> None:
        """Append the digests of ``batch`` (doc_id, digest) that the index lacks."""
        new = batch.groupBy("digest").agg(F.min("doc_id").alias("keep_id"))
        fresh = new.hint("merge").join(self.read().select("digest"), "digest", "left_anti")
        # by the bucket's number, as the writer computes it: one file per bucket and batch
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        fresh.repartition(bucket).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def resolve(self, members: DataFrame) -> DataFrame:
        """doc_id, digest, keep_id, group_size, kept for (doc_id, digest) rows.

        The groups are stored before they are joined to the documents, so that
        both sides of that join are plain shuffles and the run-time planner can
        split the digest of a large group of copies.
        """
        sizes = members.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
        groups = self.read().hint("merge").join(sizes, "digest")
        groups = store(groups.select(F.col("digest").alias("_digest"), "keep_id", "group_size"), "digest-groups")
        joined = members.join(groups, F.col("digest") == F.col("_digest"), "left")
        return joined.select(
            "doc_id", "digest", "keep_id", "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        )


def exact_groups(docs: DataFrame, index_path: str | None = None, batches: int = 2, buckets: int = 64) -> DataFrame:
    """Run ``docs`` through an index in ``batches`` id ranges, smallest ids first.

    Returns one row per document: doc_id, digest, keep_id, group_size, kept.
    """
    spark = docs.sparkSession
    members = store(digests(docs), "digests")
    index = DigestIndex(spark, index_path or shared_path(spark, "digest-index"), buckets, dict(members.dtypes)["doc_id"])
    low, high = members.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        index.add(members)
    else:
        width = max(1, -(-(high - low + 1) // batches))
        last = (high - low) // width
        batch = F.least(F.floor((F.col("doc_id") - F.lit(low)) / F.lit(width)), F.lit(last))
        for k in range(last + 1):
            # NULL ids come last, so that an id stays wherever there is one
            mine = batch == k
            index.add(members.filter(mine | F.col("doc_id").isNull() if k == last else mine))
    return index.resolve(members)


def drop_copies(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns; of repeated rows one.

    Whole rows are shuffled once, to the ids that stay; a second time only if some
    id has a text twice, to keep one of its rows.
    """
    with temporary(docs.sparkSession):
        kept = exact_groups(docs, **how).filter("kept")
        kept = kept.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).agg(F.count(F.lit(1)).alias("_n"))
        kept = store(kept, "kept", keep=True)
    tagged = wrapped(docs).withColumn("_own", text_digest(F.col("row.text")))
    found = tagged.join(kept, F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest")), "left_semi")
    if kept.filter("_n > 1").isEmpty():
        return found.select("row.*")
    return found.dropDuplicates(["_own"]).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document with the id that stays for its text."""
    found = exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


SQL = r"""
WITH t AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
), g AS (
    SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, t.text_sha256
FROM t JOIN g USING (text_sha256)
"""
