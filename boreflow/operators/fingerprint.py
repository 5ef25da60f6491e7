"""DQ-9: reconciliation by fingerprints.

Both sides are summed up per (partition, key range) by checksums that do not depend
on the order of rows; the ranges whose checksums agree hold the same rows, and
only the others are compared row by row. A fingerprint has one row per range,
whatever the rows, so it can be stored with a load and compared later without
reading the load again.

A checksum is the number of rows and, of a 64-bit hash of all columns, the XOR and
the sums of both halves: a lost, added, repeated or changed row changes it. Two
different ranges agree by chance about once in 2**64.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANGE = "_range"
CHECKS = ("rows", "xor", "low", "high")


def with_range(rows: DataFrame, key: Sequence[str], ranges: int) -> DataFrame:
    """Adds the key range of a row: a hash range, so that all are about equally full."""
    return rows.withColumn(RANGE, F.pmod(F.xxhash64(*key), F.lit(ranges)).cast("int"))


def fingerprints(rows: DataFrame, partition_by: Sequence[str], key: Sequence[str], ranges: int = 16) -> DataFrame:
    """``partition_by``, ``_range`` and the checksums: one hash aggregate with partial sums."""
    # a NULL hashes to the seed, so each column says whether it is NULL as well
    h = F.xxhash64(*[c for name in sorted(rows.columns) for c in (F.col(name), F.col(name).isNull())])
    hashed = with_range(rows, key, ranges).withColumn("_h", h)
    half = F.lit(2**32)
    return hashed.groupBy(*partition_by, RANGE).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("_h").alias("xor"),
        F.sum(F.pmod("_h", half)).alias("low"), F.sum(F.shiftright("_h", 32)).alias("high"),
    )


def differing(left: DataFrame, right: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """The ranges (``partition_by``, ``_range``) whose fingerprints differ or that one side lacks."""
    at = F.struct(*partition_by, RANGE).alias("_at")
    checks = F.struct(*CHECKS)
    a = left.select(at, checks.alias("_a"))
    b = right.select(at, checks.alias("_b"))
    both = a.join(b, "_at", "full_outer")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select("_at.*")


def load_diff(
    left: DataFrame, right: DataFrame, partition_by: Sequence[str], key: Sequence[str], ranges: int = 16,
    left_prints: DataFrame | None = None, right_prints: DataFrame | None = None,
) -> DataFrame:
    """Rows that one side has more often than the other: all columns, ``side`` (``left`` or
    ``right``) and ``n`` (how many more). Columns of both sides must be the same.

    Stored ``fingerprints`` of a side spare reading it whole. Rows are read from the
    partitions that differ only, if the tables are partitioned by the first of
    ``partition_by`` (their values are a short list, which prunes the scans).
    """
    left_prints = fingerprints(left, partition_by, key, ranges) if left_prints is None else left_prints
    right_prints = fingerprints(right, partition_by, key, ranges) if right_prints is None else right_prints
    found = differing(left_prints, right_prints, partition_by).checkpoint()
    first = partition_by[0]
    values = [r[0] for r in found.select(first).distinct().collect()]
    inside = F.col(first).isin([v for v in values if v is not None])
    inside = inside | F.col(first).isNull() if None in values else inside
    wanted = found.select(F.struct(*partition_by, RANGE).alias("_at"))

    def rows(side: DataFrame, sign: int) -> DataFrame:
        ranged = with_range(side.where(inside), key, ranges).withColumn("_at", F.struct(*partition_by, RANGE))
        return ranged.join(wanted, "_at", "left_semi").select(*left.columns, F.lit(sign).alias("_sign"))

    both = rows(left, 1).unionByName(rows(right, -1))
    net = both.groupBy(*left.columns).agg(F.sum("_sign").alias("_n")).where("_n <> 0")
    return net.select(*left.columns, F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"), F.abs("_n").alias("n"))
