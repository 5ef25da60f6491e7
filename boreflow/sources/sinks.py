"""Sinks: replace (SNK-1), idempotent append (SNK-2), partition overwrite.

Parquet is the table format here; no Iceberg or Delta jar ships with this
build (SNK-3), and ``MERGE INTO`` is not available on plain Parquet, so keyed
appends compare the batch with what is already stored.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..operators import fingerprint


def write_replace(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CREATE OR REPLACE TABLE … AS SELECT: overwrite the whole folder."""
    w = _spread(df, partition_by).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite).

    Idempotent: running the same batch twice leaves the same files. The rows are not
    moved: ``df`` lies by partition (read from files of one partition each, or laid out
    by ``by_slot`` or ``_spread``), so that a task opens few files.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def read_if_exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    try:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    except AnalysisException:
        return None


def _spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together before a partitioned write, so that
    a task does not open one file per partition it happens to hold; AQE splits
    partitions that are large (``rebalance``)."""
    return df.hint("rebalance", *partition_by) if partition_by else df


#: Rows that one task sorts when a batch is settled against what is stored.
TASK_ROWS = 500_000
#: Column of ``by_slot``: shares of a partition, for tasks of bounded rows.
SLOT = "_slot"


def by_slot(df: DataFrame, partition_by: Sequence[str], key: Sequence[Column | str], total: int, most: int) -> DataFrame:
    """``df`` laid out by ``partition_by`` and a hash of ``key`` (added as ``SLOT``), in
    tasks of about ``TASK_ROWS``, so that neither windows by these columns and others
    nor a partitioned write move the rows again. ``total`` rows, ``most`` in a partition."""
    slots = -(-most // TASK_ROWS) * 2 if most > TASK_ROWS else 1
    df = df.withColumn(SLOT, F.pmod(F.xxhash64(*key), F.lit(slots)))
    tasks = -(-total // TASK_ROWS) * 2
    many = tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, *partition_by, SLOT) if many else df.repartition(*partition_by, SLOT)
#: Kinds of staged rows: to be stored; other than the kept row; of a key that the batch
#: holds with two values, as stored or other than the kept row.
NEW, RESTATED, TWICE_STORED, TWICE = 0, 1, 2, 3


def _beside(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def settle(
    df: DataFrame, stored: DataFrame | None, key: Sequence[str], staged: str, partition_by: Sequence[str] = (), follows: bool = False
) -> None:
    """Compare a batch with ``stored`` by ``key`` and write what is not stored as it is to
    ``staged``, partitioned by ``_kind`` and ``partition_by``.

    One shuffle of both sides and one sort: the stored row of a key comes first, then the
    batch's rows by value; the first row is the kept one. If the partition columns
    follow from the key (``follows``), rows are laid out by partition as well, so that the
    write needs no other shuffle, partitions whose checksums agree are left out, and of
    the stored rows those with a date that the batch holds are read.
    """
    spark, others = df.sparkSession, [c for c in df.columns if c not in key]
    both = df.withColumn("_old", F.lit(False))
    total, most = 0, 0
    aligned = follows and bool(partition_by)
    if aligned:
        if stored is not None:
            stored = stored.select(*df.columns)
            held = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_n")).collect()
            touched = _in_partitions([tuple(r)[:-1] for r in held], partition_by)
            prints = [fingerprint.fingerprints(x, partition_by, key, 1) for x in (df, stored.where(touched))]
            same = F.struct(*partition_by, *fingerprint.CHECKS).alias("_at")
            equal = {tuple(r[0])[: len(partition_by)] for r in prints[0].select(same).intersect(prints[1].select(same)).collect()}
            sizes = [r for r in held if tuple(r)[:-1] not in equal]
            inside = _in_partitions([tuple(r)[:-1] for r in sizes], partition_by)
            both, stored = both.where(inside), stored.where(inside)
            dates = [k for k in key if df.schema[k].dataType.simpleString() == "date"]
            if dates:  # bounded by the calendar
                known = df.where(inside).select(*[F.col(k).alias(f"_{k}") for k in dates]).distinct()
                on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in dates]
                stored = stored.join(F.broadcast(known), on, "left_semi")
        else:
            sizes = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("_n")).collect()
        total, most = sum(r["_n"] for r in sizes), max([r["_n"] for r in sizes], default=0)
    if stored is not None:
        both = both.unionByName(stored.select(*df.columns).withColumn("_old", F.lit(True)))
    together = list(key)
    if aligned:
        both = by_slot(both, partition_by, key, total, most)
        together = [*partition_by, SLOT, *[k for k in key if k not in partition_by]]
    value = F.struct(*others) if others else F.lit(0)
    w = Window.partitionBy(*together).orderBy(F.col("_old").desc(), *others)
    before = F.lag(F.struct("_old", value.alias("v"))).over(w)
    kept = F.first(F.struct("_old", value.alias("v"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    seen = both.withColumn("_before", before).withColumn("_kept", kept).where(~F.col("_old"))
    again = F.col("_before").isNotNull() & ~F.col("_before._old")  # not the key's first row in the batch
    repeated = again & value.eqNullSafe(F.col("_before.v"))
    twice = again & ~value.eqNullSafe(F.col("_before.v"))
    other = ~value.eqNullSafe(F.col("_kept.v"))
    kind = F.when(F.col("_before").isNull(), NEW).when(other, F.when(twice, TWICE).otherwise(RESTATED)).when(twice, TWICE_STORED)
    out = seen.where(~repeated).select(*df.columns, kind.alias("_kind")).where(F.col("_kind").isNotNull())
    if not aligned:
        out = _spread(out, [*partition_by, "_kind"])
    out.write.partitionBy("_kind", *partition_by).parquet(staged)


def staged_rows(spark: SparkSession, staged: str, schema: T.StructType, *kinds: int) -> DataFrame:
    """The rows of some kinds that ``settle`` has staged."""
    folders = [f"{staged}/_kind={k}" for k in kinds]
    there = [f for f in folders if _beside(spark, f)[0].exists(_beside(spark, f)[1])]
    found = [spark.read.schema(schema).parquet(f).select(*schema.names) for f in there]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schema)


def _in_partitions(partitions: Sequence[tuple], partition_by: Sequence[str]) -> Column:
    """Whether the partition columns hold values that ``partitions`` (a short list) hold."""
    found = F.lit(True)
    for i, c in enumerate(partition_by):
        values = {t[i] for t in partitions}
        inside = F.col(c).isin([v for v in values if v is not None])
        found = found & (inside | F.col(c).isNull() if None in values else inside)
    return found


def append_new(
    df: DataFrame, path: str, key: Sequence[str], partition_by: Sequence[str] = (), follows: bool = False
) -> DataFrame | None:
    """INSERT INTO … SELECT, but only rows whose ``key`` is not stored yet.

    Re-running the same append adds nothing (unlike a plain INSERT), NULL keys
    included; a row repeated inside the batch is stored once. A key that is
    stored, or repeated in the batch, with *other* values keeps the stored
    (else the smallest) row; the restated rows are returned, to be written to
    a conflicts table, and are never dropped silently. Only the partitions
    that the batch touches are read of what is stored, if ``partition_by``
    columns are among the columns of ``df``; ``follows`` says that they follow from the key.

    The new rows are staged beside the table and their files then moved into it; an
    append that fails midway is completed by running it again.
    """
    spark, others = df.sparkSession, [c for c in df.columns if c not in key]
    existing = read_if_exists(spark, path)
    if existing is not None:
        # all files of a table have the types it was made with
        df = df.select(*[F.col(c).cast(existing.schema[c].dataType).alias(c) if c in existing.columns else c for c in df.columns])
        if partition_by and not follows:
            existing = existing.where(_in_partitions([tuple(r) for r in df.select(*partition_by).distinct().collect()], partition_by))
    staged = f"{path.rstrip('/')}_staged-{uuid.uuid4().hex[:12]}"
    settle(df, existing, key, staged, partition_by, follows)
    fs, target = _beside(spark, path)
    _, new = _beside(spark, f"{staged}/_kind={NEW}")
    if fs.exists(new):
        depth = len(partition_by)
        for f in fs.globStatus(_beside(spark, f"{staged}/_kind={NEW}{'/*' * depth}/part-*")[1]):
            inner = "/".join(f.getPath().toString().split("/")[-depth - 1:])
            _, to = _beside(spark, f"{path.rstrip('/')}/{inner}")
            fs.mkdirs(to.getParent())
            if not fs.rename(f.getPath(), to):
                raise RuntimeError(f"{to} could not be added")
    elif existing is None:
        w = df.limit(0).write.mode("append")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    return staged_rows(spark, staged, schema, RESTATED, TWICE) if others else None
