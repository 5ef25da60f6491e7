"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: The white space of the text contracts, as a Java and Python regex class.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of text that a Python worker gets at once; a batch exists four times (JVM,
#: Arrow, Python strings, results), so this is what bounds a worker's memory.
BATCH_BYTES = 16 << 20


#: Rows of a stored result that one task writes, if about so many are known to come.
TASK_ROWS = 16_384

#: Folders stored inside ``temporary``, innermost last.
_TEMPORARY: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What is stored inside is deleted at the end; with ``keep=True``, at the end of
    the block around this one, if there is one. Results that are read after the
    block must have been stored with it."""
    _TEMPORARY.append([])
    try:
        yield
    finally:
        for path in _TEMPORARY.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def prepare_workers(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, let Spark delete the shuffle files of a
    finished query (results are stored, so nobody reads them again), and let Python
    workers import this package from where the driver has it (on a cluster the
    package is installed or passed with ``--py-files``)."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(setting, "67108864b").rstrip("b")) > BATCH_BYTES:
        spark.conf.set(setting, f"{BATCH_BYTES}b")
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, root]))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the folder all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which makes or takes in about ``rows`` rows, to be stored: a small result is
    written by few tasks, however many partitions the shuffles have, a large one as it lies."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def store(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: the
    lineage is cut and a lost executor re-reads files instead of recomputing."""
    prepare_workers(df.sparkSession)
    path = shared_path(df.sparkSession, name)
    within = _TEMPORARY[: -1 if keep else None]
    if within:
        within[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wrapped(docs: DataFrame) -> DataFrame:
    """Whole rows in one column ``row``, so that no name in them can clash with a helper column."""
    return docs.select(F.struct("*").alias("row"))


def bucket_count(rows: int, least: int = 64) -> int:
    """A power of two near the square root of the row count: both the rows of
    one bucket and the table of bucket totals then grow with the root only."""
    return 1 << max(int(math.log2(least)), math.ceil(math.log2(max(rows, 1)) / 2))


def shuffle_key(seed: int, *cols: Column | str) -> Column:
    """A uniform hexadecimal sort key, the same on every run."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("\u0000")) for c in cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def key_bucket(key: Column, buckets: int) -> Column:
    """The bucket of a ``shuffle_key``: its leading bits, so that buckets are in key order."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(2**32)).cast("int")


def rank_in_buckets(rows: DataFrame, stratum: list[str], bucket: str, order: list[str], rank: str, total: str) -> DataFrame:
    """Adds ``rank`` (from 1) and ``total`` of each row in its stratum.

    ``bucket`` must be non-decreasing along ``order`` and spread the rows of a
    stratum evenly. No task sees a whole stratum: rows are numbered inside
    (stratum, bucket) and shifted by the running total of the buckets before,
    which a window over the small table of bucket counts gives. Columns of
    ``stratum`` and ``bucket`` must hold no NULL.
    """
    keys = [*stratum, bucket]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # the strata are few but their buckets many: one window per stratum over its buckets
    per = Window.partitionBy(*stratum) if stratum else Window.partitionBy(F.lit(0))
    counts = counts.select(
        *keys,
        (F.sum("_n").over(per.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
        F.sum("_n").over(per).alias(total),
    )
    numbered = rows.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return (
        numbered.join(counts, keys)
        .withColumn(rank, F.col("_before") + F.col("_row"))
        .drop("_before", "_row")
    )
