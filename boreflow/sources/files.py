"""File sources: untyped CSV with rejects (SRC-1…3, SRC-8), JSON payload
documents as VARIANT (SRC-5), and the load audit (SRC-4).

Bronze keeps every field as text on purpose, so one bad value never fails a
load; typing happens in silver. Rejected rows are returned, never dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import null_tokens
from ..functions.constants import NULL_TOKENS

CORRUPT = "_corrupt_record"
META_COLS = ("_file", "_file_size", "_file_modified")


def _meta() -> list[F.Column]:
    return [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_size").alias("_file_size"),
        F.col("_metadata.file_modification_time").alias("_file_modified"),
    ]


def read_untyped_csv(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], header: bool = True
) -> DataFrame:
    """SRC-1/SRC-3: CSV with an explicit all-STRING schema, ``"`` quoting,
    PERMISSIVE mode. Returns the declared columns, ``_corrupt_record`` (the
    raw line of every row whose field count or quoting did not fit) and the
    source file columns. No schema-inference pass is made.

    Spark answers no query on raw CSV that needs only ``_corrupt_record``
    (a count of rejects, say), so land this once with ``land_bronze`` and
    split rows and rejects from the landed table (``split_rejects``).
    """
    schema = T.StructType(
        [T.StructField(c, T.StringType()) for c in columns] + [T.StructField(CORRUPT, T.StringType())]
    )
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(list(paths) if not isinstance(paths, str) else paths)
        .select(*columns, CORRUPT, *_meta())
    )


def land_bronze(raw: DataFrame, path: str) -> DataFrame:
    """Write the raw rows (rejects included) as Parquet once; return a reader
    over the landed table. One CSV parse; later passes read columnar data."""
    raw.write.mode("overwrite").parquet(path)
    return raw.sparkSession.read.parquet(path)


def split_rejects(
    bronze: DataFrame, columns: Sequence[str], tokens: Iterable[str] = NULL_TOKENS
) -> tuple[DataFrame, DataFrame]:
    """SRC-2/SRC-3: ``(rows, rejects)`` from landed bronze. ``rows`` has the
    null tokens mapped to NULL; ``rejects`` keeps the raw line and file."""
    tokens = list(tokens)
    rows = bronze.where(F.col(CORRUPT).isNull()).select(
        *[null_tokens(c, tokens).alias(c) for c in columns], *META_COLS
    )
    rejects = bronze.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("raw_line"), *META_COLS)
    return rows, rejects


def load_untyped_csv(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], bronze_path: str,
    tokens: Iterable[str] = NULL_TOKENS, header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """SRC-1…3 end to end: read, land bronze, split rows and rejects."""
    landed = land_bronze(read_untyped_csv(spark, paths, columns, header), bronze_path)
    return split_rejects(landed, columns, tokens)


def infer_schema_diff(
    spark: SparkSession, paths: str | Sequence[str], declared: Sequence[str], sampling_ratio: float = 0.01
) -> DataFrame:
    """SRC-8: what schema inference would choose, beside the declared types
    (all STRING in bronze). Diagnostic only; bronze never uses inference."""
    inferred = (
        spark.read.option("header", True).option("inferSchema", True)
        .option("samplingRatio", sampling_ratio).csv(paths).schema
    )
    rows = [(f.name, "string", f.dataType.simpleString(), f.name in declared) for f in inferred.fields]
    return spark.createDataFrame(rows, "column_name string, declared_type string, inferred_type string, declared boolean")


def read_json_payloads(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """SRC-5: each JSON file becomes ONE row with a VARIANT column ``raw``.

    A top-level array stays one row (it is flattened later, FLT-J2). Files
    that are not valid JSON keep ``raw`` NULL and their text in ``raw_text``
    (NULL for all others), so they can be listed as rejects. Each file is read whole by one task,
    so payload files are expected to be page-sized (the price API pages at
    5,000 records).
    """
    text = spark.read.text(list(paths) if not isinstance(paths, str) else paths, wholetext=True)
    return text.select(
        F.try_parse_json("value").alias("raw"),
        F.when(F.try_parse_json("value").isNull(), F.col("value")).alias("raw_text"),
        *_meta(),
    )


def load_audit(rows: DataFrame, rejects: DataFrame | None = None) -> DataFrame:
    """SRC-4: per source file, rows loaded and rows rejected.

    ``rows`` and ``rejects`` must carry the file columns added by the readers
    (``_file``, ``_file_size``, ``_file_modified``). Pre-aggregated per side,
    then combined, so the file list is never materialised on the driver.
    """
    good = rows.groupBy(*META_COLS).agg(F.count(F.lit(1)).alias("rows_loaded"))
    if rejects is None:
        both = good.withColumn("rows_rejected", F.lit(0).cast("bigint"))
    else:
        bad = rejects.groupBy(*META_COLS).agg(F.count(F.lit(1)).alias("rows_rejected"))
        both = good.join(bad, list(META_COLS), "full_outer")
    return both.select(
        F.col("_file").alias("file_path"),
        F.col("_file_size").alias("file_size"),
        F.col("_file_modified").alias("last_modified"),
        F.coalesce("rows_loaded", F.lit(0)).alias("rows_loaded"),
        F.coalesce("rows_rejected", F.lit(0)).alias("rows_rejected"),
    )


def load_history(audit: DataFrame, n: int = 5, since: Column | None = None) -> DataFrame:
    """SRC-4: the ``n`` most recently modified source files of a load audit
    (a top-n report: the limit is the feature; planned as a per-partition
    top-n and a final merge), with ``since`` (a timestamp, such as
    ``current_timestamp() - interval 1 hour``) of those modified from then on."""
    if since is not None:
        audit = audit.filter(F.col("last_modified") >= since)
    return audit.orderBy(F.col("last_modified").desc_nulls_last(), F.col("file_path")).limit(n)
