"""SRC-1, SRC-4: loads that remember what they have loaded.

A ledger keeps one row per file and load: path, size, modification time, rows,
rejects, time. A load takes only files that the ledger does not hold with this
path, size and time (an anti-join), so running it again loads nothing twice and a
file that has changed is loaded again; the rows of its earlier load then no
longer count. Rejected lines are kept with the rows, as in ``files``.

Rows are appended first, then the ledger: a load that dies between the two has
left rows of a load that no ledger row names, which ``current`` leaves out, and
its files are loaded by the next run. Both tables are ``SnapshotTable``s.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .files import CORRUPT, META_COLS, read_untyped_csv
from .snapshots import SnapshotTable

LEDGER = (
    "file_path string, file_size bigint, last_modified timestamp, rows_loaded bigint, rows_rejected bigint, "
    "load_id string, loaded_at timestamp"
)
FILE = ["file_path", "file_size", "last_modified"]


def _listed(path: Column) -> Column:
    """One spelling of a listed path, ``file:/a b``."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def _same(path: Column) -> Column:
    """The same of a path that rows carry, ``file:///a%20b``."""
    return _listed(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


class LoadLedger:
    """CSV files of ``source`` loaded into ``root``, each version of a file once."""

    def __init__(self, spark: SparkSession, root: str, columns: Sequence[str], header: bool = True):
        self.spark = spark
        self.columns = list(columns)
        self.header = header
        self.bronze = SnapshotTable(spark, f"{root.rstrip('/')}/bronze")
        self.ledger = SnapshotTable(spark, f"{root.rstrip('/')}/ledger")

    # -- what has been loaded ----------------------------------------------------
    def entries(self) -> DataFrame:
        """Every load of every file, with ``status``: ``loaded``, or ``superseded`` if
        the file was loaded again later."""
        if self.ledger.latest() is None:
            return self.spark.createDataFrame([], f"{LEDGER}, status string")
        rows = self.ledger.read()
        last = rows.groupBy(F.col("file_path").alias("_path")).agg(F.max("loaded_at").alias("_at"))
        joined = rows.join(last, F.col("file_path") == F.col("_path"))
        status = F.when(F.col("loaded_at") == F.col("_at"), "loaded").otherwise("superseded")
        return joined.select(*rows.columns, status.alias("status"))

    def history(self, since: Column | None = None, n: int | None = None) -> DataFrame:
        """Loads since a time (``current_timestamp() - interval 1 hour``), latest first;
        ``n`` makes it a top-n report."""
        rows = self.entries()
        if since is not None:
            rows = rows.where(F.col("loaded_at") >= since)
        rows = rows.orderBy(F.col("loaded_at").desc(), "file_path")
        return rows if n is None else rows.limit(n)

    def current(self) -> DataFrame:
        """The landed rows of each file's last load, rejects included (``files.split_rejects``)."""
        last = self.entries().where("status = 'loaded'").select(F.col("file_path").alias("_path"), F.col("load_id").alias("_load"))
        rows = self.bronze.read()
        on = (_same(F.col("_file")) == F.col("_path")) & (F.col("load_id") == F.col("_load"))
        return rows.join(last, on, "left_semi").drop("load_id")

    # -- loads ---------------------------------------------------------------------
    def load(self, source: str) -> str | None:
        """Load the files below ``source`` that are new or have changed; the load's id,
        or None if there are none. Only their names pass through the driver, as in
        any read of a list of files."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source).select(
            "path", _listed(F.col("path")).alias("file_path"), F.col("length").alias("file_size"), F.col("modificationTime").alias("last_modified")
        )
        todo = self._unseen(listed).checkpoint()
        paths = [r.path for r in todo.select("path").collect()]
        if not paths:
            return None
        return self._store(read_untyped_csv(self.spark, paths, self.columns, self.header), todo.drop("path"))

    def stream(self, source: str, checkpoint: str) -> StreamingQuery:
        """The same through a streaming file source: files that arrive below ``source``
        are loaded in micro-batches until none is left. The source knows a file by
        its path only; ``load`` finds those that have changed."""
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*self.columns, CORRUPT]])
        rows = (
            self.spark.readStream.schema(schema).option("header", self.header).option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", True).csv(source)
            .select(*self.columns, CORRUPT, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_file_size"),
                    F.col("_metadata.file_modification_time").alias("_file_modified"))
        )

        def apply(batch: DataFrame, _: int) -> None:
            batch = batch.checkpoint()
            files = batch.select(_same(F.col("_file")).alias("file_path"), F.col("_file_size").alias("file_size"),
                                 F.col("_file_modified").alias("last_modified")).distinct()
            todo = self._unseen(files).checkpoint()
            if not todo.isEmpty():
                wanted = todo.select(F.col("file_path").alias("_path"))
                self._store(batch.join(wanted, _same(F.col("_file")) == F.col("_path"), "left_semi"), todo)

        q = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        return q

    def _unseen(self, files: DataFrame) -> DataFrame:
        return files if self.ledger.latest() is None else files.join(self.ledger.read().select(*FILE), FILE, "left_anti")

    def _store(self, raw: DataFrame, files: DataFrame) -> str:
        load_id = uuid.uuid4().hex[:16]
        version = self.bronze.append(raw.select(*self.columns, CORRUPT, *META_COLS, F.lit(load_id).alias("load_id")))
        landed = self.bronze.read(version).where(F.col("load_id") == load_id)
        counts = landed.groupBy(_same(F.col("_file")).alias("_path")).agg(
            F.count_if(F.col(CORRUPT).isNull()).alias("rows_loaded"), F.count_if(F.col(CORRUPT).isNotNull()).alias("rows_rejected")
        )
        none = F.lit(0).cast("bigint")  # a file without rows is in the ledger, too
        self.ledger.append(files.join(counts, F.col("file_path") == F.col("_path"), "left").select(
            *FILE, F.coalesce("rows_loaded", none).alias("rows_loaded"), F.coalesce("rows_rejected", none).alias("rows_rejected"),
            F.lit(load_id).alias("load_id"), F.current_timestamp().alias("loaded_at"),
        ))
        return load_id
