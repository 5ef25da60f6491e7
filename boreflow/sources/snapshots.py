"""Tables with atomic replace and snapshot reads (SNK-1, SNK-3) and keyed corrections (SNK-2).

A table is a folder of Parquet folders that are never changed once written::

    <root>/data/origin=<added|rewritten>/batch=<id>/<partition>=<value>/*.parquet
    <root>/manifests/<version>.json

A manifest names the schema and the folders of one version. It is written last,
under a name that did not exist, so a version is visible as a whole or not at
all: a writer that fails midway leaves folders that nothing names, and readers
go on reading the version before. Earlier versions stay readable until
``expire``. A manifest lists folders of partitions, not rows or files, so it
grows with the number of partitions and appends; rewriting a partition replaces
its folders by one. One writer commits at a time: a second one that started from
the same version finds its name taken and fails.

Appended rows lie below ``origin=added``, so a streaming file source over that
folder sees each appended row once and nothing that was rewritten.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import NEW, RESTATED, TWICE, TWICE_STORED, _spread, settle, staged_rows

ADDED, REWRITTEN = "added", "rewritten"
#: As the base of a new version: a table without rows.
EMPTY = -1
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_OWN = ("origin", "batch")


class SnapshotTable:
    """A Parquet table of immutable versions below ``root``."""

    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by)

    # -- files -----------------------------------------------------------------
    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    @property
    def added(self) -> str:
        """The folder that a streaming source watches for appended rows."""
        return f"{self.root}/data/origin={ADDED}"

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifests/{version:012d}.json"

    def versions(self) -> list[int]:
        """The versions that can be read, oldest first."""
        found = self._fs().globStatus(self._path(f"{self.root}/manifests/[0-9]*.json")) or []
        return sorted(int(f.getPath().getName().split(".")[0]) for f in found)

    def manifest(self, version: int) -> dict:
        """Schema and folders of a version (a small file)."""
        lines = self.spark.read.text(self._manifest_path(version), wholetext=True).first()[0]
        return json.loads(lines)

    def _commit(self, version: int, schema: T.StructType, folders: Iterable[str]) -> int:
        fs, target = self._fs(), self._path(self._manifest_path(version))
        if fs.exists(target):
            raise RuntimeError(f"version {version} of {self.root} was committed by another writer")
        draft = self._path(f"{self.root}/manifests/.draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        text = json.dumps({"version": version, "schema": schema.jsonValue(), "partition_by": self.partition_by, "folders": sorted(folders)})
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(draft, target):
            raise RuntimeError(f"version {version} of {self.root} was committed by another writer")
        return version

    # -- reads -----------------------------------------------------------------
    def latest(self) -> int | None:
        versions = self.versions()
        return versions[-1] if versions else None

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (default: the latest)."""
        version = self.latest() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no version of {self.root} has been committed")
        found = self.manifest(version)
        return self._rows(T.StructType.fromJson(found["schema"]), found["folders"])

    def _rows(self, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        full = T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in _OWN)])
        paths = [f"{self.root}/data/{f}" for f in folders]
        return self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*paths).select(*schema.names)

    # -- writes ----------------------------------------------------------------
    def _write(self, df: DataFrame, origin: str) -> list[str]:
        """Write ``df`` below a fresh folder; the folders of its partitions."""
        folder = f"origin={origin}/batch={uuid.uuid4().hex[:16]}"
        w = _spread(df, self.partition_by).write.mode("errorifexists")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.parquet(f"{self.root}/data/{folder}")
        return self._folders(folder)

    def _folders(self, folder: str) -> list[str]:
        """The partitions of a written folder."""
        if not self.partition_by:
            return [folder]
        pattern = "/".join(f"{c}=*" for c in self.partition_by)
        found = self._fs().globStatus(self._path(f"{self.root}/data/{folder}/{pattern}")) or []
        depth = len(self.partition_by)
        return [f"{folder}/{'/'.join(f.getPath().toString().split('/')[-depth:])}" for f in found]

    def _partition(self, folder: str) -> tuple[str | None, ...]:
        """Partition values of a folder as text."""
        values = [unquote(x.split("=", 1)[1]) for x in folder.split("/")[len(_OWN):]]
        return tuple(None if v == NULL_PARTITION else v for v in values)

    def _base(self, version: int | None) -> tuple[int, dict | None]:
        latest = self.latest()
        base = latest if version is None else version
        return (0 if latest is None else latest + 1), None if base in (None, EMPTY) else self.manifest(base)

    def replace(self, df: DataFrame) -> int:
        """CREATE OR REPLACE … AS SELECT: the new version holds ``df`` only."""
        version, _ = self._base(None)
        return self._commit(version, df.schema, self._write(df, REWRITTEN))

    def append(self, df: DataFrame) -> int:
        """INSERT INTO: the latest version's folders and a new one."""
        version, base = self._base(None)
        if base is not None:
            df = self._typed(df, base)
        folders = self._write(df, ADDED)
        return self._commit(version, df.schema, [*(base["folders"] if base else []), *folders])

    def replace_partitions(self, df: DataFrame, touched: Iterable[tuple], base: int | None = None) -> int:
        """The ``touched`` partitions (tuples of values; None for NULL) hold ``df`` and
        nothing else; all others stay as in version ``base`` (default: the latest).

        With a fixed ``base`` (or ``EMPTY``) a job that failed after this commit can be
        run again: it starts from the same rows.
        """
        version, found = self._base(base)
        gone = {tuple(None if v is None else str(v) for v in t) for t in touched}
        if found is not None:
            df = self._typed(df, found)
        kept = [f for f in (found["folders"] if found else []) if self._partition(f) not in gone]
        return self._commit(version, df.schema, [*kept, *self._write(df, REWRITTEN)])

    def _typed(self, df: DataFrame, base: dict) -> DataFrame:
        """``df`` with the columns and types that the table was made with."""
        schema = T.StructType.fromJson(base["schema"])
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

    # -- corrections -------------------------------------------------------------
    def append_new(self, df: DataFrame, key: Sequence[str], follows: bool = False) -> DataFrame | None:
        """Append the rows whose key is not stored; returns those whose key is stored
        with other values (None if the table is new). Repeated rows count once; two
        different rows for a key fail. ``follows`` says that the partition columns follow
        from the key."""
        latest = self.latest()
        found = None if latest is None else self.manifest(latest)
        df = df if found is None else self._typed(df, found)
        version, folder = 0 if latest is None else latest + 1, f"origin={ADDED}/batch={uuid.uuid4().hex[:16]}"
        staged = f"{self.root}/staged/{folder.split('=')[-1]}"
        stored = None if found is None else self.read(latest) if follows else self._touched(df)
        settle(df, stored, key, staged, self.partition_by, follows)
        fs, new, schema = self._fs(), self._path(f"{staged}/_kind={NEW}"), T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        if not staged_rows(self.spark, staged, schema, TWICE, TWICE_STORED).isEmpty():
            fs.delete(self._path(staged), True)
            raise ValueError(f"two different rows for one {tuple(key)} in a batch for {self.root}")
        if fs.exists(new):
            target = self._path(f"{self.root}/data/{folder}")
            fs.mkdirs(target.getParent())
            if not fs.rename(new, target):
                raise RuntimeError(f"{folder} of {self.root} could not be added")
            self._commit(version, schema, [*(found["folders"] if found else []), *self._folders(folder)])
        elif found is None:
            self.append(df.limit(0))
        return None if found is None else staged_rows(self.spark, staged, schema, RESTATED)

    def upsert(self, df: DataFrame, key: Sequence[str]) -> int | None:
        """MERGE INTO by copy-on-write: rows with a stored key replace the stored row,
        others are added; only partitions with a change are rewritten. Returns the
        new version, or None if nothing differs.

        Partition columns must follow from the key, so that a row stays in its
        partition. Only partitions that the batch touches are read. Keys may be
        NULL; repeated rows count once, two different rows for a key fail.
        """
        df = self._one_per_key(df, key)
        on = F.struct(*[F.col(k) for k in key])
        stored = self._touched(df)
        old = stored.select(on.alias("_key"), F.struct(*df.columns).alias("_row"))
        changed = df.withColumn("_key", on).join(old, "_key", "left").where(
            F.col("_row").isNull() | ~F.struct(*df.columns).eqNullSafe(F.col("_row"))
        ).drop("_row").checkpoint()
        if changed.isEmpty():
            return None
        partitions = [tuple(r) for r in changed.select(*self.partition_by).distinct().collect()] if self.partition_by else [()]
        kept = self._within(stored, partitions).withColumn("_key", on).join(changed.select("_key"), "_key", "left_anti").drop("_key")
        return self.replace_partitions(kept.unionByName(changed.drop("_key")), partitions)

    def changes(self, since: int, until: int) -> DataFrame:
        """Rows that corrections took out (``_sign`` −1) and put in (+1) between two
        versions. Only partitions rewritten in between are read; rows that were
        appended and not rewritten are no correction."""
        a, b = self.manifest(since), self.manifest(until)
        schema = T.StructType.fromJson(b["schema"])
        gone = [f for f in a["folders"] if f not in set(b["folders"])]
        come = [f for f in b["folders"] if f not in set(a["folders"]) and f.startswith(f"origin={REWRITTEN}/")]
        old, new = self._rows(schema, gone), self._rows(schema, come)
        # one shuffle: rows that are on both sides as often cancel out
        both = old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1)))
        net = both.groupBy(*schema.names).agg(F.sum("_sign").cast("int").alias("_n")).where("_n != 0")
        return net.withColumn("_sign", F.signum("_n").cast("int")).withColumn(
            "_n", F.explode(F.sequence(F.lit(1), F.abs("_n")))
        ).drop("_n")

    def _touched(self, df: DataFrame) -> DataFrame:
        """The stored rows of the partitions that ``df`` touches (a short list: partition values)."""
        stored = self.read()
        if not self.partition_by:
            return stored
        return self._within(stored, [tuple(r) for r in df.select(*self.partition_by).distinct().collect()])

    def _within(self, rows: DataFrame, partitions: Sequence[tuple]) -> DataFrame:
        for i, c in enumerate(self.partition_by):
            values = {t[i] for t in partitions}
            inside = F.col(c).isin([v for v in values if v is not None])
            rows = rows.where(inside | F.col(c).isNull() if None in values else inside)
        return rows

    def _one_per_key(self, df: DataFrame, key: Sequence[str]) -> DataFrame:
        stored = self.latest()
        df = (df if stored is None else self._typed(df, self.manifest(stored))).distinct().checkpoint()
        if not df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
            raise ValueError(f"two different rows for one {tuple(key)} in a batch for {self.root}")
        return df

    # -- retention -----------------------------------------------------------------
    def expire(self, keep: int = 2) -> None:
        """Keep the last ``keep`` versions; delete older manifests and batches that no
        kept version names (those of failed writers too: run it with no writer open)."""
        versions = self.versions()
        kept = versions[-keep:]
        named = {"/".join(f.split("/")[:2]) for v in kept for f in self.manifest(v)["folders"]}
        fs = self._fs()
        for v in versions[: len(versions) - len(kept)]:
            fs.delete(self._path(self._manifest_path(v)), False)
        for batch in fs.globStatus(self._path(f"{self.root}/data/origin=*/batch=*")) or []:
            name = "/".join(batch.getPath().toString().split("/")[-2:])
            if name not in named:
                fs.delete(batch.getPath(), True)
