"""The medallion pipeline over the stand-in inputs.

Silver (the stand-in well-day, price, FX and monthly tables) is *stored*:
the first query of a Spark application that needs it writes it as Parquet
under the folder named by ``spark.checkpoint.dir`` and every later query
reads that table, as gold queries read a silver table in a warehouse. The
stored table also cuts the lineage, so a lost executor never recomputes the
lineitem aggregation behind it.

The filled price and the fact are stored the same way (the warehouse keeps
them as materialized tables that every derived table reads). The derived
gold layers are DataFrame *definitions* (plans, not data): Catalyst sees one
plan per query and prunes columns and pushes filters down to the scans.
"""

from __future__ import annotations

from functools import cached_property

import hashlib
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from ..operators import dims, fact, gold, silver, timeseries
from ..session import ensure_checkpoint_dir
from . import standin

# (application id, inputs, table) -> stored path
_STORED: dict[tuple[str, str, str], str] = {}
# (application id, inputs) -> pipeline (its DataFrames are immutable plans)
_PIPELINES: dict[tuple[str, str], "Pipeline"] = {}
_LOCK = threading.RLock()


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """The data folder with the names, sizes and times of its tables: stored
    layers are used again only while these stay the same."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/*.parquet")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.globStatus(folder) or []]
    return f"{sf_dir}|{hashlib.sha1(repr(sorted(found)).encode()).hexdigest()[:12]}"


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, store_silver: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.inputs = fingerprint(spark, sf_dir)
        self.store_silver = store_silver

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Pipeline":
        """The application's pipeline over ``sf_dir``; its layer plans are
        built once and shared by every query (plans, not cached data)."""
        key = (spark.sparkContext.applicationId, fingerprint(spark, sf_dir))
        with _LOCK:
            p = _PIPELINES.get(key)
            if p is None or p.spark is not spark:
                p = _PIPELINES[key] = cls(spark, sf_dir)
            return p

    def _stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if not self.store_silver:
            return build()
        key = (self.spark.sparkContext.applicationId, self.inputs, name)
        with _LOCK:
            path = _STORED.get(key)
            if path is not None:
                try:
                    return self.spark.read.parquet(path)
                except AnalysisException:  # the folder was cleaned: write it again
                    _STORED.pop(key, None)
            root = ensure_checkpoint_dir(self.spark).rstrip("/")
            tag = hashlib.sha1(f"{key[0]}|{self.inputs}".encode()).hexdigest()[:12]
            path = f"{root}/silver-{tag}/{name}"
            build().write.mode("overwrite").parquet(path)
            _STORED[key] = path
            return self.spark.read.parquet(path)

    def folder(self, name: str, write: Callable[[str], None]) -> str:
        """A folder that ``write`` fills once per application and data folder."""
        key = (self.spark.sparkContext.applicationId, self.inputs, f"files/{name}")
        with _LOCK:
            path = _STORED.get(key)
            if path is None:
                root = ensure_checkpoint_dir(self.spark).rstrip("/")
                path = f"{root}/files-{uuid.uuid4().hex[:12]}/{name}"
                write(path)
                _STORED[key] = path
            return path

    # --- silver stand-ins ---------------------------------------------------
    @cached_property
    def well_day(self) -> DataFrame:
        return self._stored("well_day", lambda: standin.well_day(self.spark, self.sf_dir))

    @cached_property
    def price(self) -> DataFrame:
        return self._stored("price", lambda: standin.price(self.spark, self.sf_dir))

    @cached_property
    def fx(self) -> DataFrame:
        return self._stored("fx", lambda: standin.fx(self.spark, self.sf_dir))

    @cached_property
    def monthly_reported(self) -> DataFrame:
        return self._stored("monthly_reported", lambda: standin.monthly_reported(self.spark, self.sf_dir))

    # --- gold -----------------------------------------------------------------
    @cached_property
    def price_filled(self) -> DataFrame:
        spine = self.well_day.select("prod_date").withColumnRenamed("prod_date", "cal_date")
        return self._stored("price_filled", lambda: timeseries.fill_series(
            spine, self.price, date="cal_date", value="brent_usd_bbl",
            series_date="price_date", out="brent_usd_bbl_filled",
        ))

    @cached_property
    def fact(self) -> DataFrame:
        return self._stored("fact", lambda: fact.build_fact(self.well_day, self.price_filled, self.fx))

    @cached_property
    def scd1(self) -> DataFrame:
        return dims.dim_scd1(self.well_day)

    @cached_property
    def decomposition(self) -> DataFrame:
        return gold.revenue_decomposition(self.fact)

    @cached_property
    def downtime(self) -> DataFrame:
        return gold.downtime_events(self.fact)

    @cached_property
    def reconcile(self) -> DataFrame:
        return gold.reconcile_detail(self.well_day, self.monthly_reported)

    # --- bronze / silver from untyped stand-ins --------------------------------
    @cached_property
    def bronze_daily(self) -> DataFrame:
        return self._stored("bronze_daily", lambda: standin.bronze_daily(self.spark, self.sf_dir, self.well_day))

    @cached_property
    def bronze_monthly(self) -> DataFrame:
        return self._stored(
            "bronze_monthly", lambda: standin.bronze_monthly(self.spark, self.sf_dir, self.monthly_reported)
        )

    @cached_property
    def silver_daily(self) -> tuple[DataFrame, DataFrame]:
        rows, rejects = silver.clean_daily(self.bronze_daily)
        return self._stored("silver_daily", lambda: rows), self._stored("silver_rejects", lambda: rejects)

    @cached_property
    def silver_monthly(self) -> DataFrame:
        return silver.clean_monthly(self.bronze_monthly)

    @cached_property
    def event_pages(self) -> DataFrame:
        return self._stored("event_pages", lambda: standin.event_pages(self.spark, self.sf_dir))

    @cached_property
    def fx_payloads(self) -> DataFrame:
        return self._stored("fx_payloads", lambda: standin.fx_payloads(self.spark, self.sf_dir, self.fx))

    @cached_property
    def dim_entity(self) -> DataFrame:
        return dims.dim_latest(self.well_day)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.calendar(self.well_day)
