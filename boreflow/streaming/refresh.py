"""Incremental refresh of the gold tables (REF-1 … REF-6).

New silver files are picked up by a Structured Streaming file source with
``trigger(availableNow=True)``; each micro-batch only tells *which keys*
changed. ``foreachBatch`` then recomputes every affected gold partition from
the full silver table and overwrites just those partitions:

| gold table         | refresh key          | why                                       |
| ------------------ | -------------------- | ----------------------------------------- |
| spine, price_filled, fx | version          | a new date can change the fill of others   |
| fact               | month                | row-wise over silver                       |
| well-month sums    | month                | signed sums; all monthly products read them |
| decline, water cut | month                | from the sums                              |
| downtime months    | month                | runs of a (well, month), mergeable         |
| downtime events    | month; spanning ones | inner runs by month; those over a border merged from the summaries |
| value ranking      | whole                | global order over the per-well totals       |
| decomposition      | year                 | from the sums; the baseline is the year's first month |
| well-month versions | month               | feeds all dimensions                       |
| dim_well(_scd1), dim_date | whole (small)  | one row per well / per day (D-5)            |
| dim_well_scd2      | version, touched wells | split, joined and renumbered; keys stay     |
| refresh log        | version              | one row per refresh                        |

Overwriting whole partitions is idempotent: a micro-batch that runs twice
after a failure writes the same files under the same version, and one that is
in the log already is skipped. Late rows for old months are simply new silver
rows: their month is touched and recomputed, so no watermark is needed. So is
every month in which a filled price or an FX rate changed since the last
refresh, with or without new rows. Partitions of touched keys that have become
empty are removed, and versions before the last two are deleted.

Corrections (``restate``) need silver as a ``SnapshotTable``: the restated rows are
merged by copy-on-write, and the rows that went (−1) and came (+1) are read from the
partitions that differ between the version the log names and the latest. The fact
rows of these keys are exchanged and the stored sums get their signed sums; no month
is aggregated again. The log names the silver and sums versions it has applied, so
a restatement that fails midway starts again from the same sums.

Tables are read with the schema they were written with, so one that has no
rows yet (no shut-in days, injectors only) reads as empty.

Silver is expected partitioned by ``month_start`` so that the touched months
(a short list, bounded by the months present in one batch) prune the scan.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.cleaning import month_start
from ..operators import fact as fact_ops
from ..operators import dims, fingerprint, gold, mergeable, timeseries
from ..sources.sinks import SLOT, _spread, by_slot, read_if_exists, write_partitions, write_replace
from ..sources.snapshots import EMPTY, SnapshotTable

LOG_SCHEMA = (
    "batch_id bigint, rows_in bigint, months_touched int, years_touched int, fact_rows_out bigint, "
    "refreshed_at timestamp, silver_version bigint, sums_version bigint, series_version bigint, series_check string, keys_issued bigint, "
    "version bigint"
)
KEY = ["well_name", "prod_date"]
SPANNING = "spanning"


@dataclass
class GoldRefresh:
    """REF-1: keep the gold tables current as silver files arrive.

    ``silver`` is a folder of Parquet files partitioned by ``month_start`` or, if rows
    can be corrected, a ``SnapshotTable`` partitioned by it.
    """

    spark: SparkSession
    silver_path: str | SnapshotTable
    gold_root: str
    checkpoint: str
    price: DataFrame
    fx: DataFrame

    def path(self, name: str) -> str:
        return f"{self.gold_root.rstrip('/')}/{name}"

    def silver(self, version: int | None = None) -> DataFrame:
        if isinstance(self.silver_path, SnapshotTable):
            return self.silver_path.read(version)
        return self.spark.read.parquet(self.silver_path)

    def _silver_version(self) -> int | None:
        return self.silver_path.latest() if isinstance(self.silver_path, SnapshotTable) else None

    def sums(self) -> SnapshotTable:
        """Signed sums of the fact per (month, well), by month."""
        return SnapshotTable(self.spark, self.path("well_month_sums"), ["month_start"])

    def log(self) -> DataFrame:
        found = read_if_exists(self.spark, self.path("refresh_log"), LOG_SCHEMA)
        return found if found is not None else self.spark.createDataFrame([], LOG_SCHEMA)

    def _last(self):
        """The log row of the last refresh, or None."""
        return self.log().orderBy(F.col("version").desc()).first()

    def scd2(self) -> DataFrame:
        """The committed type-2 dimension."""
        return self.spark.read.parquet(f"{self.path('dim_well_scd2')}/version={self._last().version}")

    def _folder(self, name: str):
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder

    def _delete(self, *names: str) -> None:
        """Remove folders below the gold root (of any file system Spark reads)."""
        for name in names:
            fs, folder = self._folder(name)
            fs.delete(folder, True)

    def _files(self, name: str) -> set[str]:
        fs, folder = self._folder(name)
        return {f.getPath().getName() for f in fs.listStatus(folder)} if fs.exists(folder) else set()

    def _replace(self, df: DataFrame, name: str, key: str, touched: list, spread: bool = True) -> DataFrame:
        """Overwrite the ``touched`` partitions of a table, also those that get no
        rows; returns a reader over the whole table. ``spread`` False: ``df`` lies by ``key`` already."""
        partitions = [f"{name}/{key}={v}" for v in touched]
        before = {p: self._files(p) for p in partitions}
        write_partitions(_spread(df, [key]) if spread else df, self.path(name), [key])
        # a partition whose files are the old ones got no rows
        self._delete(*[p for p in partitions if before[p] and self._files(p) == before[p]])
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def _versioned(self, df: DataFrame, name: str, version: int) -> DataFrame:
        path = f"{self.path(name)}/version={version}"
        write_replace(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _previous(self, like: DataFrame, name: str, version: int | None) -> DataFrame | None:
        """The committed version of a table with the columns of ``like``."""
        if version is None:
            return None
        return self.spark.read.schema(like.schema).parquet(f"{self.path(name)}/version={version}")

    def run(self) -> StreamingQuery:
        """Process every silver file not seen yet, then stop (availableNow);
        then months whose price or FX rate changed without new rows."""
        schema = self.silver().schema
        if isinstance(self.silver_path, SnapshotTable):
            source = self.spark.readStream.schema(schema.add("batch", "string")).parquet(self.silver_path.added).drop("batch")
        else:
            source = self.spark.readStream.schema(schema).parquet(self.silver_path)
        q = (
            source.writeStream.foreachBatch(self.apply_batch)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        last = self._last()
        if last is not None and (self._series_check() != last.series_check or self._silver_version() != last.silver_version):
            self.apply_batch(self.silver().limit(0), None)
        return q

    def _series_check(self) -> str:
        """Checksum of the prices and rates: whether they have changed since a refresh."""
        found = []
        for series in (self.price, self.fx):
            row = fingerprint.fingerprints(series.withColumn("_all", F.lit(0)), ["_all"], ["_all"], 1).select(*fingerprint.CHECKS).first()
            found.append("-" if row is None else ":".join(map(str, row)))
        return " ".join(found)

    # -- one micro-batch -------------------------------------------------------
    def apply_batch(self, batch: DataFrame, batch_id: int | None) -> None:
        # The date spine, the filled price and the rates are versioned and the
        # refresh log is written last: a replayed batch builds on, and diffs
        # against, the last *committed* version, never its own half-written one.
        log, last = self.log(), self._last()
        if batch_id is not None and not log.where(F.col("batch_id") == batch_id).isEmpty():
            return
        version = 0 if last is None else last.version + 1
        series = None if last is None else last.series_version
        silver_version = self._silver_version()
        silver = self.silver(silver_version)
        # 1. date spine = committed spine + this batch's dates (one row per
        # day; silver is never scanned whole for it)
        batch_dates = batch.select(F.col("prod_date").alias("cal_date")).where(F.col("cal_date").isNotNull())
        old_spine = self._previous(batch_dates, "spine", series)
        dates = batch_dates if old_spine is None else batch_dates.unionByName(old_spine)
        spine = self._versioned(dates.distinct(), "spine", version)
        # 2. filled price over the spine. New spine dates can change the
        # filled price of *later* dates (forward fill), so months whose filled
        # price changed are touched as well; so are those whose rate changed.
        price_filled = self._versioned(
            timeseries.fill_series(
                spine, self.price, date="cal_date", value="brent_usd_bbl", series_date="price_date",
                out="brent_usd_bbl_filled",
            ),
            "price_filled", version,
        )
        rates = timeseries.one_per_key(self.fx.select("rate_date", "nok_per_usd"), ["rate_date"], "nok_per_usd")
        rates = self._versioned(rates, "fx", version)
        touched_dates = batch_dates
        for new, name, date, value in (
            (price_filled, "price_filled", "cal_date", "brent_usd_bbl_filled"), (rates, "fx", "rate_date", "nok_per_usd"),
        ):
            old = self._previous(new, name, series)
            if old is not None:
                changed = new.alias("n").join(old.alias("o"), date, "full_outer").where(
                    ~F.col(f"n.{value}").eqNullSafe(F.col(f"o.{value}"))
                ).select(F.col(date).alias("cal_date"))
                # a day without production has no fact to change
                touched_dates = touched_dates.unionByName(changed.join(spine, "cal_date", "left_semi"))
        # corrections that no refresh has applied yet are recomputed with the rest
        if last is not None and silver_version != last.silver_version:
            corrected = self.silver_path.changes(last.silver_version, silver_version)
            touched_dates = touched_dates.unionByName(corrected.select(F.col("prod_date").alias("cal_date")))
        # The touched months are few (bounded by the calendar span of the
        # data, one value per month); as a literal list they prune the
        # month-partitioned scans.
        months = [r.m for r in touched_dates.select(month_start("cal_date").alias("m")).distinct().collect() if r.m is not None]
        if not months:
            self._delete(*[f"{t}/version={version}" for t in ("spine", "price_filled", "fx")])
            return

        # 3. fact and its sums for the touched months
        touched = silver.where(F.col("month_start").isin(months))
        fact = fact_ops.build_fact(touched, price_filled, rates).withColumn("month_start", month_start("prod_date"))
        # silver lies by month and the joins are broadcast: the rows stay where they are read
        fact = self._replace(fact, "fact", "month_start", months, spread=False)
        sums_version = self.sums().replace_partitions(
            mergeable.signed_sums(fact.where(F.col("month_start").isin(months)), ["month_start", "well_name"]),
            [(m,) for m in months], EMPTY if last is None else last.sums_version,
        )
        rows_in = batch.agg(F.count(F.lit(1)).alias("rows_in"))
        self._derive(fact, touched, months, rows_in, batch_id, last, version, silver_version, sums_version, version, self._series_check())
        if series is not None:  # the committed series stay for a replay, those before them go
            older = log.where(F.col("series_version") < series).agg(F.max("series_version")).first()[0]
            if older is not None:
                self._delete(*[f"{t}/version={older}" for t in ("spine", "price_filled", "fx")])

    # -- corrections -------------------------------------------------------------
    def restate(self, corrections: DataFrame) -> int | None:
        """SNK-2, REF-6: apply restated rows (silver columns) to silver and gold.

        Returns the silver version that holds them (None if nothing differs).
        Running it again after a failure, or ``apply_corrections``, completes it.
        """
        if not isinstance(self.silver_path, SnapshotTable):
            raise TypeError("corrections need silver as a SnapshotTable")
        version = self.silver_path.upsert(corrections.withColumn("month_start", month_start("prod_date")), KEY)
        self.apply_corrections()
        return version

    def apply_corrections(self) -> None:
        """Bring the gold tables from the silver version of the log to the latest."""
        last, until = self._last(), self._silver_version()
        if last is None or until == last.silver_version:
            return
        changes = self.silver_path.changes(last.silver_version, until).checkpoint()
        spine = self.spark.read.parquet(f"{self.path('spine')}/version={last.series_version}")
        dated = changes.where(F.col("prod_date").isNotNull())
        if not dated.join(spine, F.col("prod_date") == F.col("cal_date"), "left_anti").isEmpty():
            # a date that is new to the spine can change the filled price of others
            self.apply_batch(changes.where("_sign > 0").drop("_sign"), None)
            return
        months = [r.m for r in dated.select(month_start("prod_date").alias("m")).distinct().collect()]
        if not months:
            return
        price_filled, rates = (self.spark.read.parquet(f"{self.path(t)}/version={last.series_version}") for t in ("price_filled", "fx"))

        def facts(sign: int) -> DataFrame:
            rows = fact_ops.build_fact(changes.where(F.col("_sign") == sign), price_filled, rates)
            return rows.withColumn("month_start", month_start("prod_date"))

        went, came = facts(-1), facts(1)
        # the fact rows of changed keys are exchanged, those of other keys copied
        key = F.struct(*KEY)
        stored = self.spark.read.parquet(self.path("fact")).where(F.col("month_start").isin(months))
        kept = stored.withColumn("_key", key).join(changes.select(key.alias("_key")), "_key", "left_anti").drop("_key")
        fact = self._replace(kept.unionByName(came), "fact", "month_start", months)
        signed = went.withColumn("_sign", F.lit(-1)).unionByName(came.withColumn("_sign", F.lit(1)))
        delta = mergeable.signed_sums(signed, ["month_start", "well_name"])
        before = self.sums().read(last.sums_version).where(F.col("month_start").isin(months))
        sums_version = self.sums().replace_partitions(
            mergeable.merge_sums(before.unionByName(delta), ["month_start", "well_name"]), [(m,) for m in months], last.sums_version
        )
        touched = self.silver(until).where(F.col("month_start").isin(months))
        rows_in = changes.where("_sign > 0").agg(F.count(F.lit(1)).alias("rows_in"))
        self._derive(fact, touched, months, rows_in, None, last, last.version + 1, until, sums_version, last.series_version, last.series_check)

    # -- what follows from the fact, its sums and silver ------------------------------
    def _derive(self, fact, touched, months, rows_in, batch_id, last, version, silver_version, sums_version, series_version, series_check) -> None:
        years = sorted({m.year for m in months})
        in_months = F.col("month_start").isin(months)
        fact_m = fact.where(in_months)
        sums = self.sums().read(sums_version)
        self._replace(gold.decline_from_sums(sums.where(in_months)), "decline_trend", "month_start", months, spread=False)
        self._replace(gold.water_cut_from_sums(sums.where(in_months)), "water_cut_trend", "month_start", months, spread=False)

        # 4. downtime: the runs of the touched months are made again from their shut-in
        # days; events over a month border are merged from one row per (well, month)
        runs = self._replace(
            mergeable.month_runs(fact_m.where(F.col("is_shutin"))), "downtime_months", "month_start", months
        )
        inner = runs.where(in_months).withColumn("head_end", F.lit(None).cast("date")).withColumn("tail_start", F.lit(None).cast("date"))
        spanning = runs.withColumn("inner", F.array().cast(runs.schema["inner"].dataType))
        events = mergeable.run_events(inner).withColumn("part", month_start("event_start").cast("string")).unionByName(
            mergeable.run_events(spanning).withColumn("part", F.lit(SPANNING))
        )
        self._replace(events, "downtime_events", "part", [*months, SPANNING])

        # 5. ranking over the per-well totals (one row per well)
        write_replace(gold.ranking_from_sums(sums), self.path("value_ranking"))

        # 6. dimensions (D-5: kept current with the fact). The version summaries of the
        # touched months feed the type-2 and the other dimensions and the calendar
        # bounds, so silver is never scanned whole for them.
        sizes = [r.n for r in touched.groupBy("month_start").agg(F.count(F.lit(1)).alias("n")).collect()]
        versions = mergeable.month_versions(
            touched, laid=lambda x: by_slot(x, ["month_start"], ["well_name"], sum(sizes), max(sizes, default=0)), layout=[SLOT],
        )
        summary = self._replace(versions, "well_month_versions", "month_start", months, spread=False)
        attrs = ("well_type", "field_name", "facility_name")
        wm = summary.select(
            "well_name", F.array_max(F.transform("parts", lambda x: F.struct(x["hi"], x["a"])))["a"].alias("_a"),
            F.array_min(F.transform("parts", lambda x: x["lo"])).alias("first_date"),
            F.array_max(F.transform("parts", lambda x: x["hi"])).alias("last_date"),
        )
        dim = wm.groupBy("well_name").agg(
            F.max_by("_a", "last_date").alias("_a"),
            F.min("first_date").alias("first_producing_date"),
            F.max("last_date").alias("last_producing_date"),
        ).select("well_name", F.col("_a.type").alias("well_type"), "_a.field_name", "_a.facility_name", "first_producing_date", "last_producing_date")
        # the summaries are read once; what follows comes from one row per well
        dim = dim.select("well_name", *attrs, "first_producing_date", "last_producing_date")
        write_replace(dim, self.path("dim_well_scd1"))
        dim = self.spark.read.schema(dim.schema).parquet(self.path("dim_well_scd1"))
        write_replace(dim.drop("well_type"), self.path("dim_well"))
        bounds = dim.agg(F.min("first_producing_date").alias("_lo"), F.max("last_producing_date").alias("_hi"))
        write_replace(
            dims.calendar(bounds.select(F.explode(F.array("_lo", "_hi")).alias("prod_date"))),
            self.path("dim_date"),
        )
        issued = self._refresh_scd2(summary, months, last, version)

        # 7. decomposition for the touched years
        year_sums = sums.where(F.year("month_start").isin(years))
        self._replace(gold.decomposition_from_sums(year_sums), "revenue_decomposition", "report_year", years)

        # 8. refresh log, keyed on the version; it commits the refresh
        rows_out = fact_m.agg(F.count(F.lit(1))).scalar()  # fact rows of the touched months
        row = rows_in.select(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            "rows_in",
            F.lit(version).cast("bigint").alias("version"),
            F.lit(len(months)).alias("months_touched"),
            F.lit(len(years)).alias("years_touched"),
            rows_out.alias("fact_rows_out"),
            F.current_timestamp().alias("refreshed_at"),
            F.lit(silver_version).cast("bigint").alias("silver_version"),
            F.lit(sums_version).cast("bigint").alias("sums_version"),
            F.lit(series_version).cast("bigint").alias("series_version"),
            F.lit(series_check).alias("series_check"),
            F.lit(issued).cast("bigint").alias("keys_issued"),
        )
        write_partitions(row, self.path("refresh_log"), ["version"])
        if last is not None:  # the two last versions stay for replays and readers
            self._delete(f"dim_well_scd2/version={last.version - 1}")
            self.sums().expire(2)

    def _refresh_scd2(self, summary: DataFrame, months: list, last, version: int) -> int:
        """DIM-3: versions of the touched wells from their month summaries; all other
        rows are copied. Returns the highest surrogate key given so far."""
        new = mergeable.merge_versions(summary, touched=months)
        if last is None:
            dim = mergeable.keep_keys(new, None, 0)
        else:
            # versions of other wells meet no new one; rows without a name meet
            dim = mergeable.keep_keys(new, self.scd2(), last.keys_issued, copied=True)
        stored = self._versioned(dim, "dim_well_scd2", version)
        return max(stored.agg(F.max("well_surrogate_key")).first()[0] or 0, 0 if last is None else last.keys_issued)


def refresh_history(spark: SparkSession, gold_root: str, n: int = 10) -> DataFrame | None:
    """REF-5: the latest ``n`` refreshes (a top-n report, so the limit is the feature)."""
    log = read_if_exists(spark, f"{gold_root.rstrip('/')}/refresh_log", LOG_SCHEMA)
    return None if log is None else log.orderBy(F.col("version").desc()).limit(n)


def latest_dates(spark: SparkSession, gold_root: str) -> dict[str, _dt.date | None]:
    """REF-4: proof of refresh: newest fact date and decomposition month."""
    out: dict[str, _dt.date | None] = {}
    for name, col in (("fact", "prod_date"), ("revenue_decomposition", "month_start")):
        df = read_if_exists(spark, f"{gold_root.rstrip('/')}/{name}")
        out[name] = None if df is None else df.agg(F.max(col)).first()[0]
    return out


def land_silver(batch: DataFrame, silver_path: str | SnapshotTable, conflicts_path: str | None = None) -> DataFrame | None:
    """REF-6: land a cleaned batch in the month-partitioned silver folder.

    Dynamic partition overwrite would drop rows already stored for a month
    the batch shares, so arriving batches are appended; re-landing the same
    batch is guarded by ``sources.sinks.append_new`` on (well, date). A
    restated (well, date) keeps the stored row; the restated rows are returned
    and, if ``conflicts_path`` is given, appended there; ``GoldRefresh.restate``
    applies them if silver is a ``SnapshotTable``.
    """
    from ..sources.sinks import append_new

    batch = batch.withColumn("month_start", month_start("prod_date"))
    if isinstance(silver_path, SnapshotTable):
        conflicts = silver_path.append_new(batch, KEY, follows=True)
    else:
        conflicts = append_new(batch, silver_path, KEY, ["month_start"], follows=True)
    if conflicts is not None and conflicts_path:
        conflicts.write.mode("append").parquet(conflicts_path)
    return conflicts
