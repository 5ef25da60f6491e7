"""Registered queries over files that Spark writes and reads back: untyped CSV
and JSON loads with rejects (SRC-*), keyed appends (SNK-2), overlapping FX
documents, the chain from silver to gold, and the two-batch refresh (REF-*).

The files hold the stand-in inputs of the whole driver tables and lie in the
folder named by ``spark.checkpoint.dir``; each set is written once per
application and data folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import month_start
from ..operators import gold, timeseries
from ..operators.fact import build_fact
from ..operators.silver import RAW_DAILY, fx_series
from ..sources import files, payloads
from ..sources.sinks import append_new
from ..streaming import GoldRefresh, land_silver
from . import standin
from .pipeline import Pipeline
from .present import present
from .registry import DECOMP_KINDS, DECOMP_SQL, DOWNTIME_SQL, FACT_DIGITS, FACT_KINDS, MONEY2, PRICE4, QUERIES, oracle, register
from .registry_ingest import EVENT_FIELDS, SILVER_DAILY_SQL

# --- CSV: SRC-1, SRC-3, SRC-4, SRC-8 -----------------------------------------------


def _damaged(c: str) -> str:
    return f"{c} = 'not a date'"


FILE_LINES = 500_000


def csv_files(p: Pipeline) -> str:
    """The bronze rows as CSV lines; rows without a readable date are cut short. The
    files are compressed, and cut so that each is read by one task."""

    def write(path: str) -> None:
        line = F.to_csv(F.struct(*RAW_DAILY), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
        cut = F.concat_ws(",", "dateprd", F.coalesce("npd_well_bore_name", F.lit("")))
        bronze = standin.bronze_daily(p.spark, p.sf_dir, p.well_day)
        lines = bronze.select(F.when(F.expr(_damaged("dateprd")), cut).otherwise(line).alias("value"))
        lines.write.option("compression", "snappy").option("maxRecordsPerFile", FILE_LINES).text(path)

    return p.folder("csv_daily", write)


def csv_loaded(p: Pipeline) -> tuple[DataFrame, DataFrame]:
    source = csv_files(p)
    landed = p.folder("csv_bronze", lambda path: files.land_bronze(
        files.read_untyped_csv(p.spark, source, RAW_DAILY, header=False), path))
    return files.split_rejects(p.spark.read.parquet(landed), RAW_DAILY)


@register("csv_load", oracle(f"SELECT * FROM bronze_daily WHERE NOT ({_damaged('dateprd')}) OR dateprd IS NULL",
                             [(c, "keep") for c in RAW_DAILY]))
def q_csv_load(p: Pipeline) -> DataFrame:
    """SRC-1/2: rows of the untyped CSV files, null tokens mapped."""
    return csv_loaded(p)[0].select(*RAW_DAILY)


@register("csv_rejects", oracle(
    f"SELECT dateprd || ',' || COALESCE(npd_well_bore_name, '') AS raw_line FROM bronze_daily WHERE {_damaged('dateprd')}",
    [("raw_line", "keep")]))
def q_csv_rejects(p: Pipeline) -> DataFrame:
    """SRC-3: lines with too few fields, kept as they are."""
    return csv_loaded(p)[1].select("raw_line")


@register("csv_audit", oracle(
    f"SELECT COUNT_IF(NOT ({_damaged('dateprd')})) AS rows_loaded, COUNT_IF({_damaged('dateprd')}) AS rows_rejected FROM bronze_daily",
    [("rows_loaded", "int"), ("rows_rejected", "int")]))
def q_csv_audit(p: Pipeline) -> DataFrame:
    """SRC-4: rows loaded and rejected, summed over the audited files."""
    audit = files.load_audit(*csv_loaded(p))
    return present(audit.agg(F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected")))


@register("schema_diff", oracle(
    """SELECT * FROM (VALUES ('prod_date', 'string', 'date', TRUE), ('oil_vol_sm3', 'string', 'double', TRUE),
                             ('is_shutin', 'string', 'boolean', FALSE)) t(column_name, declared_type, inferred_type, declared)""",
    [("column_name", "keep"), ("declared_type", "keep"), ("inferred_type", "keep"), ("declared", "keep")]))
def q_schema_diff(p: Pipeline) -> DataFrame:
    """SRC-8: the types inference would choose for a CSV of the daily rows."""
    source = p.folder("csv_typed", lambda path: p.well_day.select("prod_date", F.col("oil_vol_sm3").cast("double"), "is_shutin")
                      .write.option("header", True).csv(path))
    return files.infer_schema_diff(p.spark, source, ["prod_date", "oil_vol_sm3"], sampling_ratio=0.1)


# --- JSON: SRC-5, rejects ----------------------------------------------------------------

BROKEN_PAGES = 3


def json_payloads(p: Pipeline) -> DataFrame:
    """One file per page, and some files that are cut off in the middle."""

    def write(path: str) -> None:
        pages = p.event_pages.select("page", F.to_json("raw").alias("value"))
        broken = pages.where(F.col("page") < BROKEN_PAGES).select(
            F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(" {"), F.substring("value", 1, 9)).alias("value"))
        pages.select("value").unionByName(broken).write.option("maxRecordsPerFile", 1).text(path)

    return files.read_json_payloads(p.spark, p.folder("json_pages", write))


@register("json_load", oracle(
    "SELECT event_id AS id, ts AS period, value, event_type AS series_desc, '$/BBL' AS units FROM events",
    [("id", "int"), ("period", "keep"), ("value", "dbl"), ("series_desc", "keep"), ("units", "keep")]))
def q_json_load(p: Pipeline) -> DataFrame:
    """SRC-5/6: pages read back from JSON files, merged into one series."""
    good = json_payloads(p).where(F.col("raw").isNotNull())
    return present(payloads.merge_pages(good, EVENT_FIELDS, ["id"], "$.response.data", "$.response.total")[0])


@register("payload_rejects", oracle(
    f"""SELECT 'page ' || page || ' {{' || '{{"respons' AS raw_text FROM (
          SELECT event_id // 5000 AS page FROM events
          UNION SELECT event_id // 5000 - 1 FROM events WHERE event_id % 5000 = 0 AND event_id > 0) p
        WHERE page < {BROKEN_PAGES}""",
    [("raw_text", "keep")]))
def q_payload_rejects(p: Pipeline) -> DataFrame:
    """SRC-5: files that are no JSON, with their text."""
    return json_payloads(p).where(F.col("raw").isNull()).select(F.regexp_replace("raw_text", r"\n$", "").alias("raw_text"))


# --- overlapping FX documents: S-12 ----------------------------------------------------------


def overlapping_rates(p: Pipeline) -> DataFrame:
    """FX rows of documents that overlap: day 20 comes twice, day 15 with two rates."""
    day = F.dayofmonth("rate_date")
    again = p.fx.where(day == 20).unionByName(p.fx.where(day == 15).withColumn("nok_per_usd", F.col("nok_per_usd") + 1))
    return fx_series(standin.fx_payloads(p.spark, p.sf_dir, p.fx.unionByName(again)))


@register("fx_resolved", oracle("SELECT rate_date, CAST(nok_per_usd AS DOUBLE) AS nok_per_usd FROM fx",
                                [("rate_date", "keep"), ("nok_per_usd", "dbl")], {"nok_per_usd": 7}))
def q_fx_resolved(p: Pipeline) -> DataFrame:
    """SLV-4: one rate per date from overlapping documents."""
    return present(timeseries.resolve_series(overlapping_rates(p), "rate_date", "nok_per_usd")[0], {"nok_per_usd": 7})


@register("fx_conflicts", oracle(
    """SELECT rate_date, CAST(nok_per_usd + extra AS DOUBLE) AS nok_per_usd, 1 AS rows
       FROM fx, (VALUES (0), (1)) t(extra) WHERE day(rate_date) = 15""",
    [("rate_date", "keep"), ("nok_per_usd", "dbl"), ("rows", "int")], {"nok_per_usd": 7}))
def q_fx_conflicts(p: Pipeline) -> DataFrame:
    """S-12: dates with several rates, all of them listed."""
    return present(timeseries.resolve_series(overlapping_rates(p), "rate_date", "nok_per_usd")[1], {"nok_per_usd": 7})


# --- SNK-2 --------------------------------------------------------------------------------------


@register("append_idempotent", oracle(
    """SELECT 'stored' AS part, well_name, prod_date, oil_vol_sm3 FROM well_day
       UNION ALL SELECT 'conflict', well_name, prod_date, oil_vol_sm3 + 1 FROM well_day WHERE day(prod_date) = 3""",
    [("part", "keep"), ("well_name", "keep"), ("prod_date", "keep"), ("oil_vol_sm3", "dec")]))
def q_append(p: Pipeline) -> DataFrame:
    """SNK-2: rows landed twice are stored once; restated rows are listed."""
    rows = p.well_day.select("well_name", "prod_date", "oil_vol_sm3").withColumn("month_start", month_start("prod_date"))
    day3 = F.dayofmonth("prod_date") == 3

    def write(path: str) -> None:
        append_new(rows.where(F.dayofmonth("prod_date") <= 20), f"{path}/rows", ["well_name", "prod_date"], ["month_start"], follows=True)
        again = rows.withColumn("oil_vol_sm3", F.when(day3, F.col("oil_vol_sm3") + 1).otherwise(F.col("oil_vol_sm3")))
        found = append_new(again, f"{path}/rows", ["well_name", "prod_date"], ["month_start"], follows=True)
        found.write.parquet(f"{path}/conflicts")

    path = p.folder("append", write)
    columns = ["well_name", "prod_date", F.col("oil_vol_sm3").cast("decimal(18,5)").alias("oil_vol_sm3")]
    parts = [p.spark.read.parquet(f"{path}/{f}").select(F.lit(n).alias("part"), *columns) for f, n in (("rows", "stored"), ("conflicts", "conflict"))]
    return present(parts[0].unionByName(parts[1]))


# --- the chain: bronze -> SLV-1 -> TS-1 -> GLD-1 -> GLD-4 ------------------------------------------


def chain_fact(p: Pipeline) -> DataFrame:
    rows, _ = p.silver_daily
    # a day loaded twice is one day
    rows = rows.distinct()
    price = timeseries.fill_series(rows.select(F.col("prod_date").alias("cal_date")), p.price, date="cal_date",
                                   value="brent_usd_bbl", series_date="price_date", out="brent_usd_bbl_filled")
    return build_fact(rows, price, p.fx)


def _chain(body: str) -> str:
    """``body`` over the fact that the cleaned bronze rows give."""
    filled, fact = (standin.STANDIN_SQL[name].replace("well_day", "cleaned") for name in ("price_filled", "fact"))
    return f"WITH cleaned AS (SELECT DISTINCT * FROM ({SILVER_DAILY_SQL}) s), price_filled AS ({filled}), fact AS ({fact}) {body}"


@register("chain_fact", oracle(_chain("SELECT * FROM fact"), FACT_KINDS, FACT_DIGITS))
def q_chain_fact(p: Pipeline) -> DataFrame:
    """GLD-1 over the output of SLV-1: damaged dates, tokens and duplicates included."""
    return present(chain_fact(p), FACT_DIGITS)


@register("chain_decline", oracle(
    _chain("""SELECT CAST(date_trunc('month', prod_date) AS DATE) AS month_start, well_name, SUM(oil_vol_sm3) AS monthly_oil_vol,
              SUM(gas_vol_sm3) AS monthly_gas_vol, SUM(water_vol_sm3) AS monthly_water_vol, COUNT_IF(is_shutin) AS shutin_days_in_month
              FROM fact GROUP BY ALL"""),
    [("month_start", "keep"), ("well_name", "keep"), ("monthly_oil_vol", "dec"), ("monthly_gas_vol", "dec"),
     ("monthly_water_vol", "dec"), ("shutin_days_in_month", "int")]))
def q_chain_decline(p: Pipeline) -> DataFrame:
    """GLD-2 over the output of SLV-1."""
    return present(gold.decline_trend(chain_fact(p)))


# --- REF-1 … REF-6 -------------------------------------------------------------------------------------

REFRESH_SPLIT = "1996-01-01"


def refreshed(p: Pipeline, name: str) -> DataFrame:
    """A gold table after two batches: days before the split, then the rest with
    one late month, restated rows, the same batch landed twice, and the rates
    of one year that arrive last."""

    def write(path: str) -> None:
        daily = p.well_day.drop("well_id")
        late = F.trunc("prod_date", "month") == F.lit("1994-06-01").cast("date")
        first = (F.col("prod_date") < F.lit(REFRESH_SPLIT).cast("date")) & ~late
        known = p.fx.where(F.year("rate_date") != 1995)
        run = GoldRefresh(p.spark, f"{path}/silver", f"{path}/gold", f"{path}/checkpoint", p.price, known)
        land_silver(daily.where(first), run.silver_path)
        run.run()
        restated = daily.where(first & (F.dayofmonth("prod_date") == 3)).withColumn("oil_vol_sm3", (F.col("oil_vol_sm3") + 1).cast("decimal(18,5)"))
        second = daily.where(~first).unionByName(restated)
        land_silver(second, run.silver_path, f"{path}/conflicts")
        land_silver(second, run.silver_path)
        run.run()
        run.fx = p.fx
        run.run()

    return p.spark.read.parquet(f"{p.folder('refresh', write)}/{name}")


def _refresh(name: str, of: str, table: str, columns: list[str], digits: dict | None = None) -> None:
    """Register the refreshed table under the oracle of the full recompute."""

    def build(p: Pipeline) -> DataFrame:
        return present(refreshed(p, table).select(*columns), digits)

    build.__doc__ = f"REF-1…3: ``{of}`` after incremental refreshes equals the full recompute."
    register(name, QUERIES[of][1])(build)


_refresh("refresh_fact", "fact_production", "gold/fact", [c for c, _ in FACT_KINDS], FACT_DIGITS)
_refresh("refresh_decline", "decline_trend", "gold/decline_trend",
         ["month_start", "well_name", "monthly_oil_vol", "monthly_gas_vol", "monthly_water_vol", "shutin_days_in_month"])
_refresh("refresh_water_cut", "water_cut_trend", "gold/water_cut_trend", ["month_start", "well_name", "monthly_water_cut"])
_refresh("refresh_ranking", "value_ranking", "gold/value_ranking",
         ["well_name", "cumulative_revenue_usd", "cumulative_revenue_nok", "value_rank", "running_pct_of_total"],
         {"cumulative_revenue_usd": 2, "cumulative_revenue_nok": 2})
_refresh("refresh_dim_well", "dim_entity", "gold/dim_well",
         ["well_name", "field_name", "facility_name", "first_producing_date", "last_producing_date"])


@register("refresh_downtime", oracle(DOWNTIME_SQL, [("well_name", "keep"), ("event_start", "keep"), ("event_end", "keep"), ("duration_days", "int")]))
def q_refresh_downtime(p: Pipeline) -> DataFrame:
    """REF-2: downtime events after incremental refreshes."""
    return present(refreshed(p, "gold/downtime_events").select("well_name", "event_start", "event_end", "duration_days"))


@register("refresh_decomposition", oracle(DECOMP_SQL, DECOMP_KINDS, {**MONEY2, **PRICE4}))
def q_refresh_decomposition(p: Pipeline) -> DataFrame:
    """REF-2: revenue decomposition after incremental refreshes."""
    return present(refreshed(p, "gold/revenue_decomposition").select(*[c for c, _ in DECOMP_KINDS]), {**MONEY2, **PRICE4})


@register("refresh_conflicts", oracle(
    f"""SELECT well_name, prod_date, oil_vol_sm3 + 1 AS oil_vol_sm3 FROM well_day
        WHERE day(prod_date) = 3 AND prod_date < DATE '{REFRESH_SPLIT}' AND date_trunc('month', prod_date) <> DATE '1994-06-01'""",
    [("well_name", "keep"), ("prod_date", "keep"), ("oil_vol_sm3", "dec")]))
def q_refresh_conflicts(p: Pipeline) -> DataFrame:
    """REF-6: restated rows of the second batch, listed and not applied."""
    return present(refreshed(p, "conflicts").select("well_name", "prod_date", F.col("oil_vol_sm3").cast("decimal(18,5)").alias("oil_vol_sm3")))


@register("refresh_log", oracle(
    f"""SELECT version, CASE version WHEN 0 THEN (SELECT COUNT(*) FROM well_day WHERE {{first}})
                        WHEN 1 THEN (SELECT COUNT(*) FROM well_day WHERE NOT ({{first}})) ELSE 0 END AS rows_in
        FROM range(3) t(version)""".replace(
        "{first}", f"prod_date < DATE '{REFRESH_SPLIT}' AND date_trunc('month', prod_date) <> DATE '1994-06-01'"),
    [("version", "int"), ("rows_in", "int")]))
def q_refresh_log(p: Pipeline) -> DataFrame:
    """REF-5: one log row per refresh: two batches and the late rates."""
    return present(refreshed(p, "gold/refresh_log").select("version", "rows_in"))
