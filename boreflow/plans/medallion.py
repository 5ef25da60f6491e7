"""End to end on real input files: bronze → silver → gold, written as Parquet.

``run_pipeline`` is the whole load-profile-clean-model-derive chain for the
daily/monthly production CSVs and the price/FX JSON payloads:

* bronze: CSVs landed with every field as text (rejected lines kept apart),
  JSON files landed as one VARIANT row each;
* silver: typed daily (partitioned by month, tolerant dates, rejects),
  monthly, price and FX series;
* gold: filled price, dimensions (latest, SCD1, SCD2, calendar), the fact
  (partitioned by month), decline, water cut, downtime events,
  decomposition, ranking, reconciliation;
* quality: null profile, duplicate keys, uncastable and negative values,
  date formats, price gaps, series checks, load audit.

Every step reads the previous layer from storage, so each stage is
restartable and the lineage of later stages stays short.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import month_start
from ..functions.constants import PRICE_ARRAY_PATH, PRICE_TOTAL_PATH
from ..operators import dims, gold, quality, silver, timeseries
from ..operators.fact import build_fact
from ..sources import files, payloads
from ..sources.sinks import write_replace

NEGATIVE_CHECKS = ["bore_oil_vol", "bore_gas_vol", "avg_downhole_pressure", "avg_downhole_temperature",
                   "avg_choke_size_p"]
CAST_CHECKS = ["bore_oil_vol", "bore_gas_vol", "bore_wat_vol"]


def run_pipeline(
    spark: SparkSession,
    *,
    daily_csv: str,
    monthly_csv: str,
    price_json: str,
    fx_json: str,
    out: str,
    repair_names: bool = False,
) -> dict[str, str]:
    """Run every layer; return table name -> folder."""
    out = out.rstrip("/")
    written: dict[str, str] = {}

    def put(name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{out}/{name}"
        write_replace(df, path, partition_by)
        written[name] = path
        return spark.read.parquet(path)

    # bronze
    daily_rows, daily_rejects = files.load_untyped_csv(spark, daily_csv, silver.RAW_DAILY, f"{out}/bronze/daily_raw")
    monthly_rows, monthly_rejects = files.load_untyped_csv(
        spark, monthly_csv, silver.RAW_MONTHLY, f"{out}/bronze/monthly_raw"
    )
    written["bronze/daily_raw"] = f"{out}/bronze/daily_raw"
    written["bronze/monthly_raw"] = f"{out}/bronze/monthly_raw"
    price_raw = put("bronze/price_raw", files.read_json_payloads(spark, price_json))
    fx_raw = put("bronze/fx_raw", files.read_json_payloads(spark, fx_json))

    # quality on bronze (one pass per check)
    audits = [files.load_audit(daily_rows, daily_rejects), files.load_audit(monthly_rows, monthly_rejects)]
    audits += [files.load_audit(r.where(F.col("raw").isNotNull()), r.where(F.col("raw").isNull())) for r in (price_raw, fx_raw)]
    audit = put("quality/load_audit", reduce(DataFrame.unionByName, audits))
    put("quality/load_history", files.load_history(audit))
    put("quality/daily_rejects", daily_rejects)
    put("quality/monthly_rejects", monthly_rejects)
    # a payload that is no JSON stays as text, with its file
    for name, raw in (("price", price_raw), ("fx", fx_raw)):
        put(f"quality/{name}_rejects", raw.where(F.col("raw").isNull()).drop("raw"))
    put("quality/null_profile", quality.null_profile(daily_rows, silver.RAW_DAILY))
    put("quality/duplicates", quality.duplicate_keys(
        daily_rows.select(F.col("npd_well_bore_name").alias("wellbore_name"), F.col("dateprd").alias("prod_date")),
        ["wellbore_name", "prod_date"]))
    put("quality/uncastable", quality.uncastable(daily_rows, CAST_CHECKS))
    put("quality/negatives", quality.negatives(daily_rows, NEGATIVE_CHECKS))
    put("quality/categories", quality.category_counts(daily_rows, ["well_type", "flow_kind"]))
    put("quality/date_formats", quality.date_formats(daily_rows, "dateprd"))
    put("quality/payload_shape", payloads.payload_shape(price_raw.where(F.col("raw").isNotNull())
                                                        .select("raw").unionByName(fx_raw.select("raw"))))

    # silver
    clean, date_rejects = silver.clean_daily(daily_rows, repair_names=repair_names)
    put("quality/date_rejects", date_rejects)
    daily = put("silver/daily", clean.withColumn("month_start", month_start("prod_date")), ("month_start",))
    daily = daily.drop("month_start")
    monthly = put("silver/monthly", silver.clean_monthly(monthly_rows))
    good_price = price_raw.where(F.col("raw").isNotNull())
    price_fields = {"price_date": ("$.period", "string"), "value": ("$.value", "string"), "units": ("$.units", "string"),
                  "series_desc": ('$["series-description"]', "string")}
    series_text, completeness = payloads.merge_pages(good_price, price_fields, ["price_date"], PRICE_ARRAY_PATH,
                                                     PRICE_TOTAL_PATH)
    put("quality/price_completeness", completeness)
    put("quality/price_series_checks", quality.series_checks(series_text, "price_date", "value", "units", "$/BBL"))
    price_text = series_text.select(
        F.col("price_date").try_cast("date").alias("price_date"),
        F.col("value").try_cast("double").alias("brent_usd_bbl"),
        "series_desc", "units",
    )
    # pages and files may overlap: one value per date, all others listed
    prices, price_conflicts = timeseries.resolve_series(price_text, "price_date", "brent_usd_bbl")
    labels = price_text.groupBy("price_date").agg(F.min("series_desc").alias("series_desc"), F.min("units").alias("units"))
    price = put("silver/price", prices.join(labels, "price_date"))
    put("quality/price_conflicts", price_conflicts)
    rates, fx_conflicts = timeseries.resolve_series(silver.fx_series(fx_raw.where(F.col("raw").isNotNull())), "rate_date", "nok_per_usd")
    fx = put("silver/fx", rates)
    put("quality/fx_conflicts", fx_conflicts)

    # gold
    spine = daily.select(F.col("prod_date").alias("cal_date"))
    price_filled = put("gold/price_filled", timeseries.fill_series(
        spine, price, date="cal_date", value="brent_usd_bbl", series_date="price_date", out="brent_usd_bbl_filled"))
    put("gold/dim_well", dims.dim_latest(daily))
    scd1 = put("gold/dim_well_scd1", dims.dim_scd1(daily))
    put("gold/dim_well_scd2", dims.dim_scd2(daily))
    put("gold/dim_date", dims.calendar(daily))
    fact = put("gold/fact_production", build_fact(daily, price_filled, fx).withColumn(
        "month_start", month_start("prod_date")), ("month_start",)).drop("month_start")
    put("gold/well_decline_trend", gold.decline_trend(fact))
    put("gold/water_cut_trend", gold.water_cut_trend(fact))
    put("gold/downtime_events", gold.downtime_events(fact))
    decomp = put("gold/revenue_decomposition", gold.revenue_decomposition(fact))
    put("gold/decomposition_check", gold.decomposition_check(decomp))
    put("gold/well_value_ranking", gold.value_ranking(fact))
    put("gold/scd1_at_risk", dims.scd1_at_risk_total(daily, scd1, price_filled))
    recon = put("gold/reconciliation", gold.reconcile_detail(daily, monthly))
    put("gold/reconciliation_summary", gold.reconcile_summary(recon))
    put("quality/price_gaps", quality.price_gaps(daily, price, value="brent_usd_bbl"))
    put("quality/fx_gaps", quality.price_gaps(daily, fx, price_date="rate_date", value="nok_per_usd",
                                              out="null_fx_rows"))
    return written
