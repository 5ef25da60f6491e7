"""Every main operator accepts empty inputs and returns an empty (or
all-zero) result with its usual schema, instead of failing."""

from pyspark.sql import functions as F

from boreflow.operators import dims, gold, governance, measures, quality, timeseries
from boreflow.operators.fact import build_fact
from boreflow.operators.ordering import global_rank_running, global_row_number
from boreflow.sources import payloads

DAILY = ("well_name string, prod_date date, well_type string, field_name string, facility_name string, "
         "oil_vol_sm3 decimal(18,5), gas_vol_sm3 decimal(18,5), water_vol_sm3 decimal(18,5), "
         "avg_choke_size decimal(18,5), dp_choke_size decimal(18,5), avg_whp decimal(18,5), is_shutin boolean")


def test_operators_on_empty_inputs(spark):
    daily = spark.createDataFrame([], DAILY)
    price = spark.createDataFrame([], "cal_date date, brent_usd_bbl_filled double")
    fx = spark.createDataFrame([], "rate_date date, nok_per_usd double")
    fact = build_fact(daily, price, fx)
    monthly = spark.createDataFrame([], "well_name string, prod_year int, prod_month int, oil_sm3 decimal(18,5), "
                                        "gas_sm3 decimal(18,5)")
    empty = [
        fact, gold.decline_trend(fact), gold.water_cut_trend(fact), gold.downtime_events(fact),
        gold.revenue_decomposition(fact), gold.value_ranking(fact), gold.reconcile_detail(daily, monthly),
        dims.dim_latest(daily), dims.dim_scd2(daily), dims.dim_multi_type(daily), dims.calendar(daily),
        measures.choke_performance(fact), measures.deferred_volume(fact),
        measures.downtime_summary(gold.downtime_events(fact)), quality.unusual(fact),
        timeseries.fill_series(daily.select(F.col("prod_date").alias("cal_date")),
                               price.withColumnRenamed("brent_usd_bbl_filled", "p"), date="cal_date", value="p"),
        global_row_number(daily, [F.col("well_name")]), global_rank_running(fact, "oil_vol_sm3", ["well_name"]),
        governance.governed(fact, "VIEWER"),
    ]
    for df in empty:
        assert df.count() == 0
    # one-row summaries stay one row
    assert measures.kpi_strip(fact).first().producing_rows == 0
    assert gold.reconcile_summary(gold.reconcile_detail(daily, monthly)).first().total_well_months == 0
    checks = {r.check_name: r.n for r in quality.series_checks(
        spark.createDataFrame([], "d string, v string, u string"), "d", "v", "u", "$/BBL").collect()}
    assert checks["rows"] == 0 and checks["missing_dates"] == 0
    pages = spark.createDataFrame([], "raw string").select(F.parse_json("raw").alias("raw"))
    series, comp = payloads.merge_pages(pages, {"id": ("$.id", "bigint")}, ["id"], "$.data", "$.total")
    assert series.count() == 0 and comp.count() == 1
