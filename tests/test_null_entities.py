"""Rows whose well is NULL, duplicated dates and odd texts keep their place."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from boreflow.functions import cleaning
from boreflow.operators import dims, gold, measures, quality, timeseries
from boreflow.operators.fact import build_fact

DAILY = "well_name string, prod_date date, well_type string, field_name string, facility_name string, oil_vol_sm3 decimal(18,5), is_shutin boolean"


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def daily(spark, wells=("A", None), days=70):
    rows = []
    for w in wells:
        for n in range(days):
            shut = n % 9 in (3, 4)
            rows.append((w, day(n), "OP" if n < 40 else "WI", "f", "p", D(0) if shut else D(10 + n % 5), shut))
    return spark.createDataFrame(rows, DAILY)


def by_well(df):
    out = {}
    for r in df.collect():
        d = r.asDict()
        out.setdefault(d.pop("well_name"), []).append(tuple(sorted((k, str(v)) for k, v in d.items() if k != "well_surrogate_key")))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("build", [dims.dim_latest, dims.dim_scd1, dims.dim_scd2, gold.downtime_events, quality.unusual, measures.deferred_volume])
def test_a_null_well_is_a_well(spark, build):
    got = by_well(build(daily(spark)))
    assert got.keys() == {"A", None} and got["A"] == got[None]


def test_unusual_keeps_row_count_on_duplicated_days(spark):
    df = daily(spark, ("A",)).unionByName(daily(spark, ("A",)).where("is_shutin"))
    out = quality.unusual(df)
    assert out.count() == df.count()
    assert {r.zero_run_days for r in out.where("oil_vol_sm3 = 0").collect()} == {2}


def test_deferred_volume_is_exact_after_large_values(spark):
    rows = [("A", day(n), "OP", "f", "p", D("900000000000") if n < 30 else D("0.01010"), False) for n in range(60)]
    rows.append(("A", day(60), "OP", "f", "p", D(0), True))
    got = measures.deferred_volume(spark.createDataFrame(rows, DAILY)).first()
    assert got.deferred_oil_sm3_est == 0.0101


def test_duplicated_series_dates(spark):
    rates = spark.createDataFrame([(day(0), 9.0), (day(0), 9.0), (day(1), 8.0), (day(1), 8.5), (day(2), None)], "rate_date date, nok_per_usd double")
    resolved, conflicts = timeseries.resolve_series(rates, "rate_date", "nok_per_usd")
    assert sorted(map(tuple, resolved.collect())) == [(day(0), 9.0), (day(1), 8.0), (day(2), None)]
    assert sorted(map(tuple, conflicts.collect())) == [(day(1), 8.0, 1), (day(1), 8.5, 1)]
    rows = daily(spark, ("A",), 3).withColumns({c: F.lit(1).cast("decimal(18,5)") for c in ("gas_vol_sm3", "water_vol_sm3", "avg_choke_size", "dp_choke_size", "avg_whp")})
    prices = spark.createDataFrame([(day(0), 50.0), (day(0), 50.0)], "cal_date date, brent_usd_bbl_filled double")
    assert build_fact(rows, prices, resolved).count() == 3
    with pytest.raises(Exception, match="conflicting values"):
        build_fact(rows, prices, rates).collect()
    spine = rows.select(F.col("prod_date").alias("cal_date"))
    series = spark.createDataFrame([(day(0), 1.0), (day(0), 1.0)], "cal_date date, v double")
    assert timeseries.fill_series(spine, series, date="cal_date", value="v").count() == 3


def test_mojibake_in_one_place_only(spark):
    df = spark.createDataFrame([("Ærfugl Ã¥",), ("Ã…sgard",), ("Ã¥sgard",)], "x string")
    assert [r.y for r in df.select(cleaning.repair_mojibake("x").alias("y")).collect()] == ["Ærfugl Ã¥", "Ã…sgard", "åsgard"]


def test_series_checks_report_bad_dates(spark):
    s = spark.createDataFrame([("2020-01-01", "1"), ("no date", "2"), ("2020-01-03", "x"), (None, None)], "d string, v string")
    got = {r.check_name: r.n for r in quality.series_checks(s, "d", "v").collect()}
    assert got["unparsed_dates"] == 2 and got["rows"] == 4 and got["non_numeric_values"] == 1 and got["missing_dates"] == 1
