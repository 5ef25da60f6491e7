"""SURVEY §7.6 semantics pinned down on small inputs."""

import datetime as dt

import pytest
from decimal import Decimal

from pyspark.sql import functions as F

from boreflow.operators import dims, gold, quality
from boreflow.operators.fact import build_fact

D = dt.date
SCHEMA = ("well_name string, prod_date date, well_type string, oil_vol_sm3 decimal(18,5), gas_vol_sm3 decimal(18,5), "
          "water_vol_sm3 decimal(18,5), avg_choke_size decimal(18,5), dp_choke_size decimal(18,5), "
          "avg_whp decimal(18,5), is_shutin boolean")


def _daily(spark, recs):
    return spark.createDataFrame(
        [(w, d, t, None if o is None else Decimal(o), Decimal("0"), None if wa is None else Decimal(wa),
          Decimal("1"), Decimal("1"), Decimal("1"), False) for w, d, t, o, wa in recs], SCHEMA)


def test_fx_not_filled_and_water_cut_nulls(spark):
    daily = _daily(spark, [("a", D(2020, 1, 1), "OP", "10", "10"), ("a", D(2020, 1, 2), "OP", None, "5"),
                           ("a", D(2020, 1, 3), "OP", "0", "0"), ("a", D(2020, 1, 4), "WI", "0", "0")])
    price = spark.createDataFrame([(D(2020, 1, d), 50.0) for d in (1, 2, 3, 4)], "cal_date date, brent_usd_bbl_filled double")
    fx = spark.createDataFrame([(D(2020, 1, 1), 10.0)], "rate_date date, nok_per_usd double")
    f = {r.prod_date.day: r for r in build_fact(daily, price, fx).collect()}
    assert set(f) == {1, 2, 3}                                    # producer rows only
    assert f[1].water_cut == 0.5 and f[2].water_cut is None and f[3].water_cut is None   # S-10
    assert f[1].est_revenue_nok is not None and f[3].nok_per_usd is None and f[3].est_revenue_nok is None  # S-2


def test_duplicate_price_date_is_refused_and_flagged(spark):
    daily = _daily(spark, [("a", D(2020, 1, 1), "OP", "10", "0")])
    price = spark.createDataFrame([(D(2020, 1, 1), 50.0), (D(2020, 1, 1), 51.0)], "cal_date date, brent_usd_bbl_filled double")
    fx = spark.createDataFrame([(D(2020, 1, 1), 10.0)], "rate_date date, nok_per_usd double")
    with pytest.raises(Exception, match="conflicting values"):                             # S-12: would multiply rows
        build_fact(daily, price, fx).collect()
    assert quality.duplicate_keys(price, ["cal_date"]).count() == 1                        # the gate that catches it


def test_weighted_price_with_null_price(spark):
    daily = _daily(spark, [("a", D(2020, 1, 1), "OP", "10", "0"), ("a", D(2020, 1, 2), "OP", "10", "0")])
    price = spark.createDataFrame([(D(2020, 1, 1), 50.0), (D(2020, 1, 2), None)], "cal_date date, brent_usd_bbl_filled double")
    fx = spark.createDataFrame([(D(2020, 1, 1), 1.0), (D(2020, 1, 2), 1.0)], "rate_date date, nok_per_usd double")
    m = gold.monthly_value(build_fact(daily, price, fx)).first()
    # the NULL-price day's volume stays in the denominator, so the price understates (S-5)
    assert m.avg_brent_price_usd == 25.0


def test_scd2_versions_cover_every_row_once(spark):
    recs = []
    types = ["OP", "OP", "WI", "WI", "OP", "WI", "OP", "OP"]
    for w in ("a", "b"):
        for i, t in enumerate(types if w == "a" else types[::-1]):
            recs.append((w, D(2020, 1, 1) + dt.timedelta(days=i * 9), t, "1", "1"))
    daily = _daily(spark, recs)
    v = dims.dim_scd2(daily, carried=(), partitions=3)
    covered = daily.alias("d").join(
        v.alias("v"),
        (F.col("d.well_name") == F.col("v.well_name")) & (F.col("d.well_type") == F.col("v.well_type"))
        & F.col("d.prod_date").between(F.col("v.effective_start_date"), F.col("v.effective_end_date")),
    )
    assert covered.count() == daily.count()                      # every row in exactly one version
    assert v.where("is_current").count() == 2
    assert v.count() == 5 + 5


def test_injector_day_breaks_a_downtime_run(spark):
    recs = [("a", D(2020, 1, 1), "OP", "0", "0"), ("a", D(2020, 1, 2), "OP", "0", "0"),
            ("a", D(2020, 1, 3), "WI", "0", "0"), ("a", D(2020, 1, 4), "OP", "0", "0")]
    daily = _daily(spark, recs).withColumn("is_shutin", F.col("well_type") == "OP")
    price = spark.createDataFrame([(D(2020, 1, d), 50.0) for d in range(1, 5)], "cal_date date, brent_usd_bbl_filled double")
    fx = spark.createDataFrame([(D(2020, 1, 1), 1.0)], "rate_date date, nok_per_usd double")
    ev = gold.downtime_events(build_fact(daily, price, fx))
    assert sorted((r.event_start.day, r.duration_days) for r in ev.collect()) == [(1, 2), (4, 1)]   # S-9
