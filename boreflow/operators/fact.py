"""GLD-1: the daily production fact."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import safe_ratio
from ..functions.constants import BBL_PER_SM3, PRODUCER
from .timeseries import one_per_key

FACT_COLUMNS = (
    "prod_date well_name well_type oil_vol_sm3 oil_vol_bbl gas_vol_sm3 water_vol_sm3 avg_choke_size "
    "dp_choke_size avg_whp is_shutin brent_usd_bbl_filled nok_per_usd water_cut est_revenue_usd "
    "est_revenue_nok"
).split()


def build_fact(
    daily: DataFrame,
    price_filled: DataFrame,
    fx: DataFrame,
    *,
    producer: str = PRODUCER,
    factor: Decimal = BBL_PER_SM3,
    price_date: str = "cal_date",
    price_col: str = "brent_usd_bbl_filled",
    fx_date: str = "rate_date",
    fx_col: str = "nok_per_usd",
) -> DataFrame:
    """Producer rows joined to the filled price and the FX rate of the day.

    Left joins on the date: a missing FX rate leaves the NOK value NULL (FX is
    not filled, S-2). A duplicated date would multiply fact rows (S-12), so
    both series are reduced to one row per calendar day first and conflicting
    values fail the job (``timeseries.one_per_key``). That also bounds their
    size by the calendar span: they are broadcast and the fact is never
    shuffled for these joins.
    """
    p = daily.where(F.col("well_type") == F.lit(producer))
    prices = price_filled.select(F.col(price_date).alias("_pd"), F.col(price_col).alias("brent_usd_bbl_filled"))
    rates = fx.select(F.col(fx_date).alias("_fd"), F.col(fx_col).alias("nok_per_usd"))
    prices = one_per_key(prices, ["_pd"], "brent_usd_bbl_filled")
    rates = one_per_key(rates, ["_fd"], "nok_per_usd")
    j = p.join(F.broadcast(prices), p.prod_date == prices._pd, "left").join(
        F.broadcast(rates), p.prod_date == rates._fd, "left"
    )
    bbl = F.col("oil_vol_sm3") * F.lit(factor)
    usd = bbl * F.col("brent_usd_bbl_filled")
    return j.select(
        "prod_date",
        "well_name",
        "well_type",
        "oil_vol_sm3",
        bbl.alias("oil_vol_bbl"),
        "gas_vol_sm3",
        "water_vol_sm3",
        "avg_choke_size",
        "dp_choke_size",
        "avg_whp",
        "is_shutin",
        "brent_usd_bbl_filled",
        "nok_per_usd",
        safe_ratio(F.col("water_vol_sm3"), F.col("oil_vol_sm3") + F.col("water_vol_sm3")).alias("water_cut"),
        usd.alias("est_revenue_usd"),
        (usd * F.col("nok_per_usd")).alias("est_revenue_nok"),
    )
