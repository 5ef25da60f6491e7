"""Derived gold products GLD-2 … GLD-7 and the source reconciliation DQ-12."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import month_start, pct_variance, safe_ratio
from ..functions.constants import BBL_PER_SM3, RECONCILE_THRESHOLD_PCT
from .mergeable import merge_sums, total
from .ordering import global_rank_running
from .timeseries import islands


def decline_trend(fact: DataFrame, entity: str = "well_name") -> DataFrame:
    """GLD-2: monthly oil, gas, water and shut-in day count per entity.

    One hash aggregate on (month, entity) with map-side partial sums, so a
    busy entity is pre-aggregated before the shuffle.
    """
    return fact.groupBy(month_start("prod_date").alias("month_start"), entity).agg(
        F.sum("oil_vol_sm3").alias("monthly_oil_vol"),
        F.sum("gas_vol_sm3").alias("monthly_gas_vol"),
        F.sum("water_vol_sm3").alias("monthly_water_vol"),
        F.count_if(F.col("is_shutin")).cast("bigint").alias("shutin_days_in_month"),
    )


def field_trend(fact: DataFrame) -> DataFrame:
    """BI-5: GLD-2 without the entity key."""
    return fact.groupBy(month_start("prod_date").alias("month_start")).agg(
        F.sum("oil_vol_sm3").alias("monthly_oil_vol"),
        F.sum("gas_vol_sm3").alias("monthly_gas_vol"),
        F.sum("water_vol_sm3").alias("monthly_water_vol"),
        F.count_if(F.col("is_shutin")).cast("bigint").alias("shutin_days_in_month"),
    )


def water_cut_trend(fact: DataFrame, entity: str = "well_name") -> DataFrame:
    """GLD-3: ratio of sums water / (oil + water) per month and entity."""
    return fact.groupBy(month_start("prod_date").alias("month_start"), entity).agg(
        safe_ratio(F.sum("water_vol_sm3"), F.sum("oil_vol_sm3") + F.sum("water_vol_sm3")).alias(
            "monthly_water_cut"
        )
    )


def downtime_events(fact: DataFrame, entity: str = "well_name") -> DataFrame:
    """GLD-4: islands of consecutive shut-in days per entity."""
    return islands(fact, entity=entity, date="prod_date", flag="is_shutin")


def monthly_value(fact: DataFrame, factor: Decimal = BBL_PER_SM3) -> DataFrame:
    """Monthly field volume, volume-weighted prices and benchmark revenue."""
    oil = F.sum("oil_vol_sm3")
    return fact.groupBy(month_start("prod_date").alias("month_start")).agg(
        (oil * F.lit(factor)).alias("total_oil_vol_bbl"),
        safe_ratio(F.sum(F.col("oil_vol_sm3") * F.col("brent_usd_bbl_filled")), oil).alias("avg_brent_price_usd"),
        safe_ratio(
            F.sum(F.col("oil_vol_sm3") * F.col("brent_usd_bbl_filled") * F.col("nok_per_usd")), oil
        ).alias("avg_brent_price_nok"),
        F.sum("est_revenue_usd").alias("benchmark_revenue_usd"),
        F.sum("est_revenue_nok").alias("benchmark_revenue_nok"),
    )


def revenue_decomposition(fact: DataFrame, factor: Decimal = BBL_PER_SM3) -> DataFrame:
    """GLD-5: change from the first available month of the year, split into
    volume effect, price effect and their interaction, in USD and NOK.

    The baseline per year comes from a ``min_by`` aggregate (no window), and
    is joined back on the year; both sides hold one row per month.
    """
    return decompose(monthly_value(fact, factor))


def decompose(monthly: DataFrame) -> DataFrame:
    """GLD-5 from the monthly values (``monthly_value`` or sums kept by month)."""
    m = monthly.withColumn("report_year", F.year("month_start").cast("bigint"))
    first = F.min_by(
        F.struct("total_oil_vol_bbl", "avg_brent_price_usd", "avg_brent_price_nok",
                 "benchmark_revenue_usd", "benchmark_revenue_nok"),
        F.col("month_start"),
    )
    b = m.groupBy("report_year").agg(first.alias("_b")).select(
        "report_year",
        F.col("_b.total_oil_vol_bbl").alias("baseline_vol_bbl"),
        F.col("_b.avg_brent_price_usd").alias("baseline_price_usd"),
        F.col("_b.avg_brent_price_nok").alias("baseline_price_nok"),
        F.col("_b.benchmark_revenue_usd").alias("baseline_revenue_usd"),
        F.col("_b.benchmark_revenue_nok").alias("baseline_revenue_nok"),
    )
    j = m.join(b, "report_year")
    dvol = (F.col("total_oil_vol_bbl") - F.col("baseline_vol_bbl")).cast("double")
    bvol = F.col("baseline_vol_bbl").cast("double")
    out = [
        "month_start", "report_year", "total_oil_vol_bbl", "avg_brent_price_usd", "avg_brent_price_nok",
        "benchmark_revenue_usd", "benchmark_revenue_nok", "baseline_vol_bbl", "baseline_price_usd",
        "baseline_price_nok", "baseline_revenue_usd", "baseline_revenue_nok",
    ]
    effects = []
    for cur in ("usd", "nok"):
        dprice = F.col(f"avg_brent_price_{cur}") - F.col(f"baseline_price_{cur}")
        effects += [
            (F.col(f"benchmark_revenue_{cur}") - F.col(f"baseline_revenue_{cur}")).alias(f"revenue_change_{cur}"),
            (dvol * F.col(f"baseline_price_{cur}")).alias(f"volume_effect_{cur}"),
            (dprice * bvol).alias(f"price_effect_{cur}"),
            (dvol * dprice).alias(f"volume_price_interaction_{cur}"),
        ]
    return j.select(*out, *effects)


def decomposition_check(decomp: DataFrame, digits: int = 2) -> DataFrame:
    """GLD-6: change − (volume + price + interaction), rounded; expected 0.

    Checked in USD and NOK (D-9).
    """
    cols = [F.col("month_start")]
    for cur in ("usd", "nok"):
        recon = (
            F.col(f"volume_effect_{cur}") + F.col(f"price_effect_{cur}") + F.col(f"volume_price_interaction_{cur}")
        )
        cols += [
            F.col(f"revenue_change_{cur}").cast("double").alias(f"revenue_change_{cur}"),
            recon.alias(f"reconstructed_change_{cur}"),
            F.round(F.col(f"revenue_change_{cur}").cast("double") - recon, digits).alias(f"should_be_zero_{cur}"),
        ]
    return decomp.select(*cols)


def value_ranking(fact: DataFrame, entity: str = "well_name", partitions: int | None = None) -> DataFrame:
    """GLD-7: cumulative value per entity, RANK by USD value (NULLs last) and
    running share of the total, ties in the running sum broken by name (S-8).

    ``running_pct_of_total`` is a fraction 0..1, named as in the source (D-15).
    Ordering runs through ``global_rank_running``: no single-task window.
    """
    totals = fact.groupBy(entity).agg(
        F.sum("est_revenue_usd").alias("cumulative_revenue_usd"),
        F.sum("est_revenue_nok").alias("cumulative_revenue_nok"),
    )
    ranked = global_rank_running(
        totals, "cumulative_revenue_usd", [entity], rank_col="value_rank", running_col="_run",
        total_col="_grand", partitions=partitions,
    )
    return ranked.select(
        entity,
        "cumulative_revenue_usd",
        "cumulative_revenue_nok",
        "value_rank",
        safe_ratio(F.col("_run"), F.col("_grand")).alias("running_pct_of_total"),
    )


# --- the same products from signed sums kept by (month, entity) ---------------------------


def decline_from_sums(sums: DataFrame, entity: str = "well_name") -> DataFrame:
    """GLD-2 from ``mergeable.signed_sums``."""
    return sums.select(
        "month_start", entity, total("oil").alias("monthly_oil_vol"), total("gas").alias("monthly_gas_vol"),
        total("water").alias("monthly_water_vol"), F.col("n_flag").cast("bigint").alias("shutin_days_in_month"),
    )


def water_cut_from_sums(sums: DataFrame, entity: str = "well_name") -> DataFrame:
    """GLD-3 from ``mergeable.signed_sums``."""
    return sums.select("month_start", entity, safe_ratio(total("water"), total("oil") + total("water")).alias("monthly_water_cut"))


def decomposition_from_sums(sums: DataFrame, factor: Decimal = BBL_PER_SM3) -> DataFrame:
    """GLD-5 from ``mergeable.signed_sums``: the entities' sums are added up by month first."""
    m = merge_sums(sums, ["month_start"])
    return decompose(m.select(
        "month_start",
        (total("oil") * F.lit(factor)).alias("total_oil_vol_bbl"),
        safe_ratio(total("oil_price"), total("oil")).alias("avg_brent_price_usd"),
        safe_ratio(total("oil_price_fx"), total("oil")).alias("avg_brent_price_nok"),
        total("usd").alias("benchmark_revenue_usd"),
        total("nok").alias("benchmark_revenue_nok"),
    ))


def ranking_from_sums(sums: DataFrame, entity: str = "well_name", partitions: int | None = None) -> DataFrame:
    """GLD-7 from ``mergeable.signed_sums``."""
    return value_ranking(sums.select(entity, total("usd").alias("est_revenue_usd"), total("nok").alias("est_revenue_nok")), entity, partitions)


def reconcile_detail(
    daily: DataFrame,
    reported: DataFrame,
    *,
    entity: str = "well_name",
    measures: tuple[tuple[str, str, str], ...] = (("oil", "oil_vol_sm3", "oil_sm3"), ("gas", "gas_vol_sm3", "gas_sm3")),
) -> DataFrame:
    """DQ-12: daily sums per entity-month against the reported monthly value.

    Inner join on (entity, year, month): a month present on one side only is
    not listed (S-7); use ``quality.key_mismatch`` to see those.
    """
    sums = daily.groupBy(
        entity, F.year("prod_date").alias("year"), F.month("prod_date").alias("month")
    ).agg(*[F.sum(d).alias(f"daily_summed_{n}") for n, d, _ in measures])
    rep = reported.select(
        F.col(entity).alias("_e"),
        F.col("prod_year").cast("int").alias("_y"),
        F.col("prod_month").cast("int").alias("_m"),
        *[F.col(r).alias(f"monthly_reported_{n}") for n, _, r in measures],
    )
    j = sums.join(rep, (sums[entity] == rep._e) & (sums.year == rep._y) & (sums.month == rep._m))
    cols = [F.col(entity), F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month")]
    for n, _, _ in measures:
        d, r = F.col(f"daily_summed_{n}"), F.col(f"monthly_reported_{n}")
        cols += [d, r, (d - r).alias(f"{n}_variance"), pct_variance(d, r).alias(f"{n}_variance_pct")]
    return j.select(*cols)


def reconcile_summary(detail: DataFrame, threshold_pct: float = RECONCILE_THRESHOLD_PCT) -> DataFrame:
    """DQ-12: entity-months compared and how many exceed the threshold.

    The percent is rounded before the test; a NULL percent is never flagged.
    """
    return detail.agg(
        F.count(F.lit(1)).alias("total_well_months"),
        F.count_if(F.abs("oil_variance_pct") > threshold_pct).cast("bigint").alias("oil_flags"),
        F.count_if(F.abs("gas_variance_pct") > threshold_pct).cast("bigint").alias("gas_flags"),
    )
