"""BI measures as DataFrames: BI-1 … BI-7 (BI-5 lives in ``gold.field_trend``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import month_start, safe_ratio
from ..functions.constants import WHAT_IF_PRICES
from .segmented import CHUNK, segmented_scan, with_chunk


def kpi_strip(fact: DataFrame) -> DataFrame:
    """BI-1: total oil (bbl), value USD and NOK, uptime percent.

    Uptime = 100 × (1 − shut-in rows / rows), as the fact carries no hours.
    """
    return fact.agg(
        F.sum("oil_vol_bbl").alias("total_oil_bbl"),
        F.sum("est_revenue_usd").alias("total_value_usd"),
        F.sum("est_revenue_nok").alias("total_value_nok"),
        F.count(F.lit(1)).alias("producing_rows"),
        F.count_if(F.col("is_shutin")).cast("bigint").alias("shutin_rows"),
    ).withColumn(
        "uptime_pct",
        F.lit(100.0) * (F.lit(1.0) - safe_ratio(F.col("shutin_rows"), F.col("producing_rows"))),
    )


def what_if_price(fact: DataFrame, prices: Sequence[float] = WHAT_IF_PRICES) -> DataFrame:
    """BI-2: value of the produced barrels at each assumed price, beside the
    actual value and the difference. The scenarios are a literal array
    exploded after the one-row aggregate, so no join is planned."""
    totals = fact.agg(
        F.sum("oil_vol_bbl").alias("total_oil_bbl"), F.sum("est_revenue_usd").alias("actual_value_usd")
    )
    s = totals.select(
        "total_oil_bbl", "actual_value_usd",
        F.explode(F.array(*[F.lit(float(p)) for p in prices])).alias("scenario_price_usd"),
    )
    scen = F.col("total_oil_bbl").cast("double") * F.col("scenario_price_usd")
    return s.select(
        "scenario_price_usd", "total_oil_bbl", scen.alias("scenario_value_usd"), "actual_value_usd",
        (scen - F.col("actual_value_usd").cast("double")).alias("difference_usd"),
    )


def value_vs_price(decomp: DataFrame) -> DataFrame:
    """BI-3: monthly value against the volume-weighted price (from GLD-5)."""
    return decomp.select("month_start", "benchmark_revenue_usd", "avg_brent_price_usd", "total_oil_vol_bbl")


def _mean(c: str) -> F.Column:
    return safe_ratio(F.sum(c), F.count(c))


def _corr(a: str, b: str) -> F.Column:
    # Pearson correlation; NULL (not an ANSI divide-by-zero error, as
    # ``corr`` raises) when either side is constant or has one value.
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    return safe_ratio(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def choke_performance(fact: DataFrame, entity: str = "well_name", by_month: bool = False) -> DataFrame:
    """BI-4: per entity (or entity and month) mean choke, mean oil rate, mean
    wellhead pressure (bubble size) and the choke-oil correlation."""
    keys = [entity, month_start("prod_date").alias("month_start")] if by_month else [entity]
    return fact.groupBy(*keys).agg(
        _mean("avg_choke_size").alias("avg_choke"),
        _mean("oil_vol_sm3").alias("avg_oil_sm3"),
        _mean("avg_whp").alias("avg_whp"),
        _corr("avg_choke_size", "oil_vol_sm3").alias("choke_oil_corr"),
        F.count(F.lit(1)).alias("days"),
    )


def downtime_summary(events: DataFrame, entity: str = "well_name") -> DataFrame:
    """BI-6: per entity event count, shut-in days, longest and mean event."""
    return events.groupBy(entity).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("duration_days").alias("shutin_days"),
        F.max("duration_days").alias("longest_event_days"),
        safe_ratio(F.sum("duration_days"), F.count(F.lit(1))).alias("mean_event_days"),
    )


def deferred_volume(fact: DataFrame, entity: str = "well_name", window_days: int = 30) -> DataFrame:
    """BI-7 (an estimate): oil not produced on shut-in days.

    Each shut-in day is valued at the entity's mean oil over its last
    ``window_days`` producing (not shut-in) days before it; summed per entity.

    Sums are DECIMAL, so that the difference of two long sums is exact. No
    window spans a whole entity: producing days get a chunked position k
    and running sum S (``segmented_scan``); the trailing mean is
    (S_k − S_{k−n}) / min(k, n), with S_{k−n} from an equi-join on
    (entity, k − n); a shut-in day takes the mean of the latest producing
    day before it (``segmented_scan``, last known value).
    """
    n = window_days
    base = with_chunk(
        fact.select(entity, "prod_date", "is_shutin", F.col("oil_vol_sm3").cast("decimal(28,9)").alias("_oil")), "prod_date"
    )
    prod = base.where(~F.col("is_shutin"))
    prod = segmented_scan(prod, [entity], [F.col("prod_date"), F.col("_oil")], row_number="_k",
                          running_sum=("_oil", "_cum"))
    back = prod.select(F.struct(entity, (F.col("_k") + n).alias("_k")).alias("_at"), F.col("_cum").alias("_cum_back"))
    # a struct is never NULL, so an entity that is NULL finds its own rows
    prod = prod.withColumn("_at", F.struct(entity, "_k")).join(back, "_at", "left").withColumn(
        "_trail",
        (F.col("_cum") - F.coalesce("_cum_back", F.lit(0).cast("decimal(38,9)"))).cast("double")
        / F.least(F.col("_k"), F.lit(n)),
    ).select(entity, "prod_date", "is_shutin", "_oil", CHUNK, "_trail")
    shut = base.where(F.col("is_shutin")).withColumn("_trail", F.lit(None).cast("double"))
    both = prod.unionByName(shut)
    est = segmented_scan(
        both, [entity], [F.col("prod_date"), F.col("is_shutin")], last_known_before=("_trail", "_est")
    ).where(F.col("is_shutin"))
    return est.groupBy(entity).agg(
        F.count(F.lit(1)).alias("shutin_days"),
        F.count("_est").alias("estimated_days"),
        F.sum("_est").alias("deferred_oil_sm3_est"),
    )
