"""Dimensions: DIM-1 … DIM-6."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import BBL_PER_SM3, PRODUCER
from .ordering import global_row_number
from .segmented import CHUNK, with_chunk
from .timeseries import one_per_key


def dim_latest(
    daily: DataFrame,
    entity: str = "well_name",
    attrs: Sequence[str] = ("field_name", "facility_name"),
    date: str = "prod_date",
    first: str = "first_producing_date",
    last: str = "last_producing_date",
) -> DataFrame:
    """DIM-1 (and DIM-2 with ``well_type`` in ``attrs``): latest attributes,
    first and last date per entity. All dates count, shut-in and injection
    days included (S-11).

    Each attribute has the value of the entity's latest date, even when that
    is NULL (MAX_BY semantics); ties on the date go to the larger value, rows
    without a date are ignored. The rows are reduced by a hash aggregate over
    (entity, attributes) that keeps only dates; the latest is then picked from
    the few combinations an entity has had.
    """
    seen = daily.groupBy(entity, *attrs).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))

    def latest(c: str) -> F.Column:
        dated = F.when(F.col("_hi").isNotNull(), F.struct(F.col("_hi"), F.col(c).alias("_v")))
        return F.array_max(F.collect_list(dated))["_v"].alias(c)

    return seen.groupBy(entity).agg(*[latest(a) for a in attrs], F.min("_lo").alias(first), F.max("_hi").alias(last))


def dim_scd1(daily: DataFrame, entity: str = "well_name", date: str = "prod_date") -> DataFrame:
    """DIM-2: type-1 dimension, the entity's most recent type overwrites."""
    return dim_latest(daily, entity, ("well_type", "field_name", "facility_name"), date)


def dim_multi_type(
    daily: DataFrame, entity: str = "well_name", tracked: str = "well_type",
    carried: Sequence[str] = ("field_name", "facility_name"),
) -> DataFrame:
    """DIM-4: distinct (entity, type, attrs) for entities with more than one type."""
    multi = (
        daily.select(entity, tracked).distinct().groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1).select(entity)
    )
    # few rows are left after the distinct, and it comes first
    kinds = daily.select(entity, tracked, *carried).distinct()
    return kinds.join(multi, entity, "left_semi")


def dim_scd2(
    daily: DataFrame,
    entity: str = "well_name",
    tracked: str = "well_type",
    carried: Sequence[str] = ("field_name", "facility_name"),
    date: str = "prod_date",
    partitions: int | None = None,
) -> DataFrame:
    """DIM-3: type-2 dimension versioned by changes of ``tracked``.

    A row opens a version when its type differs from the previous row's, or
    the previous type is NULL (S-3). Versions are grouped with the carried
    attributes, so a facility change inside a version yields two rows with
    one version number (S-4). Start/end are the first/last observed dates.
    The surrogate key follows (entity, version, type, attributes) and is
    numbered without a single-task window (``global_row_number``).
    """
    versioned = _versions(daily.select(entity, tracked, *carried, date), entity, tracked, date)
    grouped = versioned.groupBy(entity, tracked, *carried, "_version", "_top").agg(
        F.min(date).alias("effective_start_date"), F.max(date).alias("effective_end_date")
    )
    # The pass over the rows brings each entity's highest version along. The
    # rows of one version differ only if an attribute changed inside it (S-4),
    # so the window that picks the current one of them holds very few rows.
    attributes = F.struct(tracked, *carried)
    pick = F.max(attributes).over(Window.partitionBy(entity, "_version"))
    cur = grouped.withColumn(
        "is_current", (F.col("_version") == F.col("_top")) & attributes.eqNullSafe(pick)
    ).drop("_top")
    order = [F.col(entity).asc_nulls_last(), F.col("_version"), F.col(tracked).asc_nulls_last(),
             *[F.col(c).asc_nulls_last() for c in carried]]
    keyed = global_row_number(cur, order, out="well_surrogate_key", partitions=partitions)
    return keyed.select(
        "well_surrogate_key", entity, tracked, *carried, "effective_start_date", "effective_end_date", "is_current"
    )


def _versions(df: DataFrame, entity: str, tracked: str, date: str) -> DataFrame:
    """Adds ``_version`` = running count of version starts per entity, and
    ``_top``, the entity's last version.

    A row starts a version when its type differs from the previous row's or
    the previous type is NULL (S-3); the count uses the default RANGE frame
    over the date, as ``SUM(...) OVER (PARTITION BY entity ORDER BY date)``.

    One pass, chunked by month (no window spans an entity): rows 2…n of a
    month only need the month's own previous row, so their flags and running
    count are local. Row 1 needs the last type of the entity's previous
    month; that, and the number of starts per month, come from one summary
    row per (entity, month) read off the month's last row.
    """
    x = with_chunk(df, date)
    # a struct is never NULL, so entities and dates that are NULL join too
    part = ["_part"]
    x = x.withColumn("_part", F.struct(entity, CHUNK))
    w = Window.partitionBy(*part).orderBy(F.col(date), F.col(tracked))
    w_range = Window.partitionBy(*part).orderBy(date)
    prev = F.lag(tracked).over(w)
    x = (
        x.withColumn("_lrn", F.row_number().over(w))
        .withColumn("_is_last", F.lead(F.lit(1)).over(w).isNull())
        .withColumn("_first_t", F.first(tracked).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(
            "_new", F.when(F.col("_lrn") == 1, F.lit(0))
            .when((F.col(tracked) != prev) | prev.isNull(), F.lit(1)).otherwise(F.lit(0))
        )
        .withColumn("_lsum", F.sum("_new").over(w_range))
    )
    summary = x.where(F.col("_is_last")).select(
        *part, entity, CHUNK, F.col("_first_t"), F.col(tracked).alias("_last_t"), F.col("_lsum").alias("_starts_after_first")
    )
    sw = Window.partitionBy(entity).orderBy(CHUNK)
    prev_last = F.lag("_last_t").over(sw)
    summary = summary.withColumn(
        "_first_new", F.when((F.col("_first_t") != prev_last) | prev_last.isNull(), F.lit(1)).otherwise(F.lit(0))
    )
    starts = F.col("_first_new") + F.col("_starts_after_first")
    carry = summary.select(
        *part,
        "_first_new",
        F.sum(starts).over(Window.partitionBy(entity)).cast("bigint").alias("_top"),
        F.coalesce(
            F.sum(starts).over(sw.rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_before"),
    )
    return (
        x.join(carry, part)
        .withColumn("_version", (F.col("_before") + F.col("_first_new") + F.col("_lsum")).cast("bigint"))
        .drop("_part", CHUNK, "_lrn", "_is_last", "_first_t", "_new", "_lsum", "_first_new", "_before")
    )


def calendar(daily: DataFrame, date: str = "prod_date") -> DataFrame:
    """DIM-6: every day from the first to the last date, with year, month,
    quarter and month start. One aggregate for the bounds, then ``sequence``
    plus ``explode`` (no row generator and no cross join)."""
    bounds = daily.agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    days = bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 DAY"))).alias("calendar_date"))
    return days.select(
        "calendar_date",
        F.year("calendar_date").cast("bigint").alias("year"),
        F.month("calendar_date").cast("bigint").alias("month"),
        F.quarter("calendar_date").cast("bigint").alias("quarter"),
        F.trunc("calendar_date", "month").alias("month_start"),
    )


def scd1_at_risk_by_entity(
    daily: DataFrame, scd1: DataFrame, price_filled: DataFrame, entity: str = "well_name",
    producer: str = PRODUCER, factor=BBL_PER_SM3,
) -> DataFrame:
    """DIM-5: producer-day volume and value per entity beside the type the
    SCD1 dimension shows today. Value uses barrels (D-6)."""
    j = _producer_value(daily, scd1, price_filled, entity, producer, factor)
    return j.groupBy(entity, F.col("_label").alias("dim_well_current_label")).agg(
        F.count(F.lit(1)).alias("op_days"),
        F.sum("oil_vol_sm3").alias("op_oil_vol"),
        F.sum("_value").alias("op_revenue_usd"),
    )


def scd1_at_risk_total(
    daily: DataFrame, scd1: DataFrame, price_filled: DataFrame, entity: str = "well_name",
    producer: str = PRODUCER, factor=BBL_PER_SM3,
) -> DataFrame:
    """DIM-5: producer-day value whose entity the SCD1 label no longer calls a
    producer, against all producer-day value, and the percent."""
    j = _producer_value(daily, scd1, price_filled, entity, producer, factor)
    at_risk = F.sum(F.when(F.col("_label") != F.lit(producer), F.col("_value")).otherwise(F.lit(0)))
    total = F.sum("_value")
    return j.agg(at_risk.alias("at_risk_revenue_usd"), total.alias("total_op_revenue_usd")).withColumn(
        "at_risk_pct",
        F.round(F.lit(100.0) * F.col("at_risk_revenue_usd").cast("double")
                / F.when(F.col("total_op_revenue_usd") != 0, F.col("total_op_revenue_usd").cast("double")), 2),
    )


def _producer_value(daily, scd1, price_filled, entity, producer, factor):
    p = daily.where(F.col("well_type") == F.lit(producer)).select(entity, "prod_date", "oil_vol_sm3")
    d = scd1.select(entity, F.col("well_type").alias("_label"))
    # one row per calendar day, so its size is bounded by the calendar
    b = one_per_key(price_filled.withColumnRenamed("cal_date", "_d"), ["_d"], "brent_usd_bbl_filled")
    j = p.join(d, entity).join(F.broadcast(b), F.col("prod_date") == F.col("_d"), "left")
    return j.withColumn("_value", F.col("oil_vol_sm3") * F.lit(factor) * F.col("brent_usd_bbl_filled"))
