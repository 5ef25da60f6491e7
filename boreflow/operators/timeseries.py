"""Time-series operators: gap filling (TS-1) and gaps-and-islands (TS-2)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segmented import segmented_scan, with_chunk

BucketFn = Callable[[Column], Column]


def _year_bucket(c: Column) -> Column:
    return F.year(c)


def one_per_key(series: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``keys…, value`` with one row per key: rows that repeat a value collapse;
    two different values for one key fail the job, because joining them would
    multiply rows. ``resolve_series`` settles such conflicts beforehand."""
    low, high = F.min(value), F.max(value)
    fail = F.raise_error(F.concat_ws(" ", F.lit(f"conflicting values of {value} for"), *[F.col(k).cast("string") for k in keys]))
    known = series.where(F.col(keys[-1]).isNotNull())
    return known.groupBy(*keys).agg(F.when(low != high, fail).otherwise(high).alias(value))


def resolve_series(series: DataFrame, date: str, value: str) -> tuple[DataFrame, DataFrame]:
    """``(resolved, conflicts)`` of a dated series whose pages may overlap.

    A date with several different values keeps the smallest one; all values
    of such dates, with the number of rows that carry each, are the conflicts.
    """
    values = series.where(F.col(date).isNotNull()).groupBy(date, value).agg(F.count(F.lit(1)).alias("rows"))
    per_date = values.groupBy(date).agg(F.min(value).alias(value), F.count(value).alias("_values"))
    several = per_date.where(F.col("_values") > 1).select(date)
    return per_date.select(date, value), values.where(F.col(value).isNotNull()).join(several, date, "left_semi")


def fill_series(
    spine: DataFrame,
    series: DataFrame,
    *,
    date: str,
    value: str,
    series_date: str | None = None,
    out: str | None = None,
    keys: Sequence[str] = (),
    bucket: BucketFn | None = _year_bucket,
    mode: str = "equi",
) -> DataFrame:
    """TS-1: forward fill, then backward fill for the head, over a date spine.

    ``spine`` supplies the dates (distinct ``date`` per ``keys``). In the
    default ``mode="equi"`` the series is left-joined on equal dates, so a
    value dated off the spine is never used (S-1); ``mode="asof"`` lets such a
    value carry forward to later spine dates. Returns ``keys…, date, out``.

    Scale: with ``bucket`` (default: calendar year) the fill runs inside each
    (keys, bucket) window, and one summary row per bucket carries the last and
    first known value across buckets, so no window ever spans the whole
    series. ``bucket=None`` uses one ordered window per key set.
    """
    series_date = series_date or date
    out = out or f"{value}_filled"
    keys = list(keys)
    dates = spine.select(*keys, date).distinct()
    s = one_per_key(series.select(*keys, F.col(series_date).alias(date), F.col(value).alias("_v")), [*keys, date], "_v")
    if mode == "equi":
        rows = dates.join(s, [*keys, date], "left").withColumn("_spine", F.lit(1))
    elif mode == "asof":
        rows = dates.withColumn("_v", F.lit(None).cast(s.schema["_v"].dataType)).withColumn("_spine", F.lit(1))
        rows = rows.unionByName(s.withColumn("_spine", F.lit(0)))
    else:
        raise ValueError(f"unknown fill mode {mode!r}")

    order = [F.col(date), F.col("_spine")]
    if bucket is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        filled = rows.withColumn(
            out,
            F.coalesce(
                F.last("_v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
                F.first("_v", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)),
            ),
        )
    else:
        rows = rows.withColumn("_b", bucket(F.col(date)))
        w = Window.partitionBy(*keys, "_b").orderBy(*order)
        local = rows.withColumn(
            "_fwd", F.last("_v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        ).withColumn("_bwd", F.first("_v", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
        # position of known values as a long: day number, spine rows after
        # series rows of the same day; integer ordering keeps the aggregate
        # a hash aggregate
        pos = F.when(
            F.col("_v").isNotNull(),
            F.datediff(F.col(date), F.lit("1970-01-01").cast("date")).cast("long") * 2 + F.col("_spine"),
        )
        summary = rows.groupBy(*keys, "_b").agg(
            F.max_by("_v", pos).alias("_last"), F.min_by("_v", pos).alias("_first")
        )
        sw = Window.partitionBy(*keys).orderBy("_b")
        summary = summary.select(
            *keys,
            "_b",
            F.last("_last", ignorenulls=True).over(sw.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry_f"),
            F.first("_first", ignorenulls=True).over(sw.rowsBetween(1, Window.unboundedFollowing)).alias("_carry_b"),
        )
        # Without keys the summary has one row per bucket (e.g. per year).
        summary = F.broadcast(summary) if not keys else summary
        filled = local.join(summary, [*keys, "_b"]).withColumn(
            out, F.coalesce("_fwd", "_carry_f", "_bwd", "_carry_b")
        )
    return filled.where(F.col("_spine") == 1).select(*keys, date, out)


def islands(
    df: DataFrame,
    *,
    entity: str,
    date: str,
    flag: str | None = None,
    anchor: str = "1970-01-01",
    start: str = "event_start",
    end: str = "event_end",
    duration: str = "duration_days",
) -> DataFrame:
    """TS-2 / GLD-4: runs of consecutive days per entity where ``flag`` is true.

    Island key = day number − row number within the entity (rows ordered by
    date), as in the classic gaps-and-islands query, so a duplicate date
    splits a run and a missing day ends it (S-9). ``anchor`` only shifts the
    key. Output: entity, start, end, duration = end − start + 1 days.

    The row number comes from ``segmented.segmented_scan``: windows run
    per (entity, month) and a per-chunk count carries the offset, so a hot
    entity is spread over its months instead of one task.
    """
    rows = df.where(F.col(flag)) if flag else df
    rows = with_chunk(rows.select(entity, date), date)
    numbered = segmented_scan(rows, [entity], [F.col(date)], row_number="_rn")
    keyed = numbered.withColumn("_grp", F.datediff(F.col(date), F.lit(anchor).cast("date")) - F.col("_rn"))
    return (
        keyed.groupBy(entity, "_grp")
        .agg(F.min(date).alias(start), F.max(date).alias(end))
        .withColumn(duration, (F.datediff(F.col(end), F.col(start)) + 1).cast("bigint"))
        .drop("_grp")
    )
