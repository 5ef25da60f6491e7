"""Profiling and data-quality checks DQ-1 … DQ-15.

Each check is one aggregate pass over its table (the reference ran one scan
per counted column). Results are small DataFrames; none removes rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import failed_cast
from ..functions.constants import DATE_FORMATS, PRODUCER, WEEKEND_DAYS
from .segmented import CHUNK, segmented_scan, with_chunk
from .timeseries import islands


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """DQ-1: per column, rows and NULLs (``COUNT(*) - COUNT(c)``), one pass."""
    columns = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[(F.count(F.lit(1)) - F.count(F.col(c))).alias(c) for c in columns],
    )
    return wide.select(
        F.col("_total").alias("total_rows"),
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns
        ])).alias("_p"),
    ).select("_p.column_name", "total_rows", "_p.null_count")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-2: keys present more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def key_mismatch(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_name: str = "left", right_name: str = "right"
) -> DataFrame:
    """DQ-3 / SE-1: keys in one source and not the other, both ways, tagged
    with the side that has them. As in ``MINUS``, NULL keys equal each other:
    both sides are counted per key in one hash aggregate."""
    sides = left.select(*keys, F.lit(1).alias("_side")).unionByName(right.select(*keys, F.lit(2).alias("_side")))
    seen = sides.groupBy(*keys).agg(F.min("_side").alias("_lo"), F.max("_side").alias("_hi")).where("_lo = _hi")
    return seen.select(*keys, F.when(F.col("_lo") == 1, left_name).otherwise(right_name).alias("only_in"))


def uncastable(df: DataFrame, columns: Sequence[str], target: str = "decimal(18,5)") -> DataFrame:
    """DQ-4 / FIL-5: per column, present non-empty values that do not cast,
    with the smallest such value as a sample. One pass."""
    aggs = []
    for c in columns:
        bad = failed_cast(c, target)
        aggs += [F.count_if(bad).alias(f"{c}__n"), F.min(F.when(bad, F.col(c))).alias(f"{c}__s")]
    wide = df.agg(*aggs)
    return wide.select(
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__n").cast("bigint").alias("uncastable_count"),
                     F.col(f"{c}__s").alias("sample_value"))
            for c in columns
        ])).alias("_p")
    ).select("_p.*")


def negatives(df: DataFrame, columns: Sequence[str], target: str = "decimal(18,4)") -> DataFrame:
    """DQ-5: per column, values that cast to a negative number. One pass."""
    wide = df.agg(*[F.count_if(F.col(c).try_cast(target) < 0).alias(c) for c in columns])
    return wide.select(
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("negative_count")) for c in columns
        ])).alias("_p")
    ).select("_p.*")


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ-6: row count per value of each categorical column.

    Rows are expanded once per listed column (a fixed, small factor) and
    counted in one grouped aggregate with map-side combine.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).alias("value")) for c in columns]))
    return df.select(pairs.alias("_p")).groupBy("_p.attribute", "_p.value").agg(F.count(F.lit(1)).alias("n"))


def date_formats(df: DataFrame, column: str, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """DQ-7: earliest/latest parsable date and how many rows parse with each
    layout, plus rows no layout parses."""
    parsed = [F.try_to_date(F.trim(F.col(column)), f) for f in formats]
    first = F.coalesce(*parsed)
    aggs = [F.min(parsed[0]).alias("earliest_date"), F.max(parsed[0]).alias("latest_date")]
    aggs += [F.count(p).alias(f"rows_format_{i + 1}") for i, p in enumerate(parsed)]
    aggs += [F.count_if(first.isNull()).cast("bigint").alias("rows_unparsed"), F.count(F.lit(1)).alias("rows")]
    return df.agg(*aggs)


def _missing_price_rows(
    daily: DataFrame, price: DataFrame, producer: str, date: str, price_date: str, value: str | None
) -> DataFrame:
    # A price row with a NULL value counts as missing, as in a left join
    # followed by ``price IS NULL``.
    p = daily.where(F.col("well_type") == F.lit(producer)).select(date)
    known = price if value is None else price.where(F.col(value).isNotNull())
    known = known.select(F.col(price_date).alias(date)).distinct()
    # distinct days: bounded by the calendar
    return p.join(F.broadcast(known), date, "left_anti")


def price_gaps(
    daily: DataFrame, price: DataFrame, producer: str = PRODUCER, date: str = "prod_date",
    price_date: str = "price_date", value: str | None = None, out: str = "null_price_rows",
) -> DataFrame:
    """DQ-8: producer rows without a price on their day, by weekday name.

    The known-date list is one row per calendar day, so it is broadcast.
    """
    return _missing_price_rows(daily, price, producer, date, price_date, value).groupBy(
        F.dayname(date).alias("day_of_week")
    ).agg(F.count(F.lit(1)).alias(out))


def weekday_gaps(
    daily: DataFrame, price: DataFrame, producer: str = PRODUCER, date: str = "prod_date",
    price_date: str = "price_date", value: str | None = None, weekend: Sequence[str] = WEEKEND_DAYS,
) -> DataFrame:
    """DQ-8: distinct weekday dates with production but no price (holidays)."""
    m = _missing_price_rows(daily, price, producer, date, price_date, value).select(date).distinct()
    return m.select(date, F.dayname(date).alias("day_of_week")).where(~F.col("day_of_week").isin(list(weekend)))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """DQ-9: rows of each stored table (bronze, silver, rejects, …), so that a
    load that lost rows between two of them shows."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def dim_uniqueness(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """DQ-10: per stored dimension, rows against distinct keys."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(F.col(key)).alias("distinct_keys"))
        .select(F.lit(name).alias("table_name"), "total_rows", "distinct_keys")
        for name, (df, key) in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ-11 (moments): count, mean, sample stddev, min, max per column."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__count").alias("count"),
                 F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("stddev"),
                 F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
        for c in columns
    ])).alias("_p")).select("_p.*")


def column_quartiles(df: DataFrame, columns: Sequence[str], points: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """DQ-11 (quartiles): exact 25/50/75 % per column (the smallest value that
    at least that part of the known values does not exceed).

    Rows are reduced to counts per (column, value) by a hash aggregate. Those
    are cut into ranges of the value at approximate quantiles (a sketch of
    bounded size); running totals go over the ranges, then inside each, so no
    task holds all values of a column.
    """
    cells = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns
    ])).alias("_p")).select("_p.*").where(F.col("v").isNotNull())
    counts = cells.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    cuts = [i / 64 for i in range(1, 64)]
    bounds = cells.groupBy("column_name").agg(F.percentile_approx("v", cuts, 1000).alias("cuts"), F.count(F.lit(1)).alias("total"))
    # one row per column of the table
    ranged = counts.join(F.broadcast(bounds), "column_name").withColumn("r", F.size(F.filter("cuts", lambda x: x < F.col("v")))).drop("cuts")
    per_range = ranged.groupBy("column_name", "r").agg(F.sum("n").alias("in_range"))
    over = Window.partitionBy("column_name").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    before = per_range.select("column_name", "r", F.coalesce(F.sum("in_range").over(over), F.lit(0)).alias("before"))
    inside = Window.partitionBy("column_name", "r").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = ranged.withColumn("upto", F.sum("n").over(inside)).join(before, ["column_name", "r"])
    upto = upto.withColumn("upto", F.col("upto") + F.col("before"))
    return upto.groupBy("column_name").agg(*[
        F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * p), F.col("v"))).alias(f"p{int(p * 100)}") for p in points
    ])


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """DQ-11 (shape): type, rows, NULLs and distinct values of each column.

    Cells are counted per (column, value) with map-side combine, so distinct
    counts need no per-column shuffle of all rows."""
    columns = list(columns or df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("type"), F.col(c).cast("string").alias("v")) for c in columns
    ]))
    values = df.select(cells.alias("_p")).groupBy("_p.column_name", "_p.type", "_p.v").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("column_name", "type").agg(
        F.sum("n").alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("v").alias("distinct_values"),
    )


def orphans(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """DQ-13 / JN-9: fact rows whose key has no row in the dimension.

    ``dims``: name -> (dimension, fact key column, dimension key column).
    """
    parts = []
    for name, (dim, fkey, dkey) in dims.items():
        keys = dim.select(F.col(dkey).alias(fkey)).distinct()
        parts.append(
            fact.select(fkey).join(keys, fkey, "left_anti").agg(F.count(F.lit(1)).alias("orphan_rows"))
            .select(F.lit(name).alias("dimension"), "orphan_rows")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unusual(
    fact: DataFrame, entity: str = "well_name", value: str = "oil_vol_sm3", sigma: float = 3.0,
    min_zero_run: int = 7,
) -> DataFrame:
    """DQ-14: marks (never removes) unusual production per entity-day.

    * ``is_high``: value above the entity's mean + ``sigma`` sample std;
    * ``is_jump``: |value − previous day's value| above ``sigma`` std;
    * ``zero_run_days``: length of the run of zero-value days the row is in
      (0 when the value is not zero); ``is_long_zero_run`` when ≥ ``min_zero_run``.

    Entity statistics come from one grouped aggregate joined back on the
    entity; the previous value is a chunked ``lag`` (``segmented``).
    """
    x = fact.select(entity, "prod_date", F.col(value).cast("double").alias("_x"))
    stats = x.groupBy(F.col(entity).alias("_e")).agg(F.avg("_x").alias("_mu"), F.stddev_samp("_x").alias("_sd"))
    flagged = segmented_scan(
        with_chunk(x.join(stats, F.col(entity).eqNullSafe(F.col("_e"))).drop("_e"), "prod_date"), [entity],
        [F.col("prod_date"), F.col("_x")], lag=("_x", "_prev"),
    ).drop(CHUNK)
    # days, not rows: a day is in one run however many rows it has
    zero_days = x.where((F.col("_x") == 0) & F.col("prod_date").isNotNull()).select(entity, "prod_date").distinct()
    zeros = islands(zero_days, entity=entity, date="prod_date")
    zdays = zeros.select(
        F.col(entity).alias("_e"), F.explode(F.sequence("event_start", "event_end")).alias("_d"), "duration_days"
    )
    # only rows without production can be in a run
    out = flagged.join(
        zdays, (F.col("_x") == 0) & F.col(entity).eqNullSafe(F.col("_e")) & (F.col("prod_date") == F.col("_d")), "left"
    )
    return out.select(
        entity, "prod_date", F.col("_x").alias(value),
        F.coalesce(F.col("_x") > F.col("_mu") + F.lit(sigma) * F.col("_sd"), F.lit(False)).alias("is_high"),
        F.coalesce(F.abs(F.col("_x") - F.col("_prev")) > F.lit(sigma) * F.col("_sd"), F.lit(False)).alias("is_jump"),
        F.coalesce("duration_days", F.lit(0)).cast("bigint").alias("zero_run_days"),
        (F.coalesce("duration_days", F.lit(0)) >= min_zero_run).alias("is_long_zero_run"),
    )


def series_checks(
    series: DataFrame, date: str, value_text: str, units: str | None = None, expected_unit: str | None = None,
    weekdays_only: bool = True,
) -> DataFrame:
    """DQ-15: series checks over an untyped series (value as text), one row
    per check: rows, NULL values, non-numeric values, dates present more than
    once, rows whose date does not parse, rows with an unexpected unit, and calendar days (weekdays only by
    default) between the first and last date with no row.
    """
    # One pass over the series: every count is taken per date, and the
    # checks below read only that table (one row per date).
    unit_bad = F.count_if(F.col(units) != F.lit(expected_unit)) if units and expected_unit else F.lit(0)
    per_date = series.groupBy(F.col(date).try_cast("date").alias("_d")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col(value_text).isNull()).alias("_null"),
        F.count_if(failed_cast(value_text, "double")).alias("_bad"),
        unit_bad.alias("_unit"),
    )
    base = per_date.agg(
        F.sum("_n").alias("rows"),
        F.sum("_null").alias("null_values"),
        F.sum("_bad").alias("non_numeric_values"),
        F.sum("_unit").alias("unexpected_units"),
        F.count_if(F.col("_d").isNotNull() & (F.col("_n") > 1)).alias("duplicate_dates"),
        F.sum(F.when(F.col("_d").isNull(), F.col("_n"))).alias("unparsed_dates"),
    )
    bounds = per_date.agg(F.min("_d").alias("_lo"), F.max("_d").alias("_hi"))
    cal = bounds.select(F.explode(F.sequence("_lo", "_hi")).alias("_d"))
    if weekdays_only:
        cal = cal.where(F.weekday("_d") < 5)
    missing = cal.join(per_date.select("_d"), "_d", "left_anti").agg(F.count(F.lit(1)).alias("missing_dates"))

    def long(df: DataFrame) -> DataFrame:
        return df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("check_name"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("n"))
            for c in df.columns
        ])).alias("_p")).select("_p.*")

    return long(base).unionByName(long(missing))


def water_cut_range(fact: DataFrame) -> DataFrame:
    """DQ-15 (water cut): rows outside 0..1 and NULL water cut."""
    wc = F.col("water_cut")
    return fact.agg(
        F.count_if((wc < 0) | (wc > 1)).cast("bigint").alias("out_of_range"),
        F.count_if(wc.isNull()).cast("bigint").alias("null_water_cut"),
        F.count(F.lit(1)).alias("rows"),
    )


__all__ = [
    "category_counts", "column_quartiles", "column_stats", "date_formats", "dim_uniqueness", "duplicate_keys",
    "column_profile", "key_mismatch", "negatives", "null_profile", "orphans", "price_gaps",
    "series_checks", "table_counts", "uncastable", "unusual", "water_cut_range", "weekday_gaps",
]
