"""Month summaries that merge, for tables that are kept current by month.

Each product is split into a summary of one (entity, month), made from that
month's rows alone, and a merge of summaries that is associative: months can be
made again in any order, and the merge reads one row per (entity, month).

* runs of days (GLD-4, TS-2): ``month_runs`` keeps the run that touches the first
  day, the run that touches the last day, and those in between; ``run_events``
  joins what meets at month borders (``merge_runs``);
* type-2 versions (DIM-3): ``month_versions`` keeps a month's stretches of one type,
  its first and last type; ``merge_versions`` splits, joins and renumbers them, and
  ``keep_keys`` gives each version the surrogate key it had;
* sums (GLD-2, 3, 5, 7): ``signed_sums`` of rows that come (+1) or go (−1), so that a
  correction is added to stored sums; a sum is NULL when no value is left in it.

Windows over summaries hold at most one row (runs: two) per month of the calendar
for an entity. Rows without a date belong to no month and are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import month_start
from .ordering import global_row_number

MONTH = "month_start"


# --- runs of days -------------------------------------------------------------------


def month_runs(days: DataFrame, entity: str = "well_name", date: str = "prod_date") -> DataFrame:
    """Per (entity, month): ``head_end`` (end of the run from the first day), ``tail_start``
    (start of the run to the last day) and ``inner`` runs. Repeated days count once.

    One shuffle: the windows and both aggregates share the partitioning by (entity, month).
    """
    x = days.where(F.col(date).isNotNull()).select(entity, F.col(date).alias("_d")).withColumn(MONTH, month_start("_d"))
    # equal days share a rank, so a run is where day - rank stays the same
    rank = F.dense_rank().over(Window.partitionBy(entity, MONTH).orderBy("_d"))
    runs = x.withColumn("_run", F.date_sub("_d", rank)).groupBy(entity, MONTH, "_run").agg(
        F.min("_d").alias("run_start"), F.max("_d").alias("run_end")
    )
    head, tail = F.col("run_start") == F.col(MONTH), F.col("run_end") == F.last_day(MONTH)
    return runs.groupBy(entity, MONTH).agg(
        F.max(F.when(head, F.col("run_end"))).alias("head_end"),
        F.min(F.when(tail, F.col("run_start"))).alias("tail_start"),
        F.sort_array(F.collect_list(F.when(~head & ~tail, F.struct("run_start", "run_end")))).alias("inner"),
    )


def border_runs(months: DataFrame, entity: str = "well_name") -> DataFrame:
    """The runs (entity, run_start, run_end) of the summaries that touch a month border."""
    last = F.last_day(MONTH)
    head = F.when(F.col("head_end").isNotNull(), F.struct(F.col(MONTH).alias("run_start"), F.col("head_end").alias("run_end")))
    # a run over the whole month is head and tail at once
    tail = F.when(
        F.col("tail_start") > F.col(MONTH), F.struct(F.col("tail_start").alias("run_start"), last.alias("run_end"))
    )
    return months.select(entity, F.explode(F.array_compact(F.array(head, tail))).alias("r")).select(entity, "r.run_start", "r.run_end")


def merge_runs(runs: DataFrame, entity: str = "well_name") -> DataFrame:
    """Runs of an entity that overlap or follow each other become one. Associative:
    merged runs merge with others like the runs they were made of."""
    w = Window.partitionBy(entity).orderBy("run_start", "run_end")
    reached = F.max("run_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reached.isNull() | (F.col("run_start") > F.date_add(reached, 1)), 1).otherwise(0)
    chained = runs.withColumn("_opens", opens).withColumn("_chain", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return chained.groupBy(entity, "_chain").agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end")).drop("_chain")


def run_events(months: DataFrame, entity: str = "well_name") -> DataFrame:
    """GLD-4 from summaries: entity, event_start, event_end, duration_days."""
    inner = months.select(entity, F.explode("inner").alias("r")).select(entity, "r.run_start", "r.run_end")
    both = inner.unionByName(merge_runs(border_runs(months, entity), entity))
    return both.select(
        entity, F.col("run_start").alias("event_start"), F.col("run_end").alias("event_end"),
        (F.datediff("run_end", "run_start") + 1).cast("bigint").alias("duration_days"),
    )


# --- type-2 versions -----------------------------------------------------------------


def month_versions(
    daily: DataFrame, entity: str = "well_name", tracked: str = "well_type",
    carried: Sequence[str] = ("field_name", "facility_name"), date: str = "prod_date",
    laid: Callable[[DataFrame], DataFrame] | None = None, layout: Sequence[str] = (),
) -> DataFrame:
    """Per (entity, month): ``parts`` (number of the version in the month from 0, type,
    attributes, first and last date), ``first_type``, ``last_type`` and ``opened`` (versions
    opened after the month's first row). Versions open as in ``dims.dim_scd2``.

    ``laid`` may lay the rows out by month and the columns ``layout`` that it adds, which
    follow from entity and month: the result keeps that layout."""
    x = daily.where(F.col(date).isNotNull()).select(
        entity, F.col(date).alias("_d"), F.struct(F.col(tracked).alias("type"), *carried).alias("_a")
    ).withColumn(MONTH, month_start("_d"))
    x, per = x if laid is None else laid(x), [*layout, entity, MONTH]
    w = Window.partitionBy(*per).orderBy("_d", "_a.type")
    previous = F.lag("_a.type").over(w)
    x = x.withColumn("_n", F.row_number().over(w)).withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    opens = (F.col("_n") > 1) & ((F.col("_a.type") != previous) | previous.isNull())
    x = x.withColumn("_opens", F.when(opens, 1).otherwise(0))
    # rows of one date are peers: the default frame over the date
    x = x.withColumn("_local", F.sum("_opens").over(Window.partitionBy(*per).orderBy("_d")))
    parts = x.groupBy(*per, "_local", "_a").agg(
        F.min("_d").alias("lo"), F.max("_d").alias("hi"),
        F.max(F.when(F.col("_n") == 1, 1).otherwise(0)).alias("first"), F.max(F.when(F.col("_last"), 1).otherwise(0)).alias("last"),
    )
    collected = parts.groupBy(*per).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_local").alias("local"), F.col("_a").alias("a"), "lo", "hi", "first", "last"))).alias("parts"),
        F.max("_local").alias("opened"),
    )

    return collected.select(entity, MONTH, "parts", _type_of("first").alias("first_type"), _type_of("last").alias("last_type"), "opened")


def _type_of(flag: str) -> Column:
    """The type of the part with the month's first or last row."""
    return F.filter("parts", lambda p: p[flag] == 1)[0]["a"]["type"]


def merge_versions(
    months: DataFrame, entity: str = "well_name", tracked: str = "well_type",
    carried: Sequence[str] = ("field_name", "facility_name"), touched: Sequence | None = None,
) -> DataFrame:
    """DIM-3 from summaries, without surrogate key: entity, type, attributes, version,
    effective_start_date, effective_end_date, is_current. With ``touched`` months only of
    entities that have a summary in one of them.

    One shuffle of the summaries, by entity."""
    months = months.select(entity, MONTH, "parts", "first_type", "last_type", "opened")
    # a hash first: names that begin alike are told apart without comparing them
    months, per = months.repartition(entity).withColumn("_hash", F.xxhash64(entity)), ["_hash", entity]
    if touched is not None:
        met = F.max(F.col(MONTH).isin(list(touched))).over(Window.partitionBy(*per))
        months = months.withColumn("_met", met).where("_met").drop("_met")
    w = Window.partitionBy(*per).orderBy(MONTH)
    before = F.lag("last_type").over(w)
    x = months.withColumn("_first", F.when((F.col("first_type") != before) | before.isNull(), 1).otherwise(0))
    opened = F.col("_first") + F.col("opened")
    x = x.withColumn("_until", F.sum(opened).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    x = x.withColumn("_top", F.max("_until").over(Window.partitionBy(*per)))
    # the rows of one version differ only where an attribute changed inside it: the greatest of
    # the last version is current, and only months that reach that version hold it
    last = F.transform(F.filter("parts", lambda p: p["local"] == F.col("opened")), lambda p: p["a"])
    pick = F.max(F.when(F.col("_until") == F.col("_top"), F.array_max(last))).over(Window.partitionBy(*per))
    x = x.withColumn("_pick", pick)
    p = x.select(entity, "_top", "_pick", (F.col("_until") - F.col("opened")).alias("_base"), F.explode("parts").alias("p"))
    p = p.withColumn("version", (F.col("_base") + F.col("p.local")).cast("bigint"))
    current = (F.col("version") == F.col("_top")) & F.col("p.a").eqNullSafe(F.col("_pick"))
    grouped = p.groupBy(entity, F.col("p.a").alias("_a"), "version", current.alias("is_current")).agg(
        F.min("p.lo").alias("effective_start_date"), F.max("p.hi").alias("effective_end_date")
    )
    return grouped.select(
        entity, F.col("_a.type").alias(tracked), *[F.col(f"_a.{c}").alias(c) for c in carried], "version",
        "effective_start_date", "effective_end_date", "is_current",
    )


def keep_keys(
    new: DataFrame, old: DataFrame | None, issued: int, entity: str = "well_name", tracked: str = "well_type",
    carried: Sequence[str] = ("field_name", "facility_name"), key: str = "well_surrogate_key", copied: bool = False,
) -> DataFrame:
    """``new`` versions with surrogate keys: a version keeps the key of the earliest
    ``old`` version of the same entity, type and attributes that starts inside it; the
    others get numbers above ``issued``, in order of entity and version. With ``copied``
    also the ``old`` versions of entities that have no new one, as they were.

    So an untouched version keeps its key, of a split one the first part does, and of
    joined ones the first; keys are never used twice. Both sides meet in one shuffle and
    one sort by entity: versions of the same entity, type and attributes do not overlap,
    so the old one that a new one meets first, seen from the end, is the last before it.
    """
    columns = new.columns
    if old is None:
        known = new.withColumn(key, F.lit(None).cast("bigint"))
    else:
        start, end, was = F.col("effective_start_date"), F.col("effective_end_date"), F.col("_old")
        rows = new.withColumn(key, F.lit(None).cast("bigint")).withColumn("_old", F.lit(False)).unionByName(
            old.select(*[c for c in old.columns if c in (*columns, key)]).withColumn("_old", F.lit(True)), allowMissingColumns=True
        )
        what, per = [tracked, *carried], ["_hash", entity]
        rows = rows.repartition(entity).withColumns({"_hash": F.xxhash64(entity), "_what": F.xxhash64(*what)})
        w = Window.partitionBy(*per, "_what", *what).orderBy(start.desc(), was.desc(), F.col(key).desc())
        w, had = w.rowsBetween(Window.unboundedPreceding, 0), was & start.isNotNull() & F.col(key).isNotNull()
        rows = rows.withColumns({f"_met_{n}": F.last(F.when(had, c), ignorenulls=True).over(w) for n, c in (("start", start), ("key", F.col(key)))})
        inside = (F.col("_met_start") >= start) & (F.col("_met_start") <= end)
        kept = ~was
        if copied:  # the sort serves this window too
            rows = rows.withColumn("_new", F.max(~was).over(Window.partitionBy(*per)))
            kept = ~was | ~F.col("_new")
        known = rows.where(kept).select(*columns, F.when(was, F.col(key)).when(inside, F.col("_met_key")).alias(key))
    known = known.checkpoint()
    order = [F.col(entity).asc_nulls_last(), F.col("version"), *[F.col(c).asc_nulls_last() for c in (tracked, *carried)]]
    fresh = global_row_number(known.where(F.col(key).isNull()).drop(key), order, out=key)
    fresh = fresh.withColumn(key, (F.col(key) + F.lit(issued)).cast("bigint"))
    return known.where(F.col(key).isNotNull()).unionByName(fresh).select(key, *columns)


# --- signed sums ------------------------------------------------------------------------

#: What the monthly products of the fact are made of.
FACT_SUMS = {
    "oil": "oil_vol_sm3",
    "gas": "gas_vol_sm3",
    "water": "water_vol_sm3",
    "usd": "est_revenue_usd",
    "nok": "est_revenue_nok",
    "oil_price": "oil_vol_sm3 * brent_usd_bbl_filled",
    "oil_price_fx": "oil_vol_sm3 * brent_usd_bbl_filled * nok_per_usd",
}


def signed_sums(rows: DataFrame, keys: Sequence[Column | str], sums: Mapping[str, str] = FACT_SUMS, flag: str = "is_shutin", sign: str = "_sign") -> DataFrame:
    """Per key: ``n_rows``, ``n_flag`` and, for each of ``sums``, ``s_<name>`` and the number
    ``n_<name>`` of values in it. ``rows`` without a ``sign`` column all count +1."""
    if sign not in rows.columns:
        rows = rows.withColumn(sign, F.lit(1))
    up, out = F.col(sign), [F.sum(sign).alias("n_rows"), F.sum(F.when(F.col(flag), F.col(sign)).otherwise(0)).alias("n_flag")]
    for name, value in sums.items():
        v = F.expr(value)
        out += [F.sum(F.when(up > 0, v).otherwise(-v)).alias(f"s_{name}"), F.sum(F.when(v.isNotNull(), up).otherwise(0)).alias(f"n_{name}")]
    return rows.groupBy(*keys).agg(*out)


def merge_sums(parts: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Signed sums added up by coarser or equal keys; keys without rows are gone.
    Types stay those of the parts, so that merged sums can be stored with them."""
    values = [c for c in parts.columns if c[:2] in ("s_", "n_")]
    merged = parts.groupBy(*keys).agg(*[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in values])
    return merged.where("n_rows <> 0")


def total(name: str) -> Column:
    """SUM of a measure: NULL if no value is in it (exact for integers and decimals)."""
    return F.when(F.col(f"n_{name}") > 0, F.col(f"s_{name}"))
