"""Per-entity ordered computations without one window per entity.

``Window.partitionBy(entity).orderBy(date)`` sends every row of an entity to
one task; a hot entity (a third of all rows, say) then runs in a single task.
``segmented_scan`` splits each entity's rows into *chunks* (default: the
calendar month of the date) and windows only inside ``(entity, chunk)``.
What must flow across chunk borders (row offsets, running sums, the previous
row's value, the last known value) is read off the last row of each chunk:
one summary row per ``(entity, chunk)``, ordered per entity, whose size is
bounded by the number of chunks in the calendar span, not by the rows.

One window pass, one small summary, one join; no aggregate with a
variable-width buffer (which would make Spark sort). The results equal the
single per-entity window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ChunkFn = Callable[[Column], Column]
CHUNK = "_chunk"


def month_chunk(c: Column) -> Column:
    return F.trunc(c, "month")


def with_chunk(df: DataFrame, date: str, chunk: ChunkFn = month_chunk) -> DataFrame:
    return df.withColumn(CHUNK, chunk(F.col(date)))


def segmented_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    *,
    row_number: str | None = None,
    running_sum: tuple[str, str] | None = None,
    running_sum_range_by: str | None = None,
    lag: tuple[str, str] | None = None,
    last_known_before: tuple[str, str] | None = None,
    chunk_col: str = CHUNK,
) -> DataFrame:
    """Per ``keys``, in ``order`` (ascending columns; make it a total order),
    add any of:

    * ``row_number=out``: ROW_NUMBER();
    * ``running_sum=(value, out)``: SUM(value) ROWS UNBOUNDED PRECEDING, or
      with ``running_sum_range_by=date`` the default RANGE frame over that
      column (rows on the same date are peers);
    * ``lag=(value, out)``: LAG(value) (NULL values included);
    * ``last_known_before=(value, out)``: LAST_VALUE(value IGNORE NULLS)
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING.

    ``df`` must carry ``chunk_col``, monotone in ``order`` (e.g. the month
    of the leading date column, see ``with_chunk``).
    """
    # One struct holds the keys and the chunk: it is never NULL, so rows whose
    # key or date is NULL find their carry like any others, and the join
    # below reuses the windows' partitioning.
    part = ["_part"]
    df = df.withColumn("_part", F.struct(*keys, chunk_col))
    w = Window.partitionBy(*part).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    x = df.withColumn("_lrn", F.row_number().over(w)).withColumn(
        "_is_last", F.lead(F.lit(1)).over(w).isNull()
    )
    summary_cols = [F.col("_lrn").alias("_n")]
    if running_sum:
        value, _ = running_sum
        if running_sum_range_by:
            rw = Window.partitionBy(*part).orderBy(running_sum_range_by)
            x = x.withColumn("_lsum", F.sum(value).over(rw))
        else:
            x = x.withColumn("_lsum", F.sum(value).over(upto))
        summary_cols.append(F.col("_lsum").alias("_t"))
    if lag:
        value, _ = lag
        x = x.withColumn("_llag", F.lag(value).over(w))
        summary_cols.append(F.col(value).alias("_lastv"))
    if last_known_before:
        value, _ = last_known_before
        x = x.withColumn("_lknown", F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        x = x.withColumn("_lknown_all", F.last(value, ignorenulls=True).over(upto))
        summary_cols.append(F.col("_lknown_all").alias("_lastk"))

    summary = x.where(F.col("_is_last")).select(*part, *keys, chunk_col, *summary_cols)
    sw = Window.partitionBy(*keys).orderBy(chunk_col)
    before = sw.rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")]
    if running_sum:
        carry_cols.append(F.sum("_t").over(before).alias("_cum_before"))
    if lag:
        carry_cols.append(F.lag("_lastv").over(sw).alias("_prev_last"))
    if last_known_before:
        carry_cols.append(F.last("_lastk", ignorenulls=True).over(before).alias("_carry_known"))
    carry = summary.select(*part, *carry_cols)

    out = x.join(carry, part)
    if row_number:
        out = out.withColumn(row_number, F.col("_off") + F.col("_lrn"))
    if running_sum:
        out = out.withColumn(
            running_sum[1],
            F.when(F.col("_cum_before").isNull(), F.col("_lsum")).otherwise(
                F.col("_cum_before") + F.coalesce(F.col("_lsum"), F.lit(0))
            ),
        )
    if lag:
        out = out.withColumn(lag[1], F.when(F.col("_lrn") == 1, F.col("_prev_last")).otherwise(F.col("_llag")))
    if last_known_before:
        out = out.withColumn(last_known_before[1], F.coalesce("_lknown", "_carry_known"))
    internal = ["_part", "_lrn", "_is_last", "_off", "_lsum", "_cum_before", "_llag", "_prev_last", "_lknown", "_lknown_all",
                "_carry_known"]
    return out.drop(*[c for c in internal if c in out.columns])
