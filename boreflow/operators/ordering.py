"""Global orderings without a single-task window.

``ROW_NUMBER() OVER (ORDER BY …)`` or ``RANK() OVER (ORDER BY …)`` with no
PARTITION BY makes Spark gather every row into one task. These helpers keep
the same results while the rows stay spread out:

1. range-partition the rows on the full sort key (Spark samples the key, so
   the partitions are balanced even when one value is very common, because
   the tie-break columns are part of the key);
2. write that layout once with a reliable ``checkpoint`` (the folder named by
   ``spark.checkpoint.dir``) so every later read sees the same partition
   assignment, even if an executor is lost and a task re-runs;
3. number rows by their place in the sorted partition; rank and accumulate with
   a window partitioned by the partition id;
4. turn one summary row per partition into offsets. The summary has exactly
   as many rows as partitions, which is the bound that makes broadcasting it
   and ordering it in one task safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_P = "_part"


def _ranged(df: DataFrame, order: Sequence[Column], partitions: int | None) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    # Without an explicit count AQE may coalesce neighbouring ranges to its
    # advisory size (order is preserved: only contiguous ranges merge), so
    # the partition count follows the data at any scale.
    laid = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    laid = laid.sortWithinPartitions(*order).withColumn(_P, F.spark_partition_id())
    # Reliable checkpoint: fixes the sampled range bounds for both the
    # summary pass and the row pass, and cuts the lineage.
    return laid.checkpoint(eager=True)


def global_row_number(
    df: DataFrame, order: Sequence[Column], out: str = "row_number", partitions: int | None = None
) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order)`` as BIGINT, computed in parallel.

    ``order`` should be a total order (add tie-break columns), otherwise the
    numbering among ties is arbitrary, as it is in SQL.
    """
    laid = _ranged(df, order, partitions)
    # the stored partitions are sorted, so a row's place in its partition is its number there
    # (the lower 33 bits): no second shuffle and sort
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    local = laid.withColumn("_lrn", place + 1)
    summary = laid.groupBy(_P).agg(F.count(F.lit(1)).alias("_cnt"))
    summary = summary.withColumn(
        "_off",
        F.coalesce(
            F.sum("_cnt").over(Window.orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
    ).select(_P, "_off")
    return (
        local.join(F.broadcast(summary), _P)
        .withColumn(out, (F.col("_off") + F.col("_lrn")).cast("bigint"))
        .drop(_P, "_lrn", "_off")
    )


def global_rank_running(
    df: DataFrame,
    value: str,
    tiebreak: Sequence[str],
    rank_col: str = "rank",
    running_col: str = "running_sum",
    total_col: str | None = "grand_total",
    partitions: int | None = None,
) -> DataFrame:
    """RANK by ``value`` DESC (NULLs last) plus a running sum in that order.

    Equivalent to::

        RANK() OVER (ORDER BY value DESC NULLS LAST)
        SUM(value) OVER (ORDER BY value DESC NULLS LAST, tiebreak ROWS UNBOUNDED PRECEDING)
        SUM(value) OVER ()

    Ties may straddle a partition boundary; a rank then comes from the
    first partition that holds the tied value (found on the summary table).
    """
    v = F.col(value)
    order = [v.desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak]]
    laid = _ranged(df, order, partitions)
    w = Window.partitionBy(_P).orderBy(*order)
    # ties are defined by the value alone, not by the tie-break columns
    w_rank = Window.partitionBy(_P).orderBy(v.desc_nulls_last())
    local = (
        laid.withColumn("_lrank", F.rank().over(w_rank))
        .withColumn("_lrn", F.row_number().over(w))
        .withColumn("_lcum", F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    )
    summary = local.groupBy(_P).agg(
        F.count(F.lit(1)).alias("_cnt"),
        F.sum(v).alias("_tot"),
        F.min_by(v, F.col("_lrn")).alias("_fv"),
        F.max_by(v, F.col("_lrn")).alias("_lv"),
        F.max("_lrank").alias("_lr_last"),
    )
    before = Window.orderBy(_P).rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        summary.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
        .withColumn("_cum_before", F.sum("_tot").over(before))
        .withColumn("_sum_all", F.sum("_tot").over(Window.partitionBy()))
        .withColumn("_last_start", F.col("_off") + F.col("_lr_last"))
    )
    # Where a partition starts with the value that earlier partitions end on,
    # the rank is the position where that run of ties began.
    s1 = summary.select(F.col(_P).alias("_p1"), F.col("_fv").alias("_k"))
    s2 = summary.select(F.col(_P).alias("_p2"), F.col("_lv").alias("_k2"), "_last_start")
    carried = (
        s1.join(s2, (s2["_k2"].eqNullSafe(s1["_k"])) & (s2["_p2"] < s1["_p1"]))
        .groupBy("_p1")
        .agg(F.min("_last_start").alias("_tie_start"))
    )
    summary = summary.join(carried, summary[_P] == carried["_p1"], "left").drop("_p1")
    out = local.join(F.broadcast(summary.select(_P, "_fv", "_off", "_cum_before", "_sum_all", "_tie_start")), _P)
    rank = F.when(
        v.eqNullSafe(F.col("_fv")) & F.col("_tie_start").isNotNull(), F.col("_tie_start")
    ).otherwise(F.col("_off") + F.col("_lrank"))
    running = F.when(
        F.col("_cum_before").isNull(), F.col("_lcum")
    ).otherwise(F.col("_cum_before") + F.coalesce(F.col("_lcum"), F.lit(0)))
    out = out.withColumn(rank_col, rank.cast("bigint")).withColumn(running_col, running)
    if total_col:
        out = out.withColumn(total_col, F.col("_sum_all"))
    return out.drop(_P, "_lrank", "_lrn", "_lcum", "_fv", "_off", "_cum_before", "_sum_all", "_tie_start")
