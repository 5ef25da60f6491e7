import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from boreflow.operators import gold, measures
from boreflow.operators.fact import build_fact
from boreflow.operators.ordering import global_rank_running, global_row_number

D = dt.date


def _fact(spark, recs):
    """recs: (well, date, oil, price, fx, shutin)"""
    daily = spark.createDataFrame(
        [(w, d, "OP", Decimal(str(o)) if o is not None else None, Decimal("0"), Decimal("1"), Decimal("1"),
          Decimal("1"), Decimal("1"), s) for w, d, o, p, f, s in recs],
        "well_name string, prod_date date, well_type string, oil_vol_sm3 decimal(18,5), gas_vol_sm3 decimal(18,5), "
        "water_vol_sm3 decimal(18,5), avg_choke_size decimal(18,5), dp_choke_size decimal(18,5), avg_whp decimal(18,5), "
        "is_shutin boolean",
    )
    price = spark.createDataFrame(sorted({(d, p) for _, d, _, p, _, _ in recs}), "cal_date date, brent_usd_bbl_filled double")
    fx = spark.createDataFrame(sorted({(d, f) for _, d, _, _, f, _ in recs if f is not None}), "rate_date date, nok_per_usd double")
    return build_fact(daily, price, fx)


def test_fact_columns_and_values(spark):
    f = _fact(spark, [("w", D(2020, 1, 1), 10, 50.0, 10.0, False)])
    r = f.first()
    assert len(f.columns) == 16
    assert r.oil_vol_bbl == Decimal("62.898000000")
    assert abs(r.est_revenue_usd - 62.898 * 50) < 1e-9 and abs(r.est_revenue_nok - 62.898 * 500) < 1e-6
    assert abs(r.water_cut - 1 / 11) < 1e-12


def test_decomposition_identity_and_baseline(spark):
    recs = []
    # the year starts in September; one month with zero oil; one NULL price
    for m, oil, price in [(9, 100, 50.0), (10, 120, 55.0), (11, 0, 60.0), (12, 90, None)]:
        recs.append(("w", D(2019, m, 1), oil, price, 10.0, False))
    recs.append(("w", D(2020, 1, 1), 10, 70.0, 10.0, False))
    dec = gold.revenue_decomposition(_fact(spark, recs))
    by = {r.month_start: r for r in dec.collect()}
    base = by[D(2019, 9, 1)]
    assert base.revenue_change_usd == 0 and base.volume_effect_usd == 0 and base.price_effect_usd == 0
    assert by[D(2019, 10, 1)].baseline_vol_bbl == base.total_oil_vol_bbl
    assert by[D(2019, 11, 1)].avg_brent_price_usd is None           # zero volume -> NULL price (S-5)
    assert by[D(2020, 1, 1)].revenue_change_usd == 0                  # its own baseline
    chk = gold.decomposition_check(dec).where(F.col("month_start") == D(2019, 10, 1)).first()
    assert chk.should_be_zero_usd == 0 and chk.should_be_zero_nok == 0


def test_ranking_ties_nulls_and_partitions(spark):
    rnd = random.Random(11)
    vals = [("w%03d" % i, float(rnd.choice([1, 2, 2, 3, 5, 5, 5, 8]))) for i in range(120)]
    vals.append(("wnull", None))
    df = spark.createDataFrame(vals, "well_name string, v double")
    got = global_rank_running(df, "v", ["well_name"], partitions=7)
    w = Window.orderBy(F.col("v").desc_nulls_last(), "well_name")
    ref = df.select(
        "well_name",
        F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).alias("rank"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_sum"),
    )
    a = {r.well_name: (r.rank, r.running_sum) for r in got.collect()}
    b = {r.well_name: (r.rank, r.running_sum) for r in ref.collect()}
    assert a == b
    rn = global_row_number(df, [F.col("v").desc_nulls_last(), F.col("well_name")], partitions=5)
    ref_rn = df.select("well_name", F.row_number().over(w).alias("row_number"))
    assert {r.well_name: r.row_number for r in rn.collect()} == {r.well_name: r.row_number for r in ref_rn.collect()}
    # rows are numbered where they lie: only the summary of the partitions is shuffled
    plan = rn._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number(" not in plan and plan.count("Window") == 1, plan


def test_value_ranking_share_ends_at_one(spark):
    recs = [("a", D(2020, 1, 1), 10, 50.0, 1.0, False), ("b", D(2020, 1, 1), 10, 50.0, 1.0, False),
            ("c", D(2020, 1, 1), 5, 50.0, 1.0, False)]
    r = gold.value_ranking(_fact(spark, recs), partitions=2).orderBy("running_pct_of_total").collect()
    assert [x.value_rank for x in r] == [1, 1, 3]
    assert abs(r[-1].running_pct_of_total - 1.0) < 1e-12
    one = gold.value_ranking(_fact(spark, recs[:1])).first()
    assert one.value_rank == 1 and one.running_pct_of_total == 1.0


def test_reconcile_thresholds(spark):
    daily = spark.createDataFrame(
        [("w", D(2020, m, 1), Decimal(str(v)), Decimal("1")) for m, v in [(1, 100), (2, 100.5), (3, 101.004), (4, 102), (5, 5), (6, 7)]],
        "well_name string, prod_date date, oil_vol_sm3 decimal(18,5), gas_vol_sm3 decimal(18,5)")
    rep = spark.createDataFrame(
        [("w", 2020, m, Decimal(str(v)), Decimal("1")) for m, v in [(1, 100), (2, 100), (3, 100), (4, 100), (5, 0), (7, 1)]],
        "well_name string, prod_year int, prod_month int, oil_sm3 decimal(18,5), gas_sm3 decimal(18,5)")
    det = gold.reconcile_detail(daily, rep)
    pct = {r.month: r.oil_variance_pct for r in det.collect()}
    assert pct == {1: 0.0, 2: 0.5, 3: 1.0, 4: 2.0, 5: None}   # month 6/7 on one side only: not listed
    s = gold.reconcile_summary(det).first()
    assert (s.total_well_months, s.oil_flags, s.gas_flags) == (5, 1, 0)   # 1.004 % rounds to 1.00: not flagged


def test_measures(spark):
    recs = [("a", D(2020, 1, d), 10 if d % 3 else 0, 50.0, 10.0, d % 3 == 0) for d in range(1, 13)]
    f = _fact(spark, recs)
    k = measures.kpi_strip(f).first()
    assert k.producing_rows == 12 and k.shutin_rows == 4 and abs(k.uptime_pct - 100 * 8 / 12) < 1e-9
    w = {r.scenario_price_usd: r for r in measures.what_if_price(f).collect()}
    assert set(w) == {50.0, 70.0, 90.0} and abs(w[50.0].difference_usd) < 1e-6
    ds = measures.downtime_summary(gold.downtime_events(f)).first()
    assert ds.events == 4 and ds.shutin_days == 4 and ds.longest_event_days == 1
    dv = measures.deferred_volume(f).first()
    assert dv.shutin_days == 4 and abs(dv.deferred_oil_sm3_est - 40.0) < 1e-9
    assert measures.choke_performance(f).first().days == 12


def test_ranking_many_nulls_and_one_hot_value(spark):
    # a third of the rows share one value and another third are NULL: both tie runs straddle partitions
    vals = [("w%03d" % i, None if i % 3 == 0 else (7.0 if i % 3 == 1 else float(i))) for i in range(150)]
    df = spark.createDataFrame(vals, "well_name string, v double")
    got = global_rank_running(df, "v", ["well_name"], partitions=9)
    w = Window.orderBy(F.col("v").desc_nulls_last(), "well_name")
    ref = df.select(
        "well_name",
        F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).alias("rank"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_sum"),
        F.sum("v").over(Window.partitionBy()).alias("grand_total"),
    )
    key = lambda r: (r.rank, r.running_sum, r.grand_total)
    assert {r.well_name: key(r) for r in got.collect()} == {r.well_name: key(r) for r in ref.collect()}


def test_quartiles_are_exact(spark):
    """Ties, NULLs and two columns of different scale, against numpy."""
    import numpy as np

    from boreflow.operators.quality import column_quartiles

    rnd = random.Random(5)
    xs = [rnd.gauss(100, 30) for _ in range(5000)]
    ys = [float(rnd.randint(0, 3)) if rnd.random() < 0.9 else None for _ in range(5000)]
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double")
    got = {r.column_name: (r.p25, r.p50, r.p75) for r in column_quartiles(df, ["x", "y"]).collect()}
    for name, values in (("x", xs), ("y", [y for y in ys if y is not None])):
        assert got[name] == tuple(np.quantile(values, [0.25, 0.5, 0.75], method="inverted_cdf"))
