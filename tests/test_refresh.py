"""REF-1 … REF-6: incremental refresh equals a full recompute."""

import os

from pyspark.sql import functions as F

from boreflow.operators import gold, timeseries
from boreflow.operators.fact import build_fact
from boreflow.plans import standin
from boreflow.streaming import GoldRefresh, land_silver, latest_dates, refresh_history
from tests.conftest import SF_SMALL, rows


def _full(spark, silver_df, price, fx):
    spine = silver_df.select(F.col("prod_date").alias("cal_date"))
    pf = timeseries.fill_series(spine, price, date="cal_date", value="brent_usd_bbl", series_date="price_date",
                                out="brent_usd_bbl_filled")
    return build_fact(silver_df, pf, fx)


def test_two_batches_refresh(spark, tmpdir_path):
    daily = standin.well_day(spark, SF_SMALL).drop("well_id")
    price, fx = standin.price(spark, SF_SMALL), standin.fx(spark, SF_SMALL)
    split = "1997-01-01"
    held_month = "1995-06-01"  # late rows for an old month arrive with batch 2
    in_held = F.trunc("prod_date", "month") == F.lit(held_month).cast("date")
    b1 = daily.where((F.col("prod_date") < split) & ~in_held)
    b2 = daily.where((F.col("prod_date") >= split) | in_held)

    silver_path = os.path.join(tmpdir_path, "silver")
    gold_root = os.path.join(tmpdir_path, "gold")
    ckpt = os.path.join(tmpdir_path, "ckpt")

    land_silver(b1, silver_path)
    r = GoldRefresh(spark, silver_path, gold_root, ckpt, price, fx)
    r.run()
    before = latest_dates(spark, gold_root)

    land_silver(b2, silver_path)
    land_silver(b2, silver_path)             # landing the same batch twice adds nothing
    assert spark.read.parquet(silver_path).count() == daily.count()
    r.run()
    after = latest_dates(spark, gold_root)
    assert after["fact"] > before["fact"]

    r.run()                                  # no new file: nothing happens
    log = refresh_history(spark, gold_root)
    assert log.count() == 2
    assert log.agg(F.min("fact_rows_out")).first()[0] > 0

    silver_all = spark.read.parquet(silver_path).drop("month_start")
    fact = _full(spark, silver_all, price, fx)
    g = lambda n: spark.read.parquet(os.path.join(gold_root, n))

    cols = ["month_start", "well_name", "monthly_oil_vol", "monthly_gas_vol", "monthly_water_vol",
            "shutin_days_in_month"]
    assert rows(g("decline_trend"), *cols) == rows(gold.decline_trend(fact), *cols)
    cols = ["month_start", "well_name", "monthly_water_cut"]
    assert rows(g("water_cut_trend"), *cols) == rows(gold.water_cut_trend(fact), *cols)
    cols = ["well_name", "event_start", "event_end", "duration_days"]
    assert rows(g("downtime_events"), *cols) == rows(gold.downtime_events(fact), *cols)
    cols = ["well_name", "value_rank", "cumulative_revenue_usd"]
    assert rows(g("value_ranking"), *cols) == rows(gold.value_ranking(fact), *cols)
    cols = ["month_start", "report_year", "benchmark_revenue_usd", "revenue_change_usd", "total_oil_vol_bbl"]
    assert rows(g("revenue_decomposition"), *cols) == rows(gold.revenue_decomposition(fact), *cols)
    assert g("fact").count() == fact.count()
    from boreflow.operators import dims

    cols = ["well_name", "field_name", "facility_name", "first_producing_date", "last_producing_date"]
    assert rows(g("dim_well"), *cols) == rows(dims.dim_latest(silver_all), *cols)
    cols = ["well_name", "well_type", "last_producing_date"]
    assert rows(g("dim_well_scd1"), *cols) == rows(dims.dim_scd1(silver_all), *cols)
    assert rows(g("dim_date")) == rows(dims.calendar(silver_all))


def test_replayed_batch_is_idempotent(spark, tmpdir_path):
    """A micro-batch that runs twice (e.g. after an executor loss) leaves the
    same gold tables and one log row for its batch id."""
    daily = standin.well_day(spark, SF_SMALL).drop("well_id").where(F.col("prod_date") < "1996-01-01")
    price, fx = standin.price(spark, SF_SMALL), standin.fx(spark, SF_SMALL)
    silver_path = os.path.join(tmpdir_path, "silver")
    gold_root = os.path.join(tmpdir_path, "gold")
    land_silver(daily, silver_path)
    r = GoldRefresh(spark, silver_path, gold_root, os.path.join(tmpdir_path, "ckpt"), price, fx)
    batch = spark.read.parquet(silver_path)
    r.apply_batch(batch, 7)
    g = lambda n: spark.read.parquet(os.path.join(gold_root, n))
    first = {n: rows(g(n)) for n in ("decline_trend", "downtime_events", "value_ranking")}
    r.apply_batch(batch, 7)
    assert {n: rows(g(n)) for n in first} == first
    assert g("refresh_log").where("batch_id = 7").count() == 1


def test_batch_failing_midway_then_replayed(spark, tmpdir_path, monkeypatch):
    """The first attempt of batch 2 dies after writing the fact; the restarted
    stream replays the batch and the gold tables still equal a full recompute."""
    import pytest
    from pyspark.errors import StreamingQueryException

    import boreflow.streaming.refresh as refresh_mod

    daily = standin.well_day(spark, SF_SMALL).drop("well_id")
    price, fx = standin.price(spark, SF_SMALL), standin.fx(spark, SF_SMALL)
    in_held = F.trunc("prod_date", "month") == F.lit("1995-06-01").cast("date")
    b1 = daily.where((F.col("prod_date") < "1997-01-01") & ~in_held)
    b2 = daily.where((F.col("prod_date") >= "1997-01-01") | in_held)
    silver_path = os.path.join(tmpdir_path, "silver")
    gold_root = os.path.join(tmpdir_path, "gold")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    land_silver(b1, silver_path)
    r = GoldRefresh(spark, silver_path, gold_root, ckpt, price, fx)
    r.run()

    land_silver(b2, silver_path)
    real = refresh_mod.write_partitions
    state = {"failed": False}

    def flaky(df, path, parts):
        real(df, path, parts)
        if path.endswith("/fact") and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("executor lost")

    monkeypatch.setattr(refresh_mod, "write_partitions", flaky)
    with pytest.raises((StreamingQueryException, RuntimeError)):
        r.run()
    assert state["failed"]
    r.run()                                    # restart: the batch is replayed

    silver_all = spark.read.parquet(silver_path).drop("month_start")
    fact = _full(spark, silver_all, price, fx)
    g = lambda n: spark.read.parquet(os.path.join(gold_root, n))
    cols = ["month_start", "well_name", "monthly_oil_vol", "shutin_days_in_month"]
    assert rows(g("decline_trend"), *cols) == rows(gold.decline_trend(fact), *cols)
    cols = ["well_name", "value_rank", "cumulative_revenue_usd"]
    assert rows(g("value_ranking"), *cols) == rows(gold.value_ranking(fact), *cols)
    fcols = ["prod_date", "well_name", "est_revenue_usd"]
    assert rows(g("fact"), *fcols) == rows(fact, *fcols)


def _rows(spark, data):
    """(well, day, type, oil) rows as silver."""
    from datetime import date

    schema = ("well_name string, prod_date date, well_type string, field_name string, facility_name string, "
              "oil_vol_sm3 decimal(18,5), gas_vol_sm3 decimal(18,5), water_vol_sm3 decimal(18,5), "
              "avg_choke_size decimal(18,5), dp_choke_size decimal(18,5), avg_whp decimal(18,5), is_shutin boolean")
    from decimal import Decimal as D
    out = [(w, date.fromisoformat(d), t, "f", "p", D(o), D(0), D(1), D(1), D(1), D(1), t == "OP" and o == 0)
           for w, d, t, o in data]
    return spark.createDataFrame(out, schema)


def _series(spark, price, fx):
    from datetime import date

    to = lambda rows: [(date.fromisoformat(d), float(v)) for d, v in rows]
    return (spark.createDataFrame(to(price), "price_date date, brent_usd_bbl double"),
            spark.createDataFrame(to(fx), "rate_date date, nok_per_usd double"))


def test_first_batches_without_shutins_or_producers(spark, tmpdir_path):
    price, fx = _series(spark, [("2020-01-01", 50)], [("2020-01-01", 9), ("2020-02-01", 9)])
    for name, data in (("noshut", [("A", "2020-01-01", "OP", 5), ("B", "2020-01-02", "OP", 6)]),
                       ("injectors", [("A", "2020-01-01", "WI", 0)])):
        silver_path, root = os.path.join(tmpdir_path, name, "s"), os.path.join(tmpdir_path, name, "g")
        land_silver(_rows(spark, data), silver_path)
        r = GoldRefresh(spark, silver_path, root, os.path.join(tmpdir_path, name, "c"), price, fx)
        r.run()
        land_silver(_rows(spark, [("A", "2020-02-01", "OP", 0), (None, "2020-02-02", "OP", 0)]), silver_path)
        r.run()
        events = spark.read.parquet(os.path.join(root, "downtime_events"))
        assert {e.well_name for e in events.collect()} == {"A", None}
        assert spark.read.parquet(os.path.join(root, "fact")).count() == (4 if name == "noshut" else 2)
        assert refresh_history(spark, root).count() == 2


def test_late_rate_and_restated_row(spark, tmpdir_path):
    price, fx = _series(spark, [("2020-01-01", 50)], [])
    silver_path, root, bad = (os.path.join(tmpdir_path, x) for x in ("s", "g", "bad"))
    first = _rows(spark, [("A", "2020-01-01", "OP", 5), ("A", "2020-02-01", "OP", 7)])
    assert land_silver(first, silver_path, bad) is None or spark.read.parquet(bad).isEmpty()
    r = GoldRefresh(spark, silver_path, root, os.path.join(tmpdir_path, "c"), price, fx)
    r.run()
    fact = lambda: {f.prod_date.isoformat(): f.est_revenue_nok for f in spark.read.parquet(os.path.join(root, "fact")).collect()}
    assert fact() == {"2020-01-01": None, "2020-02-01": None}
    r.fx = _series(spark, [], [("2020-01-01", 9)])[1]  # the rate arrives late, no new silver
    r.run()
    assert fact()["2020-01-01"] is not None and fact()["2020-02-01"] is None
    assert refresh_history(spark, root).first().months_touched == 1
    r.run()
    assert refresh_history(spark, root).count() == 2
    restated = _rows(spark, [("A", "2020-01-01", "OP", 99), ("A", "2020-01-01", "OP", 99), ("A", "2020-02-01", "OP", 7)])
    conflicts = land_silver(restated, silver_path, bad)
    assert [c.oil_vol_sm3 for c in conflicts.collect()] == [99] and spark.read.parquet(bad).count() == 1
    assert sorted(int(x.oil_vol_sm3) for x in spark.read.parquet(silver_path).collect()) == [5, 7]
