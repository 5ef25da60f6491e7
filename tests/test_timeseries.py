import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from boreflow.operators.timeseries import fill_series, islands

D = dt.date


def _series(spark, spine_dates, prices):
    spine = spark.createDataFrame([(d,) for d in spine_dates], "cal_date date")
    price = spark.createDataFrame(list(prices.items()), "price_date date, p double")
    return spine, price


def _fill(spark, spine_dates, prices, **kw):
    spine, price = _series(spark, spine_dates, prices)
    out = fill_series(spine, price, date="cal_date", value="p", series_date="price_date", out="f", **kw)
    return {r.cal_date: r.f for r in out.collect()}


def test_fill_head_middle_tail(spark):
    days = [D(2020, 1, i) for i in range(1, 8)]
    prices = {D(2020, 1, 2): 10.0, D(2020, 1, 5): 20.0}
    got = _fill(spark, days, prices)
    assert [got[d] for d in days] == [10.0, 10.0, 10.0, 10.0, 20.0, 20.0, 20.0]


def test_fill_all_null_and_off_spine_price(spark):
    days = [D(2020, 1, 1), D(2020, 1, 3)]
    # the only price is on a non-production day: never used (S-1)
    assert _fill(spark, days, {D(2020, 1, 2): 5.0}) == {days[0]: None, days[1]: None}
    # as-of mode carries it to later spine dates
    got = _fill(spark, days, {D(2020, 1, 2): 5.0}, mode="asof")
    assert got == {days[0]: 5.0, days[1]: 5.0}  # head gets the backward fill


def test_fill_bucketed_equals_single_window(spark):
    rnd = random.Random(7)
    days = [D(2015, 1, 1) + dt.timedelta(days=i) for i in range(0, 1500, 3)]
    prices = {d: float(rnd.randint(1, 99)) for d in days if rnd.random() < 0.05}
    a = _fill(spark, days, prices)
    b = _fill(spark, days, prices, bucket=None)
    assert a == b
    # given values are kept, and filling again changes nothing
    assert all(a[d] == v for d, v in prices.items())
    spine, _ = _series(spark, days, prices)
    again = fill_series(spine, spark.createDataFrame(list(a.items()), "price_date date, p double"),
                        date="cal_date", value="p", series_date="price_date", out="f")
    assert {r.cal_date: r.f for r in again.collect()} == a


def test_fill_per_key(spark):
    spine = spark.createDataFrame([("a", D(2020, 1, 1)), ("a", D(2020, 1, 2)), ("b", D(2020, 1, 1)), ("b", D(2021, 1, 1))],
                                  "k string, d date")
    s = spark.createDataFrame([("a", D(2020, 1, 2), 1.0), ("b", D(2020, 1, 1), 2.0)], "k string, d date, v double")
    got = {(r.k, r.d): r.f for r in fill_series(spine, s, date="d", value="v", out="f", keys=["k"]).collect()}
    assert got == {("a", D(2020, 1, 1)): 1.0, ("a", D(2020, 1, 2)): 1.0, ("b", D(2020, 1, 1)): 2.0,
                   ("b", D(2021, 1, 1)): 2.0}


def test_islands_fixture(spark):
    rows = []
    # single day; 3 in a row; gap of one; run across a month and a year
    for d in [D(2020, 1, 1), D(2020, 1, 5), D(2020, 1, 6), D(2020, 1, 7), D(2020, 1, 9),
              D(2020, 12, 31), D(2021, 1, 1)]:
        rows.append(("w1", d, True))
    rows.append(("w1", D(2020, 1, 8), False))  # not shut in: breaks nothing extra
    rows.append(("w2", D(2020, 1, 1), True))
    rows.append(("w2", D(2020, 1, 2), True))
    df = spark.createDataFrame(rows, "well_name string, prod_date date, is_shutin boolean")
    ev = islands(df, entity="well_name", date="prod_date", flag="is_shutin")
    got = sorted((r.well_name, r.event_start, r.event_end, r.duration_days) for r in ev.collect())
    assert got == [
        ("w1", D(2020, 1, 1), D(2020, 1, 1), 1), ("w1", D(2020, 1, 5), D(2020, 1, 7), 3),
        ("w1", D(2020, 1, 9), D(2020, 1, 9), 1), ("w1", D(2020, 12, 31), D(2021, 1, 1), 2),
        ("w2", D(2020, 1, 1), D(2020, 1, 2), 2),
    ]


def test_islands_duplicate_day_splits(spark):
    df = spark.createDataFrame([("w", D(2020, 1, 1)), ("w", D(2020, 1, 2)), ("w", D(2020, 1, 2)), ("w", D(2020, 1, 3))],
                               "well_name string, prod_date date")
    ev = islands(df, entity="well_name", date="prod_date")
    assert sorted((r.event_start, r.event_end) for r in ev.collect()) == [
        (D(2020, 1, 1), D(2020, 1, 2)), (D(2020, 1, 2), D(2020, 1, 3))]


def test_islands_partition_rows(spark):
    rnd = random.Random(3)
    rows = [("w%d" % (i % 5), D(2019, 1, 1) + dt.timedelta(days=rnd.randint(0, 400))) for i in range(600)]
    df = spark.createDataFrame(rows, "well_name string, prod_date date").distinct()
    ev = islands(df, entity="well_name", date="prod_date")
    # islands cover every row exactly once and never touch each other
    assert ev.agg(F.sum("duration_days")).first()[0] == df.count()
    w = Window.partitionBy("well_name").orderBy("event_start")
    gaps = ev.withColumn("prev_end", F.lag("event_end").over(w)).where(F.col("prev_end").isNotNull())
    assert gaps.where(F.datediff("event_start", "prev_end") < 2).count() == 0
