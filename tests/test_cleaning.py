import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from boreflow.functions import cleaning as C


def test_null_tokens_and_decimal_cast(spark):
    df = spark.createDataFrame([("12.5",), ("NULL",), ("NaN",), ("",), ("abc",), (" 7 ",), ("-3",), ("1E3",)], "x string")
    out = df.select(C.null_tokens("x").alias("t"), C.try_decimal(C.null_tokens("x"), 18, 5).alias("d")).collect()
    assert [r.t for r in out][:4] == ["12.5", None, None, None]
    assert [r.d for r in out] == [Decimal("12.50000"), None, None, None, None, Decimal("7.00000"),
                                  Decimal("-3.00000"), Decimal("1000.00000")]


def test_tolerant_date_both_layouts_and_century(spark):
    df = spark.createDataFrame([("2007-09-01",), ("01-09-07",), ("31-12-95",), ("bad",), (None,), (" 2016-12-01 ",)], "x string")
    got = [r.d for r in df.select(C.tolerant_date("x").alias("d")).collect()]
    assert got == [dt.date(2007, 9, 1), dt.date(2007, 9, 1), dt.date(1995, 12, 31), None, None, dt.date(2016, 12, 1)]


def test_shutin_flag_fixtures(spark):
    # all measures missing -> shut in; zero hours with oil -> not; injector with zeros -> not
    df = spark.createDataFrame(
        [("OP", None, None, None, None), ("OP", 0.0, 5.0, 0.0, 0.0), ("WI", 0.0, 0.0, 0.0, 0.0),
         ("OP", 0.0, 0.0, 0.0, 0.0), (None, 0.0, 0.0, 0.0, 0.0), ("OP", 24.0, 0.0, 0.0, 0.0)],
        "t string, h double, o double, g double, w double",
    )
    got = [r.s for r in df.select(C.shutin_flag("t", ["h", "o", "g", "w"]).alias("s")).collect()]
    assert got == [True, False, False, True, False, False]


def test_safe_ratio_and_pct(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (None, 2.0), (101.004, 100.0)], "a double, b double")
    out = df.select(C.safe_ratio("a", "b").alias("r"), C.pct_variance("a", "b").alias("p")).collect()
    assert out[0].r == 0.25 and out[1].r is None and out[2].r is None
    assert out[3].p == 1.0


def test_mojibake_repair_guarded(spark):
    broken = "\u00c3\u0086sgard"  # UTF-8 bytes of "Æsgard" read as Latin-1
    cp1252 = "\u00c3\u2020sgard"  # the same bytes read as windows-1252: left alone
    df = spark.createDataFrame([(broken,), ("Æsgard",), ("Plain",), (None,), (cp1252,)], "x string")
    got = [r.y for r in df.select(C.repair_mojibake("x").alias("y")).collect()]
    assert got == ["Æsgard", "Æsgard", "Plain", None, cp1252]


def test_failed_cast(spark):
    df = spark.createDataFrame([("1.5",), ("",), (None,), ("x1",)], "x string")
    assert [r.f for r in df.select(C.failed_cast("x", "decimal(18,4)").alias("f")).collect()] == [False, False, False, True]


def test_tolerant_date_round_trip_property(spark):
    """Any date written in either accepted layout parses back to itself
    (two-digit years within the 1970-2069 window)."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    collected = []

    @settings(max_examples=200, deadline=None)
    @given(st.dates(min_value=dt.date(1970, 1, 1), max_value=dt.date(2069, 12, 31)))
    def gen(d):
        collected.append(d)

    gen()
    rows = [(d, d.isoformat(), d.strftime("%d-%m-%y")) for d in collected]
    df = spark.createDataFrame(rows, "d date, iso string, dmy string")
    out = df.select("d", C.tolerant_date("iso").alias("a"), C.tolerant_date("dmy").alias("b")).collect()
    assert all(r.a == r.d and r.b == r.d for r in out)
