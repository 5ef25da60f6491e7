import datetime as dt

from pyspark.sql import functions as F

from boreflow.operators import dims
from tests.conftest import nsort, rows

D = dt.date


def _daily(spark, recs):
    return spark.createDataFrame(recs, "well_name string, prod_date date, well_type string, field_name string, facility_name string")


def test_scd2_type_history(spark):
    recs = []
    # one type
    recs += [("A", D(2020, 1, d), "OP", "F", "X") for d in (1, 2, 3)]
    # OP -> WI -> OP
    recs += [("B", D(2020, 1, 1), "OP", "F", "X"), ("B", D(2020, 1, 2), "WI", "F", "X"), ("B", D(2020, 1, 5), "OP", "F", "X")]
    # NULL in the middle: NULL opens no version, the row after it does (S-3)
    recs += [("C", D(2020, 1, 1), "OP", "F", "X"), ("C", D(2020, 1, 2), None, "F", "X"), ("C", D(2020, 1, 3), "OP", "F", "X")]
    # facility change inside a version: two rows, same version (S-4)
    recs += [("E", D(2020, 1, 1), "OP", "F", "X"), ("E", D(2020, 1, 2), "OP", "F", "Y")]
    out = dims.dim_scd2(_daily(spark, recs), partitions=3)
    got = rows(out, "well_name", "well_type", "facility_name", "effective_start_date", "effective_end_date", "is_current")
    assert got == nsort([
        ("A", "OP", "X", D(2020, 1, 1), D(2020, 1, 3), True),
        ("B", "OP", "X", D(2020, 1, 1), D(2020, 1, 1), False),
        ("B", "WI", "X", D(2020, 1, 2), D(2020, 1, 2), False),
        ("B", "OP", "X", D(2020, 1, 5), D(2020, 1, 5), True),
        ("C", "OP", "X", D(2020, 1, 1), D(2020, 1, 1), False),
        ("C", None, "X", D(2020, 1, 2), D(2020, 1, 2), False),
        ("C", "OP", "X", D(2020, 1, 3), D(2020, 1, 3), True),
        ("E", "OP", "X", D(2020, 1, 1), D(2020, 1, 1), False),
        ("E", "OP", "Y", D(2020, 1, 2), D(2020, 1, 2), True),
    ])
    keys = [r.well_surrogate_key for r in out.orderBy("well_surrogate_key").collect()]
    assert keys == list(range(1, len(keys) + 1))
    # exactly one current version per well
    assert out.groupBy("well_name").agg(F.count_if("is_current").alias("c")).where("c != 1").count() == 0
    # surrogate keys follow (well, start)
    ordered = [r.well_name for r in out.orderBy("well_surrogate_key").collect()]
    assert ordered == sorted(ordered)


def test_scd1_latest_and_multi_type(spark):
    recs = [("B", D(2020, 1, 1), "OP", "F", "X"), ("B", D(2020, 1, 2), "WI", "G", "Y"), ("A", D(2020, 1, 1), "OP", "F", "X")]
    d = _daily(spark, recs)
    scd1 = {r.well_name: (r.well_type, r.field_name, r.first_producing_date, r.last_producing_date)
            for r in dims.dim_scd1(d).collect()}
    assert scd1 == {"B": ("WI", "G", D(2020, 1, 1), D(2020, 1, 2)), "A": ("OP", "F", D(2020, 1, 1), D(2020, 1, 1))}
    multi = rows(dims.dim_multi_type(d), "well_name", "well_type")
    assert multi == [("B", "OP"), ("B", "WI")]


def test_latest_value_may_be_null(spark):
    recs = [("A", D(2020, 1, 1), "OP", "F", "X"), ("A", D(2020, 1, 2), "OP", None, "X")]
    r = dims.dim_latest(_daily(spark, recs)).first()
    assert r.field_name is None  # MAX_BY keeps the latest value even when NULL


def test_calendar(spark):
    d = _daily(spark, [("A", D(2019, 12, 30), "OP", "F", "X"), ("A", D(2020, 3, 1), "OP", "F", "X")])
    cal = dims.calendar(d)
    assert cal.count() == 63
    r = cal.where(F.col("calendar_date") == D(2020, 2, 29)).first()
    assert (r.year, r.month, r.quarter, r.month_start) == (2020, 2, 1, D(2020, 2, 1))
