"""Keyed appends: one shuffle, one sort, and no write that moves rows again."""

import datetime as dt
import os

from pyspark.sql import functions as F

from boreflow.sources import sinks

from tests.conftest import rows

SCHEMA = "k string, d date, m date, v int, s string"


def day(n):
    return dt.date(2020, 1 + n // 28, 1 + n % 28)


def frame(spark, items):
    return spark.createDataFrame([(k, d and day(d), d and day(d).replace(day=1), v, s) for k, d, v, s in items], SCHEMA)


FIRST = [("a", 1, 1, None), ("a", 40, 2, "x"), (None, 2, 3, "y"), ("b", 1, None, None), ("n", None, 7, "z")]


def test_new_and_restated_rows(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    assert sinks.append_new(frame(spark, FIRST + FIRST[:1]), path, ["k", "d"], ["m"], follows=True).count() == 0
    again = [*FIRST[1:], ("a", 1, 9, None), ("c", 41, 1, "q"), ("c", 41, 2, "q"), ("b", 1, None, "now"), ("a", 1, 9, None), ("n", None, 8, "z")]
    for follows in (True, False):
        found = sinks.append_new(frame(spark, again), path, ["k", "d"], ["m"], follows=follows)
        want = [("a", 1, 9, None), ("b", 1, None, "now"), ("c", 41, 2, "q"), ("n", None, 8, "z")]
        assert rows(found) == rows(frame(spark, want))
        assert rows(spark.read.parquet(path).select("k", "d", "m", "v", "s")) == rows(frame(spark, [*FIRST, ("c", 41, 1, "q")]))


def test_batch_is_settled_by_one_shuffle(spark, tmpdir_path, monkeypatch):
    plans = []
    monkeypatch.setattr(sinks, "TASK_ROWS", 10)
    big = spark.range(200).select(
        F.concat(F.lit("w"), F.col("id") % 20).alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 20).cast("int")).alias("d"), F.col("id").alias("v")
    ).withColumn("m", F.trunc("d", "month"))
    path = os.path.join(tmpdir_path, "t")
    real = sinks._spread
    monkeypatch.setattr(sinks, "_spread", lambda df, by: plans.append(by) or real(df, by))
    sinks.append_new(big.where("v < 150"), path, ["k", "d"], ["m"], follows=True)
    found = sinks.append_new(big.withColumn("v", F.when(F.col("v") == 3, -3).otherwise(F.col("v"))), path, ["k", "d"], ["m"], follows=True)
    assert plans == []
    assert [r.v for r in found.collect()] == [-3]
    assert rows(spark.read.parquet(path), "k", "d", "v") == rows(big, "k", "d", "v")
    # the same batch again: checksums agree, so no row is shuffled and nothing is staged
    before = sorted(os.listdir(path))
    assert sinks.append_new(big, path, ["k", "d"], ["m"], follows=True).count() == 0
    assert sorted(os.listdir(path)) == before and spark.read.parquet(path).count() == 200
