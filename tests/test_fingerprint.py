"""DQ-9: fingerprints find every range that differs, and only its rows are compared."""

import os
import random

from pyspark.sql import functions as F

from boreflow.operators.fingerprint import differing, fingerprints, load_diff
from tests.conftest import rows

SCHEMA = "p string, k int, v string, w double"


def test_lost_changed_repeated_and_null_rows(spark):
    rng = random.Random(5)
    left = [(rng.choice(["a", "b", "c", None]), k, rng.choice(["x", None, ""]), float(k)) for k in range(300)]
    right = left[3:] + [left[10], left[10], ("new", 900, "n", None)]
    right[20] = (*right[20][:2], "changed", right[20][3])
    right[40] = (right[40][0], right[40][1], None if right[40][2] is not None else "x", None)
    a, b = spark.createDataFrame(left, SCHEMA).repartition(3), spark.createDataFrame(right, SCHEMA).repartition(5)
    got = rows(load_diff(a, b, ["p"], ["k"], 7))
    want = []
    for r in {*left, *right}:
        n = left.count(r) - right.count(r)
        if n:
            want.append((*r, "left" if n > 0 else "right", abs(n)))
    assert got == rows(spark.createDataFrame(want, SCHEMA + ", side string, n bigint"))
    assert load_diff(a, a.repartition(2), ["p"], ["k"], 7).count() == 0
    empty = a.limit(0)
    assert load_diff(empty, empty, ["p"], ["k"]).count() == 0 and load_diff(a, empty, ["p"], ["k"]).agg(F.sum("n")).first()[0] == 300


def test_swapped_nulls_and_pairs_are_seen(spark):
    a = spark.createDataFrame([("a", 1, None, 1.0), ("a", 2, "x", 1.0), ("a", 2, "x", 1.0)], SCHEMA)
    b = spark.createDataFrame([("a", 1, "x", None), ("a", 2, "x", 1.0)], SCHEMA)
    # XOR alone would miss a pair of equal rows
    assert differing(fingerprints(a, ["p"], ["k"], 1), fingerprints(b, ["p"], ["k"], 1), ["p"]).count() == 1
    assert rows(load_diff(a, b, ["p"], ["k"], 1), "k", "side", "n") == [(1, "left", 1), (1, "right", 1), (2, "left", 1)]


def test_stored_fingerprints_and_pruned_scans(spark, tmpdir_path):
    data = [(p, k, "x", 1.0) for p in "abcd" for k in range(50)]
    for name, frame in (("l", data), ("r", [r for r in data if r[:2] != ("c", 7)])):
        spark.createDataFrame(frame, SCHEMA).write.partitionBy("p").parquet(os.path.join(tmpdir_path, name))
    left, right = (spark.read.parquet(os.path.join(tmpdir_path, n)) for n in "lr")
    stored = [fingerprints(x, ["p"], ["k"], 4) for x in (left, right)]
    for n, x in zip("lr", stored):
        x.write.parquet(os.path.join(tmpdir_path, f"prints_{n}"))
    prints = [spark.read.parquet(os.path.join(tmpdir_path, f"prints_{n}")) for n in "lr"]
    out = load_diff(left, right, ["p"], ["k"], 4, *prints)
    assert rows(out, "p", "k", "side", "n") == [("c", 7, "left", 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    filters = [x.split("PushedFilters")[0] for x in plan.split("PartitionFilters")[1:]]
    assert filters and all("c" in f and "(p#" in f for f in filters)
