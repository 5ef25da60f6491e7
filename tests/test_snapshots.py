"""SNK-1…3: versions, failed writers, corrections and their signed changes."""

import os

import pytest
from pyspark.sql import functions as F

from boreflow.sources.snapshots import SnapshotTable
from tests.conftest import rows

SCHEMA = "k string, d int, v string, p string"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


A = [("a", 1, "x", "p1"), ("a", 2, "y", "p2"), (None, 1, "z", "p1"), ("b", 1, None, None)]


def test_versions_append_and_replace(spark, tmpdir_path):
    t = SnapshotTable(spark, os.path.join(tmpdir_path, "t"), ["p"])
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.append(frame(spark, A)) == 0
    assert t.append(frame(spark, [("c", 1, "w", "p/ 3")])) == 1
    assert t.replace(frame(spark, A[:1])) == 2
    assert rows(t.read(0)) == rows(frame(spark, A))
    assert rows(t.read(1)) == rows(frame(spark, [*A, ("c", 1, "w", "p/ 3")]))
    assert rows(t.read()) == A[:1] and t.versions() == [0, 1, 2]
    t.replace_partitions(frame(spark, [("n", 9, "n", "p/ 3")]), [("p/ 3",), (None,)], base=1)
    assert rows(t.read()) == rows(frame(spark, [*A[:3], ("n", 9, "n", "p/ 3")]))
    t.replace(frame(spark, []))
    assert t.read().count() == 0 and t.read().columns == ["k", "d", "v", "p"]


def test_failed_writer_leaves_the_old_version(spark, tmpdir_path):
    t = SnapshotTable(spark, os.path.join(tmpdir_path, "t"))
    t.replace(frame(spark, A))
    fails = frame(spark, A).repartition(4).withColumn("v", F.when(F.col("d") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        t.replace(fails.select("k", "d", F.col("v").cast("string").alias("v"), "p"))
    assert t.versions() == [0] and rows(t.read()) == rows(frame(spark, A))
    t.replace(frame(spark, A[:1]))
    assert rows(t.read()) == A[:1] and rows(t.read(0)) == rows(frame(spark, A))


def test_second_writer_of_a_version_fails(spark, tmpdir_path):
    t = SnapshotTable(spark, os.path.join(tmpdir_path, "t"))
    t.replace(frame(spark, A))
    with pytest.raises(RuntimeError, match="another writer"):
        t._commit(0, frame(spark, A).schema, [])
    assert rows(t.read()) == rows(frame(spark, A))


def test_expire_keeps_the_last_versions(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "t")
    t = SnapshotTable(spark, root, ["p"])
    t.append(frame(spark, A))
    t.append(frame(spark, [("c", 1, "w", "p1")]))
    t.replace(frame(spark, A[:2]))
    t.upsert(frame(spark, [("a", 1, "new", "p1")]), ["k", "d"])
    t.expire(2)
    assert t.versions() == [2, 3]
    assert rows(t.read(2)) == A[:2] and rows(t.read()) == rows(frame(spark, [("a", 1, "new", "p1"), A[1]]))
    assert os.listdir(f"{root}/data/origin=added") == [] and len(os.listdir(f"{root}/data/origin=rewritten")) == 2


def test_upsert_and_changes(spark, tmpdir_path):
    t = SnapshotTable(spark, os.path.join(tmpdir_path, "t"), ["p"])
    t.append(frame(spark, A))
    before = t.manifest(0)["folders"]
    restated = [(None, 1, "new", "p1"), (None, 1, "new", "p1"), ("a", 1, "x", "p1"), ("b", 1, "now", None), ("n", 1, "add", "p1")]
    assert t.upsert(frame(spark, restated), ["k", "d"]) == 1
    want = [("a", 1, "x", "p1"), ("a", 2, "y", "p2"), (None, 1, "new", "p1"), ("b", 1, "now", None), ("n", 1, "add", "p1")]
    assert rows(t.read()) == rows(frame(spark, want))
    # only the partitions with a change are rewritten
    assert [f for f in t.manifest(1)["folders"] if f in before] == [f for f in before if f.endswith("p=p2")]
    assert rows(t.changes(0, 1)) == rows(spark.createDataFrame(
        [(None, 1, "z", "p1", -1), (None, 1, "new", "p1", 1), ("b", 1, None, None, -1), ("b", 1, "now", None, 1), ("n", 1, "add", "p1", 1)],
        SCHEMA + ", _sign int"))
    assert t.upsert(frame(spark, want), ["k", "d"]) is None and t.latest() == 1
    with pytest.raises(ValueError, match="two different rows"):
        t.upsert(frame(spark, [("a", 1, "x", "p1"), ("a", 1, "y", "p1")]), ["k", "d"])
    # appended rows are no correction; several versions can be spanned
    t.append(frame(spark, [("q", 1, "q", "p2")]))
    assert t.changes(1, 2).count() == 0
    t.upsert(frame(spark, [("a", 1, "x2", "p1")]), ["k", "d"])
    assert t.changes(0, 3).where("k = 'a'").count() == 2


def test_upsert_reads_touched_partitions_only(spark, tmpdir_path):
    t = SnapshotTable(spark, os.path.join(tmpdir_path, "t"), ["p"])
    t.append(frame(spark, A))
    plan = t._touched(frame(spark, [("a", 2, "n", "p2")]))._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "p2" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_append_new(spark, tmpdir_path):
    t = SnapshotTable(spark, os.path.join(tmpdir_path, "t"), ["p"])
    assert t.append_new(frame(spark, [*A, A[0]]), ["k", "d"]) is None
    restated = t.append_new(frame(spark, [("a", 1, "other", "p1"), A[1], ("z", 5, "z", "p9")]), ["k", "d"])
    assert rows(restated) == [("a", 1, "other", "p1")]
    assert rows(t.read()) == rows(frame(spark, [*A, ("z", 5, "z", "p9")]))
    assert t.append_new(frame(spark, A), ["k", "d"]).count() == 0 and t.latest() == 1
