"""SRC-4: every version of a file is loaded once."""

import os
import time

import pytest
from pyspark.sql import functions as F

from boreflow.sources.files import split_rejects
from boreflow.sources.ledger import LoadLedger
from tests.conftest import rows

COLUMNS = ["a", "b"]


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(["a,b", *lines, ""]))


def state(ledger):
    return sorted((os.path.basename(r.file_path), r.rows_loaded, r.rows_rejected, r.status) for r in ledger.entries().collect())


def test_loads_once_and_changed_files_again(spark, tmpdir_path):
    source = os.path.join(tmpdir_path, "in")
    ledger = LoadLedger(spark, os.path.join(tmpdir_path, "out"), COLUMNS)
    assert ledger.entries().count() == 0
    write(source, "one 1+%.csv", ["1,x", "2,NULL", "short"])
    write(os.path.join(source, "sub"), "two.csv", ["3,z"])
    write(source, "empty.csv", [])
    assert ledger.load(source) is not None
    assert state(ledger) == [("empty.csv", 0, 0, "loaded"), ("one 1+%.csv", 2, 1, "loaded"), ("two.csv", 1, 0, "loaded")]
    assert ledger.load(source) is None and ledger.entries().count() == 3

    start = spark.range(1).select(F.current_timestamp()).first()[0]
    time.sleep(1.1)
    write(os.path.join(source, "sub"), "two.csv", ["3,z", "4,new"])
    write(source, "three.csv", ["5,q"])
    assert ledger.load(source) is not None
    assert state(ledger)[-2:] == [("two.csv", 1, 0, "superseded"), ("two.csv", 2, 0, "loaded")]
    good, bad = split_rejects(ledger.current(), COLUMNS)
    assert rows(good, "a", "b") == [("1", "x"), ("2", None), ("3", "z"), ("4", "new"), ("5", "q")]
    assert rows(bad, "raw_line") == [("short",)]
    recent = ledger.history(F.lit(start)).collect()
    assert [os.path.basename(r.file_path) for r in recent] == ["two.csv", "three.csv"] or len(recent) == 2
    assert ledger.history(n=1).count() == 1
    assert ledger.history(F.current_timestamp() - F.expr("INTERVAL 1 HOUR")).count() == 5


def test_load_that_dies_before_the_ledger(spark, tmpdir_path, monkeypatch):
    source = os.path.join(tmpdir_path, "in")
    ledger = LoadLedger(spark, os.path.join(tmpdir_path, "out"), COLUMNS)
    write(source, "one.csv", ["1,x"])

    def lost(df):
        raise RuntimeError("lost")

    monkeypatch.setattr(ledger.ledger, "append", lost)
    with pytest.raises(RuntimeError, match="lost"):
        ledger.load(source)
    monkeypatch.undo()
    assert ledger.current().count() == 0 and ledger.bronze.read().count() == 1
    ledger.load(source)
    assert rows(ledger.current(), "a") == [("1",)] and ledger.bronze.read().count() == 2


def test_stream_and_load_share_the_ledger(spark, tmpdir_path):
    source, checkpoint = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "c")
    ledger = LoadLedger(spark, os.path.join(tmpdir_path, "out"), COLUMNS)
    write(source, "one.csv", ["1,x", "bad"])
    ledger.stream(source, checkpoint)
    assert state(ledger) == [("one.csv", 1, 1, "loaded")]
    write(source, "two.csv", ["2,y"])
    ledger.load(source)
    ledger.stream(source, checkpoint)  # sees two.csv, which is in the ledger
    assert state(ledger) == [("one.csv", 1, 1, "loaded"), ("two.csv", 1, 0, "loaded")]
    time.sleep(1.1)
    write(source, "one.csv", ["1,x"])
    ledger.load(source)
    assert state(ledger)[:2] == [("one.csv", 1, 0, "loaded"), ("one.csv", 1, 1, "superseded")]
    assert rows(ledger.current(), "a", "_corrupt_record") == [("1", None), ("2", None)]
