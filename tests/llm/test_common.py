"""Stored intermediates: kept results stay, temporary ones go."""

import os

import pytest

from boreflow.llm import common


def folders(spark, df):
    return df.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]


def test_temporary_results_are_deleted(spark):
    outer = common.store(spark.range(3), "outer")
    with common.temporary(spark):
        inner = folders(spark, common.store(spark.range(4), "inner"))
        with common.temporary(spark):
            nested = folders(spark, common.store(spark.range(4), "nested"))
            kept = common.store(spark.range(5), "kept", keep=True)
        assert not os.path.exists(nested) and os.path.exists(inner) and kept.count() == 5
        result = common.store(spark.range(6), "result", keep=True)
    assert not os.path.exists(inner) and not os.path.exists(folders(spark, kept))
    assert result.count() == 6 and outer.count() == 3


def test_temporary_results_are_deleted_after_an_error(spark):
    with pytest.raises(ValueError):
        with common.temporary(spark):
            inner = folders(spark, common.store(spark.range(4), "inner"))
            raise ValueError
    assert not os.path.exists(inner) and common._TEMPORARY == []


def test_shuffle_files_of_a_stored_result_are_deleted(spark):
    common.prepare_workers(spark)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    found = common.store(spark.range(1000).repartition(7, "id"), "again")
    # a frame that is used twice shuffles again
    counts = found.groupBy("id").count()
    assert counts.count() == 1000 and counts.agg({"count": "max"}).first()[0] == 1
