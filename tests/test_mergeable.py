"""Month summaries merge to the same results as the whole tables."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from boreflow.operators import dims, gold, mergeable
from boreflow.operators.fact import build_fact
from boreflow.operators.timeseries import fill_series, islands
from boreflow.plans.present import present
from boreflow.sources.snapshots import SnapshotTable
from boreflow.streaming import GoldRefresh, land_silver
from tests.conftest import rows
from tests.test_refresh import _rows, _series

START = date(2020, 1, 1)


def days(spark, data):
    return spark.createDataFrame([(w, START + timedelta(d)) for w, d in data], "well_name string, prod_date date")


def random_days(rng, wells=("a", "b", None)):
    """Long runs over several months, runs that end on borders, single days."""
    out = set()
    for w in wells:
        d = 0
        while d < 400:
            n = rng.choice([1, 2, 5, 31, 60, 95])
            out |= {(w, x) for x in range(d, d + n)}
            d += n + rng.choice([1, 2, 29, 31])
        out |= {(w, x) for x in range(30, 61) if rng.random() < 0.5}
    return sorted(out, key=str)


def test_month_runs_and_events(spark):
    rng = random.Random(4)
    for _ in range(3):
        data = random_days(rng)
        frame = days(spark, data)
        want = rows(islands(frame, entity="well_name", date="prod_date", start="event_start", end="event_end"),
                    "well_name", "event_start", "event_end", "duration_days")
        got = mergeable.run_events(mergeable.month_runs(frame.union(frame.limit(3))))
        assert rows(got, "well_name", "event_start", "event_end", "duration_days") == want


def test_merge_runs_is_associative(spark):
    rng = random.Random(7)
    data = [(w, START + timedelta(a), START + timedelta(a + rng.randrange(9))) for w in ("a", None) for a in rng.sample(range(200), 40)]
    frame = spark.createDataFrame(data, "well_name string, run_start date, run_end date").repartition(4)
    whole = rows(mergeable.merge_runs(frame))
    for k in (2, 3):
        parts = [frame.where(F.pmod(F.hash("run_start"), F.lit(k)) == i) for i in range(k)]
        merged = mergeable.merge_runs(parts[0])
        for p in parts[1:]:
            merged = mergeable.merge_runs(merged.unionByName(mergeable.merge_runs(p)))
        assert rows(merged) == whole


def test_month_versions_equal_the_whole_table(spark):
    rng = random.Random(9)
    data = []
    for w in ("a", "b", None):
        t, f = "OP", "f1"
        for d in range(0, 500):
            if rng.random() < 0.7:
                t = rng.choice(["OP", "OP", "WI", None]) if rng.random() < 0.08 else t
                f = rng.choice(["f1", "f2", None]) if rng.random() < 0.03 else f
                data.append((w, START + timedelta(d), t, f, "p"))
    frame = spark.createDataFrame(data, "well_name string, prod_date date, well_type string, field_name string, facility_name string").repartition(4)
    cols = ["well_name", "well_type", "field_name", "facility_name", "effective_start_date", "effective_end_date", "is_current"]
    got = mergeable.merge_versions(mergeable.month_versions(frame))
    assert rows(got, *cols) == rows(dims.dim_scd2(frame), *cols)


def _typed_days(spark, wells=("a", "b", None)):
    rng = random.Random(11)
    data = [(w, START + timedelta(d), rng.choice(["OP", "WI", None]), rng.choice(["f1", None]), "p")
            for w in wells for d in range(0, 120 if w else 25, 3) if rng.random() < 0.8]
    return spark.createDataFrame(data, "well_name string, prod_date date, well_type string, field_name string, facility_name string")


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange")


def test_versions_of_touched_wells_take_one_shuffle(spark):
    days = _typed_days(spark)
    summary = mergeable.month_versions(days).checkpoint()
    last = max(r.month_start for r in summary.collect())  # the well without a name has no row in it
    got = mergeable.merge_versions(summary, touched=[last])
    whole = mergeable.merge_versions(summary)
    assert rows(got) == rows(whole.where("well_name IS NOT NULL")) and rows(whole) != rows(got)
    assert _exchanges(got) == 1
    keyed = mergeable.keep_keys(got, mergeable.keep_keys(whole, None, 0), 1000)
    assert keyed.columns == ["well_surrogate_key", *got.columns] and rows(keyed.drop("well_surrogate_key")) == rows(got)
    assert keyed.where("well_surrogate_key > 1000").isEmpty()


def test_summaries_laid_out_by_month_are_not_moved_again(spark, monkeypatch, tmpdir_path):
    from boreflow.sources import sinks

    days = _typed_days(spark).withColumn("month_start", F.trunc("prod_date", "month"))
    monkeypatch.setattr(sinks, "TASK_ROWS", 10)
    got = mergeable.month_versions(days, laid=lambda x: sinks.by_slot(x, ["month_start"], ["well_name"], 90, 30), layout=[sinks.SLOT])
    assert _exchanges(got) == 1
    sinks.write_partitions(got, f"{tmpdir_path}/v", ["month_start"])
    want = mergeable.month_versions(days)
    assert rows(spark.read.schema(want.schema).parquet(f"{tmpdir_path}/v").select(*want.columns)) == rows(want)


def version(w, a, b, t="OP", n=1, f="f"):
    return (w, t, f, "p", n, START + timedelta(a), START + timedelta(b), False)


VERSIONS = "well_name string, well_type string, field_name string, facility_name string, version bigint, effective_start_date date, effective_end_date date, is_current boolean"


def test_keys_of_untouched_split_and_joined_versions(spark):
    frame = lambda data: spark.createDataFrame(data, VERSIONS)
    first = mergeable.keep_keys(frame([version("a", 0, 99), version("b", 0, 9), version("b", 20, 29, n=2), version(None, 0, 5)]), None, 0)
    keys = {(r.well_name, r.effective_start_date): r.well_surrogate_key for r in first.collect()}
    assert sorted(keys.values()) == [1, 2, 3, 4]
    # a is split by a late month, b is joined, the well without a name grows at its start
    new = frame([version("a", 0, 40), version("a", 41, 50, "WI", 2), version("a", 51, 99, n=3), version("b", 0, 29), version(None, -7, 5)])
    second = {(r.well_name, r.effective_start_date): r.well_surrogate_key for r in mergeable.keep_keys(new, first, 4).collect()}
    at = lambda d: START + timedelta(d)
    assert second[("a", at(0))] == keys[("a", at(0))] and second[("b", at(0))] == keys[("b", at(0))]
    assert second[(None, at(-7))] == keys[(None, at(0))]
    assert sorted([second[("a", at(41))], second[("a", at(51))]]) == [5, 6]


def test_versions_of_other_entities_are_copied_with_their_keys(spark, monkeypatch):
    frame = lambda data: spark.createDataFrame(data, VERSIONS)
    data = [version("a", 0, 9), version("a", 10, 19, "WI", 2), version("b", 0, 9), version(None, 0, 5), version(None, 6, 9, None, 2), version("c", 3, 4, f=None)]
    old = mergeable.keep_keys(frame(data), None, 0).checkpoint()
    # a's first version is split, its second gone; c moves before its start; the others have no new version
    new = frame([version("a", 0, 4), version("a", 5, 6, "WI", 2), version("a", 7, 9, n=3), version("a", 10, 12, None, 4), version("c", 1, 3, f=None)])
    alone = mergeable.keep_keys(new, old, 6)
    monkeypatch.setattr(type(old), "join", lambda *a, **k: pytest.fail("versions and keys meet without a join"))
    known = []
    monkeypatch.setattr(mergeable, "global_row_number", lambda df, order, out: known.append(df.count()) or df.withColumn(out, F.lit(1)))
    both = mergeable.keep_keys(new, old, 6, copied=True)
    assert known == [3]
    monkeypatch.undo()
    both = mergeable.keep_keys(new, old, 6, copied=True)
    assert both.columns == old.columns and both.schema == old.schema
    assert rows(both) == rows(alone.unionByName(old.where("well_name = 'b' OR well_name IS NULL")))
    was = {(r.well_name, r.effective_start_date): r.well_surrogate_key for r in old.collect()}
    now = {(r.well_name, r.effective_start_date): r.well_surrogate_key for r in both.collect()}
    at = lambda d: START + timedelta(d)
    assert now[("a", at(0))] == was[("a", at(0))] and now[("c", at(1))] == was[("c", at(3))]
    assert [now[("a", at(d))] for d in (5, 7, 10)] == [7, 8, 9]
    # an earlier table without rows, and no new version at all
    assert rows(mergeable.keep_keys(new, old.limit(0), 6, copied=True).drop("well_surrogate_key")) == rows(new)
    assert rows(mergeable.keep_keys(new.limit(0), old, 6, copied=True)) == rows(old)


def test_current_version_with_two_attributes(spark):
    """The last version has two rows if an attribute changes inside it: the greater one is current."""
    data = [("a", START + timedelta(d), "OP", f, "p") for d, f in ((0, "z"), (40, "x"), (41, "y"), (80, "x"))]
    data += [("b", START, "OP", "x", "p"), ("b", START + timedelta(40), None, None, "p"), ("b", START + timedelta(40), None, "x", None)]
    frame = spark.createDataFrame(data, "well_name string, prod_date date, well_type string, field_name string, facility_name string")
    got = mergeable.merge_versions(mergeable.month_versions(frame))
    cols = ["well_name", "well_type", "field_name", "facility_name", "effective_start_date", "effective_end_date", "is_current"]
    assert rows(got, *cols) == rows(dims.dim_scd2(frame), *cols)
    assert got.where("is_current").count() == 2


def test_signed_sums_take_out_what_they_put_in(spark):
    schema = "k string, oil decimal(18,5), is_shutin boolean"
    from decimal import Decimal as D

    old = spark.createDataFrame([("a", D("1.5"), True), ("a", None, False), ("b", D("2"), True)], schema)
    new = spark.createDataFrame([("a", D("4"), False), ("c", None, True)], schema)
    sums = {"oil": "oil"}
    stored = mergeable.signed_sums(old, ["k"], sums)
    delta = mergeable.signed_sums(old.withColumn("_sign", F.lit(-1)).unionByName(new.withColumn("_sign", F.lit(1))), ["k"], sums)
    merged = mergeable.merge_sums(stored.unionByName(delta), ["k"])
    assert merged.schema == stored.schema or [f.dataType for f in merged.schema] == [f.dataType for f in stored.schema]
    got = rows(merged.select("k", "n_rows", "n_flag", mergeable.total("oil").alias("oil")))
    assert got == [("a", 1, 0, D("4.00000")), ("c", 1, 1, None)]


def test_refreshed_months_only(spark, tmpdir_path, monkeypatch):
    """A late month: the downtime summary is made from its shut-in rows only."""
    price, fx = _series(spark, [("2020-01-01", 50)], [("2020-01-01", 9)])
    table = SnapshotTable(spark, os.path.join(tmpdir_path, "s"), ["month_start"])
    data = [("A", (START + timedelta(d)).isoformat(), "OP", 0 if 20 < d < 70 else 5) for d in range(120)]
    late = [r for r in data if r[1][:7] == "2020-02"]
    land_silver(_rows(spark, [r for r in data if r not in late]), table)
    r = GoldRefresh(spark, table, os.path.join(tmpdir_path, "g"), os.path.join(tmpdir_path, "c"), price, fx)
    r.run()
    events = lambda: rows(spark.read.parquet(r.path("downtime_events")), "event_start", "event_end", "duration_days")
    assert [e[2] for e in events()] == [10, 10]
    plans, real = [], mergeable.month_runs
    monkeypatch.setattr(mergeable, "month_runs", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()
                                                                            + df._jdf.queryExecution().executedPlan().toString()) or real(df, *a))
    land_silver(_rows(spark, late), table)
    r.run()
    assert [e[2] for e in events()] == [49]
    scan = plans[0].split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "2020-02-01" in scan or "18293" in scan, scan
    assert "2020-03-01" not in scan and "2020-01-01" not in scan


def test_dimensions_read_the_summaries_once(spark, tmpdir_path, monkeypatch):
    import boreflow.streaming.refresh as module

    price, fx = _series(spark, [("2020-01-01", 50)], [("2020-01-01", 9)])
    table = SnapshotTable(spark, os.path.join(tmpdir_path, "s"), ["month_start"])
    land_silver(_rows(spark, [(w, (START + timedelta(d)).isoformat(), "OP", 5) for w in ("A", None) for d in (0, 40, 41)]), table)
    r = GoldRefresh(spark, table, os.path.join(tmpdir_path, "g"), os.path.join(tmpdir_path, "c"), price, fx)
    read, real = {}, module.write_replace
    monkeypatch.setattr(module, "write_replace", lambda df, path, *a: read.setdefault(path.split("/")[-1], df.inputFiles()) and False or real(df, path, *a))
    r.run()
    assert [n for n, files in read.items() if any("well_month_versions" in f for f in files) and n.startswith("dim")] == ["dim_well_scd1"]
    silver = table.read().drop("month_start")
    for name, want in (("dim_well", dims.dim_latest(silver)), ("dim_well_scd1", dims.dim_scd1(silver)), ("dim_date", dims.calendar(silver))):
        assert rows(spark.read.parquet(r.path(name)).select(*want.columns)) == rows(want), name


def full(spark, r, table):
    silver = table.read().drop("month_start")
    spine = silver.select(F.col("prod_date").alias("cal_date"))
    filled = fill_series(spine, r.price, date="cal_date", value="brent_usd_bbl", series_date="price_date", out="brent_usd_bbl_filled")
    return silver, build_fact(silver, filled, r.fx)


def check(spark, r, table):
    silver, fact = full(spark, r, table)
    g = lambda n: spark.read.parquet(r.path(n))
    for name, want in (
        ("fact", fact), ("decline_trend", gold.decline_trend(fact)), ("water_cut_trend", gold.water_cut_trend(fact)),
        ("downtime_events", gold.downtime_events(fact)), ("value_ranking", gold.value_ranking(fact)),
        ("dim_well_scd1", dims.dim_scd1(silver)), ("revenue_decomposition", gold.revenue_decomposition(fact)),
    ):
        # prices are doubles here, so sums of sums are compared as presented
        assert rows(present(g(name).select(*want.columns))) == rows(present(want)), name
    want = dims.dim_scd2(silver)
    cols = [c for c in want.columns if c != "well_surrogate_key"]
    assert rows(r.scd2(), *cols) == rows(want, *cols)
    keys = [x.well_surrogate_key for x in r.scd2().collect()]
    assert len(keys) == len(set(keys))
    return {(x.well_name, x.well_type, x.effective_start_date): x.well_surrogate_key for x in r.scd2().collect()}


def test_corrections_late_months_and_failures(spark, tmpdir_path, monkeypatch):
    price, fx = _series(spark, [("2020-01-01", 50), ("2020-02-10", 60)], [("2020-01-05", 9), ("2020-02-03", 8)])
    table = SnapshotTable(spark, os.path.join(tmpdir_path, "s"), ["month_start"])
    day = lambda d: (START + timedelta(d)).isoformat()
    data = [(w, day(d), "OP", 0 if d % 13 < 4 else 5 + d) for w in ("A", "B", None) for d in range(0, 75, {"A": 1, "B": 3, None: 4}[w])]
    late = [(w, d, "WI" if w == "A" else t, o) for w, d, t, o in data if d[:7] == "2020-02"]
    land_silver(_rows(spark, [r for r in data if r[1][:7] != "2020-02"]), table)
    r = GoldRefresh(spark, table, os.path.join(tmpdir_path, "g"), os.path.join(tmpdir_path, "c"), price, fx)
    r.run()
    first = {(x.well_name, x.well_type, x.effective_start_date): x.well_surrogate_key for x in r.scd2().collect()}
    land_silver(_rows(spark, late), table)           # splits a version of A
    r.run()
    second = check(spark, r, table)
    assert first and all(second[k] == v for k, v in first.items())

    # restated volumes, a type that changes (its fact row goes), a repeated and an unchanged row
    restated = [("A", day(3), "OP", 777), ("A", day(3), "OP", 777), ("B", day(30), "WI", 0), (None, day(36), "OP", 0), data[0]]
    aggregated = []
    real = mergeable.signed_sums
    monkeypatch.setattr(mergeable, "signed_sums", lambda df, *a, **k: aggregated.append(df.count()) or real(df, *a, **k))
    assert r.restate(_rows(spark, restated)) is not None
    monkeypatch.undo()
    assert aggregated == [5]                          # two rows out and in, one out only
    check(spark, r, table)
    assert r.restate(_rows(spark, restated)) is None

    # the gold side fails after the sums were written; the repetition starts from the same sums
    import boreflow.streaming.refresh as module

    write, state = module.write_partitions, {"failed": False}

    def flaky(df, path, parts):
        write(df, path, parts)
        if path.endswith("/decline_trend") and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("executor lost")

    monkeypatch.setattr(module, "write_partitions", flaky)
    with pytest.raises(RuntimeError, match="executor lost"):
        r.restate(_rows(spark, [("A", day(4), "OP", 1000)]))
    r.apply_corrections()
    check(spark, r, table)
    # a date that is new to the calendar comes by a correction
    r.restate(_rows(spark, [("B", day(150), "OP", 9), ("A", day(4), "OP", 1)]))
    check(spark, r, table)
    # corrections and new rows before one ordinary refresh
    table.upsert(_rows(spark, [("A", day(5), "OP", 31)]).withColumn("month_start", F.trunc("prod_date", "month")), ["well_name", "prod_date"])
    land_silver(_rows(spark, [("C", day(6), "OP", 3)]), table)
    r.run()
    check(spark, r, table)
