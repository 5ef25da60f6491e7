import json
import os

from pyspark.sql import functions as F

from boreflow.operators import quality, silver
from boreflow.sources import files, payloads

HEADER = ",".join(silver.RAW_DAILY)


def _line(**kv):
    vals = {c: "" for c in silver.RAW_DAILY}
    vals.update(kv)
    return ",".join(vals[c] for c in silver.RAW_DAILY)


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def daily_csv(folder):
    base = dict(npd_well_bore_name="W1", npd_facility_name="F", well_type="OP", on_stream_hrs="24",
                bore_oil_vol="10.5", bore_gas_vol="100", bore_wat_vol="1")
    lines = [
        HEADER,
        _line(dateprd="2007-09-01", **base),                                        # clean
        _line(**{**base, "dateprd": "2007-09-02", "bore_oil_vol": "NULL", "bore_gas_vol": "NaN",
                 "bore_wat_vol": ""}),                                               # null tokens
        _line(**{**base, "dateprd": "2007-09-03", "npd_facility_name": '"Main, North"'}),  # quoted comma
        "2007-09-04,only,three",                                                     # short row
        _line(**{**base, "dateprd": "2007-09-05"}) + ",extra",                       # long row
        _line(**{**base, "dateprd": "not-a-date"}),                                  # bad date
        _line(**{**base, "dateprd": "06-09-07"}),                                    # dd-MM-yy
        _line(**{**base, "dateprd": "2007-09-07", "bore_oil_vol": "12,5x".replace(",", "")}),  # uncastable
        _line(**{**base, "dateprd": "2007-09-08", "bore_oil_vol": "-4"}),            # negative
        _line(**{**base, "dateprd": "2007-09-09", "well_type": " OP", "on_stream_hrs": "0",
                 "bore_oil_vol": "0", "bore_gas_vol": "0", "bore_wat_vol": "0"}),    # leading blank type, shut in
        _line(**{**base, "dateprd": "2007-09-10", "npd_facility_name": "\u00c3\u0086sgard"}),  # mis-decoded UTF-8
    ]
    return _write(os.path.join(folder, "daily.csv"), "\n".join(lines) + "\n")


def test_csv_rejects_and_cleaning(spark, tmpdir_path):
    path = daily_csv(tmpdir_path)
    rows, rejects = files.load_untyped_csv(spark, path, silver.RAW_DAILY, os.path.join(tmpdir_path, "bronze"))
    assert rows.count() == 9 and rejects.count() == 2
    assert all(f.dataType.simpleString() == "string" for f in rows.schema.fields if f.name in silver.RAW_DAILY)
    r2 = rows.where(F.col("dateprd") == "2007-09-02").first()
    assert r2.bore_oil_vol is None and r2.bore_gas_vol is None and r2.bore_wat_vol is None
    assert rows.where(F.col("npd_facility_name") == "Main, North").count() == 1

    clean, bad = silver.clean_daily(rows, repair_names=True)
    assert clean.count() == 8 and bad.count() == 1
    assert clean.where(F.col("prod_date") == "2007-09-06").count() == 1
    r9 = clean.where(F.col("prod_date") == "2007-09-09").first()
    assert r9.well_type == "OP" and r9.is_shutin is True                      # trimmed first (D-2)
    assert clean.where(F.col("prod_date") == "2007-09-07").first().oil_vol_sm3 is None
    assert clean.where(F.col("prod_date") == "2007-09-10").first().facility_name == "Æsgard"
    first = silver.clean_daily(rows, split_date="2007-09-05", batch="first")[0]
    second = silver.clean_daily(rows, split_date="2007-09-05", batch="second")[0]
    assert first.count() + second.count() == clean.count()

    audit = files.load_audit(rows, rejects).collect()
    assert len(audit) == 1 and audit[0].rows_loaded == 9 and audit[0].rows_rejected == 2

    dq = {r.column_name: r.uncastable_count for r in quality.uncastable(rows, ["bore_oil_vol"]).collect()}
    assert dq == {"bore_oil_vol": 1}
    neg = {r.column_name: r.negative_count for r in quality.negatives(rows, ["bore_oil_vol"]).collect()}
    assert neg == {"bore_oil_vol": 1}

    diff = files.infer_schema_diff(spark, path, silver.RAW_DAILY)
    assert diff.where("column_name = 'bore_gas_vol'").count() == 1


def test_load_history_since(spark):
    audit = spark.sql("SELECT concat('f', id) file_path, if(id = 9, NULL, timestamp'2024-01-01 12:00:00' - make_interval(0, 0, 0, 0, 0, 20 * id)) last_modified FROM range(10)")
    since = F.expr("timestamp'2024-01-01 12:00:00' - interval 1 hour")
    assert [r.file_path for r in files.load_history(audit, since=since).collect()] == ["f0", "f1", "f2", "f3"]
    assert [r.file_path for r in files.load_history(audit, 2, since).collect()] == ["f0", "f1"]
    assert files.load_history(audit).count() == 5


def test_monthly_units_row(spark, tmpdir_path):
    cols = silver.RAW_MONTHLY
    text = "\n".join([",".join(cols), ",,,,hrs,Sm3,Sm3,Sm3,Sm3,Sm3", "W1,1,2008,1,700,100.5,1000,5,,",
                      "W1,1,2008,2,650,90,900,6,,"]) + "\n"
    rows, rejects = files.load_untyped_csv(spark, _write(os.path.join(tmpdir_path, "m.csv"), text), cols,
                                           os.path.join(tmpdir_path, "bronze_m"))
    m = silver.clean_monthly(rows)
    assert rows.count() == 3 and m.count() == 2
    assert sorted((r.prod_year, r.prod_month) for r in m.collect()) == [(2008, 1), (2008, 2)]


def test_price_pages_merge_and_checks(spark, tmpdir_path):
    def page(records, total):
        return {"response": {"total": total, "frequency": "daily", "data": records}}

    p1 = [{"period": "2007-09-03", "value": "74.1", "series-description": "Brent", "units": "$/BBL"},
          {"period": "2007-09-04", "value": None, "series-description": "Brent", "units": "$/BBL"}]
    p2 = [{"period": "2007-09-04", "value": None, "series-description": "Brent", "units": "$/BBL"},  # overlap
          {"period": "2007-09-05", "value": "n/a", "series-description": "Brent", "units": "$/BBL"},
          {"period": "2007-09-07", "value": "75", "series-description": "Brent", "units": "USD"}]
    d = os.path.join(tmpdir_path, "price")
    os.makedirs(d)
    _write(os.path.join(d, "p1.json"), json.dumps(page(p1, "5")))
    _write(os.path.join(d, "p2.json"), json.dumps(page(p2, 5)))
    _write(os.path.join(d, "broken.json"), "{not json")
    docs = files.read_json_payloads(spark, d)
    assert docs.where(F.col("raw").isNull()).count() == 1
    good = docs.where(F.col("raw").isNotNull())

    typed = silver.price_series(good)
    assert typed.count() == 5
    vals = {r.price_date.isoformat(): r.brent_usd_bbl for r in typed.dropDuplicates(["price_date"]).collect()}
    assert vals["2007-09-03"] == 74.1 and vals["2007-09-05"] is None and vals["2007-09-07"] == 75.0

    fields = {"period": ("$.period", "string"), "value": ("$.value", "string"), "units": ("$.units", "string")}
    series, comp = payloads.merge_pages(good, fields, ["period"], "$.response.data", "$.response.total")
    c = comp.first()
    assert (c.reported_total, c.records_received, c.records_distinct, c.duplicates, c.conflicting_keys,
            c.missing) == (5, 5, 4, 1, 0, 1)
    checks = {r.check_name: r.n for r in quality.series_checks(series, "period", "value", "units", "$/BBL").collect()}
    assert checks == {"rows": 4, "null_values": 1, "non_numeric_values": 1, "unexpected_units": 1,
                      "duplicate_dates": 0, "unparsed_dates": 0, "missing_dates": 1}  # 09-06 is a Thursday
    shapes = payloads.payload_shape(good).collect()
    # both pages are objects, but "total" is text in one and a number in the other: two schemas
    assert {r.top_level_type for r in shapes} == {"object"} and sum(r.payloads for r in shapes) == 2
    assert len(shapes) == 2


def test_fx_top_level_array(spark, tmpdir_path):
    fx = [{"date": "2007-09-01", "rate": 5.8}, {"date": "2007-09-03", "rate": 5.9}, {"date": "2007-09-03", "rate": 5.9}]
    p = _write(os.path.join(tmpdir_path, "fx.json"), json.dumps(fx))
    docs = files.read_json_payloads(spark, p)
    assert docs.count() == 1                       # one row per file, array kept whole
    out = silver.fx_series(docs)
    assert out.count() == 3
    dup = quality.duplicate_keys(out, ["rate_date"]).collect()
    assert len(dup) == 1 and dup[0].n == 2
    outer = payloads.flatten_payload(docs, {"x": ("$.x", "int")}, array_path="$.missing", outer=True)
    assert outer.count() == 1


def test_sinks_append_is_idempotent(spark, tmpdir_path):
    from boreflow.sources.sinks import append_new

    df = spark.createDataFrame([("w", "2020-01-01", 1.0), ("w", "2020-01-02", 2.0)], "well_name string, d string, v double")
    path = os.path.join(tmpdir_path, "t")
    append_new(df, path, ["well_name", "d"])
    append_new(df, path, ["well_name", "d"])
    assert spark.read.parquet(path).count() == 2
