"""End to end on hand-made input files (CSV + JSON) through every layer."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from boreflow.operators import silver
from boreflow.plans.medallion import run_pipeline

START = dt.date(2007, 8, 25)
DAYS = 70


def _daily_rows():
    rows = []
    for i in range(DAYS):
        d = START + dt.timedelta(days=i)
        # well A: producer, shut in on days 10-12 and 40
        shut = i in (10, 11, 12, 40)
        oil = 0 if shut else 100 + i
        rows.append(dict(dateprd=d.isoformat(), npd_well_bore_name="A", npd_field_name="F", npd_facility_name="P1",
                         on_stream_hrs="0" if shut else "24", bore_oil_vol=str(oil), bore_gas_vol="0" if shut else "1000",
                         bore_wat_vol="0" if shut else "10", well_type="OP", flow_kind="production"))
        # well B: producer for 30 days, then injector
        wt = "OP" if i < 30 else "WI"
        rows.append(dict(dateprd=d.isoformat(), npd_well_bore_name="B", npd_field_name="F", npd_facility_name="P1",
                         on_stream_hrs="24", bore_oil_vol="50" if wt == "OP" else "0", bore_gas_vol="500",
                         bore_wat_vol="5", well_type=wt, flow_kind="production"))
    return rows


def _csv_line(r):
    return ",".join(r.get(c, "") for c in silver.RAW_DAILY)


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def _inputs(folder):
    rows = _daily_rows()
    lines = [",".join(silver.RAW_DAILY)] + [_csv_line(r) for r in rows]
    lines.append("2007-09-01,short,row")                                    # rejected by the CSV reader
    lines.append(_csv_line(dict(rows[0], dateprd="31/02/2007")))          # date no layout parses
    daily = _write(os.path.join(folder, "daily.csv"), "\n".join(lines) + "\n")

    # monthly: sums of the daily file, with September oil of A off by 2 %
    sums = {}
    for r in rows:
        d = dt.date.fromisoformat(r["dateprd"])
        k = (r["npd_well_bore_name"], d.year, d.month)
        o, g = sums.get(k, (0.0, 0.0))
        sums[k] = (o + float(r["bore_oil_vol"]), g + float(r["bore_gas_vol"]))
    mlines = [",".join(silver.RAW_MONTHLY), ",,,,hrs,Sm3,Sm3,Sm3,Sm3,Sm3"]
    for (w, y, m), (o, g) in sorted(sums.items()):
        if (w, m) == ("A", 9):
            o *= 1.02
        mlines.append(f"{w},1,{y},{m},700,{o},{g},,,")
    monthly = _write(os.path.join(folder, "monthly.csv"), "\n".join(mlines) + "\n")

    # price: weekday prices in two overlapping pages; FX: one top-level array
    recs = []
    for i in range(DAYS):
        d = START + dt.timedelta(days=i)
        if d.weekday() < 5:
            recs.append({"period": d.isoformat(), "value": str(70 + i % 7), "series-description": "Brent",
                         "units": "$/BBL"})
    pdir = os.path.join(folder, "price")
    os.makedirs(pdir)
    half = len(recs) // 2
    for n, part in enumerate((recs[: half + 1], recs[half:])):
        _write(os.path.join(pdir, f"page{n}.json"), json.dumps({"response": {"total": len(recs), "data": part}}))
    fx = [{"date": (START + dt.timedelta(days=i)).isoformat(), "rate": 6.0 + i / 100} for i in range(DAYS)]
    fxp = _write(os.path.join(folder, "fx.json"), json.dumps(fx))
    return daily, monthly, pdir, fxp, len(recs)


def test_run_pipeline_end_to_end(spark, tmpdir_path):
    daily, monthly, pdir, fxp, n_prices = _inputs(tmpdir_path)
    out = os.path.join(tmpdir_path, "warehouse")
    t = run_pipeline(spark, daily_csv=daily, monthly_csv=monthly, price_json=pdir, fx_json=fxp, out=out)
    r = lambda name: spark.read.parquet(t[name])

    assert r("quality/daily_rejects").count() == 1
    assert r("quality/load_history").count() == 5       # two CSVs, two price pages, one FX file audited
    assert r("quality/date_rejects").count() == 1
    assert r("silver/daily").count() == 2 * DAYS
    assert r("silver/monthly").count() == 8  # 2 wells x Aug..Nov
    comp = r("quality/price_completeness").first()
    assert (comp.records_received, comp.records_distinct, comp.duplicates, comp.missing) == (n_prices + 1, n_prices, 1, 0)

    fact = r("gold/fact_production")
    assert fact.count() == DAYS + 30
    assert fact.where(F.col("brent_usd_bbl_filled").isNull() | F.col("nok_per_usd").isNull()).count() == 0
    ev = sorted((x.event_start, x.duration_days) for x in r("gold/downtime_events").collect())
    assert ev == [(START + dt.timedelta(days=10), 3), (START + dt.timedelta(days=40), 1)]

    scd2 = {(x.well_name, x.well_type): x.is_current for x in r("gold/dim_well_scd2").collect()}
    assert scd2 == {("A", "OP"): True, ("B", "OP"): False, ("B", "WI"): True}
    assert {x.well_name: x.well_type for x in r("gold/dim_well_scd1").collect()} == {"A": "OP", "B": "WI"}
    assert r("gold/dim_date").count() == DAYS

    assert r("gold/decomposition_check").where("should_be_zero_usd != 0 OR should_be_zero_nok != 0").count() == 0
    s = r("gold/reconciliation_summary").first()
    assert (s.total_well_months, s.oil_flags, s.gas_flags) == (8, 1, 0)
    rank = {x.well_name: x.value_rank for x in r("gold/well_value_ranking").collect()}
    assert rank == {"A": 1, "B": 2}
    risk = r("gold/scd1_at_risk").first()
    assert risk.at_risk_pct is not None and 0 < risk.at_risk_pct < 100
    assert {x.day_of_week for x in r("quality/price_gaps").collect()} <= {"Sat", "Sun"}
