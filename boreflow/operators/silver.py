"""Silver cleaning: typed daily and monthly production (SLV-1, SLV-2) and the
price / FX series from JSON payloads (SLV-3, SLV-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import repair_mojibake, shutin_flag, tolerant_date, try_decimal
from ..functions.constants import DATE_FORMATS, PRICE_ARRAY_PATH
from ..sources.payloads import flatten_payload

# --- fixed values: raw daily column -> clean column, kind ---------------------
DAILY_COLUMNS = [
    ("well_bore_code", "well_code_no", "text"),
    ("npd_well_bore_code", "well_code", "text"),
    ("npd_well_bore_name", "well_name", "text"),
    ("npd_field_code", "field_code", "text"),
    ("npd_field_name", "field_name", "text"),
    ("npd_facility_code", "facility_code", "text"),
    ("npd_facility_name", "facility_name", "text"),
    ("on_stream_hrs", "on_stream_hrs", "hours"),
    ("avg_downhole_pressure", "avg_downhole_pressure", "measure"),
    ("avg_downhole_temperature", "avg_downhole_temp", "measure"),
    ("avg_dp_tubing", "avg_dp_tubing", "measure"),
    ("avg_annulus_press", "avg_annulus_press", "measure"),
    ("avg_choke_size_p", "avg_choke_size", "measure"),
    ("avg_choke_uom", "choke_uom", "text"),
    ("avg_whp_p", "avg_whp", "measure"),
    ("avg_wht_p", "avg_wht", "measure"),
    ("dp_choke_size", "dp_choke_size", "measure"),
    ("bore_oil_vol", "oil_vol_sm3", "measure"),
    ("bore_gas_vol", "gas_vol_sm3", "measure"),
    ("bore_wat_vol", "water_vol_sm3", "measure"),
    ("bore_wi_vol", "wi_vol", "measure"),
    ("flow_kind", "flow_kind", "text"),
    ("well_type", "well_type", "text"),
]
DAILY_DATE = "dateprd"
RAW_DAILY = [DAILY_DATE] + [r for r, _, _ in DAILY_COLUMNS]

MONTHLY_COLUMNS = [
    ("wellbore_name", "well_name", "text"),
    ("npd_code", "npd_code", "text"),
    ("year", "prod_year", "int"),
    ("month", "prod_month", "int"),
    ("on_stream_hrs", "on_stream_hrs", "hours"),
    ("oil_sm3", "oil_sm3", "measure"),
    ("gas_sm3", "gas_sm3", "measure"),
    ("water_sm3", "water_sm3", "measure"),
    ("gi_sm3", "gi_sm3", "measure"),
    ("wi_sm3", "wi_sm3", "measure"),
]
RAW_MONTHLY = [r for r, _, _ in MONTHLY_COLUMNS]
# --- end of fixed values -------------------------------------------------------


def _typed(raw: str, kind: str) -> F.Column:
    if kind == "text":
        return F.trim(F.col(raw))
    if kind == "hours":
        return try_decimal(raw, 10, 4)
    if kind == "int":
        return try_decimal(raw, 10, 0).cast("int")
    return try_decimal(raw, 18, 5)


def clean_daily(
    bronze: DataFrame,
    split_date: str | None = None,
    batch: str = "all",
    repair_names: bool = False,
    formats=DATE_FORMATS,
) -> tuple[DataFrame, DataFrame]:
    """SLV-1: typed daily production, and the rows whose date did not parse.

    Trim text, tolerant decimal casts (bad text -> NULL), tolerant date parse
    (D-1: rows that still fail go to the rejects instead of failing the job),
    shut-in flag tested on the trimmed type (D-2). ``batch`` selects rows
    before (``"first"``) or from (``"second"``) ``split_date`` (FIL-2); the
    predicate is on the typed date, so it prunes a date-partitioned silver.
    """
    d = tolerant_date(DAILY_DATE, formats)
    cols = [d.alias("prod_date")]
    for raw, clean, kind in DAILY_COLUMNS:
        c = _typed(raw, kind)
        if repair_names and clean in ("facility_name", "field_name", "well_name"):
            c = repair_mojibake(c)
        cols.append(c.alias(clean))
    typed = bronze.select(*cols)
    typed = typed.withColumn(
        "is_shutin", shutin_flag("well_type", ["on_stream_hrs", "oil_vol_sm3", "gas_vol_sm3", "water_vol_sm3"])
    )
    clean = typed.where(F.col("prod_date").isNotNull())
    if split_date and batch == "first":
        clean = clean.where(F.col("prod_date") < F.lit(split_date).cast("date"))
    elif split_date and batch == "second":
        clean = clean.where(F.col("prod_date") >= F.lit(split_date).cast("date"))
    rejects = bronze.where(d.isNull()).select(
        *RAW_DAILY, F.lit("unparseable date").alias("reject_reason")
    )
    return clean, rejects


def clean_monthly(bronze: DataFrame) -> DataFrame:
    """SLV-2: typed monthly production; the units row (no name) is dropped
    (FIL-1: a NULL name fails ``!= ''`` as well)."""
    return bronze.where(F.col("wellbore_name").isNotNull() & (F.col("wellbore_name") != "")).select(
        *[_typed(raw, kind).alias(clean) for raw, clean, kind in MONTHLY_COLUMNS]
    )


PRICE_FIELDS = {
    "price_date": ("$.period", "date"),
    "brent_usd_bbl": ("$.value", "double"),
    "series_desc": ('$["series-description"]', "string"),
    "units": ("$.units", "string"),
}
FX_FIELDS = {"rate_date": ("$.date", "date"), "nok_per_usd": ("$.rate", "double")}


def price_series(payloads: DataFrame, raw: str = "raw") -> DataFrame:
    """SLV-3: price rows from object payloads (``response.data[]``)."""
    return flatten_payload(payloads, PRICE_FIELDS, raw=raw, array_path=PRICE_ARRAY_PATH).drop("index")


def fx_series(payloads: DataFrame, raw: str = "raw") -> DataFrame:
    """SLV-4: FX rows from top-level array payloads."""
    return flatten_payload(payloads, FX_FIELDS, raw=raw, array_path="$").drop("index")
