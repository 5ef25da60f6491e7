"""Registered queries for ingest, silver, data quality, payloads and
governed reads (SRC-*, FLT-*, SLV-*, DQ-*, GOV-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import FULL_ACCESS_ROLES, VIEWER_ROLE
from ..operators import governance, quality
from ..operators.silver import DAILY_COLUMNS, DAILY_DATE, MONTHLY_COLUMNS, RAW_DAILY
from ..sources import files, payloads
from .pipeline import Pipeline
from .present import present
from .registry import DECOMP_SQL, DECOMP_KINDS, FACT_DIGITS, FACT_KINDS, MONEY2, PRICE4, oracle, register, runs_sql
from .standin import table

# ---------------------------------------------------------------------------
# SQL fragments mirroring the silver cleaning
# ---------------------------------------------------------------------------

# DuckDB's %Y also takes 1-2 digit years; Spark's yyyy needs 4 digits.
SQL_ISO = (
    f"CASE WHEN regexp_matches(trim({DAILY_DATE}), '^[0-9]{{4}}-') "
    f"THEN CAST(TRY_STRPTIME(trim({DAILY_DATE}), '%Y-%m-%d') AS DATE) END"
)
SQL_DMY = f"CAST(TRY_STRPTIME(trim({DAILY_DATE}), '%d-%m-%y') AS DATE)"
SQL_DATE = f"COALESCE({SQL_ISO}, {SQL_DMY})"


def _sql_typed(raw: str, kind: str) -> str:
    if kind == "text":
        return f"trim({raw})"
    if kind == "hours":
        return f"TRY_CAST({raw} AS DECIMAL(10,4))"
    if kind == "int":
        return f"CAST(TRY_CAST({raw} AS DECIMAL(10,0)) AS INTEGER)"
    return f"TRY_CAST({raw} AS DECIMAL(18,5))"


_TYPED = ",\n".join(f"{_sql_typed(r, k)} AS {c}" for r, c, k in DAILY_COLUMNS)
SILVER_DAILY_SQL = f"""
  SELECT *, well_type IS NOT DISTINCT FROM 'OP'
            AND list_sum(list_transform([CAST(on_stream_hrs AS DOUBLE), oil_vol_sm3, gas_vol_sm3, water_vol_sm3, 0],
                                        lambda x: abs(x))) = 0 AS is_shutin
  FROM (SELECT {SQL_DATE} AS prod_date, {_TYPED} FROM bronze_daily) t
  WHERE prod_date IS NOT NULL"""
SILVER_KINDS = [("prod_date", "keep")] + [
    (c, {"text": "keep", "hours": "dec", "measure": "dec"}[k]) for _, c, k in DAILY_COLUMNS
] + [("is_shutin", "keep")]


@register("silver_daily", oracle(SILVER_DAILY_SQL, SILVER_KINDS))
def q_silver_daily(p: Pipeline) -> DataFrame:
    """SLV-1: typed daily production from the untyped bronze rows."""
    return present(p.silver_daily[0])


@register(
    "silver_daily_rejects",
    oracle(f"SELECT *, 'unparseable date' AS reject_reason FROM bronze_daily WHERE {SQL_DATE} IS NULL",
           [(c, "keep") for c in RAW_DAILY] + [("reject_reason", "keep")]),
)
def q_silver_rejects(p: Pipeline) -> DataFrame:
    """SLV-1 / D-1: bronze rows whose date no layout parses."""
    return present(p.silver_daily[1])


_MTYPED = ", ".join(f"{_sql_typed(r, k)} AS {c}" for r, c, k in MONTHLY_COLUMNS)


@register(
    "silver_monthly",
    oracle(f"SELECT {_MTYPED} FROM bronze_monthly WHERE wellbore_name IS NOT NULL AND wellbore_name != ''",
           [(c, {"text": "keep", "hours": "dec", "measure": "dec", "int": "int"}[k]) for _, c, k in MONTHLY_COLUMNS]),
)
def q_silver_monthly(p: Pipeline) -> DataFrame:
    """SLV-2: typed monthly production, units row dropped."""
    return present(p.silver_monthly)


# ---------------------------------------------------------------------------
# DQ-1 … DQ-15
# ---------------------------------------------------------------------------


@register(
    "dq_null_profile",
    oracle(
        "UNPIVOT (SELECT COUNT(*) AS total_rows, "
        + ", ".join(f"COUNT(*) - COUNT({c}) AS {c}" for c in RAW_DAILY)
        + " FROM bronze_daily) ON " + ", ".join(RAW_DAILY) + " INTO NAME column_name VALUE null_count",
        [("column_name", "keep"), ("total_rows", "int"), ("null_count", "int")],
    ),
)
def q_null_profile(p: Pipeline) -> DataFrame:
    """DQ-1: NULL count per bronze column, one pass."""
    return present(quality.null_profile(p.bronze_daily))


@register(
    "dq_duplicates",
    oracle(
        """SELECT npd_well_bore_name AS wellbore_name, dateprd AS prod_date, COUNT(*) AS n
           FROM bronze_daily GROUP BY 1, 2 HAVING COUNT(*) > 1""",
        [("wellbore_name", "keep"), ("prod_date", "keep"), ("n", "int")],
    ),
)
def q_duplicates(p: Pipeline) -> DataFrame:
    """DQ-2: (well, date) keys loaded more than once."""
    b = p.bronze_daily.select(F.col("npd_well_bore_name").alias("wellbore_name"), F.col("dateprd").alias("prod_date"))
    return present(quality.duplicate_keys(b, ["wellbore_name", "prod_date"]))


@register(
    "dq_key_mismatch",
    oracle(
        """(SELECT well_name, year(prod_date) AS year, month(prod_date) AS month, 'daily' AS only_in FROM well_day
            EXCEPT SELECT well_name, prod_year, prod_month, 'daily' FROM monthly_reported)
           UNION ALL
           (SELECT well_name, prod_year, prod_month, 'monthly' FROM monthly_reported
            EXCEPT SELECT well_name, year(prod_date), month(prod_date), 'monthly' FROM well_day)""",
        [("well_name", "keep"), ("year", "int"), ("month", "int"), ("only_in", "keep")],
    ),
)
def q_key_mismatch(p: Pipeline) -> DataFrame:
    """DQ-3: well-months in one source and not the other."""
    d = p.well_day.select("well_name", F.year("prod_date").alias("year"), F.month("prod_date").alias("month"))
    m = p.monthly_reported.select("well_name", F.col("prod_year").alias("year"), F.col("prod_month").alias("month"))
    return present(quality.key_mismatch(d, m, ["well_name", "year", "month"], "daily", "monthly"))


CAST_COLS = ["on_stream_hrs", "avg_choke_size_p", "avg_whp_p", "bore_oil_vol", "bore_gas_vol", "bore_wat_vol", "bore_wi_vol"]


def _bad(c: str) -> str:
    return f"{c} IS NOT NULL AND {c} != '' AND TRY_CAST({c} AS DECIMAL(18,5)) IS NULL"


@register(
    "dq_uncastable",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT_IF({_bad(c)}) AS uncastable_count, "
            f"MIN(CASE WHEN {_bad(c)} THEN {c} END) AS sample_value FROM bronze_daily"
            for c in CAST_COLS
        ),
        [("column_name", "keep"), ("uncastable_count", "int"), ("sample_value", "keep")],
    ),
)
def q_uncastable(p: Pipeline) -> DataFrame:
    """DQ-4: values that do not cast to a number, per column, with a sample."""
    return present(quality.uncastable(p.bronze_daily, CAST_COLS))


NEG_COLS = ["bore_oil_vol", "bore_gas_vol", "avg_downhole_pressure", "avg_downhole_temperature", "avg_choke_size_p"]


@register(
    "dq_negatives",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT_IF(TRY_CAST({c} AS DECIMAL(18,4)) < 0) AS negative_count "
            f"FROM bronze_daily" for c in NEG_COLS
        ),
        [("column_name", "keep"), ("negative_count", "int")],
    ),
)
def q_negatives(p: Pipeline) -> DataFrame:
    """DQ-5: negative values per column, one pass instead of one scan each."""
    return present(quality.negatives(p.bronze_daily, NEG_COLS))


@register(
    "dq_categories",
    oracle(
        """SELECT 'well_type' AS attribute, well_type AS value, COUNT(*) AS n FROM bronze_daily GROUP BY 2
           UNION ALL SELECT 'flow_kind', flow_kind, COUNT(*) FROM bronze_daily GROUP BY 2""",
        [("attribute", "keep"), ("value", "keep"), ("n", "int")],
    ),
)
def q_categories(p: Pipeline) -> DataFrame:
    """DQ-6: row count per well type and flow kind."""
    return present(quality.category_counts(p.bronze_daily, ["well_type", "flow_kind"]))


@register(
    "dq_date_formats",
    oracle(
        f"""SELECT MIN({SQL_ISO}) AS earliest_date,
                   MAX({SQL_ISO}) AS latest_date,
                   COUNT({SQL_ISO}) AS rows_format_1,
                   COUNT({SQL_DMY}) AS rows_format_2,
                   COUNT_IF({SQL_DATE} IS NULL) AS rows_unparsed, COUNT(*) AS rows
            FROM bronze_daily""",
        [("earliest_date", "keep"), ("latest_date", "keep"), ("rows_format_1", "int"), ("rows_format_2", "int"),
         ("rows_unparsed", "int"), ("rows", "int")],
    ),
)
def q_date_formats(p: Pipeline) -> DataFrame:
    """DQ-7: date coverage and rows per date layout."""
    return present(quality.date_formats(p.bronze_daily, "dateprd"))


GAPS_BASE = """SELECT prod_date FROM well_day WHERE well_type = 'OP'
               AND prod_date NOT IN (SELECT price_date FROM price WHERE brent_usd_bbl IS NOT NULL)"""


@register(
    "dq_price_gaps",
    oracle(
        f"SELECT left(dayname(prod_date), 3) AS day_of_week, COUNT(*) AS null_price_rows FROM ({GAPS_BASE}) g GROUP BY 1",
        [("day_of_week", "keep"), ("null_price_rows", "int")],
    ),
)
def q_price_gaps(p: Pipeline) -> DataFrame:
    """DQ-8: producer rows without a raw price, by weekday."""
    return present(quality.price_gaps(p.well_day, p.price, value="brent_usd_bbl"))


@register(
    "dq_weekday_gaps",
    oracle(
        f"""SELECT DISTINCT prod_date, left(dayname(prod_date), 3) AS day_of_week FROM ({GAPS_BASE}) g
            WHERE left(dayname(prod_date), 3) NOT IN ('Sat', 'Sun')""",
        [("prod_date", "keep"), ("day_of_week", "keep")],
    ),
)
def q_weekday_gaps(p: Pipeline) -> DataFrame:
    """DQ-8: weekdays with production but no price (holidays)."""
    return present(quality.weekday_gaps(p.well_day, p.price, value="brent_usd_bbl"))


@register(
    "dq_counts",
    oracle(
        f"""SELECT 'bronze' AS table_name, COUNT(*) AS rows FROM bronze_daily
            UNION ALL SELECT 'silver', COUNT({SQL_DATE}) FROM bronze_daily
            UNION ALL SELECT 'rejects', COUNT(*) - COUNT({SQL_DATE}) FROM bronze_daily
            UNION ALL SELECT 'payload_records', COUNT(*) FROM events""",
        [("table_name", "keep"), ("rows", "int")],
    ),
)
def q_counts(p: Pipeline) -> DataFrame:
    """DQ-9: rows of the stored bronze, silver and reject tables, and of the
    records flattened from the stored payloads."""
    rows, rejects = p.silver_daily
    series, _ = _merged(p)
    return present(quality.table_counts({"bronze": p.bronze_daily, "silver": rows, "rejects": rejects, "payload_records": series}))


@register(
    "dq_dim_unique",
    oracle(
        """SELECT 'dim_well' AS table_name, COUNT(*) AS total_rows, COUNT(DISTINCT well_name) AS distinct_keys
           FROM (SELECT DISTINCT well_name FROM well_day) d
           UNION ALL
           SELECT 'dim_date', COUNT(*), COUNT(DISTINCT d) FROM
             (SELECT unnest(generate_series(MIN(prod_date), MAX(prod_date), INTERVAL 1 DAY)) AS d FROM well_day) c""",
        [("table_name", "keep"), ("total_rows", "int"), ("distinct_keys", "int")],
    ),
)
def q_dim_unique(p: Pipeline) -> DataFrame:
    """DQ-10: stored dimensions have one row per key."""
    return present(quality.dim_uniqueness({"dim_well": (p.dim_entity, "well_name"),
                                           "dim_date": (p.dim_date, "calendar_date")}))


STAT_COLS = ["oil_vol_sm3", "gas_vol_sm3", "water_vol_sm3", "avg_choke_size", "avg_whp"]


@register(
    "dq_stats",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS count, AVG(CAST({c} AS DOUBLE)) AS mean, "
            f"STDDEV_SAMP(CAST({c} AS DOUBLE)) AS stddev, MIN(CAST({c} AS DOUBLE)) AS min, "
            f"MAX(CAST({c} AS DOUBLE)) AS max FROM fact" for c in STAT_COLS
        ),
        [("column_name", "keep"), ("count", "int"), ("mean", "dbl"), ("stddev", "dbl"), ("min", "dbl"), ("max", "dbl")],
    ),
)
def q_stats(p: Pipeline) -> DataFrame:
    """DQ-11: count, mean, std, min, max of the fact's measures."""
    return present(quality.column_stats(p.fact, STAT_COLS))


@register(
    "dq_quartiles",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, quantile_disc(CAST({c} AS DOUBLE), 0.25) AS p25, "
            f"quantile_disc(CAST({c} AS DOUBLE), 0.5) AS p50, quantile_disc(CAST({c} AS DOUBLE), 0.75) AS p75 FROM fact"
            for c in STAT_COLS
        ),
        [("column_name", "keep"), ("p25", "dbl"), ("p50", "dbl"), ("p75", "dbl")],
    ),
)
def q_quartiles(p: Pipeline) -> DataFrame:
    """DQ-11: exact quartiles of the fact's measures."""
    return present(quality.column_quartiles(p.fact, STAT_COLS))


def _profile_sql(name: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, 'string' AS type, COUNT(*) AS total_rows, COUNT(*) - COUNT({c}) AS null_count, "
        f"COUNT(DISTINCT {c}) AS distinct_values FROM {name}" for c in columns
    )


PROFILE_KINDS = [("column_name", "keep"), ("type", "keep"), ("total_rows", "int"), ("null_count", "int"), ("distinct_values", "int")]
MONTHLY_RAW = [r for r, _, _ in MONTHLY_COLUMNS]


@register("dq_profile_daily", oracle(_profile_sql("bronze_daily", RAW_DAILY), PROFILE_KINDS))
def q_profile_daily(p: Pipeline) -> DataFrame:
    """DQ-11: type, rows, NULLs and distinct values per bronze column."""
    return present(quality.column_profile(p.bronze_daily, RAW_DAILY))


@register("dq_profile_monthly", oracle(_profile_sql("bronze_monthly", MONTHLY_RAW), PROFILE_KINDS))
def q_profile_monthly(p: Pipeline) -> DataFrame:
    """DQ-11 on the monthly source."""
    return present(quality.column_profile(p.bronze_monthly, MONTHLY_RAW))


@register(
    "dq_name_mismatch",
    oracle(
        """SELECT COALESCE(d.n, m.n) AS well_name, CASE WHEN d.n IS NULL THEN 'monthly' ELSE 'daily' END AS only_in
           FROM (SELECT DISTINCT npd_well_bore_name AS n FROM bronze_daily WHERE npd_well_bore_name IS NOT NULL) d
           FULL JOIN (SELECT DISTINCT wellbore_name AS n FROM bronze_monthly WHERE wellbore_name IS NOT NULL) m ON d.n = m.n
           WHERE d.n IS NULL OR m.n IS NULL""",
        [("well_name", "keep"), ("only_in", "keep")],
    ),
)
def q_name_mismatch(p: Pipeline) -> DataFrame:
    """DQ-3: raw well names that only one bronze source has (spelling drift)."""
    d = p.bronze_daily.select(F.col("npd_well_bore_name").alias("well_name"))
    m = p.bronze_monthly.select(F.col("wellbore_name").alias("well_name"))
    return present(quality.key_mismatch(d, m, ["well_name"], "daily", "monthly"))


MONTHLY_CAST_COLS = ["on_stream_hrs", "oil_sm3", "gas_sm3", "water_sm3", "gi_sm3", "wi_sm3"]


@register(
    "dq_uncastable_monthly",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT(CASE WHEN {_bad(c)} THEN 1 END) AS uncastable_count, "
            f"MIN(CASE WHEN {_bad(c)} THEN {c} END) AS sample_value FROM bronze_monthly" for c in MONTHLY_CAST_COLS
        ),
        [("column_name", "keep"), ("uncastable_count", "int"), ("sample_value", "keep")],
    ),
)
def q_uncastable_monthly(p: Pipeline) -> DataFrame:
    """DQ-4 on the monthly source: every numeric column (the units row shows)."""
    return present(quality.uncastable(p.bronze_monthly, MONTHLY_CAST_COLS))


@register(
    "dq_orphans",
    oracle(
        """SELECT 'dim_well' AS dimension, COUNT(*) AS orphan_rows FROM fact f
             WHERE NOT EXISTS (SELECT 1 FROM well_day w WHERE w.well_name = f.well_name)
           UNION ALL
           SELECT 'dim_date', COUNT(*) FROM fact f WHERE f.prod_date NOT IN
             (SELECT CAST(unnest(generate_series(MIN(prod_date), MAX(prod_date), INTERVAL 1 DAY)) AS DATE) FROM well_day)""",
        [("dimension", "keep"), ("orphan_rows", "int")],
    ),
)
def q_orphans(p: Pipeline) -> DataFrame:
    """DQ-13: fact rows with no dimension row (a NULL well has none)."""
    return present(quality.orphans(p.fact, {"dim_well": (p.dim_entity, "well_name", "well_name"),
                                            "dim_date": (p.dim_date, "prod_date", "calendar_date")}))


@register(
    "dq_unusual",
    oracle(
        """WITH x AS (SELECT well_name, prod_date, CAST(oil_vol_sm3 AS DOUBLE) AS x FROM fact),
           s AS (SELECT well_name, AVG(x) AS mu, STDDEV_SAMP(x) AS sd FROM x GROUP BY well_name),
           zd AS (SELECT well_name, CAST(unnest(generate_series(event_start, event_end, INTERVAL 1 DAY)) AS DATE) AS prod_date,
                         duration_days AS d FROM ({runs}) z)
           SELECT x.well_name, x.prod_date, x.x AS oil_vol_sm3,
                  COALESCE(x.x > s.mu + 3.0 * s.sd, FALSE) AS is_high,
                  COALESCE(ABS(x.x - LAG(x.x) OVER (PARTITION BY x.well_name ORDER BY x.prod_date)) > 3.0 * s.sd, FALSE)
                    AS is_jump,
                  COALESCE(zd.d, 0) AS zero_run_days, COALESCE(zd.d, 0) >= 7 AS is_long_zero_run
           FROM x JOIN s ON x.well_name IS NOT DISTINCT FROM s.well_name
           LEFT JOIN zd ON x.well_name IS NOT DISTINCT FROM zd.well_name AND x.prod_date = zd.prod_date""".replace(
            "{runs}", runs_sql("SELECT well_name, prod_date FROM fact WHERE oil_vol_sm3 = 0")),
        [("well_name", "keep"), ("prod_date", "keep"), ("oil_vol_sm3", "dbl"), ("is_high", "keep"),
         ("is_jump", "keep"), ("zero_run_days", "int"), ("is_long_zero_run", "keep")],
    ),
)
def q_unusual(p: Pipeline) -> DataFrame:
    """DQ-14: marks high values, jumps and long zero runs per well-day."""
    return present(quality.unusual(p.fact))


EVENT_FIELDS = {
    "id": ("$.id", "bigint"),
    "period": ("$.period", "timestamp_ntz"),
    "value": ("$.value", "double"),
    "series_desc": ('$["series-description"]', "string"),
    "units": ("$.units", "string"),
}
EVENT_TEXT_FIELDS = {"id": ("$.id", "bigint"), "period": ("$.period", "string"), "value": ("$.value", "string"),
                     "units": ("$.units", "string")}


def _merged(p: Pipeline, fields=EVENT_FIELDS):
    return payloads.merge_pages(p.event_pages, fields, ["id"], "$.response.data", "$.response.total")


@register(
    "dq_series",
    oracle(
        """WITH e AS (SELECT CASE WHEN event_id % 101 <> 7 THEN CAST(ts AS DATE) END AS d,
                             CASE event_id % 97 WHEN 1 THEN 'bad' WHEN 2 THEN NULL ELSE CAST(value AS VARCHAR) END AS value,
                             CASE WHEN event_id % 89 = 3 THEN 'EUR/t' ELSE '$/BBL' END AS units FROM events),
           pd AS (SELECT d, COUNT(*) AS n FROM e WHERE d IS NOT NULL GROUP BY d),
           cal AS (SELECT CAST(unnest(generate_series(MIN(d), MAX(d), INTERVAL 1 DAY)) AS DATE) AS d FROM pd)
           SELECT 'rows' AS check_name, COUNT(*) AS n FROM e
           UNION ALL SELECT 'null_values', COUNT(CASE WHEN value IS NULL THEN 1 END) FROM e
           UNION ALL SELECT 'non_numeric_values',
                  COUNT(CASE WHEN value IS NOT NULL AND value != '' AND TRY_CAST(value AS DOUBLE) IS NULL THEN 1 END)
                  FROM e
           UNION ALL SELECT 'unexpected_units', COUNT(CASE WHEN units != '$/BBL' THEN 1 END) FROM e
           UNION ALL SELECT 'duplicate_dates', COUNT_IF(n > 1) FROM pd
           UNION ALL SELECT 'unparsed_dates', COUNT_IF(d IS NULL) FROM e
           UNION ALL SELECT 'missing_dates', COUNT(*) FROM cal
             WHERE isodow(d) < 6 AND d NOT IN (SELECT d FROM pd)""",
        [("check_name", "keep"), ("n", "int")],
    ),
)
def q_series(p: Pipeline) -> DataFrame:
    """DQ-15: checks on the merged paged series (text values)."""
    series, _ = _merged(p, EVENT_TEXT_FIELDS)
    # damage of every kind that the checks look for
    series = series.withColumns({
        "period": F.when(F.col("id") % 101 == 7, F.lit("no date")).otherwise(F.col("period")),
        "value": F.when(F.col("id") % 97 == 1, F.lit("bad")).when(F.col("id") % 97 == 2, F.lit(None)).otherwise(F.col("value")),
        "units": F.when(F.col("id") % 89 == 3, F.lit("EUR/t")).otherwise(F.col("units")),
    })
    return present(quality.series_checks(series, "period", "value", "units", "$/BBL"))


@register(
    "dq_water_cut",
    oracle(
        """SELECT COUNT_IF(water_cut < 0 OR water_cut > 1) AS out_of_range, COUNT_IF(water_cut IS NULL) AS null_water_cut,
                  COUNT(*) AS rows FROM fact""",
        [("out_of_range", "int"), ("null_water_cut", "int"), ("rows", "int")],
    ),
)
def q_water_cut_range(p: Pipeline) -> DataFrame:
    """DQ-15: water cut stays within 0..1."""
    return present(quality.water_cut_range(p.fact))


# ---------------------------------------------------------------------------
# Payloads: FLT-J1, FLT-J2, SRC-4, SRC-6, SRC-7, JSON path
# ---------------------------------------------------------------------------


@register(
    "flatten_nested",
    oracle("SELECT event_id AS id, ts AS period, value, event_type AS series_desc, '$/BBL' AS units FROM events",
           [("id", "int"), ("period", "keep"), ("value", "dbl"), ("series_desc", "keep"), ("units", "keep")]),
)
def q_flatten_nested(p: Pipeline) -> DataFrame:
    """FLT-J1 / SLV-3: records under response.data of paged payloads,
    merged and de-duplicated on the record id."""
    series, _ = _merged(p)
    return present(series)


@register(
    "merge_pages",
    oracle(
        """WITH r AS (SELECT DISTINCT event_id, ts, value, event_type FROM events)
           SELECT (SELECT COUNT(*) FROM events) AS reported_total,
                  (SELECT COUNT(*) + COUNT_IF(event_id % 5000 = 0 AND event_id > 0) FROM events) AS records_received,
                  COUNT(*) AS records_distinct,
                  (SELECT COUNT(*) + COUNT_IF(event_id % 5000 = 0 AND event_id > 0) FROM events) - COUNT(*) AS duplicates,
                  COUNT(*) - COUNT(DISTINCT event_id) AS conflicting_keys,
                  (SELECT COUNT(*) FROM events) - COUNT(DISTINCT event_id) AS missing
           FROM r""",
        [("reported_total", "int"), ("records_received", "int"), ("records_distinct", "int"),
         ("duplicates", "int"), ("conflicting_keys", "int"), ("missing", "int")],
    ),
)
def q_merge_pages(p: Pipeline) -> DataFrame:
    """SRC-6: paged payload merge against the reported total."""
    _, comp = _merged(p)
    return present(comp)


@register(
    "payload_shape",
    oracle(
        """SELECT 'object' AS top_level_type, 'response' AS fields, COUNT(*) AS payloads FROM (
             SELECT event_id // 5000 AS page FROM events
             UNION SELECT event_id // 5000 - 1 FROM events WHERE event_id % 5000 = 0 AND event_id > 0) p
           UNION ALL
           SELECT 'array', '', COUNT(DISTINCT strftime(rate_date, '%Y-%m')) FROM fx""",
        [("top_level_type", "keep"), ("fields", "keep"), ("payloads", "int")],
    ),
)
def q_payload_shape(p: Pipeline) -> DataFrame:
    """SRC-7: payload shapes (object pages and array documents)."""
    shapes = payloads.payload_shape(p.event_pages.select("raw").unionByName(p.fx_payloads.select("raw")))
    return present(shapes.groupBy("top_level_type", "fields").agg(F.sum("payloads").alias("payloads")))


@register(
    "flatten_array",
    oracle("SELECT rate_date, CAST(nok_per_usd AS DOUBLE) AS nok_per_usd FROM fx",
           [("rate_date", "keep"), ("nok_per_usd", "dbl")], {"nok_per_usd": 7}),
)
def q_flatten_array(p: Pipeline) -> DataFrame:
    """FLT-J2 / SLV-4: records of top-level JSON arrays (FX documents)."""
    from ..operators.silver import fx_series

    return present(fx_series(p.fx_payloads), {"nok_per_usd": 7})


@register(
    "flatten_embeddings",
    oracle("SELECT vec_id, unnest(range(len(embedding))) AS pos, unnest(embedding) AS value FROM embeddings",
           [("vec_id", "int"), ("pos", "int"), ("value", "dbl")]),
)
def q_flatten_embeddings(p: Pipeline) -> DataFrame:
    """FLT-J2 on an array column: one row per element with its position."""
    e = table(p.spark, p.sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "value"))
    return present(e)


@register(
    "json_path",
    oracle("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
           [("event_id", "int"), ("k", "int")]),
)
def q_json_path(p: Pipeline) -> DataFrame:
    """Typed JSON path access on a text column (VARIANT)."""
    e = table(p.spark, p.sf_dir, "events").select(
        "event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k")
    )
    return present(e)


@register(
    "load_audit",
    oracle(
        """SELECT 'lineitem.parquet' AS file_name, COUNT(*) AS rows_loaded, 0 AS rows_rejected FROM lineitem
           UNION ALL SELECT 'orders.parquet', COUNT(*), 0 FROM orders""",
        [("file_name", "keep"), ("rows_loaded", "int"), ("rows_rejected", "int")],
    ),
)
def q_load_audit(p: Pipeline) -> DataFrame:
    """SRC-4: rows per source file, from the scan's file metadata."""
    parts = []
    for t in ("lineitem", "orders"):
        df = table(p.spark, p.sf_dir, t).select(
            F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_file_size"),
            F.col("_metadata.file_modification_time").alias("_file_modified"),
        )
        parts.append(files.load_audit(df))
    a = parts[0].unionByName(parts[1])
    return present(
        a.select(F.regexp_extract("file_path", r"([^/]+)$", 1).alias("file_name"), "rows_loaded", "rows_rejected")
    )


# ---------------------------------------------------------------------------
# GOV-1 … GOV-3 (policy naming two stand-in wells for the viewer role)
# ---------------------------------------------------------------------------

STANDIN_VIEWER_WELLS = ("Supplier#000000001", "Supplier#000000015")
STANDIN_POLICY = governance.Policy(
    full_access=frozenset(FULL_ACCESS_ROLES), restricted={VIEWER_ROLE: STANDIN_VIEWER_WELLS}
)
_IN = ", ".join(f"'{w}'" for w in STANDIN_VIEWER_WELLS)


@register(
    "gov_row_filter",
    oracle(f"SELECT * REPLACE (CAST(NULL AS DECIMAL(18,5)) AS avg_whp) FROM fact WHERE well_name IN ({_IN})",
           FACT_KINDS, FACT_DIGITS),
)
def q_gov_rows(p: Pipeline) -> DataFrame:
    """GOV-1/GOV-2: the fact as the partner viewer sees it."""
    return present(governance.governed(p.fact, VIEWER_ROLE, STANDIN_POLICY), FACT_DIGITS)


@register(
    "gov_mask",
    oracle(
        f"""SELECT * REPLACE (CAST(NULL AS DECIMAL(38,6)) AS benchmark_revenue_usd,
                              CAST(NULL AS DECIMAL(38,6)) AS benchmark_revenue_nok)
            FROM ({DECOMP_SQL}) d""",
        DECOMP_KINDS, {**MONEY2, **PRICE4},
    ),
)
def q_gov_mask(p: Pipeline) -> DataFrame:
    """GOV-2: revenue decomposition with masked revenue columns (viewer)."""
    return present(governance.mask_columns(p.decomposition, VIEWER_ROLE, STANDIN_POLICY), {**MONEY2, **PRICE4})


@register(
    "gov_compare",
    oracle(
        f"""WITH roles AS (SELECT * FROM (VALUES ('ENGINEER'), ('{VIEWER_ROLE}'), ('UNKNOWN')) t(role)),
                 full_access AS (SELECT * FROM (VALUES {", ".join(f"('{r}')" for r in FULL_ACCESS_ROLES)}) t(role))
            SELECT r.role,
                   COUNT(DISTINCT f.well_name) AS wells_visible, COUNT(f.prod_date) AS rows_visible,
                   COUNT(CASE WHEN r.role IN (SELECT role FROM full_access) THEN f.avg_whp END) AS avg_whp_visible
            FROM roles r LEFT JOIN fact f
              ON r.role IN (SELECT role FROM full_access)
                 OR (r.role = '{VIEWER_ROLE}' AND f.well_name IN ({_IN}))
            GROUP BY r.role""",
        [("role", "keep"), ("wells_visible", "int"), ("rows_visible", "int"), ("avg_whp_visible", "int")],
    ),
)
def q_gov_compare(p: Pipeline) -> DataFrame:
    """GOV-3: the same summary as three roles."""
    return present(governance.compare_roles(p.fact, ["ENGINEER", VIEWER_ROLE, "UNKNOWN"], STANDIN_POLICY))


# ---------------------------------------------------------------------------
# FIL-2 batch split (DQ-9 batch counts) and SO-2 top-k
# ---------------------------------------------------------------------------

STANDIN_SPLIT_DATE = "1998-01-01"  # splits the stand-in years roughly in half


@register(
    "dq_batches",
    oracle(
        f"""SELECT CASE WHEN prod_date < DATE '{STANDIN_SPLIT_DATE}' THEN 'first' ELSE 'second' END AS batch,
                   COUNT(*) AS silver_rows, COUNT_IF(is_shutin) AS shutin_days,
                   MIN(prod_date) AS first_date, MAX(prod_date) AS last_date
            FROM ({SILVER_DAILY_SQL}) s GROUP BY 1""",
        [("batch", "keep"), ("silver_rows", "int"), ("shutin_days", "int"), ("first_date", "keep"),
         ("last_date", "keep")],
    ),
)
def q_batches(p: Pipeline) -> DataFrame:
    """FIL-2 / DQ-9: the two load batches of silver, split at a date."""
    rows, _ = p.silver_daily
    first = F.col("prod_date") < F.lit(STANDIN_SPLIT_DATE).cast("date")
    return present(rows.groupBy(F.when(first, "first").otherwise("second").alias("batch")).agg(
        F.count(F.lit(1)).alias("silver_rows"),
        F.count_if("is_shutin").alias("shutin_days"),
        F.min("prod_date").alias("first_date"),
        F.max("prod_date").alias("last_date"),
    ))


@register(
    "top_wells",
    oracle(
        """SELECT well_name, SUM(est_revenue_usd) AS cumulative_revenue_usd, COUNT(*) AS producing_days
           FROM fact GROUP BY well_name
           ORDER BY cumulative_revenue_usd DESC NULLS LAST, well_name LIMIT 10""",
        [("well_name", "keep"), ("cumulative_revenue_usd", "dec"), ("producing_days", "int")],
        {"cumulative_revenue_usd": 2},
    ),
)
def q_top_wells(p: Pipeline) -> DataFrame:
    """SO-2: top-10 wells by value (the limit is the report; planned as
    TakeOrderedAndProject, a per-partition top-k then a final merge)."""
    t = p.fact.groupBy("well_name").agg(
        F.sum("est_revenue_usd").alias("cumulative_revenue_usd"), F.count(F.lit(1)).alias("producing_days")
    )
    top = t.orderBy(F.col("cumulative_revenue_usd").desc_nulls_last(), F.col("well_name")).limit(10)
    return present(top, {"cumulative_revenue_usd": 2})


# ---------------------------------------------------------------------------
# The reference's own verification queries: FX gaps by weekday, fact checks,
# latest dates (REF-4)
# ---------------------------------------------------------------------------


@register(
    "dq_fx_gaps",
    oracle(
        """SELECT left(dayname(p.prod_date), 3) AS day_of_week, COUNT(*) AS null_fx_rows
           FROM well_day p LEFT JOIN fx f ON p.prod_date = f.rate_date
           WHERE f.nok_per_usd IS NULL AND p.well_type = 'OP' GROUP BY 1""",
        [("day_of_week", "keep"), ("null_fx_rows", "int")],
    ),
)
def q_fx_gaps(p: Pipeline) -> DataFrame:
    """DQ-8: producer rows without an FX rate on their day, by weekday."""
    return present(quality.price_gaps(p.well_day, p.fx, price_date="rate_date", value="nok_per_usd",
                                      out="null_fx_rows"))


@register(
    "dq_fact_checks",
    oracle(
        """SELECT COUNT(*) AS fact_rows, MAX(prod_date) AS latest_date,
                  COUNT_IF(brent_usd_bbl_filled IS NULL) AS null_price, COUNT_IF(nok_per_usd IS NULL) AS null_fx,
                  (SELECT COUNT_IF(brent_usd_bbl_filled IS NULL) FROM price_filled) AS null_after_fill
           FROM fact""",
        [("fact_rows", "int"), ("latest_date", "keep"), ("null_price", "int"), ("null_fx", "int"),
         ("null_after_fill", "int")],
    ),
)
def q_fact_checks(p: Pipeline) -> DataFrame:
    """DQ-9 / DQ-15: fact rows, latest date, rows without price or FX, and
    NULLs left after the fill."""
    fill_nulls = p.price_filled.agg(F.count_if(F.col("brent_usd_bbl_filled").isNull()).alias("n")).scalar()
    return present(p.fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.max("prod_date").alias("latest_date"),
        F.count_if(F.col("brent_usd_bbl_filled").isNull()).alias("null_price"),
        F.count_if(F.col("nok_per_usd").isNull()).alias("null_fx"),
        fill_nulls.alias("null_after_fill"),
    ))


@register(
    "latest_dates",
    oracle(
        f"""SELECT (SELECT MAX(prod_date) FROM fact) AS latest_fact_date,
                   (SELECT MAX(month_start) FROM ({DECOMP_SQL}) d) AS latest_decomposition_month""",
        [("latest_fact_date", "keep"), ("latest_decomposition_month", "keep")],
    ),
)
def q_latest_dates(p: Pipeline) -> DataFrame:
    """REF-4: proof of refresh, newest fact date and decomposition month."""
    latest_month = p.decomposition.agg(F.max("month_start")).scalar()
    return present(p.fact.agg(F.max("prod_date").alias("latest_fact_date")).select(
        "latest_fact_date", latest_month.alias("latest_decomposition_month")
    ))


# ---------------------------------------------------------------------------
# DQ-1 / DQ-5 on the monthly source (units row excluded)
# ---------------------------------------------------------------------------

MONTHLY_PROFILE_COLS = ["wellbore_name", "year", "month", "on_stream_hrs", "oil_sm3", "gas_sm3", "water_sm3", "gi_sm3"]
MONTHLY_NEG_COLS = ["on_stream_hrs", "oil_sm3", "gas_sm3", "water_sm3"]
_NOT_UNITS = "wellbore_name != '' AND npd_code != ''"


@register(
    "dq_null_profile_monthly",
    oracle(
        f"""SELECT column_name, COUNT(*) AS total_rows, COUNT_IF(cell IS NULL) AS null_count
            FROM (SELECT * FROM bronze_monthly WHERE {_NOT_UNITS}) rows
            UNPIVOT INCLUDE NULLS (cell FOR column_name IN ({", ".join(MONTHLY_PROFILE_COLS)})) GROUP BY column_name""",
        [("column_name", "keep"), ("total_rows", "int"), ("null_count", "int")],
    ),
)
def q_null_profile_monthly(p: Pipeline) -> DataFrame:
    """DQ-1: NULL counts of the monthly source, its units row excluded."""
    rows = p.bronze_monthly.where((F.col("wellbore_name") != "") & (F.col("npd_code") != ""))
    return present(quality.null_profile(rows, MONTHLY_PROFILE_COLS))


@register(
    "dq_negatives_monthly",
    oracle(
        " UNION ALL ".join(
            # COUNT(CASE …): DuckDB's COUNT_IF gives NULL when every predicate is NULL
            f"SELECT '{c}' AS column_name, COUNT(CASE WHEN TRY_CAST({c} AS DECIMAL(18,4)) < 0 THEN 1 END) "
            f"AS negative_count FROM bronze_monthly" for c in MONTHLY_NEG_COLS
        ),
        [("column_name", "keep"), ("negative_count", "int")],
    ),
)
def q_negatives_monthly(p: Pipeline) -> DataFrame:
    """DQ-5: negative values in the monthly source, one pass."""
    return present(quality.negatives(p.bronze_monthly, MONTHLY_NEG_COLS))


@register(
    "dq_duplicates_monthly",
    oracle(
        """SELECT DISTINCT wellbore_name, month, year, n FROM (
             SELECT *, COUNT(*) OVER (PARTITION BY year, month, wellbore_name) AS n FROM bronze_monthly) counted
           WHERE n <> 1""",
        [("wellbore_name", "keep"), ("month", "keep"), ("year", "keep"), ("n", "int")],
    ),
)
def q_duplicates_monthly(p: Pipeline) -> DataFrame:
    """DQ-2: (well, month, year) keys of the monthly source loaded more than once."""
    return present(quality.duplicate_keys(p.bronze_monthly, ["wellbore_name", "month", "year"]))


@register(
    "payload_types",
    oracle(
        """SELECT 'object' AS top_level_type, COUNT(*) AS payloads FROM (
             SELECT DISTINCT CAST(floor(event_id / 5000) AS BIGINT) AS page FROM events
             UNION SELECT CAST(floor(event_id / 5000) AS BIGINT) - 1 FROM events
                   WHERE event_id % 5000 = 0 AND event_id > 0) p
           UNION ALL
           SELECT 'array', COUNT(DISTINCT date_trunc('month', rate_date)) FROM fx""",
        [("top_level_type", "keep"), ("payloads", "int")],
    ),
)
def q_payload_types(p: Pipeline) -> DataFrame:
    """SRC-7: payloads per top-level JSON type (object pages, array documents)."""
    shapes = payloads.payload_shape(p.event_pages.select("raw").unionByName(p.fx_payloads.select("raw")))
    return present(shapes.groupBy("top_level_type").agg(F.sum("payloads").alias("payloads")))
