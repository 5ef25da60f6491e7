"""Stand-in inputs built from the driver tables.

The production, price and FX data the operators were designed for is not
available, so each input is derived from the TPC-H-like driver tables with the
same shape (see SURVEY §7.3). Each builder reads only the columns it needs, so
Catalyst prunes the Parquet scan; ``STANDIN_SQL`` is the same definition as
DuckDB SQL CTEs, used by ``oracle_sql()``.

Money and volume columns are DECIMAL so that sums are exact in both engines.

| stand-in          | from                                                    |
| ----------------- | ------------------------------------------------------- |
| well_day          | lineitem by (l_suppkey, ship day); names via supplier    |
| price             | orders on weekdays: lowest order total of the day        |
| fx                | orders: highest order total of the day / 100000          |
| monthly_reported  | lineitem by supplier, year, month; line 7 counts half    |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import shutin_flag
from ..functions.constants import DAILY_DECIMAL

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


UNNAMED_WELL = 7
#: Lines that one task of the daily aggregate takes; about 250 bytes each in its hash table.
TASK_LINES = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def well_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """well_id, well_name, facility_name, field_name.

    nation (25 rows) and region (5 rows) are fixed-size, so broadcasting them
    is always safe; supplier grows with the data and is left to the planner.
    """
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey)
        .join(F.broadcast(reg), nat.n_regionkey == reg.r_regionkey)
        .select(
            F.col("s_suppkey").alias("well_id"),
            # one well without a name: results must keep its rows
            F.when(F.col("s_suppkey") != UNNAMED_WELL, F.col("s_name")).alias("well_name"),
            F.col("n_name").alias("facility_name"),
            F.col("r_name").alias("field_name"),
        )
    )


def _flag_volume(flag: str) -> F.Column:
    return F.sum(F.when(F.col("l_returnflag") == flag, F.col("l_quantity")).otherwise(F.lit(0.0))).cast(
        DAILY_DECIMAL
    )


def _max_flag_is(flag: str) -> F.Column:
    """``MAX(l_returnflag) = flag`` from integer aggregates: a string MAX
    makes Spark fall back to a sort-based aggregate over all of lineitem,
    integer MAX stays in the hash aggregate."""
    rf = F.col("l_returnflag")
    return (F.max((rf > F.lit(flag)).cast("int")) == 0) & (F.max((rf == F.lit(flag)).cast("int")) == 1)


def well_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver daily production stand-in: one row per (well, day).

    well_type is WI when any line of the day has flag R, else OP; oil, gas,
    water are the quantities with flag N, R, A. A producer day without oil is
    shut in (the stand-in has no hours, and water is always present).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_returnflag", "l_quantity", "l_discount", "l_tax", "l_extendedprice"
    )
    # nearly every line is a group of its own, so partial sums before the shuffle would only
    # hold a whole file split in memory: lines are brought together first, in bounded tasks
    tasks = -(-li.count() // TASK_LINES)
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        li = li.repartition(tasks, "l_suppkey")
    daily = li.groupBy(
        F.col("l_suppkey").alias("well_id"), F.to_date("l_shipdate").alias("prod_date")
    ).agg(
        _max_flag_is("R").alias("_is_wi"),
        _flag_volume("N").alias("oil_vol_sm3"),
        _flag_volume("R").alias("gas_vol_sm3"),
        _flag_volume("A").alias("water_vol_sm3"),
        (F.avg("l_discount") * 100).cast(DAILY_DECIMAL).alias("avg_choke_size"),
        (F.avg("l_tax") * 100).cast(DAILY_DECIMAL).alias("avg_whp"),
        (F.max("l_extendedprice") / 1000).cast(DAILY_DECIMAL).alias("dp_choke_size"),
    )
    daily = daily.withColumn("well_type", F.when(F.col("_is_wi"), F.lit("WI")).otherwise(F.lit("OP"))).drop("_is_wi")
    return daily.join(well_names(spark, sf_dir), "well_id").withColumn(
        "is_shutin", shutin_flag("well_type", ["oil_vol_sm3"])
    )


def price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily benchmark price on weekdays only; weekends are true gaps."""
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    d = F.to_date("o_orderdate")
    return (
        o.where(F.weekday(d) < 5)
        .groupBy(d.alias("price_date"))
        .agg(F.min("o_totalprice").cast("decimal(18,2)").alias("brent_usd_bbl"))
    )


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily NOK per USD on every order date; other dates have no rate."""
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    return o.groupBy(F.to_date("o_orderdate").alias("rate_date")).agg(
        (F.max("o_totalprice").cast("decimal(18,2)") / F.lit(100000)).cast("decimal(12,7)").alias("nok_per_usd")
    )


def monthly_reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second source that differs: line 7 counts half, every tenth well is
    spelled in capitals."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_returnflag", "l_quantity", "l_linenumber"
    )
    quantity = F.col("l_quantity") * F.when(F.col("l_linenumber") == 7, F.lit(0.5)).otherwise(F.lit(1.0))
    m = (
        li.withColumn("l_quantity", quantity)
        .groupBy(
            F.col("l_suppkey").alias("well_id"),
            F.year("l_shipdate").alias("prod_year"),
            F.month("l_shipdate").alias("prod_month"),
        )
        .agg(_flag_volume("N").alias("oil_sm3"), _flag_volume("R").alias("gas_sm3"))
    )
    name = F.when(F.col("well_id") % 10 == 4, F.upper("well_name")).otherwise(F.col("well_name"))
    return m.join(well_names(spark, sf_dir), "well_id").select(
        name.alias("well_name"), "prod_year", "prod_month", "oil_sm3", "gas_sm3"
    )


# The same stand-ins as DuckDB SQL (CTE bodies), for oracle_sql().
STANDIN_SQL = {
    "names": """
        SELECT s.s_suppkey AS well_id, CASE WHEN s.s_suppkey <> 7 THEN s.s_name END AS well_name,
               n.n_name AS facility_name, r.r_name AS field_name
        FROM supplier s
        JOIN nation n ON s.s_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "well_day": """
        SELECT d.*, nm.well_name, nm.facility_name, nm.field_name,
               CASE WHEN d.well_type = 'OP' AND COALESCE(d.oil_vol_sm3, 0) = 0
                    THEN TRUE ELSE FALSE END AS is_shutin
        FROM (
          SELECT l_suppkey AS well_id, CAST(l_shipdate AS DATE) AS prod_date,
                 CASE WHEN MAX(l_returnflag) = 'R' THEN 'WI' ELSE 'OP' END AS well_type,
                 CAST(SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) AS DECIMAL(18,5)) AS oil_vol_sm3,
                 CAST(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS DECIMAL(18,5)) AS gas_vol_sm3,
                 CAST(SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS DECIMAL(18,5)) AS water_vol_sm3,
                 CAST(AVG(l_discount) * 100 AS DECIMAL(18,5)) AS avg_choke_size,
                 CAST(AVG(l_tax) * 100 AS DECIMAL(18,5)) AS avg_whp,
                 CAST(MAX(l_extendedprice) / 1000 AS DECIMAL(18,5)) AS dp_choke_size
          FROM lineitem
          GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
        ) d JOIN names nm ON d.well_id = nm.well_id""",
    "price": """
        SELECT CAST(o_orderdate AS DATE) AS price_date,
               CAST(MIN(o_totalprice) AS DECIMAL(18,2)) AS brent_usd_bbl
        FROM orders
        WHERE isodow(CAST(o_orderdate AS DATE)) < 6
        GROUP BY CAST(o_orderdate AS DATE)""",
    "fx": """
        SELECT CAST(o_orderdate AS DATE) AS rate_date,
               CAST(CAST(MAX(o_totalprice) AS DECIMAL(18,2)) / 100000 AS DECIMAL(12,7)) AS nok_per_usd
        FROM orders
        GROUP BY CAST(o_orderdate AS DATE)""",
    "monthly_reported": """
        SELECT CASE WHEN m.well_id % 10 = 4 THEN upper(nm.well_name) ELSE nm.well_name END AS well_name,
               m.prod_year, m.prod_month, m.oil_sm3, m.gas_sm3
        FROM (
          SELECT l_suppkey AS well_id, CAST(year(l_shipdate) AS INTEGER) AS prod_year,
                 CAST(month(l_shipdate) AS INTEGER) AS prod_month,
                 CAST(SUM(CASE WHEN l_returnflag = 'N' THEN q ELSE 0 END) AS DECIMAL(18,5)) AS oil_sm3,
                 CAST(SUM(CASE WHEN l_returnflag = 'R' THEN q ELSE 0 END) AS DECIMAL(18,5)) AS gas_sm3
          FROM (SELECT *, l_quantity * CASE WHEN l_linenumber = 7 THEN 0.5 ELSE 1.0 END AS q FROM lineitem) halved
          GROUP BY 1, 2, 3
        ) m JOIN names nm ON m.well_id = nm.well_id""",
    # TS-1 by two as-of joins: the last known price on or before the day, else
    # the first one after it; only prices dated on a production day count.
    "price_filled": """
        SELECT s.cal_date, COALESCE(b.v, a.v) AS brent_usd_bbl_filled
        FROM (SELECT DISTINCT prod_date AS cal_date FROM well_day) s
        ASOF LEFT JOIN (SELECT price_date AS d, brent_usd_bbl AS v FROM price
                        WHERE price_date IN (SELECT prod_date FROM well_day)) b ON s.cal_date >= b.d
        ASOF LEFT JOIN (SELECT price_date AS d, brent_usd_bbl AS v FROM price
                        WHERE price_date IN (SELECT prod_date FROM well_day)) a ON s.cal_date <= a.d""",
    # computed in stages: producers with their day's price and rate, barrels, value
    "fact": """
        SELECT prod_date, well_name, well_type, oil_vol_sm3, oil_vol_bbl, gas_vol_sm3, water_vol_sm3, avg_choke_size,
               dp_choke_size, avg_whp, is_shutin, brent_usd_bbl_filled, nok_per_usd,
               CASE WHEN liquid <> 0 THEN CAST(water_vol_sm3 AS DOUBLE) / CAST(liquid AS DOUBLE) END AS water_cut,
               est_revenue_usd, CAST(est_revenue_usd * nok_per_usd AS DECIMAL(38,6)) AS est_revenue_nok
        FROM (
          SELECT *, CAST(oil_vol_bbl * brent_usd_bbl_filled AS DECIMAL(38,6)) AS est_revenue_usd
          FROM (
            SELECT *, CAST(oil_vol_sm3 AS DECIMAL(38,5)) * 6.2898 AS oil_vol_bbl, oil_vol_sm3 + water_vol_sm3 AS liquid
            FROM (FROM well_day WHERE well_type = 'OP') producers
            LEFT JOIN (SELECT cal_date AS prod_date, brent_usd_bbl_filled FROM price_filled) USING (prod_date)
            LEFT JOIN (SELECT rate_date AS prod_date, nok_per_usd FROM fx) USING (prod_date)) staged) valued""",
}

STANDIN_ORDER = ("names", "well_day", "price", "fx", "monthly_reported", "price_filled", "fact")


def standin_ctes() -> str:
    """All stand-in CTEs, in dependency order, for a ``WITH`` list."""
    return ",\n".join(f"{name} AS ({STANDIN_SQL[name]})" for name in STANDIN_ORDER)


# ---------------------------------------------------------------------------
# Untyped bronze stand-ins (all STRING), with deliberate defects.
# A defect code k = (well_id * 31 + day number) mod 97 picks which value of a
# row is damaged; every row is kept, and rows with k = 10 appear twice (a
# duplicated key for DQ-2).
# ---------------------------------------------------------------------------


def _s(c: str) -> F.Column:
    return F.col(c).cast("string")


def bronze_daily(spark: SparkSession, sf_dir: str, daily: DataFrame | None = None) -> DataFrame:
    """Raw daily production as the CSV load leaves it: 24 text columns.
    ``daily``: an already stored ``well_day`` to derive it from."""
    from ..functions.cleaning import null_tokens
    from ..operators.silver import RAW_DAILY

    w = daily if daily is not None else well_day(spark, sf_dir)
    k = F.pmod(F.col("well_id") * 31 + F.datediff("prod_date", F.lit("1970-01-01").cast("date")), F.lit(97))
    w = w.withColumn("_k", k)

    def when_k(cases: dict[int, F.Column], default: F.Column) -> F.Column:
        out = default
        for code, val in reversed(list(cases.items())):
            out = F.when(F.col("_k") == code, val).otherwise(out)
        return out

    third = F.pmod(F.col("_k"), F.lit(3)) == 0
    raw = w.select(
        when_k({0: F.date_format("prod_date", "dd-MM-yy"), 1: F.lit("not a date")}, _s("prod_date")).alias("dateprd"),
        F.concat(F.lit("NO "), _s("well_id")).alias("well_bore_code"),
        _s("well_id").alias("npd_well_bore_code"),
        F.col("well_name").alias("npd_well_bore_name"),
        F.upper("field_name").alias("npd_field_code"),
        F.col("field_name").alias("npd_field_name"),
        F.upper("facility_name").alias("npd_facility_code"),
        F.col("facility_name").alias("npd_facility_name"),
        when_k({11: F.lit("NaN")}, F.when(F.col("is_shutin"), F.lit("0")).otherwise(F.lit("24"))).alias("on_stream_hrs"),
        F.when(third, F.lit(None).cast("string")).otherwise(_s("avg_whp")).alias("avg_downhole_pressure"),
        F.when(third, F.lit(None).cast("string")).otherwise(_s("avg_choke_size")).alias("avg_downhole_temperature"),
        F.when(third, F.lit(None).cast("string")).otherwise(_s("dp_choke_size")).alias("avg_dp_tubing"),
        F.when(F.pmod(F.col("_k"), F.lit(5)) == 0, F.lit("")).otherwise(_s("avg_whp")).alias("avg_annulus_press"),
        when_k({12: F.concat(F.lit("-"), _s("avg_choke_size"))}, _s("avg_choke_size")).alias("avg_choke_size_p"),
        F.lit("%").alias("avg_choke_uom"),
        _s("avg_whp").alias("avg_whp_p"),
        F.when(F.pmod(F.col("_k"), F.lit(4)) == 0, F.lit("NULL")).otherwise(_s("avg_choke_size")).alias("avg_wht_p"),
        _s("dp_choke_size").alias("dp_choke_size"),
        when_k({2: F.lit("bad"), 3: F.lit(""), 4: F.lit("NaN"), 5: F.lit("NULL"),
                6: F.concat(F.lit("-"), _s("oil_vol_sm3"))}, _s("oil_vol_sm3")).alias("bore_oil_vol"),
        when_k({7: F.lit("n/a")}, _s("gas_vol_sm3")).alias("bore_gas_vol"),
        when_k({8: F.lit("")}, _s("water_vol_sm3")).alias("bore_wat_vol"),
        when_k({13: F.lit("x1")}, F.when(F.col("well_type") == "WI", _s("gas_vol_sm3"))).alias("bore_wi_vol"),
        F.when(F.col("well_type") == "WI", F.lit("injection")).otherwise(F.lit("production")).alias("flow_kind"),
        when_k({9: F.concat(F.lit(" "), F.col("well_type"))}, F.col("well_type")).alias("well_type"),
        F.col("_k"),
    )
    loaded = raw.select(*[null_tokens(c).alias(c) for c in RAW_DAILY], "_k")
    # rows with k = 10 are loaded twice; an explode keeps one partition layout
    copies = F.explode(F.when(F.col("_k") == 10, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return loaded.select("*", copies.alias("_copy")).drop("_k", "_copy")


def bronze_monthly(spark: SparkSession, sf_dir: str, monthly: DataFrame | None = None) -> DataFrame:
    """Raw monthly production (10 text columns) with its units row, negative
    and unreadable volumes in some months and rows loaded twice in others."""
    m = monthly if monthly is not None else monthly_reported(spark, sf_dir)
    n = F.col("prod_year") * 12 + F.col("prod_month")
    oil = F.when(n % 17 == 3, F.concat(F.lit("-"), _s("oil_sm3"))).otherwise(_s("oil_sm3"))
    gas = F.when(n % 29 == 7, F.lit("bad")).otherwise(_s("gas_sm3"))
    copies = F.when(n % 23 == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = m.select("*", F.explode(copies).alias("_copy")).select(
        F.col("well_name").alias("wellbore_name"),
        F.upper("well_name").alias("npd_code"),
        _s("prod_year").alias("year"),
        _s("prod_month").alias("month"),
        F.lit(None).cast("string").alias("on_stream_hrs"),
        oil.alias("oil_sm3"),
        gas.alias("gas_sm3"),
        F.lit(None).cast("string").alias("water_sm3"),
        F.lit(None).cast("string").alias("gi_sm3"),
        F.lit(None).cast("string").alias("wi_sm3"),
    )
    units = spark.createDataFrame(
        [(None, "", "", "", "hrs", "Sm3", "Sm3", "Sm3", "Sm3", "Sm3")], rows.schema
    )
    return rows.unionByName(units)


def event_pages(spark: SparkSession, sf_dir: str, page_size: int = 5000) -> DataFrame:
    """Paged JSON payloads built from ``events``, as a paged API returns them.

    Page p holds events p*page_size … (p+1)*page_size inclusive, so adjacent
    pages overlap by one record; every page reports the series total. Pages
    are bounded by ``page_size``, so no payload grows with the data.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    total = ev.agg(F.count(F.lit(1))).scalar()
    page = F.floor(F.col("event_id") / page_size).cast("bigint")
    on_edge = (F.pmod(F.col("event_id"), F.lit(page_size)) == 0) & (F.col("event_id") > 0)
    pages = F.when(on_edge, F.array(page, page - 1)).otherwise(F.array(page))
    rec = F.struct(
        F.col("event_id").alias("id"),
        _s("ts").alias("period"),
        _s("value").alias("value"),
        F.col("event_type").alias("series-description"),
        F.lit("$/BBL").alias("units"),
    )
    docs = ev.select(F.explode(pages).alias("page"), rec.alias("rec")).groupBy("page").agg(
        F.sort_array(F.collect_list("rec")).alias("data"), F.count(F.lit(1)).alias("n")
    )
    body = F.struct(F.struct(total.alias("total"), F.lit("daily").alias("frequency"), F.col("data")).alias("response"))
    return docs.select("page", F.parse_json(F.to_json(body)).alias("raw"))


def fx_payloads(spark: SparkSession, sf_dir: str, rates: DataFrame | None = None) -> DataFrame:
    """FX as top-level JSON arrays, one document per calendar month (at most
    31 records each), built from the ``fx`` stand-in."""
    f = rates if rates is not None else fx(spark, sf_dir)
    rec = F.struct(_s("rate_date").alias("date"), F.col("nok_per_usd").alias("rate"))
    docs = f.groupBy(F.trunc("rate_date", "month").alias("month")).agg(F.sort_array(F.collect_list(rec)).alias("a"))
    return docs.select("month", F.parse_json(F.to_json("a")).alias("raw"))


_BRONZE_DAILY_SQL = """
  WITH w AS (SELECT *, (well_id * 31 + (prod_date - DATE '1970-01-01')) % 97 AS k FROM well_day),
  r AS (
    SELECT
      CASE k WHEN 0 THEN strftime(prod_date, '%d-%m-%y') WHEN 1 THEN 'not a date'
             ELSE CAST(prod_date AS VARCHAR) END AS dateprd,
      'NO ' || CAST(well_id AS VARCHAR) AS well_bore_code,
      CAST(well_id AS VARCHAR) AS npd_well_bore_code,
      well_name AS npd_well_bore_name,
      upper(field_name) AS npd_field_code,
      field_name AS npd_field_name,
      upper(facility_name) AS npd_facility_code,
      facility_name AS npd_facility_name,
      CASE WHEN k = 11 THEN 'NaN' WHEN is_shutin THEN '0' ELSE '24' END AS on_stream_hrs,
      CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(avg_whp AS VARCHAR) END AS avg_downhole_pressure,
      CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(avg_choke_size AS VARCHAR) END AS avg_downhole_temperature,
      CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(dp_choke_size AS VARCHAR) END AS avg_dp_tubing,
      CASE WHEN k % 5 = 0 THEN '' ELSE CAST(avg_whp AS VARCHAR) END AS avg_annulus_press,
      CASE WHEN k = 12 THEN '-' || CAST(avg_choke_size AS VARCHAR) ELSE CAST(avg_choke_size AS VARCHAR) END
        AS avg_choke_size_p,
      '%' AS avg_choke_uom,
      CAST(avg_whp AS VARCHAR) AS avg_whp_p,
      CASE WHEN k % 4 = 0 THEN 'NULL' ELSE CAST(avg_choke_size AS VARCHAR) END AS avg_wht_p,
      CAST(dp_choke_size AS VARCHAR) AS dp_choke_size,
      CASE k WHEN 2 THEN 'bad' WHEN 3 THEN '' WHEN 4 THEN 'NaN' WHEN 5 THEN 'NULL'
             WHEN 6 THEN '-' || CAST(oil_vol_sm3 AS VARCHAR) ELSE CAST(oil_vol_sm3 AS VARCHAR) END AS bore_oil_vol,
      CASE WHEN k = 7 THEN 'n/a' ELSE CAST(gas_vol_sm3 AS VARCHAR) END AS bore_gas_vol,
      CASE WHEN k = 8 THEN '' ELSE CAST(water_vol_sm3 AS VARCHAR) END AS bore_wat_vol,
      CASE WHEN k = 13 THEN 'x1' WHEN well_type = 'WI' THEN CAST(gas_vol_sm3 AS VARCHAR) END AS bore_wi_vol,
      CASE WHEN well_type = 'WI' THEN 'injection' ELSE 'production' END AS flow_kind,
      CASE WHEN k = 9 THEN ' ' || well_type ELSE well_type END AS well_type,
      k
    FROM w),
  l AS (SELECT {nulls}, k FROM r)
  SELECT * EXCLUDE (k) FROM l UNION ALL SELECT * EXCLUDE (k) FROM l WHERE k = 10"""


def _null_map(cols) -> str:
    return ", ".join(f"CASE WHEN {c} IN ('', 'NULL', 'NaN') THEN NULL ELSE {c} END AS {c}" for c in cols)


def _bronze_daily_sql() -> str:
    from ..operators.silver import RAW_DAILY

    return _BRONZE_DAILY_SQL.replace("{nulls}", _null_map(RAW_DAILY))


STANDIN_SQL["bronze_daily"] = _bronze_daily_sql()
STANDIN_SQL["bronze_monthly"] = """
        SELECT well_name AS wellbore_name, upper(well_name) AS npd_code,
               CAST(prod_year AS VARCHAR) AS year, CAST(prod_month AS VARCHAR) AS month,
               CAST(NULL AS VARCHAR) AS on_stream_hrs,
               CASE WHEN (prod_year * 12 + prod_month) % 17 = 3 THEN '-' || CAST(oil_sm3 AS VARCHAR)
                    ELSE CAST(oil_sm3 AS VARCHAR) END AS oil_sm3,
               CASE WHEN (prod_year * 12 + prod_month) % 29 = 7 THEN 'bad' ELSE CAST(gas_sm3 AS VARCHAR) END AS gas_sm3,
               CAST(NULL AS VARCHAR) AS water_sm3, CAST(NULL AS VARCHAR) AS gi_sm3, CAST(NULL AS VARCHAR) AS wi_sm3
        FROM monthly_reported, range(CASE WHEN (prod_year * 12 + prod_month) % 23 = 5 THEN 2 ELSE 1 END) copies
        UNION ALL SELECT NULL, '', '', '', 'hrs', 'Sm3', 'Sm3', 'Sm3', 'Sm3', 'Sm3'"""
STANDIN_ORDER = STANDIN_ORDER + ("bronze_daily", "bronze_monthly")
