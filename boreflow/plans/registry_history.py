"""Registered queries over tables that change: type-2 versions kept current through
late months (DIM-3), corrections applied to silver and gold (SNK-2, REF-6), earlier
versions of a table (SNK-1, SNK-3), loads with a ledger (SRC-1, SRC-4), the policy
table (GOV-1) and repaired names (PRJ-8). All run over the whole driver tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import month_start, repair_mojibake
from ..operators import fingerprint, governance
from ..sources.ledger import LoadLedger
from ..sources.snapshots import SnapshotTable
from ..streaming import GoldRefresh, land_silver
from . import standin
from .pipeline import Pipeline
from .present import present
from .registry import DECOMP_KINDS, DECOMP_SQL, DOWNTIME_SQL, FACT_DIGITS, FACT_KINDS, MONEY2, MONTH, PRICE4, SCD2_SQL, oracle, register

# --- three batches, one of them a late month, then corrections -----------------------

SPLIT, LATE = "1998-01-01", "1995-06-01"
#: Restated: in one year, oil of the third day of every month, and producer rows of the ninth that were none.
RESTATED = "(year(prod_date) = 1996 AND (day(prod_date) = 3 OR (day(prod_date) = 9 AND well_type = 'OP')))"


def _restated(daily: DataFrame) -> DataFrame:
    rows = daily.where(F.expr(RESTATED))
    third = F.dayofmonth("prod_date") == 3
    return (
        rows.withColumn("oil_vol_sm3", F.when(third, F.col("oil_vol_sm3") + 1).otherwise(F.col("oil_vol_sm3")).cast(daily.schema["oil_vol_sm3"].dataType))
        .withColumn("is_shutin", F.lit(False))
        .withColumn("well_type", F.when(third, F.col("well_type")).otherwise(F.lit("WI")))
    )


def history(p: Pipeline) -> str:
    """Silver and gold after three batches (``before``), and the same with corrections (``after``)."""

    def write(path: str) -> None:
        daily = p.well_day.drop("well_id")
        late = F.trunc("prod_date", "month") == F.lit(LATE).cast("date")
        early = F.col("prod_date") < F.lit(SPLIT).cast("date")
        silver = SnapshotTable(p.spark, f"{path}/silver", ["month_start"])
        run = GoldRefresh(p.spark, silver, f"{path}/gold", f"{path}/checkpoint", p.price, p.fx)
        for batch in (early & ~late, ~early, late):
            land_silver(daily.where(batch), silver)
            run.run()
        run.scd2().write.parquet(f"{path}/scd2_before")
        run.restate(_restated(daily))

    return p.folder("history", write)


def corrected(p: Pipeline, name: str) -> DataFrame:
    return p.spark.read.parquet(f"{history(p)}/gold/{name}")


def _corrected(body: str) -> str:
    """``body`` over the fact of the corrected rows, all recomputed."""
    filled, fact = (standin.STANDIN_SQL[name].replace("well_day", "corrected") for name in ("price_filled", "fact"))
    return f"""WITH corrected AS (SELECT * REPLACE (
          CASE WHEN {RESTATED} AND day(prod_date) = 3 THEN oil_vol_sm3 + 1 ELSE oil_vol_sm3 END AS oil_vol_sm3,
          is_shutin AND NOT {RESTATED} AS is_shutin,
          CASE WHEN {RESTATED} AND day(prod_date) = 9 THEN 'WI' ELSE well_type END AS well_type) FROM well_day),
        price_filled AS ({filled}), fact AS ({fact}) SELECT * FROM ({body}) b"""


SCD2_KINDS = [(c, "keep") for c in ("well_name", "well_type", "field_name", "facility_name", "effective_start_date", "effective_end_date", "is_current")]


@register("refresh_scd2", oracle(SCD2_SQL, SCD2_KINDS))
def q_refresh_scd2(p: Pipeline) -> DataFrame:
    """DIM-3: type-2 versions after three batches, one of them a late month that splits versions."""
    return p.spark.read.parquet(f"{history(p)}/scd2_before").select(*[c for c, _ in SCD2_KINDS])


@register("refresh_scd2_keys", oracle(
    f"SELECT COUNT(*) AS versions, COUNT(*) AS keys, 0 AS keys_lost FROM ({SCD2_SQL}) v",
    [("versions", "int"), ("keys", "int"), ("keys_lost", "int")]))
def q_refresh_scd2_keys(p: Pipeline) -> DataFrame:
    """DIM-3: surrogate keys are unique, and a version that corrections left as it was kept its key."""
    before = p.spark.read.parquet(f"{history(p)}/scd2_before")
    same = ["well_name", "well_type", "field_name", "facility_name", "effective_start_date", "effective_end_date"]
    run = GoldRefresh(p.spark, SnapshotTable(p.spark, f"{history(p)}/silver", ["month_start"]), f"{history(p)}/gold", "", p.price, p.fx)
    after = run.scd2().select(F.struct(*same).alias("_v"), F.col("well_surrogate_key").alias("_key"))
    kept = before.withColumn("_v", F.struct(*same)).join(after, "_v")
    lost = kept.agg(F.count_if(F.col("well_surrogate_key") != F.col("_key"))).scalar()
    return present(before.agg(
        F.count(F.lit(1)).alias("versions"), F.countDistinct("well_surrogate_key").alias("keys"), lost.alias("keys_lost")))


def _restated_query(name: str, table: str, sql: str, kinds: list, digits: dict | None = None) -> None:
    def build(p: Pipeline) -> DataFrame:
        return present(corrected(p, table).select(*[c for c, _ in kinds]), digits)

    build.__doc__ = f"SNK-2: ``{table}`` after corrections equals a full recompute over the corrected rows."
    register(name, oracle(_corrected(sql), kinds, digits))(build)


_restated_query("refresh_restated_fact", "fact", "SELECT * FROM fact", FACT_KINDS, FACT_DIGITS)
_restated_query(
    "refresh_restated_decline", "decline_trend",
    f"""SELECT {MONTH} AS month_start, well_name, SUM(oil_vol_sm3) AS monthly_oil_vol, SUM(gas_vol_sm3) AS monthly_gas_vol,
        SUM(water_vol_sm3) AS monthly_water_vol, COUNT_IF(is_shutin) AS shutin_days_in_month FROM fact GROUP BY 1, 2""",
    [("month_start", "keep"), ("well_name", "keep"), ("monthly_oil_vol", "dec"), ("monthly_gas_vol", "dec"),
     ("monthly_water_vol", "dec"), ("shutin_days_in_month", "int")],
)
_restated_query("refresh_restated_downtime", "downtime_events", DOWNTIME_SQL,
                [("well_name", "keep"), ("event_start", "keep"), ("event_end", "keep"), ("duration_days", "int")])
_restated_query("refresh_restated_decomposition", "revenue_decomposition", DECOMP_SQL, DECOMP_KINDS, {**MONEY2, **PRICE4})


# --- versions of a table: SNK-1, SNK-3 -------------------------------------------------


def versions(p: Pipeline) -> SnapshotTable:
    """The daily rows up to 1997, then all of them, then all corrected."""

    def write(path: str) -> None:
        table = SnapshotTable(p.spark, path, ["month_start"])
        daily = p.well_day.drop("well_id").withColumn("month_start", month_start("prod_date"))
        table.replace(daily.where(F.year("prod_date") <= 1997))
        table.append(daily.where(F.year("prod_date") > 1997))
        table.upsert(_restated(daily), ["well_name", "prod_date"])

    return SnapshotTable(p.spark, p.folder("versions", write), ["month_start"])


def _yearly(rows: DataFrame) -> DataFrame:
    return present(rows.groupBy(F.year("prod_date").alias("year")).agg(
        F.count(F.lit(1)).alias("days"), F.sum("oil_vol_sm3").alias("oil"), F.count_if("is_shutin").alias("shutin_days")))


YEARLY = "SELECT year(prod_date) AS year, COUNT(*) AS days, SUM(oil_vol_sm3) AS oil, COUNT_IF(is_shutin) AS shutin_days FROM {} GROUP BY 1"
YEARLY_KINDS = [("year", "int"), ("days", "int"), ("oil", "dec"), ("shutin_days", "int")]


@register("table_latest", oracle(_corrected(YEARLY.format("corrected")), YEARLY_KINDS))
def q_table_latest(p: Pipeline) -> DataFrame:
    """SNK-1: the latest version, after a replace, an append and corrections."""
    return _yearly(versions(p).read())


@register("table_before_last", oracle(YEARLY.format("well_day WHERE year(prod_date) <= 1997"), YEARLY_KINDS))
def q_table_before_last(p: Pipeline) -> DataFrame:
    """SNK-3: the version before the last two changes, read as it was."""
    table = versions(p)
    return _yearly(table.read(table.versions()[-3]))


@register("table_changes", oracle(
    f"""SELECT year(prod_date) AS year, COUNT(*) AS restated, SUM(CASE WHEN day(prod_date) = 3 THEN 1 ELSE 0 END) AS oil_added FROM well_day
        WHERE {RESTATED} GROUP BY 1""", [("year", "int"), ("restated", "int"), ("oil_added", "dec")]))
def q_table_changes(p: Pipeline) -> DataFrame:
    """SNK-2: rows that corrections took out and put in, from the partitions that differ."""
    table = versions(p)
    changes = table.changes(*table.versions()[-2:])
    return present(changes.groupBy(F.year("prod_date").alias("year")).agg(
        F.count_if(F.col("_sign") > 0).alias("restated"),
        F.sum(F.when(F.col("_sign") > 0, F.col("oil_vol_sm3")).otherwise(-F.col("oil_vol_sm3"))).alias("oil_added")))


# --- loads with a ledger: SRC-1, SRC-4 -----------------------------------------------------

PART_ROWS = 500_000
LOAD_COLUMNS = ["prod_date", "well_name", "oil_vol_sm3"]


def loads(p: Pipeline) -> str:
    """Daily rows as CSV files by year (parts of about ``PART_ROWS``), every eleventh day cut short. The first load
    finds the years to 1997; before the second the others arrive and 1996 is
    written anew with its shut-in days only; a third load finds nothing."""

    def write(path: str) -> None:
        year = F.year("prod_date").alias("year")
        line = F.to_csv(F.struct(F.col("prod_date").cast("string").alias("prod_date"), "well_name", F.col("oil_vol_sm3").cast("string").alias("oil_vol_sm3")))
        text = F.when(F.dayofmonth("prod_date") == 11, F.col("prod_date").cast("string")).otherwise(line).alias("value")

        sizes = [r.n for r in p.well_day.groupBy(year).agg(F.count(F.lit(1)).alias("n")).collect()]
        years, parts = len(sizes), max(1, -(-max(sizes, default=0) // PART_ROWS))
        part = F.pmod(F.xxhash64("well_name", "prod_date"), F.lit(parts)).alias("part")

        def files(rows: DataFrame, folder: str) -> None:
            laid = rows.select(text, year, part)
            tasks = parts * years
            laid = laid.repartition(tasks, "year", "part") if tasks > int(p.spark.conf.get("spark.sql.shuffle.partitions")) else laid.repartition("year", "part")
            laid.write.mode("append").partitionBy("year", "part").text(folder)

        files(p.well_day.where(F.year("prod_date") <= 1997), f"{path}/in")
        ledger = LoadLedger(p.spark, f"{path}/out", LOAD_COLUMNS, header=False)
        ledger.load(f"{path}/in")
        p.spark.range(1).select(F.current_timestamp().alias("at")).write.parquet(f"{path}/between")
        files(p.well_day.where(F.year("prod_date") > 1997), f"{path}/in")
        files(p.well_day.where((F.year("prod_date") == 1996) & F.col("is_shutin")), f"{path}/new")
        _put(p, f"{path}/new/year=1996", f"{path}/in/year=1996")
        ledger.load(f"{path}/in")
        ledger.load(f"{path}/in")

    return p.folder("loads", write)


def _put(p: Pipeline, source: str, target: str) -> None:
    """The files below ``source`` take the places and names of those of the same part below
    ``target``; a part that ``source`` lacks becomes an empty file."""
    hadoop = p.spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(target).getFileSystem(p.spark.sparkContext._jsc.hadoopConfiguration())
    new, old = ({f.getPath().getParent().getName(): f.getPath() for f in fs.globStatus(hadoop.Path(f"{d}/part=*/part-*")) or []} for d in (source, target))
    for part, path in old.items():
        fs.delete(path, False)
        if part in new:
            fs.rename(new[part], path)
        else:
            fs.create(path, False).close()


def _ledger(p: Pipeline) -> LoadLedger:
    return LoadLedger(p.spark, f"{loads(p)}/out", LOAD_COLUMNS, header=False)


_LOADED = "COUNT_IF(day(prod_date) <> 11) AS rows_loaded, COUNT_IF(day(prod_date) = 11) AS rows_rejected FROM well_day"


def _counts() -> list[Column]:
    """The files of a year together."""
    return [F.sum(c).alias(c) for c in ("rows_loaded", "rows_rejected")]


def _year() -> Column:
    return F.regexp_extract("file_path", "year=([0-9]+)", 1).cast("int").alias("year")


@register("load_ledger", oracle(
    f"""SELECT year(prod_date) AS year, CASE WHEN year(prod_date) = 1996 THEN 'superseded' ELSE 'loaded' END AS status, {_LOADED} GROUP BY 1, 2
        UNION ALL SELECT 1996, 'loaded', {_LOADED} WHERE year(prod_date) = 1996 AND is_shutin""",
    [("year", "int"), ("status", "keep"), ("rows_loaded", "int"), ("rows_rejected", "int")]))
def q_load_ledger(p: Pipeline) -> DataFrame:
    """SRC-4: every load of every file; an unchanged file is loaded once, a changed one again."""
    return present(_ledger(p).entries().groupBy(_year(), "status").agg(*_counts()))


@register("load_history", oracle(
    f"""SELECT year(prod_date) AS year, {_LOADED} WHERE year(prod_date) > 1997 GROUP BY 1
        UNION ALL SELECT 1996, {_LOADED} WHERE year(prod_date) = 1996 AND is_shutin""",
    [("year", "int"), ("rows_loaded", "int"), ("rows_rejected", "int")]))
def q_load_history(p: Pipeline) -> DataFrame:
    """SRC-4: the loads within a time window, here since the first load ended."""
    since = p.spark.read.parquet(f"{loads(p)}/between").select("at").scalar()
    return present(_ledger(p).history(since).groupBy(_year()).agg(*_counts()))


@register("load_current", oracle(
    """SELECT year(prod_date) AS year, COUNT_IF(day(prod_date) <> 11) AS days, SUM(CASE WHEN day(prod_date) <> 11 THEN oil_vol_sm3 END) AS oil
       FROM well_day WHERE year(prod_date) <> 1996 OR is_shutin GROUP BY 1""", [("year", "int"), ("days", "int"), ("oil", "dec")]))
def q_load_current(p: Pipeline) -> DataFrame:
    """SRC-1: the rows of each file's last load."""
    rows = _ledger(p).current()
    day = F.coalesce(F.col("prod_date"), F.col("_corrupt_record")).try_cast("date")
    good = F.col("_corrupt_record").isNull()
    return present(rows.groupBy(F.year(day).alias("year")).agg(
        F.count_if(good).alias("days"), F.sum(F.when(good, F.col("oil_vol_sm3").try_cast("decimal(18,5)"))).alias("oil")))


# --- GOV-1 with the policy as data, PRJ-8 ---------------------------------------------------

ROLES = ("engineer", "viewer", "nobody")


@register("gov_policy_table", oracle(
    """SELECT role, COUNT(*) AS days, SUM(oil_vol_sm3) AS oil FROM fact, (VALUES ('engineer'), ('viewer'), ('nobody')) r(role)
       WHERE role = 'engineer' OR (role = 'viewer' AND well_name LIKE '%7') GROUP BY role""",
    [("role", "keep"), ("days", "int"), ("oil", "dec")]))
def q_gov_policy_table(p: Pipeline) -> DataFrame:
    """GOV-1: the same query under three roles, filtered by a policy table of the wells."""
    wells = p.dim_entity.where(F.col("well_name").like("%7")).select(F.lit("viewer").alias("role"), F.col("well_name").alias("entity"))
    policy = wells.unionByName(p.spark.createDataFrame([("engineer", "*")], "role string, entity string"))
    out = None
    for role in ROLES:
        seen = governance.row_filter_table(p.fact, role, policy).groupBy(F.lit(role).alias("role")).agg(
            F.count(F.lit(1)).alias("days"), F.sum("oil_vol_sm3").alias("oil"))
        out = seen if out is None else out.unionByName(seen)
    return present(out)


@register("name_repair", oracle(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 2 THEN s_name || ' Æ' ELSE 'Ærø ' || s_name || ' på Åsgård' END AS name FROM supplier""",
    [("s_suppkey", "int"), ("name", "keep")]))
def q_name_repair(p: Pipeline) -> DataFrame:
    """PRJ-8: names whose UTF-8 was read as Latin-1 are repaired, clean ones stay."""
    suppliers = p.spark.read.parquet(f"{p.sf_dir}/supplier.parquet")
    name = F.concat(F.lit("Ærø "), "s_name", F.lit(" på Åsgård"))
    mangled = F.decode(F.encode(name, "UTF-8"), "ISO-8859-1")
    seen = F.when(F.col("s_suppkey") % 3 == 0, mangled).when(F.col("s_suppkey") % 3 == 1, name).otherwise(F.concat("s_name", F.lit(" Æ")))
    return present(suppliers.select("s_suppkey", repair_mojibake(seen).alias("name")))


# --- DQ-9: what a load has lost, by fingerprints ---------------------------------------------

DIFF_COLUMNS = ["well_name", "prod_date", "oil_vol_sm3", "is_shutin"]
_LOST, _TWICE, _CHANGED = ("(year(prod_date) = {} AND month(prod_date) = {} AND day(prod_date) = {})".format(*d)
                           for d in ((1997, 3, 17), (1999, 1, 9), (1996, 7, 5)))


@register("dq_load_diff", oracle(
    f"""SELECT well_name, prod_date, CAST(oil_vol_sm3 AS DOUBLE) AS oil, 'left' AS side, 1 AS n FROM well_day WHERE {_LOST} OR {_CHANGED}
        UNION ALL SELECT well_name, prod_date, CAST(oil_vol_sm3 AS DOUBLE), 'right', 1 FROM well_day WHERE {_TWICE}
        UNION ALL SELECT well_name, prod_date, CAST(oil_vol_sm3 + 1 AS DOUBLE), 'right', 1 FROM well_day WHERE {_CHANGED}""",
    [("well_name", "keep"), ("prod_date", "keep"), ("oil", "dbl"), ("side", "keep"), ("n", "int")]))
def q_load_diff(p: Pipeline) -> DataFrame:
    """DQ-9: rows that a damaged load has lost, repeated or changed; only differing ranges are compared."""

    def write(path: str) -> None:
        source = p.well_day.select(*DIFF_COLUMNS, month_start("prod_date").alias("month_start"))
        oil = F.when(F.expr(_CHANGED), F.col("oil_vol_sm3") + 1).otherwise(F.col("oil_vol_sm3")).cast(source.schema["oil_vol_sm3"].dataType)
        loaded = source.where(~F.expr(_LOST)).unionByName(source.where(F.expr(_TWICE))).withColumn("oil_vol_sm3", oil)
        for name, rows in (("left", source), ("right", loaded)):
            SnapshotTable(p.spark, f"{path}/{name}", ["month_start"]).replace(rows)
            fingerprint.fingerprints(rows, ["month_start"], ["well_name", "prod_date"]).write.parquet(f"{path}/{name}_prints")

    path = p.folder("load_diff", write)
    sides = [SnapshotTable(p.spark, f"{path}/{name}", ["month_start"]).read() for name in ("left", "right")]
    prints = [p.spark.read.parquet(f"{path}/{name}_prints") for name in ("left", "right")]
    found = fingerprint.load_diff(*sides, ["month_start"], ["well_name", "prod_date"], 16, *prints)
    return present(found.select("well_name", "prod_date", F.col("oil_vol_sm3").cast("double").alias("oil"), "side", "n"))


#: GOV-3: one text; who asks decides.
BY_ROLE = """SELECT gov_role AS role, COUNT(*) AS days, SUM(oil_vol_sm3) AS oil, COUNT(avg_whp) AS pressures,
             COUNT(DISTINCT well_name) AS wells FROM governed_fact"""


@register("gov_current_role", oracle(
    """SELECT role, COUNT(well_name) AS days, SUM(oil_vol_sm3) AS oil, COUNT(CASE WHEN role = 'engineer' THEN avg_whp END) AS pressures,
              COUNT(DISTINCT well_name) AS wells
       FROM (VALUES ('engineer'), ('viewer'), ('nobody')) r(role)
       LEFT JOIN fact ON well_name IS NOT NULL AND (role = 'engineer' OR (role = 'viewer' AND well_name LIKE '%7')) GROUP BY role""",
    [("role", "keep"), ("days", "int"), ("oil", "dec"), ("pressures", "int"), ("wells", "int")]))
def q_gov_current_role(p: Pipeline) -> DataFrame:
    """GOV-1…3: one SQL text over a governed view under three values of the session's role."""
    wells = p.dim_entity.where(F.col("well_name").like("%7")).select(F.lit("viewer").alias("role"), F.col("well_name").alias("entity"))
    policy = wells.unionByName(p.spark.createDataFrame([("engineer", "*")], "role string, entity string"))
    governance.governed_view(p.spark, "governed_fact", p.fact.where(F.col("well_name").isNotNull()), policy, ["avg_whp"])
    out = None
    for role in ROLES:
        governance.use_role(p.spark, role)
        answer = p.spark.sql(BY_ROLE)
        out = answer if out is None else out.unionByName(answer)
    return present(out)
