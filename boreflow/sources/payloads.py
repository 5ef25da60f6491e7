"""JSON payload operators: flatten (FLT-J1/J2), paged merge with a
completeness check (SRC-6) and shape report (SRC-7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Field = tuple[str, str]  # (JSON path inside one record, Spark type)


def flatten_payload(
    df: DataFrame,
    fields: Mapping[str, Field],
    raw: str = "raw",
    array_path: str = "$",
    keep: Sequence[str] = (),
    outer: bool = False,
) -> DataFrame:
    """LATERAL FLATTEN of the array at ``array_path`` with typed field access.

    ``array_path="$"`` flattens a top-level array (FX payload); e.g.
    ``"$.response.data"`` a nested one (price payload). Each field is read
    with ``try_variant_get``: a value that does not fit its type becomes NULL
    (text "74.1" reads as a double, "bad" as NULL). A hyphenated key is
    written ``$["series-description"]``. ``outer=True`` keeps payloads whose
    array is empty or missing, as one row of NULLs.
    """
    arr = F.try_variant_get(F.col(raw), array_path, "array<variant>")
    gen = F.posexplode_outer(arr) if outer else F.posexplode(arr)
    rows = df.select(*keep, gen.alias("index", "_value"))
    return rows.select(
        *keep, "index", *[F.try_variant_get("_value", path, typ).alias(name) for name, (path, typ) in fields.items()]
    )


def merge_pages(
    pages: DataFrame,
    fields: Mapping[str, Field],
    key: Sequence[str],
    array_path: str,
    total_path: str,
    raw: str = "raw",
) -> tuple[DataFrame, DataFrame]:
    """SRC-6: merge paged payloads into one series and check completeness.

    Returns ``(series, completeness)``. Overlapping pages repeat whole
    records, so the series is the *distinct* records (a hash aggregate over
    all fields). Completeness is one row: the total the source reports (the
    largest ``total_path`` seen), records received, distinct records,
    duplicates (received − distinct), ``conflicting_keys`` (records sharing a
    ``key`` but differing elsewhere; never dropped silently) and missing
    (reported − distinct keys).
    """
    tagged = pages.withColumn("_total", F.try_variant_get(F.col(raw), total_path, "bigint"))
    flat = flatten_payload(tagged, fields, raw=raw, array_path=array_path, keep=["_total"]).drop("index")
    cols = [c for c in flat.columns if c != "_total"]
    rows = flat.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"), F.max("_total").alias("_t"))
    series = rows.drop("_c", "_t")
    per_key = rows.groupBy(*key).agg(
        F.sum("_c").alias("_c"), F.count(F.lit(1)).alias("_v"), F.max("_t").alias("_t")
    )
    comp = per_key.agg(
        F.max("_t").alias("reported_total"),
        F.sum("_c").alias("records_received"),
        F.sum("_v").alias("records_distinct"),
        F.count(F.lit(1)).alias("_keys"),
    ).select(
        "reported_total", "records_received", "records_distinct",
        (F.col("records_received") - F.col("records_distinct")).alias("duplicates"),
        (F.col("records_distinct") - F.col("_keys")).alias("conflicting_keys"),
        (F.col("reported_total") - F.col("_keys")).alias("missing"),
    )
    return series, comp


def payload_shape(payloads: DataFrame, raw: str = "raw") -> DataFrame:
    """SRC-7: how many payloads have each shape: the JSON type, for objects the
    sorted names of the top-level fields, and the schema with all types."""
    text = F.to_json(raw)
    fields = F.array_join(F.array_sort(F.json_object_keys(text)), ",")
    schema = F.schema_of_variant(F.col(raw))
    kind = F.lower(F.regexp_extract(schema, r"^([A-Za-z]+)", 1))
    return payloads.groupBy(
        kind.alias("top_level_type"), F.coalesce(fields, F.lit("")).alias("fields"), schema.alias("schema")
    ).agg(F.count(F.lit(1)).alias("payloads"))
