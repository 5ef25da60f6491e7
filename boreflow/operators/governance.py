"""Governed reads: role-dependent row filter and column mask (GOV-1 … GOV-3).

This is a data transform applied before any user operator, so Catalyst plans
the filter together with the query (the ``IN`` list reaches the Parquet scan
as a pushed filter). It is *not* a security boundary: anyone with access to
the files can read them directly. Use the platform's access control for that.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import FULL_ACCESS_ROLES, MASKED_COLUMNS, VIEWER_ROLE, VIEWER_WELLS


@dataclass(frozen=True)
class Policy:
    """Who sees which rows and columns.

    * ``full_access``: roles that see every row and every column;
    * ``restricted``: role -> entities (e.g. wells) that role may see;
    * ``masked``: columns that read as NULL for every role without full access.

    Any role not listed sees no rows, and masked columns as NULL (S-13).
    """

    full_access: frozenset[str] = frozenset(FULL_ACCESS_ROLES)
    restricted: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {VIEWER_ROLE: VIEWER_WELLS})
    masked: tuple[str, ...] = MASKED_COLUMNS


DEFAULT_POLICY = Policy()


def row_filter(df: DataFrame, role: str, policy: Policy = DEFAULT_POLICY, entity: str = "well_name") -> DataFrame:
    """GOV-1: rows of ``df`` the role may see.

    Full access passes through; a restricted role gets ``entity IN (...)``
    (pushed down to the scan); any other role gets an empty result with the
    same schema.
    """
    if role in policy.full_access:
        return df
    allowed = policy.restricted.get(role)
    if not allowed:
        return df.where(F.lit(False))
    return df.where(F.col(entity).isin(list(allowed)))


def row_filter_table(df: DataFrame, role: str, policy_table: DataFrame, entity: str = "well_name") -> DataFrame:
    """GOV-1 with the policy as data: ``policy_table(role, entity)`` where
    entity ``'*'`` grants every row.

    Planned as ``EXISTS(wildcard) OR entity IN (role's entities)``: a scalar
    subquery and an existence (semi) join on the entity, so no nested-loop
    join, and a policy row listed twice never duplicates data rows. How the
    policy is joined is left to the planner, which knows its size.
    """
    mine = policy_table.where(F.col("role") == F.lit(role)).select(F.col("entity").alias("_allowed"))
    wildcard = mine.where(F.col("_allowed") == F.lit("*")).exists()
    return df.where(wildcard | F.col(entity).isin(mine))


def mask_columns(df: DataFrame, role: str, policy: Policy = DEFAULT_POLICY, columns: Iterable[str] | None = None) -> DataFrame:
    """GOV-2: masked columns become typed NULLs for roles without full
    access; the schema (names and types) is unchanged."""
    if role in policy.full_access:
        return df
    masked = set(columns if columns is not None else policy.masked)
    return df.select(
        *[
            F.lit(None).cast(f.dataType).alias(f.name) if f.name in masked else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def governed(df: DataFrame, role: str, policy: Policy = DEFAULT_POLICY, entity: str | None = "well_name") -> DataFrame:
    """Row filter (when the table has the entity column) then column mask."""
    if entity and entity in df.columns:
        df = row_filter(df, role, policy, entity)
    return mask_columns(df, role, policy)


def compare_roles(
    df: DataFrame, roles: Sequence[str], policy: Policy = DEFAULT_POLICY, entity: str = "well_name",
    probe: str = "avg_whp",
) -> DataFrame:
    """GOV-3: the same summary query run as each role: visible entities,
    visible rows and how many values of ``probe`` are not masked.

    One pass: rows are counted per entity, and each role sums the entities it
    may see of that small table.
    """
    per_entity = df.groupBy(entity).agg(F.count(F.lit(1)).alias("_rows"), F.count(probe).alias("_probe"))
    summaries = []
    for r in roles:
        full = r in policy.full_access
        sees = F.lit(True) if full else F.col(entity).isin(list(policy.restricted.get(r) or ()))
        reads = sees if full or probe not in policy.masked else F.lit(False)
        summaries.append(F.struct(
            F.lit(r).alias("role"),
            F.count(F.when(sees, F.col(entity))).alias("wells_visible"),
            F.coalesce(F.sum(F.when(sees, F.col("_rows"))), F.lit(0)).alias("rows_visible"),
            F.coalesce(F.sum(F.when(reads, F.col("_probe"))), F.lit(0)).alias(f"{probe}_visible"),
        ))
    wide = per_entity.agg(F.array(*summaries).alias("_s"))
    return wide.select(F.inline("_s"))


# --- one query text, answered by role ---------------------------------------------------

ROLE_VARIABLE = "gov_role"


def use_role(spark: SparkSession, role: str) -> None:
    """CURRENT_ROLE: the role of the statements that follow in this session. A
    DataFrame keeps the role that was set when it was made."""
    spark.sql(f"SET VARIABLE {ROLE_VARIABLE} = :role", {"role": role})


def governed_view(
    spark: SparkSession, name: str, df: DataFrame, policy_table: DataFrame, masked: Iterable[str] = (), entity: str = "well_name"
) -> None:
    """GOV-1…3: a view ``name`` over ``df`` whose rows and columns depend on the session
    variable ``gov_role``, so that one SQL text has an answer for each role.

    ``policy_table(role, entity)`` is data: entity ``'*'`` grants every row and shows the
    ``masked`` columns, which are typed NULLs for all others; a role without policy
    rows sees nothing. What a role may see comes from the SQL table function
    ``<name>_grants()``. Planned as an uncorrelated EXISTS and a semi join on the entity.
    Like the other functions here this is a data transform, not a security boundary:
    the rows lie open in the view ``<name>_rows``.
    """
    df.createOrReplaceTempView(f"{name}_rows")
    policy_table.select("role", "entity").createOrReplaceTempView(f"{name}_policy")
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE_VARIABLE} STRING DEFAULT ''")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}_grants(r STRING) RETURNS TABLE (granted STRING) "
        f"RETURN SELECT entity FROM {name}_policy WHERE role = r"
    )
    everything = f"EXISTS (SELECT 1 FROM {name}_grants({ROLE_VARIABLE}) WHERE granted = '*')"
    hidden = set(masked)
    columns = [
        f"CASE WHEN {everything} THEN `{f.name}` ELSE CAST(NULL AS {f.dataType.simpleString()}) END AS `{f.name}`" if f.name in hidden else f"`{f.name}`"
        for f in df.schema
    ]
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {', '.join(columns)} FROM {name}_rows "
        f"WHERE {everything} OR `{entity}` IN (SELECT granted FROM {name}_grants({ROLE_VARIABLE}))"
    )
