"""Output normalisation shared by the Spark queries and their oracle SQL.

The oracle compare hashes values, so each output column gets the same final
form in both engines: integers as BIGINT, exact decimals rounded in the
decimal domain and then cast to DOUBLE, doubles rounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# column -> digits; columns not listed keep the default for their type.
DECIMAL_DIGITS = 4
DOUBLE_DIGITS = 6


def present(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    digits = digits or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DecimalType):
            c = F.round(c, digits.get(f.name, DECIMAL_DIGITS)).cast("double")
        elif isinstance(t, (T.DoubleType, T.FloatType)):
            # + 0.0 turns a rounded negative zero into 0.0 in both engines
            c = F.round(c.cast("double"), digits.get(f.name, DOUBLE_DIGITS)) + F.lit(0.0)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_present(columns: list[tuple[str, str]], digits: dict[str, int] | None = None, src: str = "q") -> str:
    """SELECT list doing the same as ``present`` for (name, kind) pairs.

    kind: 'int', 'dec', 'dbl' or 'keep'.
    """
    digits = digits or {}
    parts = []
    for name, kind in columns:
        if kind == "int":
            parts.append(f"CAST({name} AS BIGINT) AS {name}")
        elif kind == "dec":
            parts.append(f"CAST(ROUND({name}, {digits.get(name, DECIMAL_DIGITS)}) AS DOUBLE) AS {name}")
        elif kind == "dbl":
            parts.append(f"ROUND(CAST({name} AS DOUBLE), {digits.get(name, DOUBLE_DIGITS)}) + 0.0 AS {name}")
        else:
            parts.append(name)
    return f"SELECT {', '.join(parts)} FROM {src}"
