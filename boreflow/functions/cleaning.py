"""Column expressions used by the cleaning and gold layers.

All return ``Column`` objects built from Spark built-ins, so they stay inside
whole-stage codegen; none calls back into Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import DATE_FORMATS, NULL_TOKENS, PRODUCER, TWO_DIGIT_CENTURY_START


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """SRC-2: map every token in ``tokens`` (exact match) to NULL."""
    col = _c(c)
    return F.when(col.isin(list(tokens)), F.lit(None).cast("string")).otherwise(col)


def try_decimal(c: Column | str, precision: int = 18, scale: int = 5) -> Column:
    """PRJ-2: tolerant decimal cast; bad text and overflow give NULL."""
    return _c(c).try_cast(f"decimal({precision},{scale})")


def tolerant_date(
    c: Column | str, formats: Sequence[str] = DATE_FORMATS, century_start: int = TWO_DIGIT_CENTURY_START
) -> Column:
    """PRJ-3/PRJ-4: first layout that parses wins; none parses -> NULL.

    Spark reads a two-digit year as 20xx; layouts with ``yy`` (not ``yyyy``)
    are moved into the 100-year window that starts at ``century_start``.
    """
    col = F.trim(_c(c))
    parsed = []
    for fmt in formats:
        d = F.try_to_date(col, fmt)
        if "yy" in fmt and "yyyy" not in fmt:
            d = F.when(F.year(d) >= century_start + 100, F.add_months(d, -1200)).otherwise(d)
        parsed.append(d)
    return F.coalesce(*parsed)


def shutin_flag(well_type: Column | str, measures: Sequence[Column | str], producer: str = PRODUCER) -> Column:
    """PRJ-5: producer row whose measures are all missing or zero.

    A missing measure counts as zero (COALESCE), so a day with every measure
    missing is shut in. Any other role, or a missing role, is never shut in.
    """
    cond = _c(well_type) == F.lit(producer)
    for m in measures:
        cond = cond & (F.coalesce(_c(m), F.lit(0)) == 0)
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """PRJ-7: ``num / NULLIF(den, 0)`` in double precision; 0 or NULL -> NULL."""
    d = _c(den).cast("double")
    return _c(num).cast("double") / F.when(d != 0, d)


def pct_variance(actual: Column | str, reported: Column | str, digits: int = 2) -> Column:
    """PRJ-9: ``ROUND(100 * (a - r) / NULLIF(r, 0), digits)``."""
    return F.round(F.lit(100.0) * safe_ratio(_c(actual) - _c(reported), reported), digits)


def month_start(c: Column | str) -> Column:
    """DATE_TRUNC('MONTH', d) as a DATE."""
    return F.trunc(_c(c), "month")


def repair_mojibake(c: Column | str) -> Column:
    """PRJ-8: undo UTF-8 text that was decoded as Latin-1, when it looks so.

    Only rewrites values that contain a lead byte pair typical of the mistake
    and nothing above U+00FF (clean text such as ``Æ`` would not round-trip).
    Text that is broken in one place and clean in another is no UTF-8 when it
    is encoded back; it is left as it is.
    """
    col = _c(c)
    looks_broken = col.rlike("[Â-Ã][\u0080-¿]") & ~col.rlike("[^\u0000-ÿ]")
    encoded = F.encode(F.when(looks_broken, col), "ISO-8859-1").cast("string")
    return F.coalesce(F.try_validate_utf8(encoded), col)


def failed_cast(c: Column | str, target: str) -> Column:
    """FIL-5: present, non-empty, yet not castable to ``target``."""
    col = _c(c)
    return col.isNotNull() & (col != "") & col.try_cast(target).isNull()
