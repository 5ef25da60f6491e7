from .cleaning import (
    failed_cast,
    month_start,
    null_tokens,
    pct_variance,
    repair_mojibake,
    safe_ratio,
    shutin_flag,
    tolerant_date,
    try_decimal,
)
from .constants import BBL_PER_SM3, NULL_TOKENS, PRODUCER

__all__ = [
    "BBL_PER_SM3",
    "NULL_TOKENS",
    "PRODUCER",
    "failed_cast",
    "month_start",
    "null_tokens",
    "pct_variance",
    "repair_mojibake",
    "safe_ratio",
    "shutin_flag",
    "tolerant_date",
    "try_decimal",
]
