"""Fixed values the results depend on. Kept together, as plain text."""

from decimal import Decimal

# --- fixed values -----------------------------------------------------------
# Standard cubic metres to barrels.
BBL_PER_SM3 = Decimal("6.2898")
# Text tokens that a raw CSV field treats as missing.
NULL_TOKENS = ("", "NULL", "NaN")
# Date layouts accepted by the tolerant parser, tried in this order.
DATE_FORMATS = ("yyyy-MM-dd", "dd-MM-yy")
# Two-digit years fall in the 100 years starting here.
TWO_DIGIT_CENTURY_START = 1970
# Well role that produces oil; injector label.
PRODUCER = "OP"
INJECTOR = "WI"
# Calendar day that splits the first and second production batch.
BATCH_SPLIT_DATE = "2013-01-01"
# Reconciliation threshold, percent.
RECONCILE_THRESHOLD_PCT = 1
# What-if price scenarios, USD per barrel.
WHAT_IF_PRICES = (50, 70, 90)
# Weekend day names as Spark's dayname() prints them.
WEEKEND_DAYS = ("Sat", "Sun")
# Columns masked for roles without full access.
MASKED_COLUMNS = ("avg_whp", "benchmark_revenue_usd", "benchmark_revenue_nok")
# Price payload: path of the record array, total count and record fields.
PRICE_ARRAY_PATH = "$.response.data"
PRICE_TOTAL_PATH = "$.response.total"
# --- end of fixed values ----------------------------------------------------

# Default governance roles (parameters, not fixed values): two roles with full
# access and a partner viewer who sees only the wells a policy names.
FULL_ACCESS_ROLES = ("ENGINEER", "ANALYST")
VIEWER_ROLE = "VIEWER"
VIEWER_WELLS: tuple[str, ...] = ()

DAILY_DECIMAL = "decimal(18,5)"
HOURS_DECIMAL = "decimal(10,4)"
