"""boreflow: production-analytics operators expressed as Spark DataFrame plans.

Layers:
  sources    untyped CSV / JSON payload ingest, load audit, sinks
  functions  column expressions (cleaning, casting, safe ratios, fixed values)
  operators  silver cleaning, quality checks, time series, dimensions, fact,
             gold products, BI measures, governed reads
  plans      stand-in inputs over the driver tables and the query registry
  streaming  incremental refresh with Structured Streaming

Every operator is a pure ``DataFrame -> DataFrame`` function: no actions, no
``collect``, no Python UDFs, unless a docstring says otherwise (the global
ordering helpers checkpoint once, see ``operators.ordering``).
"""

__version__ = "0.1.0"

from .operators.dims import calendar, dim_latest, dim_scd1, dim_scd2  # noqa: E402
from .operators.fact import build_fact  # noqa: E402
from .operators.gold import (  # noqa: E402
    decline_trend,
    decomposition_check,
    downtime_events,
    reconcile_detail,
    reconcile_summary,
    revenue_decomposition,
    value_ranking,
    water_cut_trend,
)
from .operators.governance import Policy, governed  # noqa: E402
from .operators.silver import clean_daily, clean_monthly, fx_series, price_series  # noqa: E402
from .operators.timeseries import fill_series, islands  # noqa: E402
from .plans.medallion import run_pipeline  # noqa: E402
from .streaming.refresh import GoldRefresh  # noqa: E402

__all__ = [
    "GoldRefresh", "Policy", "build_fact", "calendar", "clean_daily", "clean_monthly", "decline_trend",
    "decomposition_check", "dim_latest", "dim_scd1", "dim_scd2", "downtime_events", "fill_series", "fx_series",
    "governed", "islands", "price_series", "reconcile_detail", "reconcile_summary", "revenue_decomposition",
    "run_pipeline", "value_ranking", "water_cut_trend",
]
