"""DataFrame operators: silver cleaning, quality checks, time series,
dimensions, fact, gold products, BI measures, governed reads, and the
distributed ordering helpers they use."""

from . import dims, fact, gold, governance, measures, ordering, quality, segmented, silver, timeseries

__all__ = [
    "dims", "fact", "gold", "governance", "measures", "ordering", "quality", "segmented", "silver", "timeseries",
]
