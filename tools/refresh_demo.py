"""Incremental refresh on the driver tables, end to end (REF-1 … REF-6).

Usage: python tools/refresh_demo.py [sf_dir]

Lands the stand-in silver in two batches (the second one adds a new period
and late rows for an old month), runs the Structured Streaming refresh after
each, and prints the proof the reference asks for: newest fact date and
decomposition month before/after, and the refresh history. Everything is
written under a fresh scratch folder.
"""

from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from boreflow.plans import standin  # noqa: E402
from boreflow.session import local_session  # noqa: E402
from boreflow.streaming import GoldRefresh, land_silver, latest_dates, refresh_history  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    root = tempfile.mkdtemp(prefix="boreflow-refresh-")
    spark = local_session()
    daily = standin.well_day(spark, sf_dir).drop("well_id")
    price, fx = standin.price(spark, sf_dir), standin.fx(spark, sf_dir)
    split = "1998-01-01"
    late_month = F.trunc("prod_date", "month") == F.lit("1996-03-01").cast("date")
    first = daily.where((F.col("prod_date") < split) & ~late_month)
    second = daily.where((F.col("prod_date") >= split) | late_month)

    silver, gold, ckpt = (os.path.join(root, n) for n in ("silver", "gold", "checkpoint"))
    refresh = GoldRefresh(spark, silver, gold, ckpt, price, fx)
    land_silver(first, silver)
    refresh.run()
    before = latest_dates(spark, gold)
    land_silver(second, silver)
    refresh.run()
    after = latest_dates(spark, gold)
    print(f"scratch folder: {root}")
    print(f"latest before: {before}")
    print(f"latest after:  {after}")
    refresh_history(spark, gold).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
