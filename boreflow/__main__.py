"""Command line: run the whole pipeline on input files.

    python -m boreflow --daily daily.csv --monthly monthly.csv \\
        --price price_pages/ --fx fx.json --out /shared/warehouse

On a cluster, submit with spark-submit and set ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans.medallion import run_pipeline
from .session import ensure_checkpoint_dir


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="boreflow")
    ap.add_argument("--daily", required=True, help="daily production CSV file(s) or folder")
    ap.add_argument("--monthly", required=True, help="monthly production CSV")
    ap.add_argument("--price", required=True, help="price JSON payload file(s) or folder")
    ap.add_argument("--fx", required=True, help="FX JSON payload file(s) or folder")
    ap.add_argument("--out", required=True, help="output root (bronze/, silver/, gold/, quality/)")
    ap.add_argument("--repair-names", action="store_true", help="repair mis-decoded UTF-8 in names")
    ap.add_argument("--ui", action="store_true", help="start the Spark web UI (off by default)")
    a = ap.parse_args(argv)
    spark = (
        SparkSession.builder.appName("boreflow").config("spark.ui.enabled", "true" if a.ui else "false").getOrCreate()
    )
    ensure_checkpoint_dir(spark)
    for name, path in run_pipeline(
        spark, daily_csv=a.daily, monthly_csv=a.monthly, price_json=a.price, fx_json=a.fx, out=a.out,
        repair_names=a.repair_names,
    ).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
