"""``python -m orderflow --source-root ...``: one batch run with the settings given as arguments."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from orderflow.context import PipelineConfig
from orderflow.plans.batch import run_batch


def main(argv: list[str]) -> None:
    cfg = PipelineConfig.from_args(argv)
    spark = SparkSession.builder.appName("orderflow").getOrCreate()
    try:
        dimensions = [spark.read.parquet(p) if p else None for p in (cfg.customers_path, cfg.products_path)]
        print(run_batch(spark, cfg, customers=dimensions[0], products=dimensions[1]))
    finally:
        spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
