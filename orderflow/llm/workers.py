"""Python workers that can import this package."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(spark: SparkSession) -> SparkSession:
    """Adds the folder of this package to the search path of Python workers, and makes their batches smaller.

    The path is needed where the package is not installed: the driver may have found it by its own path alone. Rows here
    are documents, so that Spark's own 10,000 a batch are tens of megabytes, several times over in a worker; a number that
    the session has set itself stays.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark
