"""Tables laid out for their joins, and statistics that plans use.

A layout is a property of a catalog table. These tables lie in the shared scratch folder and are entered in the catalog only while they are
written and analysed; the DataFrame that comes back keeps buckets and statistics, and no entry is left behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.sources.workdir import fresh_dir
from orderflow.sources.writers import refresh_statistics, save_bucketed

# A table replicated to all executors may have so many bytes, as JSON text.
MAX_REPLICATED_BYTES = 64 * 1024 * 1024

_STATISTICS = {
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.statistics.histogram.enabled": "true",
}


def _entered(spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
    try:
        if columns:
            refresh_statistics(spark, name, columns)
        return spark.table(name)
    finally:
        # the files stay: the table is an external one
        spark.sql(f"DROP TABLE {name}")


def keyed(df: DataFrame, key: str, buckets: int, sort: Sequence[str] = (), analyse: Sequence[str] = ()) -> DataFrame:
    """``df`` stored in buckets of ``key``: joins with another such table, and groupings, by the key move no row.

    Both tables need the same number of buckets. A bucket should be what a task can sort: take the larger table's
    bytes over some 200 MB. One key's rows share a bucket, so this is for keys without heavy hitters.
    """
    spark = df.sparkSession
    name = f"keyed_{uuid.uuid4().hex}"
    save_bucketed(df, name, key, buckets, sort or [key], fresh_dir(spark, "keyed"))
    return _entered(spark, name, analyse)


def text_bytes(df: DataFrame) -> int:
    """The size of all rows as JSON text, which their size in memory seldom exceeds by much."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()[0]


def replicated(df: DataFrame, max_bytes: int = MAX_REPLICATED_BYTES) -> DataFrame:
    """``df`` to be sent whole to every executor that joins with it, if it has at most ``max_bytes``; as it is beyond.

    The size is counted, not estimated, so a dimension that has grown joins by shuffle again.
    """
    return F.broadcast(df) if text_bytes(df) <= max_bytes else df


def use_statistics(spark: SparkSession) -> None:
    """Let the session's plans order joins by the statistics of tables, histograms included."""
    for name, value in _STATISTICS.items():
        spark.conf.set(name, value)


def analysed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` stored with the row count, and for ``columns`` distinct values, NULLs, ranges and histograms, known to plans."""
    spark = df.sparkSession
    use_statistics(spark)
    name = f"analysed_{uuid.uuid4().hex}"
    df.write.option("path", fresh_dir(spark, "analysed")).format("parquet").saveAsTable(name)
    return _entered(spark, name, columns)
