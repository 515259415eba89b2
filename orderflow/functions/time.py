"""Whole seconds from timestamps of either kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_seconds(df: DataFrame, column: str) -> Column:
    """Seconds since 1970; a timestamp without zone is counted as it reads, in any session zone."""
    c = F.col(column)
    if df.schema[column].dataType.typeName() != "timestamp_ntz":
        return F.unix_seconds(c)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
