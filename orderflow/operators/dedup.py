"""Keep the latest row per key, always the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_dedup_rank"


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = ("order_id",),
    order_by: Sequence[Column] | None = None,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """First row per key under ``order_by`` (default: newest ``_processed_at``).

    ``ties`` (default: every other column) follow as tie-breakers, so two rows can only tie when they are equal in
    them and the result does not depend on how the input was partitioned; name those that the others derive from. Spark turns the rank
    filter into a limit per key *before* the shuffle: a hot key sends one row per input task.
    """
    if order_by is None:
        order_by = [F.col("_processed_at").desc_nulls_last()] if "_processed_at" in df.columns else []
    last = [F.col(c).desc_nulls_last() for c in (df.columns if ties is None else ties) if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order_by, *last)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)
