"""Latest-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                ties: Sequence[str] | None = None) -> DataFrame:
    """Keep the first row per key under ``order``.

    ``ties`` (default: every other column) makes the pick deterministic.
    ``row_number = 1`` lets Spark put a window group limit below the shuffle:
    each task forwards one row per key, so a key with a huge number of copies
    never lands whole on one task.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys]
    ordering = [*order, *(F.col(c).asc_nulls_last() for c in ties)]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int,
          rank_name: str = "rank") -> DataFrame:
    """First ``k`` rows of each group; limited before the shuffle as above."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn(rank_name, rank).filter(F.col(rank_name) <= k)
