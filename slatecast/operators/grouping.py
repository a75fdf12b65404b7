"""Grouped counts and sums that carry text along."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def additive_groups(df: DataFrame, keys: Sequence[str], text: Sequence[str],
                    counts: Mapping[str, Column | None], sums: Mapping[str, Column]) -> DataFrame:
    """Counts of true flags (None: rows) and sums per key, with the greatest
    value of each text column.

    ``max`` of a string cannot live in a hash aggregate, and would sort the
    whole input. Text is constant or nearly so within a key, so the input is
    hashed on keys and text first and only that small result meets ``max``.
    """
    def flag(c: Column | None) -> Column:
        return F.count(F.lit(1)) if c is None else F.count_if(c)

    fine = df.groupBy(*keys, *text).agg(*[flag(c).alias(n) for n, c in counts.items()],
                                        *[F.sum(c).alias(n) for n, c in sums.items()])
    return fine.groupBy(*keys).agg(*[F.max(t).alias(t) for t in text],
                                   *[F.sum(n).alias(n) for n in [*counts, *sums]])
