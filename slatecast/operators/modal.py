"""Per-key summary values: modal, latest, majority side, hand split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecast.operators.dedup import top_k


def modal_value(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent non-NULL value per key, lowest value on a tie.

    Counted per (key, value) first, so a huge key arrives pre-aggregated.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = top_k(counts, keys, [F.col("_n").desc(), F.col(value).asc()], 1, "_rank")
    return best.select(*keys, F.col(value).alias(name))


def latest_value(df: DataFrame, keys: Sequence[str], value: str, when: str, name: str) -> DataFrame:
    """Value of the latest row that has one; greatest value on equal dates.

    Hashed to one row per (key, value) first: few rows reach the struct maximum.
    """
    newest = df.groupBy(*keys, value).agg(F.max(when).alias("_when"))
    stamped = F.when(F.col(value).isNotNull() & F.col("_when").isNotNull(), F.struct("_when", value))
    return newest.groupBy(*keys).agg(F.max(stamped)[value].alias(name))


def infer_switch(df: DataFrame, key: str, side: str, name: str, share: float = 0.10) -> DataFrame:
    """'S' when exactly two sides occur and the rarer has more than ``share``."""
    counts = df.groupBy(key, side).agg(F.count(F.lit(1)).alias("_n"))
    rare = F.min("_n").cast("double") / F.sum("_n")
    both = (F.count(F.lit(1)) == 2) & (rare > share)
    # largest count first, then the lower side: order sides by descending code
    major = F.max_by(F.col(side), F.when(F.col(side).isNotNull(),
                                         F.struct(F.col("_n"), -F.ascii(side))))
    return counts.groupBy(key).agg(F.when(both, F.lit("S")).otherwise(major).alias(name))


def hand_split(df: DataFrame, keys: Sequence[str], hand: str, hands: Sequence[str],
               measures: dict[str, Column]) -> DataFrame:
    """Wide pivot of already grouped measures: one column per measure and hand."""
    picks = [F.max(F.when(F.col(hand) == h, m)).alias(f"{n}_vs_{h.lower()}")
             for h in hands for n, m in measures.items()]
    return df.groupBy(*keys).agg(*picks)
