"""Runs of equal outcomes and expanding means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecast.operators.ordered import RecentMeans, Running, Spec, ordered_windows


def streak_specs(outcome: str, index: str) -> dict[str, Spec]:
    """Positions of the last failure and the last success before a row."""
    def seen(v: int) -> Running:
        return Running("max", F.when(F.col(outcome) == v, F.col(index)))
    return {"_last_miss": seen(0), "_last_hit": seen(1)}


def streak_entering(index: str, last_opposite: str):
    """Run length before this row: rows since the last opposite outcome."""
    return F.col(index) - 1 - F.coalesce(F.col(last_opposite), F.lit(0))


def longest_run(df: DataFrame, by: Sequence[str], order: Sequence[str], outcome: str,
                value: int = 0, name: str = "longest_run") -> DataFrame:
    """Longest unbroken run of ``outcome == value`` per group.

    The run length at a row is its distance from the last other outcome, so
    one running maximum is enough, and hot groups are split.
    """
    broken = Running("max", F.when(F.coalesce(F.col(outcome) != value, F.lit(True)), F.col("_pos")))
    rows = ordered_windows(df, by, order, {"_broken": broken}, index="_pos", include_current=True)
    length = F.col("_pos") - F.coalesce(F.col("_broken"), F.lit(0))
    return rows.groupBy(*by).agg(F.max(length).alias(name))


def expanding_mean(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str,
                   name: str) -> DataFrame:
    """Mean of the group's rows up to and including each row."""
    specs = {"_sum": Running("sum", F.col(value)), "_n": Running("count", F.col(value))}
    rows = ordered_windows(df, by, order, specs, include_current=True)
    return rows.withColumn(name, F.col("_sum") / F.nullif(F.col("_n"), F.lit(0))).drop("_sum", "_n")


def recent_means(metrics: Sequence[str], windows: Sequence[int], prefix: str = "") -> dict[str, Spec]:
    """Rolling means of every metric over every window length; NULLs skipped."""
    return {f"{prefix}{m}_roll": RecentMeans(F.col(m), tuple(windows)) for m in metrics}
