"""Drift of live predictions against the backtest: a one-sided cumulative sum of weekly Brier scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecast.operators.ordered import Running, ordered_windows
from slatecast.session import store


def drift_curve(weekly: DataFrame, target: float, slack: float, limit: float) -> DataFrame:
    """(week, n, brier, cusum, alarm) from (week, n, brier).

    The sum grows by what a week's score exceeds ``target`` + ``slack`` and
    never falls below zero; beyond ``limit`` it raises the alarm. The recursion
    max(0, sum + x) is the running sum less its running minimum (or zero), so it
    needs two ordered windows and no state row by row.
    """
    excess = weekly.withColumn("_x", F.col("brier") - F.lit(target + slack))
    summed = store(ordered_windows(store(excess, "weekly-brier"), [], ["week"], {"_sum": Running("sum", F.col("_x"))},
                                   include_current=True), "excess")
    low = ordered_windows(summed, [], ["week"], {"_low": Running("min", F.col("_sum"))}, include_current=True)
    cusum = F.col("_sum") - F.least(F.lit(0.0), F.col("_low"))
    return low.select("week", "n", "brier", cusum.alias("cusum"), (cusum > limit).alias("alarm"))
