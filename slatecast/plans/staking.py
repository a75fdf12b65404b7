"""Return at odds: fractional Kelly stakes, all bets of a day placed together.

The bankroll is an ordered product over days, kept as a running sum of
logarithms; its peak is a running maximum. Both come from ``ordered_windows``,
which works in blocks whose totals are added up first, so neither the bets of a
day nor the days of a record need to fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecast.operators.ordered import Running, ordered_windows
from slatecast.session import store

# Least edge over the odds for a bet.
MIN_EDGE = 0.02


def kelly_fraction(p: Column, odds: Column) -> Column:
    """Share of the bankroll that grows it fastest at decimal ``odds`` and chance ``p``; never negative."""
    gain = odds - 1
    return F.greatest(F.lit(0.0), (p * gain - (1 - p)) / gain)


def bets(graded: DataFrame, fraction: float = 0.25, least_edge: float = MIN_EDGE) -> DataFrame:
    """Graded predictions (slate_date, p_hit, odds, has_hit) that beat the odds, with stake and return of each."""
    p, odds = F.col("p_hit"), F.col("odds")
    placed = graded.filter((odds > 1) & F.col("has_hit").isNotNull() & (p - 1 / odds >= least_edge))
    won = F.col("has_hit") == 1
    return placed.withColumn("stake", F.lit(fraction) * kelly_fraction(p, odds)).withColumns({
        "gain": F.when(won, F.col("stake") * (odds - 1)).otherwise(-F.col("stake")),
        "flat_gain": F.when(won, odds - 1).otherwise(F.lit(-1.0))})


def kelly_curve(graded: DataFrame, fraction: float = 0.25, most_staked: float = 0.5,
                least_edge: float = MIN_EDGE) -> DataFrame:
    """One row per day with bets: stakes, return, bankroll (1 at first), drawdown from its peak, flat-stake profit.

    A day's stakes are shares of the bankroll it opens with; together they are
    scaled down to ``most_staked``, so a day can't lose everything.
    """
    days = bets(graded, fraction, least_edge).groupBy("slate_date").agg(
        F.count(F.lit(1)).alias("n_bets"), F.sum("stake").alias("_stake"), F.sum("gain").alias("_gain"),
        F.sum("flat_gain").alias("_flat"))
    scale = F.least(F.lit(1.0), F.lit(most_staked) / F.col("_stake"))
    days = store(days.select("slate_date", "n_bets", (F.col("_stake") * scale).alias("staked"),
                             (F.col("_gain") * scale).alias("day_return"), "_flat"), "betting-days")
    run = ordered_windows(days, [], ["slate_date"], {
        "_log": Running("sum", F.log1p("day_return")), "flat_profit": Running("sum", F.col("_flat"))}, include_current=True)
    run = store(run.withColumn("bankroll", F.exp("_log")).drop("_log", "_flat"), "bankroll")
    peaks = ordered_windows(run, [], ["slate_date"], {"_peak": Running("max", F.col("bankroll"))}, include_current=True)
    return peaks.select("slate_date", "n_bets", "staked", "day_return", "bankroll", "flat_profit",
                        (1 - F.col("bankroll") / F.greatest("_peak", F.lit(1.0))).alias("drawdown"))
