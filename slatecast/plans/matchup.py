"""Pitch mix of the opposing starter times the batter's expected average by pitch type.

Both sides are sparse vectors over pitch types as they stood before the game: a
cumulative row per (pitcher or batter, type, day), valid from that day until the
next one of its type. A game meets the valid rows of its starter and of its
batter by interval joins and the dot product is a grouped sum, without a pivot
and without a column per type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecast.operators.asof import interval_join, validity
from slatecast.operators.ordered import Running, ordered_windows


def cumulative_by_type(flags: DataFrame, key: str, measures: dict[str, Column]) -> DataFrame:
    """Intervals (key, pitch_type, measures so far, valid_from, valid_to), one per day with pitches."""
    daily = flags.filter(F.col("pitch_type").isNotNull()).groupBy(key, "pitch_type", "game_date").agg(
        *[m.alias(n) for n, m in measures.items()])
    specs = {f"{n}_so_far": Running("sum", F.col(n)) for n in measures}
    ran = ordered_windows(daily, [key, "pitch_type"], ["game_date"], specs, include_current=True)
    return validity(ran, "game_date", list(specs), [key, "pitch_type"])


def pitch_mix_xba(flags: DataFrame, batter_games: DataFrame) -> DataFrame:
    """(game_pk, batter_id, mix_xba, mix_share) of games whose starter and batter have earlier pitches.

    ``mix_xba`` weighs the batter's average expected average per type by the
    starter's share of it; ``mix_share`` is the share of the mix that the batter
    has put in play before, to which the weights are scaled.
    """
    games = batter_games.filter(F.col("opp_starter_id").isNotNull()).select(
        "game_pk", "batter_id", "opp_starter_id", "game_date")
    thrown = cumulative_by_type(flags, "pitcher_id", {"thrown": F.count(F.lit(1))})
    met = flags.filter(F.col("is_bip") & F.col("xba").isNotNull())
    struck = cumulative_by_type(met, "batter_id", {"xba": F.sum("xba"), "balls": F.count(F.lit(1))})

    starts = games.select(F.col("opp_starter_id").alias("pitcher_id"), "game_date").distinct()
    mix = interval_join(starts, thrown, "game_date", ["pitch_type", "thrown_so_far"], ["pitcher_id"])
    days = games.select("batter_id", "game_date").distinct()
    skill = interval_join(days, struck, "game_date", ["pitch_type", "xba_so_far", "balls_so_far"], ["batter_id"])

    facing = games.join(mix.withColumnRenamed("pitcher_id", "opp_starter_id").filter("pitch_type is not null"),
                        ["opp_starter_id", "game_date"])
    both = facing.join(skill.filter("pitch_type is not null"), ["batter_id", "game_date", "pitch_type"], "left")
    known = F.when(F.col("balls_so_far").isNotNull(), F.col("thrown_so_far"))
    each = F.col("thrown_so_far") * (F.col("xba_so_far") / F.col("balls_so_far"))
    sums = both.groupBy("game_pk", "batter_id").agg(
        F.sum(each).alias("_dot"), F.sum(known).alias("_known"), F.sum("thrown_so_far").alias("_thrown"))
    return sums.filter("_known > 0").select("game_pk", "batter_id", (F.col("_dot") / F.col("_known")).alias("mix_xba"),
                                            (F.col("_known") / F.col("_thrown")).alias("mix_share"))
