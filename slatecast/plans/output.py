"""Prediction log: grading and slate summary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatecast.operators.dedup import latest_wins
from slatecast.plans import evaluation as ev


PREDICTION = ["slate_date", "game_pk", "batter_id"]


def backtest_daily(predictions: DataFrame, batter_games: DataFrame) -> DataFrame:
    """Every logged prediction with its outcome and whether it is the last run.

    Exactly one row of each (slate, game, batter) is the last, also where keys
    are NULL or runs share a time; a key holds one row per scoring run.
    """
    outcomes = batter_games.select("game_pk", "batter_id", "has_hit", "hits", "pa")
    runs = W.partitionBy(*PREDICTION).orderBy(F.col("run_ts").desc_nulls_last(), F.col("model_version").desc_nulls_last(),
                                              F.col("p_hit").desc_nulls_last())
    marked = predictions.withColumn("_run", F.row_number().over(runs))
    return (marked.join(outcomes, ["game_pk", "batter_id"], "left")
            .select("run_ts", "slate_date", "game_pk", "batter_id", "player_name", "team_id",
                    "opponent_team_id", "batting_order_slot", "lineup_confirmed", "opp_starter_id",
                    "p_hit", "model_version", (F.col("_run") == 1).alias("is_latest"),
                    "has_hit", "hits", "pa", F.col("has_hit").isNotNull().alias("graded")))


def slate_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("n_batters"),
                      F.count_distinct("game_pk").alias("n_games"),
                      F.avg(F.col("lineup_confirmed").cast("double")).alias("share_confirmed"))


def top_scored(scored: DataFrame, k: int = 10) -> DataFrame:
    """The report's k best rows (sort and limit run as one take-ordered step)."""
    return scored.orderBy(F.col("p_hit").desc(), F.col("game_pk").asc(), F.col("batter_id").asc()) \
                 .limit(k).select("player_name", "batting_order_slot", "p_hit")


def predictions_as_shown(predictions: DataFrame, shown_at: Column) -> DataFrame:
    """The log as it stood when each slate was shown: of the runs up to then, the last one per prediction.

    The log has two times, the slate's and the run's; ``shown_at`` may depend on
    the slate's. Runs that came later, such as an evening one, don't count.
    """
    known = predictions.filter(F.col("run_ts") <= shown_at)
    return latest_wins(known, PREDICTION, [F.col("run_ts").desc_nulls_last(), F.col("model_version").desc_nulls_last(),
                                           F.col("p_hit").desc_nulls_last()])


def changed_lineups(lineups: DataFrame, since: str) -> DataFrame:
    """(game_pk, n_changed): games whose posted order differs from what was known at load ``since``."""
    key, newest = ["game_pk", "player_id"], [F.col("load_id").desc_nulls_last()]
    before = latest_wins(lineups.filter(F.col("load_id") <= since), key, newest)
    after = latest_wins(lineups, key, newest)
    slots = before.select(*key, F.col("batting_order").alias("was")).join(
        after.select(*key, F.col("batting_order").alias("now")), key, "full")
    moved = slots.filter(~F.col("was").eqNullSafe(F.col("now")))
    return moved.groupBy("game_pk").agg(F.count(F.lit(1)).alias("n_changed"))


def rescore(slate: DataFrame, changed: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """New prediction rows for the changed games only; ``score`` is one scoring run."""
    return score(slate.join(changed.select("game_pk"), "game_pk", "left_semi"))


def lineup_slice(shown: DataFrame, batter_games: DataFrame) -> DataFrame:
    """Rows, calibration gap, log loss and Brier of what was shown, by confirmed and projected lineup."""
    played = batter_games.select("game_pk", "batter_id", "has_hit")
    graded = shown.join(played, ["game_pk", "batter_id"]).filter(F.col("has_hit").isNotNull())
    p = ev.clip("p_hit", ev.EPS, 1 - ev.EPS)
    graded = graded.withColumn("_p", p)
    return graded.groupBy("lineup_confirmed").agg(
        F.count(F.lit(1)).alias("n"), F.avg("has_hit").alias("base_rate"),
        (F.avg("has_hit") - F.avg("_p")).alias("cal_gap"),
        ev.log_loss(F.col("has_hit"), F.col("_p")).alias("log_loss"),
        F.avg((F.col("_p") - F.col("has_hit")) * (F.col("_p") - F.col("has_hit"))).alias("brier"))
