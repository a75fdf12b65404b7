"""Landed rows to typed, deduplicated rows: one function per feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecast.functions.rates import lineup_slot
from slatecast.operators.dedup import latest_wins

PITCH_KEY = ["game_pk", "at_bat_number", "pitch_number"]

# landed name -> staged name, where they differ
PITCH_NAMES = {"batter": "batter_id", "pitcher": "pitcher_id", "player_name": "pitcher_name",
               "type": "pitch_result_type", "estimated_ba_using_speedangle": "xba",
               "estimated_woba_using_speedangle": "xwoba",
               "estimated_slg_using_speedangle": "xslg"}


def _newest(df: DataFrame, keys: list[str]) -> DataFrame:
    return latest_wins(df, keys, [F.col("load_id").desc_nulls_last()])


def _dated(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.to_date(column))


def stg_pitches(raw: DataFrame) -> DataFrame:
    """Copies of a pitch are refetches; any is right, the pick is fixed by all columns."""
    one = latest_wins(raw, PITCH_KEY, [F.col("game_date").asc_nulls_last()])
    return _dated(one, "game_date").withColumnsRenamed(PITCH_NAMES)


def stg_games(raw: DataFrame) -> DataFrame:
    one = _dated(_newest(raw, ["game_pk"]), "official_date")
    return one.withColumn("season", F.col("season").cast("int")).drop("load_id")


def stg_batting_lines(raw: DataFrame) -> DataFrame:
    one = _dated(_newest(raw, ["game_pk", "player_id"]), "official_date")
    return (one.withColumn("batting_order_slot", lineup_slot("batting_order"))
            .withColumnRenamed("batting_order", "batting_order_raw").drop("load_id"))


def stg_lineups(raw: DataFrame) -> DataFrame:
    one = _dated(_newest(raw, ["game_pk", "player_id"]), "official_date")
    return one.select("game_pk", "official_date", "team_id", "is_home", "player_id", "player_name",
                      F.col("batting_order").alias("batting_order_raw"),
                      lineup_slot("batting_order").alias("batting_order_slot"), "game_status")


def stg_standings(raw: DataFrame) -> DataFrame:
    one = _dated(_newest(raw, ["standings_date", "team_id"]), "standings_date")
    return one.withColumns({
        "division_rank": F.col("division_rank").cast("int"),
        "league_rank": F.col("league_rank").cast("int"),
        "win_pct": F.col("win_pct").cast("double"),
    }).drop("load_id")


def stg_coaches(raw: DataFrame) -> DataFrame:
    one = _newest(raw, ["season", "team_id", "person_id", "job_id"])
    return one.withColumn("season", F.col("season").cast("int")).drop("load_id")


def _most_played(raw: DataFrame, keys: list[str]) -> DataFrame:
    """PA only grows within a season, so the row with most PA is the newest download."""
    order = [F.col("pa").desc_nulls_last(), F.col("war").desc_nulls_last()]
    one = latest_wins(raw.filter(F.col("mlb_id").isNotNull()), keys, order)
    return one.withColumns({"pa": F.rint("pa").cast("int"), "games": F.rint("g").cast("int")}) \
        .withColumnsRenamed({"mlb_id": "player_id", "name_common": "player_name",
                             "year_id": "season", "stint_id": "stint"})


def stg_war_seasons(raw: DataFrame) -> DataFrame:
    one = _most_played(raw, ["mlb_id", "year_id", "stint_id"])
    return one.select("player_id", "player_name", "season", "stint",
                      F.col("team_id").alias("bref_team_code"), F.col("lg_id").alias("league"),
                      "pa", "games", "war")


def stg_war_snapshots(raw: DataFrame) -> DataFrame:
    one = _most_played(raw, ["mlb_id", "year_id", "stint_id", "snapshot_date"])
    return _dated(one, "snapshot_date").select("snapshot_date", "player_id", "player_name",
                                               "season", "stint", "pa", "games", "war")


def stg_heartbeat(raw: DataFrame) -> DataFrame:
    return raw.select("run_at", "runner", "git_sha")
