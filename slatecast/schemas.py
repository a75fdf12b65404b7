"""Column types of every table that is read from or written to storage."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and types of the landed feeds.
_DDL = {
    "pitches": """
        game_pk long, game_date string, game_type string, home_team string, away_team string,
        batter long, pitcher long, player_name string, stand string, p_throws string,
        inning int, inning_topbot string, at_bat_number long, pitch_number long,
        outs_when_up int, balls int, strikes int, pitch_type string, release_speed double,
        zone int, type string, description string, events string, bb_type string,
        woba_value double, babip_value int, launch_speed double, launch_angle double,
        launch_speed_angle int, estimated_ba_using_speedangle double,
        estimated_woba_using_speedangle double, estimated_slg_using_speedangle double""",
    "games": """
        game_pk long, official_date string, season string, game_type string, status string,
        day_night string, doubleheader string, game_number int, venue_id long, venue_name string,
        home_team_id long, home_team_name string, home_probable_pitcher_id long,
        home_probable_pitcher_name string, away_team_id long, away_team_name string,
        away_probable_pitcher_id long, away_probable_pitcher_name string, load_id string""",
    "batting_lines": """
        game_pk long, official_date string, game_type string, team_id long, is_home boolean,
        player_id long, player_name string, position string, batting_order int,
        is_substitute boolean, plate_appearances int, at_bats int, hits int, doubles int,
        triples int, home_runs int, walks int, strikeouts int, runs int, rbi int, load_id string""",
    "standings": """
        standings_date string, team_id long, team_name string, division_id long, league_id long,
        division_rank string, league_rank string, wins int, losses int, win_pct string,
        load_id string""",
    "lineups": """
        game_pk long, official_date string, team_id long, is_home boolean, player_id long,
        player_name string, batting_order int, game_status string, load_id string""",
    "coaches": """
        season int, team_id long, team_name string, person_id long, person_name string,
        job string, job_id string, load_id string""",
    "war_seasons": """
        mlb_id long, name_common string, year_id int, stint_id int, team_id string,
        lg_id string, pa double, g double, war double""",
    "war_snapshots": """
        mlb_id long, name_common string, year_id int, stint_id int, team_id string,
        lg_id string, pa double, g double, war double, snapshot_date string""",
    "heartbeat": "run_at timestamp, runner string, git_sha string",
    "predictions": """
        run_ts timestamp, slate_date date, game_pk long, batter_id long, player_name string,
        team_id long, opponent_team_id long, batting_order_slot int, lineup_confirmed boolean,
        opp_starter_id long, p_hit double, model_version string""",
    "runs": """
        run_name string, run_at timestamp, log_loss double, brier double, auc double, n long,
        top5_hit_rate double, evaluations_to_date long""",
}

_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(),
          "string": T.StringType(), "boolean": T.BooleanType(), "date": T.DateType(),
          "timestamp": T.TimestampType()}


def _struct(ddl: str) -> T.StructType:
    return T.StructType([T.StructField(*_named(column)) for column in ddl.split(",")])


def _named(column: str) -> tuple[str, T.DataType]:
    name, kind = column.split()
    return name, _TYPES[kind]


RAW: dict[str, T.StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}

# date column of each landed table, for coverage and cursors
DATE_COLUMN = {"pitches": "game_date", "games": "official_date", "batting_lines": "official_date",
               "standings": "standings_date", "war_seasons": "year_id", "coaches": "season"}
