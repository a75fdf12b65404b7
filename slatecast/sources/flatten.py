"""Nested API documents to flat landed rows.

Documents are read with fixed schemas, and every level is opened by
``explode``: no document is parsed in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIDES = ["home", "away"]

_ENTITY = "struct<id: bigint, name: string>"
_PERSON = "struct<id: bigint, fullName: string>"
_SIDE = f"struct<team: {_ENTITY}, probablePitcher: {_PERSON}>"
# Layouts of the feed's documents.
_GAME = f"""struct<gamePk: bigint, officialDate: string, season: string, gameType: string,
    status: struct<detailedState: string>, dayNight: string, doubleHeader: string, gameNumber: int,
    venue: {_ENTITY}, teams: struct<home: {_SIDE}, away: {_SIDE}>>"""
SCHEDULE = f"dates array<struct<games: array<{_GAME}>>>"
_BATTING = """struct<plateAppearances: int, atBats: int, hits: int, doubles: int, triples: int,
    homeRuns: int, baseOnBalls: int, strikeOuts: int, runs: int, rbi: int>"""
_PLAYER = f"""struct<person: {_PERSON}, position: struct<abbreviation: string>,
    battingOrder: string, stats: struct<batting: {_BATTING}>>"""
_BOX_SIDE = f"struct<team: {_ENTITY}, players: map<string, {_PLAYER}>>"
BOXSCORE = f"gamePk bigint, teams struct<home: {_BOX_SIDE}, away: {_BOX_SIDE}>"
_RECORD = f"""struct<team: {_ENTITY}, divisionRank: string, leagueRank: string, wins: int,
    losses: int, winningPercentage: string>"""
STANDINGS = f"""asOf string, records array<struct<division: struct<id: bigint>,
    league: struct<id: bigint>, teamRecords: array<{_RECORD}>>>"""
COACHES = f"""season int, team {_ENTITY},
    roster array<struct<person: {_PERSON}, job: string, jobId: string>>"""


def read_documents(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One document per file or per line; fields outside the schema are ignored."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def flatten_schedule(documents: DataFrame) -> DataFrame:
    """One row per scheduled game, with team and optional probable pitcher per side."""
    games = documents.select(F.explode("dates").alias("d")).select(F.explode("d.games").alias("g"))

    def side(s: str) -> list[Column]:
        return [F.col(f"g.teams.{s}.team.id").alias(f"{s}_team_id"),
                F.col(f"g.teams.{s}.team.name").alias(f"{s}_team_name"),
                F.col(f"g.teams.{s}.probablePitcher.id").alias(f"{s}_probable_pitcher_id"),
                F.col(f"g.teams.{s}.probablePitcher.fullName").alias(f"{s}_probable_pitcher_name")]

    return games.select(
        F.col("g.gamePk").alias("game_pk"), F.col("g.officialDate").alias("official_date"),
        F.col("g.season").alias("season"), F.col("g.gameType").alias("game_type"),
        F.col("g.status.detailedState").alias("status"), F.col("g.dayNight").alias("day_night"),
        F.col("g.doubleHeader").alias("doubleheader"), F.col("g.gameNumber").alias("game_number"),
        F.col("g.venue.id").alias("venue_id"), F.col("g.venue.name").alias("venue_name"),
        *side("home"), *side("away"))


def _box_players(boxscores: DataFrame, games: DataFrame, final: bool) -> DataFrame:
    """Players of both sides of the finished (or unfinished) games."""
    done = F.col("status") == "Final"
    wanted = games.filter(done if final else ~done | F.col("status").isNull()) \
                  .select("game_pk", "official_date", "game_type", "status")
    sides = F.array(*[F.struct(F.lit(s == "home").alias("is_home"),
                               F.col(f"teams.{s}.team.id").alias("team_id"),
                               F.col(f"teams.{s}.players").alias("players")) for s in SIDES])
    players = (boxscores.select(F.col("gamePk").alias("game_pk"), F.explode(sides).alias("s"))
               .select("game_pk", "s.is_home", "s.team_id", F.explode(F.map_values("s.players")).alias("p")))
    order = F.nullif(F.col("p.battingOrder"), F.lit("")).cast("int")
    return players.withColumn("batting_order", order).join(wanted, "game_pk")


def flatten_boxscore_lines(boxscores: DataFrame, games: DataFrame) -> DataFrame:
    """Official batting lines of finished games; players without one are skipped."""
    rows = _box_players(boxscores, games, final=True)
    line = F.col("p.stats.batting")
    # an absent and an empty line both read as all-NULL fields
    some = F.coalesce(*[line[f] for f in ("plateAppearances", "atBats", "hits", "doubles", "triples", "homeRuns",
                                          "baseOnBalls", "strikeOuts", "runs", "rbi")]).isNotNull()
    sub = F.coalesce(F.col("batting_order") % 100 != 0, F.lit(False))
    return rows.filter(some).select(
        "game_pk", "official_date", "game_type", "team_id", "is_home",
        F.col("p.person.id").alias("player_id"), F.col("p.person.fullName").alias("player_name"),
        F.col("p.position.abbreviation").alias("position"), "batting_order", sub.alias("is_substitute"),
        line["plateAppearances"].alias("plate_appearances"), line["atBats"].alias("at_bats"),
        line["hits"].alias("hits"), line["doubles"].alias("doubles"), line["triples"].alias("triples"),
        line["homeRuns"].alias("home_runs"), line["baseOnBalls"].alias("walks"),
        line["strikeOuts"].alias("strikeouts"), line["runs"].alias("runs"), line["rbi"].alias("rbi"))


def flatten_lineups(boxscores: DataFrame, games: DataFrame) -> DataFrame:
    """Posted batting orders of games not yet finished."""
    rows = _box_players(boxscores, games, final=False).filter(F.col("batting_order").isNotNull())
    return rows.select("game_pk", "official_date", "team_id", "is_home", F.col("p.person.id").alias("player_id"),
                       F.col("p.person.fullName").alias("player_name"), "batting_order",
                       F.col("status").alias("game_status"))


def flatten_standings(documents: DataFrame) -> DataFrame:
    records = documents.select("asOf", F.explode("records").alias("r")) \
                       .select("asOf", "r.division", "r.league", F.explode("r.teamRecords").alias("t"))
    return records.select(
        F.col("asOf").alias("standings_date"), F.col("t.team.id").alias("team_id"),
        F.col("t.team.name").alias("team_name"), F.col("division.id").alias("division_id"),
        F.col("league.id").alias("league_id"), F.col("t.divisionRank").alias("division_rank"),
        F.col("t.leagueRank").alias("league_rank"), F.col("t.wins").alias("wins"),
        F.col("t.losses").alias("losses"), F.col("t.winningPercentage").alias("win_pct"))


def flatten_coaches(documents: DataFrame) -> DataFrame:
    people = documents.select("season", "team", F.explode("roster").alias("c"))
    return people.select("season", F.col("team.id").alias("team_id"), F.col("team.name").alias("team_name"),
                         F.col("c.person.id").alias("person_id"), F.col("c.person.fullName").alias("person_name"),
                         F.col("c.job").alias("job"), F.col("c.jobId").alias("job_id"))
