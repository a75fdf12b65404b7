"""Star schema: dimensions and facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slatecast.functions.rates import avg_where, count_true, rate, rounded_to
from slatecast.operators.dedup import latest_wins
from slatecast.operators.grouping import additive_groups
from slatecast.operators.modal import infer_switch, latest_value, modal_value
from slatecast.operators.ordered import Running, ordered_windows
from slatecast.plans.intermediate import HANDS, PLATOON
from slatecast.session import store


STARTERS = ["home_starter_id", "home_starter_throws", "away_starter_id", "away_starter_throws"]


def dim_game(games: DataFrame, starters: DataFrame | None) -> DataFrame:
    """Scheduled games with date parts and both actual starters (None: without them).

    Starters are folded to one row per game first: one join instead of two.
    """
    def side(name: str, column: str):
        return F.max(F.when(F.col("pitching_side") == name, F.col(column)))

    if starters is not None:
        per_game = starters.groupBy("game_pk").agg(
            side("home", "starter_id").alias("home_starter_id"),
            side("home", "starter_throws").alias("home_starter_throws"),
            side("away", "starter_id").alias("away_starter_id"),
            side("away", "starter_throws").alias("away_starter_throws"))
        games = games.join(per_game, "game_pk", "left")
    return games.select(
        "game_pk", "official_date", "season", "game_type", "status", "day_night", "doubleheader",
        "game_number", F.month("official_date").alias("month"),
        F.date_format("official_date", "EEEE").alias("day_of_week"), "venue_id", "venue_name",
        "home_team_id", "home_team_name", "away_team_id", "away_team_name",
        "home_probable_pitcher_id", "away_probable_pitcher_id", *(STARTERS if starters is not None else []))


def dim_manager(coaches: DataFrame) -> DataFrame:
    """One manager per team and season: the lowest person id."""
    managers = coaches.filter((F.col("job_id") == "MNGR") | (F.lower("job") == "manager"))
    one = latest_wins(managers, ["season", "team_id"], [F.col("person_id").asc_nulls_last()])
    return one.select("season", "team_id", "team_name", F.col("person_id").alias("manager_id"),
                      F.col("person_name").alias("manager_name"))


def batter_sides(pitches: DataFrame) -> DataFrame:
    """Side of everyone seen at the plate."""
    return infer_switch(pitches.withColumnRenamed("batter_id", "player_id"), "player_id", "stand", "bats")


def dim_player(pitches: DataFrame, lines: DataFrame) -> DataFrame:
    """Everyone seen at the plate or on the mound, with name, side and hand."""
    bats = batter_sides(pitches)
    as_pitcher = pitches.withColumnRenamed("pitcher_id", "player_id")
    throws = modal_value(as_pitcher, ["player_id"], "p_throws", "throws")
    mound = as_pitcher.select("player_id").distinct()
    boxscore = latest_value(lines, ["player_id"], "player_name", "official_date", "_box_name")
    listed = latest_value(as_pitcher, ["player_id"], "pitcher_name", "game_date", "_pitch_name")
    people = (bats.withColumn("has_batted", F.lit(True))
              .join(mound.withColumn("has_pitched", F.lit(True)), "player_id", "full"))
    named = people.join(throws, "player_id", "left").join(boxscore, "player_id", "left") \
                  .join(listed, "player_id", "left")
    return named.select(
        "player_id",
        F.coalesce("_box_name", "_pitch_name", F.col("player_id").cast("string")).alias("player_name"),
        "bats", "throws", F.coalesce("has_pitched", F.lit(False)).alias("has_pitched"),
        F.coalesce("has_batted", F.lit(False)).alias("has_batted"))


def dim_team(games: DataFrame, pitches: DataFrame) -> DataFrame:
    """Crosswalk of numeric team id and code, through games both feeds share."""
    codes = pitches.select("game_pk", "home_team", "away_team").distinct()
    shared = games.join(codes, "game_pk")

    def side(s: str):
        return F.struct(F.col(f"{s}_team_id").alias("team_id"), F.col(f"{s}_team_name").alias("team_name"),
                        F.col(f"{s}_team").alias("team_code"))

    sides = shared.select("official_date", F.explode(F.array(side("home"), side("away"))).alias("s")) \
                  .select("official_date", "s.*")
    names = latest_value(sides, ["team_id"], "team_name", "official_date", "team_name")
    code = modal_value(sides, ["team_id"], "team_code", "team_code")
    return names.join(code, "team_id", "left").select("team_id", "team_name", "team_code")


def fct_standings_daily(standings: DataFrame) -> DataFrame:
    return standings.select("standings_date", "team_id", "team_name", "league_id", "division_id",
                            "league_rank", "division_rank", "wins", "losses", "win_pct")


QUALITY = ["k_pct", "bb_pct", "hard_hit_pct", "barrel_pct", "sweet_spot_pct", "line_drive_pct",
           "contact_pct", "chase_rate", "xba_mean", "xslg_mean", "xwoba_mean", "woba_mean", "ba",
           "xba_minus_ba"]


#: Columns of the fact by the parent that alone brings them.
BROUGHT = {
    "starters": ["opp_starter_id", "opp_starter_throws"],
    "batter_games": ["opp_p_throws", "sc_pa", "sc_hits", *QUALITY],
    "platoon": [f"{m}_vs_{h.lower()}" for h in HANDS for m in PLATOON],
    "standings": ["league_rank_entering", "division_rank_entering", "win_pct_entering"],
    "managers": ["manager_id", "manager_name"],
}


def fct_batter_game(lines: DataFrame, games: DataFrame, batter_games: DataFrame | None, platoon: DataFrame | None,
                    standings: DataFrame | None, managers: DataFrame | None) -> DataFrame:
    """Core fact: a batter's regular-season game with a plate appearance.

    Joins on (game, batter) meet inputs already grouped on that key; the
    dimension sides carry no hint, their measured size decides (AQE). All parents
    but lines and games only add columns (``BROUGHT``): without one, None or games
    without starters, the fact has the same rows and lacks those columns.
    """
    played = lines.filter("plate_appearances >= 1").withColumnRenamed("player_id", "batter_id")
    regular = games.filter("game_type = 'R'").drop("game_type", "status", "game_number")
    wide = played.drop("official_date", "game_type").join(regular, "game_pk")
    if batter_games is not None:
        sc = batter_games.select("game_pk", "batter_id", *[c for c in BROUGHT["batter_games"] if c in batter_games.columns])
        wide = wide.join(sc, ["game_pk", "batter_id"], "left")
    if platoon is not None:
        wide = wide.join(platoon.drop("game_date"), ["game_pk", "batter_id"], "left")
    if standings is not None:
        day_before = standings.select(F.date_add("standings_date", 1).alias("official_date"), "team_id",
                                      F.col("league_rank").alias("league_rank_entering"),
                                      F.col("division_rank").alias("division_rank_entering"),
                                      F.col("win_pct").alias("win_pct_entering"))
        wide = wide.join(day_before, ["official_date", "team_id"], "left")
    if managers is not None:
        wide = wide.join(managers.select("season", "team_id", "manager_id", "manager_name"), ["season", "team_id"], "left")

    def other(column: str):
        return F.when(F.col("is_home"), F.col(f"away_{column}")).otherwise(F.col(f"home_{column}"))

    opponent = {"opponent_team_id": "team_id", "opponent_team_name": "team_name"}
    if STARTERS[0] in games.columns:
        opponent |= {"opp_starter_id": "starter_id", "opp_starter_throws": "starter_throws"}
    wide = wide.withColumns({
        **{n: other(c) for n, c in opponent.items()}, "game_date": F.col("official_date"),
        "pa": F.col("plate_appearances"), "ab": F.col("at_bats"), "has_hit": (F.col("hits") >= 1).cast("int")})
    return wide.select(*[c for c in FACT if c in wide.columns])


FACT = ["game_pk", "game_date", "season", "month", "day_of_week",
        "day_night", "doubleheader", "venue_id", "venue_name", "batter_id", "player_name", "team_id",
        "is_home", "opponent_team_id", "opponent_team_name", *BROUGHT["starters"],
        "opp_p_throws", "batting_order_slot", "is_substitute", "pa", "ab", "hits", "has_hit", "walks",
        "strikeouts", "home_runs", "runs", "rbi", "sc_pa", "sc_hits", *QUALITY,
        *BROUGHT["platoon"], *BROUGHT["standings"], *BROUGHT["managers"]]


def fct_pitcher_game(flags: DataFrame, starters: DataFrame) -> DataFrame:
    """A pitcher's game: one grouped pass, then the starter flag."""
    counts = {"total_pitches": None, "bf": F.col("is_pa_end"), "hits_conceded": F.col("is_hit"),
              "_k": F.col("is_k"), "_bb": F.col("is_bb"), "_whiffs": F.col("is_whiff"),
              "_in": F.col("is_in_zone"), "_out": F.col("is_out_zone"),
              "_in_swings": F.col("is_in_zone") & F.col("is_swing"),
              "_out_swings": F.col("is_out_zone") & F.col("is_swing"),
              "_xwoba_n": F.col("is_pa_end") & F.col("xwoba").isNotNull()}
    game = additive_groups(flags, ["game_pk", "game_date", "pitcher_id"],
                           ["pitcher_name", "p_throws", "inning_topbot", "home_team", "away_team"],
                           counts, {"_xwoba": F.when(F.col("is_pa_end"), F.col("xwoba"))}).filter("bf >= 1")
    opened = starters.groupBy("game_pk").agg(F.collect_set("starter_id").alias("_opened"))   # a few per game
    opener = F.array_contains("_opened", F.col("pitcher_id"))
    return game.join(opened, "game_pk", "left").withColumn("is_starter", opener).select(
        "game_pk", "game_date", "pitcher_id", "pitcher_name",
        F.when(F.col("inning_topbot") == "Top", F.col("home_team")).otherwise(F.col("away_team")).alias("team_code"),
        "p_throws", F.coalesce("is_starter", F.lit(False)).alias("is_starter"), "bf", "hits_conceded",
        "total_pitches", rate("_k", "bf").alias("k_pct"), rate("_bb", "bf").alias("bb_pct"),
        rate("_out_swings", "_out").alias("o_swing_pct"), rate("_in_swings", "_in").alias("z_swing_pct"),
        rate("_whiffs", "total_pitches").alias("swstr_pct"), rate("_xwoba", "_xwoba_n").alias("xwoba_against"))


def fct_team_game(lines: DataFrame, flags: DataFrame, teams: DataFrame) -> DataFrame:
    """A team's game: offense from official lines, defense from pitches."""
    sums = {"pa": "plate_appearances", "ab": "at_bats", "hits": "hits", "walks": "walks",
            "strikeouts": "strikeouts", "runs": "runs", "home_runs": "home_runs"}
    offense = lines.groupBy("game_pk", F.col("official_date").alias("game_date"), "team_id").agg(
        F.max("is_home").alias("is_home"), *[F.sum(c).alias(n) for n, c in sums.items()])
    fielding = F.when(F.col("inning_topbot") == "Top", F.col("home_team")).otherwise(F.col("away_team"))
    defense = flags.groupBy("game_pk", fielding.alias("team_code")).agg(
        count_true("is_pa_end").alias("bf_against"), count_true("is_hit").alias("hits_allowed"),
        count_true("is_k").alias("strikeouts_thrown"), count_true("is_bb").alias("walks_allowed"),
        rounded_to(avg_where("xwoba", "is_pa_end"), 4).alias("xwoba_against"))
    named = offense.join(teams, "team_id", "left").join(defense, ["game_pk", "team_code"], "left")
    return named.select("game_pk", "game_date", "team_id", "team_code", "team_name", "is_home", *sums,
                        "bf_against", "hits_allowed", "strikeouts_thrown", "walks_allowed", "xwoba_against")


BVP_COUNTS = {"pa": "is_pa_end", "hits": "is_hit", "k": "is_k", "bb": "is_bb", "bip": "is_bip",
              "hard_hits": "is_hard_hit", "barrels": "is_barrel"}


def pair_history(flags: DataFrame, keys: Sequence[str], counts: dict[str, str],
                 prefix: str) -> DataFrame:
    """Per-meeting counts turned into totals of all earlier meetings."""
    meetings = store(flags.groupBy(*keys, "game_pk", "game_date").agg(
        *[count_true(flag).alias(f"{prefix}{n}") for n, flag in counts.items()]), "meetings")
    totals = {f"{prefix}{n}_career": Running("sum", F.col(f"{prefix}{n}")) for n in counts}
    return ordered_windows(meetings, keys, ["game_date", "game_pk"], totals)


BVP_RATIOS = {"bvp_hits_per_pa": ("hits", "pa"), "bvp_k_pct": ("k", "pa"), "bvp_bb_pct": ("bb", "pa"),
              "bvp_hard_hit_pct": ("hard_hits", "bip"), "bvp_barrel_pct": ("barrels", "bip")}


def fct_batter_vs_pitcher(flags: DataFrame, wanted: Sequence[str] = tuple(BVP_RATIOS)) -> DataFrame:
    """Batter against pitcher entering each meeting; first meetings are NULL. Only the ``wanted`` ratios are built."""
    ratios = {n: BVP_RATIOS[n] for n in wanted}
    read = {"pa", *(part for parts in ratios.values() for part in parts)}
    rows = pair_history(flags, ["batter_id", "pitcher_id"], {n: f for n, f in BVP_COUNTS.items() if n in read}, "bvp_")
    return rows.select("batter_id", "pitcher_id", "game_pk", "game_date", "bvp_pa_career",
                       *[rate(f"bvp_{a}_career", f"bvp_{b}_career").alias(n)
                         for n, (a, b) in ratios.items()])


def fct_batter_pitchtype(flags: DataFrame) -> DataFrame:
    """Batter against pitch type over the full history (not point-in-time)."""
    known = flags.filter(F.col("pitch_type").isNotNull())
    counts = known.groupBy("batter_id", "pitch_type").agg(
        F.count(F.lit(1)).alias("pitches_seen"), count_true("is_swing").alias("swings"),
        count_true("is_whiff").alias("whiffs"), count_true("is_pa_end").alias("pa_ended"),
        count_true("is_ab").alias("ab_ended"), count_true("is_hit").alias("hits"),
        rounded_to(avg_where("xba", "is_bip"), 4).alias("xba_mean"))
    return counts.withColumns({"whiff_per_swing": rate("whiffs", "swings"), "ba": rate("hits", "ab_ended")}) \
        .select("batter_id", "pitch_type", "pitches_seen", "swings", "whiffs", "whiff_per_swing",
                "pa_ended", "ab_ended", "hits", "ba", "xba_mean")
