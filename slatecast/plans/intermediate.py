"""Game-level aggregates of flagged pitches and strictly-prior team, pitcher
and league form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatecast.functions.rates import rate, rounded_to, safe_div
from slatecast.operators.grouping import additive_groups
from slatecast.operators.modal import hand_split
from slatecast.operators.ordered import Recent, ordered_windows

HANDS = ["L", "R"]
BATTER_GAME = ["game_pk", "game_date", "batter_id"]

# counts of one batter's pitches; NULL flags count as false
_COUNTS = {
    "pa": "is_pa_end", "swings": "is_swing", "contacts": "is_contact",
    "out_zone": "is_out_zone", "chases": "is_chase", "bip": "is_bip",
    "hard_hits": "is_hard_hit", "barrels": "is_barrel", "sweet_spots": "is_sweet_spot",
    "line_drives": "is_line_drive", "hits": "is_hit", "ab": "is_ab",
    "strikeouts": "is_k", "walks": "is_bb",
}


def plate_rates() -> dict[str, Column]:
    """The eight guarded rates over the counts above."""
    pairs = {"k_pct": ("strikeouts", "pa"), "bb_pct": ("walks", "pa"),
             "hard_hit_pct": ("hard_hits", "bip"), "barrel_pct": ("barrels", "bip"),
             "sweet_spot_pct": ("sweet_spots", "bip"), "line_drive_pct": ("line_drives", "bip"),
             "contact_pct": ("contacts", "swings"), "chase_rate": ("chases", "out_zone")}
    return {name: rate(a, b) for name, (a, b) in pairs.items()}


def batter_game_by_hand(flags: DataFrame) -> DataFrame:
    """Counts and sums per batter, game and pitcher hand: the one pass over
    pitches that both batter models are built from."""
    means = {v: flag for v, flag in _MEANS.items() if v in flags.columns}
    sums = {f"{v}_sum": F.when(F.col(flag), F.col(v)) for v, flag in means.items()}
    counts = {"pitches": None, **{n: F.col(flag) for n, flag in _COUNTS.items()}}
    counts |= {f"{v}_n": F.col(flag) & F.col(v).isNotNull() for v, flag in means.items()}
    return additive_groups(flags, [*BATTER_GAME, "p_throws"], ["home_team", "away_team", "inning_topbot"],
                           counts, sums)


_MEANS = {"xba": "is_bip", "xslg": "is_bip", "xwoba": "is_pa_end", "woba_value": "is_pa_end"}
_MEAN_NAMES = {"xba": "xba_mean", "xslg": "xslg_mean", "xwoba": "xwoba_mean", "woba_value": "woba_mean"}


def int_batter_game(by_hand: DataFrame) -> DataFrame:
    """One row per batter-game with at least one plate appearance event.

    The teams, the hand most faced and a mean are left out where ``by_hand`` lacks what they are read from."""
    means = [v for v in _MEANS if f"{v}_n" in by_hand.columns]
    found = [F.sum(n).alias(n) for n in _COUNTS]
    found += [F.sum(f"{v}_{s}").alias(f"{v}_{s}") for v in means for s in ("sum", "n")]
    average = safe_div("hits", "ab")
    made = {}
    if "inning_topbot" in by_hand.columns:
        found += [F.max("home_team").alias("home_team"), F.max("away_team").alias("away_team"),
                  F.max("inning_topbot").alias("topbot")]
        top = F.col("topbot") == "Top"
        made |= {"team_code": F.when(top, F.col("away_team")).otherwise(F.col("home_team")),
                 "opponent_code": F.when(top, F.col("home_team")).otherwise(F.col("away_team")),
                 "sc_is_home": F.col("topbot") == "Bot"}
    if "pitches" in by_hand.columns:
        # most-faced hand: largest count, then the lower letter; an unknown hand last
        found.append(F.max(F.struct(F.col("pitches"), -F.ascii(F.coalesce("p_throws", F.lit("~"))), F.col("p_throws")))
                     .alias("_faced"))
        made |= {"opp_p_throws": F.col("_faced.p_throws")}
    made |= {"sc_pa": F.col("pa"), "sc_hits": F.col("hits"), "sc_ab": F.col("ab")}
    made |= {c: F.col(c) for c in ("strikeouts", "walks", "bip", "hard_hits", "barrels")}
    made |= plate_rates()
    mean = {v: safe_div(f"{v}_sum", f"{v}_n") for v in means}
    made |= {_MEAN_NAMES[v]: rounded_to(mean[v], 4) for v in means}
    made |= {"ba": rounded_to(average, 4)}
    if "xba" in mean:
        made |= {"xba_minus_ba": rounded_to(mean["xba"] - average, 4)}
    game = by_hand.groupBy(*BATTER_GAME).agg(*found).filter("pa >= 1")
    return game.select(*BATTER_GAME, *[c.alias(n) for n, c in made.items()])


PLATOON = ["hits", "pa", "k_pct", "bb_pct", "hard_hit_pct", "barrel_pct", "sweet_spot_pct",
           "line_drive_pct", "contact_pct", "chase_rate"]


def int_batter_game_platoon(by_hand: DataFrame) -> DataFrame:
    """The ten measures of a batter-game split by pitcher hand, wide."""
    rates = plate_rates()
    return hand_split(by_hand, BATTER_GAME, "p_throws", HANDS,
                      {m: rates.get(m, F.col(m)) for m in PLATOON})


def int_game_starters(pitches: DataFrame) -> DataFrame:
    """Thrower of the first pitch of each half; the home side pitches the top.

    All pitches meet a hash aggregate per thrower (numbers only inside it);
    the few throwers of a half are then compared.
    """
    number = F.col("at_bat_number").cast("long") * (1 << 20) + F.col("pitch_number").cast("long")
    throwers = pitches.groupBy("game_pk", "inning_topbot", "pitcher_id", "p_throws").agg(
        F.min(number).alias("_first"), F.min("game_date").alias("game_date"))
    first = F.min(F.struct("_first", "game_date", "pitcher_id", "p_throws"))
    halves = throwers.groupBy("game_pk", "inning_topbot").agg(first.alias("f"))
    return halves.select(
        "game_pk", F.col("f.game_date").alias("game_date"),
        F.when(F.col("inning_topbot") == "Top", "home").otherwise("away").alias("pitching_side"),
        F.col("f.pitcher_id").alias("starter_id"), F.col("f.p_throws").alias("starter_throws"))


def int_league_daily(batter_games: DataFrame) -> DataFrame:
    """League hits per plate appearance up to and including each date.

    The window runs over one row per calendar date, whatever the data size.
    """
    daily = batter_games.groupBy("game_date").agg(F.sum("hits").alias("h"), F.sum("pa").alias("p"))
    upto = W.orderBy("game_date").rowsBetween(W.unboundedPreceding, 0)
    return daily.select("game_date", safe_div(F.sum("h").over(upto), F.sum("p").over(upto))
                        .alias("league_hit_per_pa"))


PITCHER_FORM = {
    "p_hits_per_bf_roll5": ("hits_per_bf", 5), "p_hits_per_bf_roll10": ("hits_per_bf", 10),
    "p_k_pct_roll5": ("k_pct", 5), "p_k_pct_roll10": ("k_pct", 10),
    "p_bb_pct_roll10": ("bb_pct", 10), "p_swstr_pct_roll10": ("swstr_pct", 10),
    "p_o_swing_pct_roll10": ("o_swing_pct", 10), "p_xwoba_against_roll10": ("xwoba_against", 10),
    "p_bf_roll10": ("bf", 10),
}

TEAM_FORM = {
    "team_hits_roll15": "hits", "team_runs_roll15": "runs", "team_pa_roll15": "pa",
    "team_hits_allowed_per_bf_roll15": "hits_allowed_per_bf",
    "team_xwoba_against_roll15": "xwoba_against", "team_k_pct_against_roll15": "k_against",
}


#: What the training frame's features are read from, of the written tables under them.
UNDER_FEATURES = {
    "batter_game_by_hand": [*BATTER_GAME, "p_throws", *_COUNTS, "xba_sum", "xba_n"],
    "fct_pitcher_game": ["game_pk", "game_date", "pitcher_id", "is_starter", "hits_conceded",
                         *dict.fromkeys(c for c, _ in PITCHER_FORM.values() if c != "hits_per_bf")],
}


def starts(pitcher_games: DataFrame) -> DataFrame:
    return pitcher_games.filter("is_starter").withColumn("hits_per_bf", safe_div("hits_conceded", "bf"))


def team_rates(team_games: DataFrame) -> DataFrame:
    return team_games.withColumns({"hits_allowed_per_bf": safe_div("hits_allowed", "bf_against"),
                                   "k_against": safe_div("strikeouts_thrown", "bf_against")})


def int_pitcher_rolling(pitcher_games: DataFrame) -> DataFrame:
    """Form of each starter entering each start (last 5 / 10 starts)."""
    specs = {"p_starts_prior": Recent("count", None, 10)}
    specs |= {n: Recent("avg", F.col(c), w) for n, (c, w) in PITCHER_FORM.items()}
    narrow = starts(pitcher_games).select("game_pk", "game_date", "pitcher_id",
                                          *{c: 0 for c, _ in PITCHER_FORM.values()})
    rows = ordered_windows(narrow, ["pitcher_id"], ["game_date", "game_pk"], specs)
    return rows.select("game_pk", "game_date", "pitcher_id", *specs)


def int_team_rolling(team_games: DataFrame) -> DataFrame:
    """Form of each team entering each game (last 15 games)."""
    specs = {"team_games_prior": Recent("count", None, 15)}
    specs |= {n: Recent("avg", F.col(c), 15) for n, c in TEAM_FORM.items()}
    narrow = team_rates(team_games).select("game_pk", "game_date", "team_id", *TEAM_FORM.values())
    rows = ordered_windows(narrow, ["team_id"], ["game_date", "game_pk"], specs)
    return rows.select("game_pk", "game_date", "team_id", *specs)
