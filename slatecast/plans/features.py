"""Training frame: one row per batter-game, every feature strictly prior."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatecast.functions.rates import LEAGUE_PRIOR, eb_shrink, safe_div
from slatecast.operators.ordered import Previous, Running, ordered_windows
from slatecast.operators.runs import recent_means, streak_entering, streak_specs

# Window lengths and the metrics rolled over them.
WINDOWS = [5, 10, 20, 40]
METRICS = ["has_hit", "hit_per_pa", "pa", "k_pct", "bb_pct", "contact_pct", "chase_rate",
           "hard_hit_pct", "barrel_pct", "sweet_spot_pct", "line_drive_pct", "xba_mean",
           "xba_minus_ba"]
SPLIT_METRICS = ["hit_per_pa", "k_pct", "contact_pct", "chase_rate", "hard_hit_pct", "barrel_pct"]
CONTEXT = ["game_pk", "game_date", "season", "month", "day_of_week", "day_night", "doubleheader",
           "venue_id", "batter_id", "player_name", "team_id", "opponent_team_id", "is_home",
           "batting_order_slot", "is_substitute", "opp_starter_id", "opp_starter_throws",
           "league_rank_entering", "division_rank_entering", "win_pct_entering"]
TARGETS = ["has_hit", "pa", "hits"]
ORDER = ["game_date", "game_pk"]
SPLIT_COLUMNS = [f"{m}_vs_{h}" for m in SPLIT_METRICS for h in "lr"]


def with_rates(batter_games: DataFrame) -> DataFrame:
    parts = {"hit_per_pa": ("hits", "pa"), "hit_per_pa_vs_l": ("hits_vs_l", "pa_vs_l"),
             "hit_per_pa_vs_r": ("hits_vs_r", "pa_vs_r")}
    return batter_games.withColumns({n: safe_div(a, b) for n, (a, b) in parts.items() if a in batter_games.columns})


def matched_split(hand: str) -> dict:
    """Rolling split columns picked by today's starter hand (unknown counts as R)."""
    return {f"{m}_platoon_roll{w}": F.when(F.col(hand) == "L", F.col(f"_{m}_vs_l_roll{w}"))
            .otherwise(F.col(f"_{m}_vs_r_roll{w}")) for w in WINDOWS for m in SPLIT_METRICS}


def lagged_history(batter_games: DataFrame, sized_by: DataFrame | None = None,
                   carry: Sequence[str] = ()) -> DataFrame:
    """Prior totals, streak marks and 100 rolling means in one ordered pass;
    ``carry`` columns ride along. What a narrower fact lacks is left out."""
    base = with_rates(batter_games)
    need = [*CONTEXT, *TARGETS, *METRICS, *SPLIT_COLUMNS, *carry]
    base = base.select(*[c for c in dict.fromkeys(need) if c in base.columns])
    metrics, splits = ([c for c in cs if c in base.columns] for cs in (METRICS, SPLIT_COLUMNS))
    season = ("season",)
    specs = {
        "_career_pa": Running("sum", F.col("pa")), "_career_hits": Running("sum", F.col("hits")),
        "_career_games": Running("count"),
        "_season_pa": Running("sum", F.col("pa"), season),
        "_season_hits": Running("sum", F.col("hits"), season),
        "_season_games": Running("count", None, season),
        "_previous_date": Previous(F.col("game_date")),
        **streak_specs("has_hit", "game_idx"),
        **recent_means(metrics, WINDOWS), **recent_means(splits, WINDOWS, "_"),
    }
    return ordered_windows(base, ["batter_id"], ORDER, specs, index="game_idx", sized_by=sized_by)


def league_entering(league_daily: DataFrame) -> DataFrame:
    """As-of league rate per date, strictly earlier.

    Every batter-game date is itself a league date, so the latest earlier
    league row is the previous row: a shift over the calendar and an equi-join
    replace a general as-of join.
    """
    previous = F.lag("league_hit_per_pa").over(W.orderBy("game_date"))
    return league_daily.select("game_date", previous.alias("league_hit_per_pa_entering"))


def prior_season(war: DataFrame) -> DataFrame:
    """Season totals over stints, keyed by the season after."""
    total = war.groupBy("player_id", "season").agg(F.sum("war").alias("war_prev_season"),
                                                   F.sum("pa").alias("pa_prev_season"))
    return total.select(F.col("player_id").alias("batter_id"), (F.col("season") + 1).alias("season"),
                        "war_prev_season", "pa_prev_season")


PITCHER_COLUMNS = ["p_starts_prior", "p_hits_per_bf_roll5", "p_hits_per_bf_roll10", "p_k_pct_roll5",
                   "p_k_pct_roll10", "p_bb_pct_roll10", "p_swstr_pct_roll10", "p_o_swing_pct_roll10",
                   "p_xwoba_against_roll10", "p_bf_roll10"]
OFFENSE = ["team_hits_roll15", "team_runs_roll15", "team_pa_roll15"]
DEFENSE = {"opp_hits_allowed_per_bf_roll15": "team_hits_allowed_per_bf_roll15",
           "opp_xwoba_against_roll15": "team_xwoba_against_roll15",
           "opp_k_pct_against_roll15": "team_k_pct_against_roll15"}
ROLLED = [f"{m}_roll{w}" for w in WINDOWS for m in METRICS]
PLATOON_ROLLED = [f"{m}_platoon_roll{w}" for w in WINDOWS for m in SPLIT_METRICS]
COUNTS = ["career_pa_prior", "career_hits_prior", "career_games_prior",
          "season_pa_prior", "season_hits_prior", "season_games_prior"]
FEATURES = [*COUNTS, "days_rest", "league_hit_per_pa_entering", "eb_hit_per_pa_career",
            "eb_hit_per_pa_season", "hit_streak_entering", "hitless_streak_entering",
            *ROLLED, *PLATOON_ROLLED, *PITCHER_COLUMNS, *OFFENSE, *DEFENSE,
            "war_prev_season", "pa_prev_season"]


def prior_seasons(war: DataFrame) -> DataFrame:
    """All prior-season totals of a batter in one row (a career has few seasons)."""
    each = F.struct("season", "war_prev_season", "pa_prev_season")
    return prior_season(war).groupBy("batter_id").agg(F.collect_list(each).alias("_seasons"))


def game_context(pitcher_rolling: DataFrame | None, team_rolling: DataFrame | None,
                 league_daily: DataFrame | None) -> DataFrame:
    """One row per game: the form of its starters and of its teams (two each), and the league's.
    Starters or teams may be None, not both; the league's form comes with the teams."""
    found = []
    if pitcher_rolling is not None:
        starters = F.struct("pitcher_id", *PITCHER_COLUMNS)
        found.append(pitcher_rolling.groupBy("game_pk").agg(F.collect_list(starters).alias("_starters")))
    if team_rolling is not None:
        each = [F.collect_list(F.struct("team_id", *OFFENSE, *DEFENSE.values())).alias("_teams")]
        if league_daily is not None:
            team_rolling = team_rolling.join(league_entering(league_daily), "game_date", "left")
            each.append(F.max("league_hit_per_pa_entering").alias("league_hit_per_pa_entering"))
        found.append(team_rolling.groupBy("game_pk").agg(*each))
    return reduce(lambda a, b: a.join(b, "game_pk", "full"), found)


def join_context(batter_games: DataFrame, league_daily: DataFrame | None, pitcher_rolling: DataFrame | None,
                 team_rolling: DataFrame | None, war: DataFrame | None) -> DataFrame:
    """Opposing starter, own offense, opposing defense, league and prior season.

    The fact moves twice only: to its game's context row, and to its batter,
    where the history windows need it anyway. A source that is None is left out
    with its columns; the league alone, a row a date, is met by date.
    """
    def first(column: str, key: str, value: str) -> Column:
        return F.get(F.filter(column, lambda x: x[key] == F.col(value)), F.lit(0))

    # each is looked up once, as a column of its own
    found, columns = {}, {}
    if pitcher_rolling is not None:
        found["_starter"] = first("_starters", "pitcher_id", "opp_starter_id")
        columns |= {c: F.col("_starter")[c] for c in PITCHER_COLUMNS}
    if team_rolling is not None:
        for side, key, names in (("_own", "team_id", {c: c for c in OFFENSE}), ("_other", "opponent_team_id", DEFENSE)):
            if key in batter_games.columns:
                found[side] = first("_teams", "team_id", key)
                columns |= {n: F.col(side)[c] for n, c in names.items()}
    rows = batter_games
    if found:
        rows = rows.join(game_context(pitcher_rolling, team_rolling, league_daily), "game_pk", "left")
        rows = rows.withColumns(found).drop("_starters", "_teams").withColumns(columns).drop(*found)
    if league_daily is not None and team_rolling is None:
        rows = rows.join(league_entering(league_daily), "game_date", "left")
    if war is None:
        return rows
    rows = rows.join(prior_seasons(war), "batter_id", "left")
    rows = rows.withColumn("_season", first("_seasons", "season", "season")).drop("_seasons")
    return rows.withColumns({c: F.col("_season")[c] for c in ("war_prev_season", "pa_prev_season")}).drop("_season")


JOINED = [*PITCHER_COLUMNS, *OFFENSE, *DEFENSE, "war_prev_season", "pa_prev_season",
          "league_hit_per_pa_entering"]


def feat_batter_game(batter_games: DataFrame, league_daily: DataFrame | None, pitcher_rolling: DataFrame | None,
                     team_rolling: DataFrame | None, war: DataFrame | None, keep: Sequence[str] = (),
                     columns: Sequence[str] | None = None) -> DataFrame:
    """The context joins come first, on narrow rows: the hundred rolling
    columns appear in the last stage and are never shuffled. ``keep`` names
    further columns of the fact that stay. ``columns`` names the only ones
    wanted: then the fact may be as narrow as ``fact_columns``, and sources
    that hold none of them (``READ_FROM``) may be None."""
    context = join_context(batter_games, league_daily, pitcher_rolling, team_rolling, war)
    if columns is not None and not set(columns) & set(FEATURES) - set(JOINED):
        return context.select(*columns)   # nothing of a batter's history
    if war is None:
        # no join has brought a batter's rows together: moved once, for the windows of a season and of a career
        context = context.repartition("batter_id")
    rows = lagged_history(context, sized_by=batter_games, carry=[*JOINED, *keep, *(columns or ())])
    made = {f"{s}_{c}_prior": F.coalesce(f"_{s}_{c}", F.lit(0))
            for s in ("career", "season") for c in ("pa", "hits", "games")}
    rows = rows.withColumns(made)
    made = {"days_rest": F.datediff("game_date", "_previous_date"),
            "hit_streak_entering": streak_entering("game_idx", "_last_miss"),
            "hitless_streak_entering": streak_entering("game_idx", "_last_hit")}
    if league_daily is not None:
        prior = F.coalesce("league_hit_per_pa_entering", F.lit(LEAGUE_PRIOR))
        made |= {"eb_hit_per_pa_career": eb_shrink("career_hits_prior", "career_pa_prior", prior),
                 "eb_hit_per_pa_season": eb_shrink("season_hits_prior", "season_pa_prior", prior)}
    if columns is None:
        return rows.withColumns({**made, **matched_split("opp_starter_throws")}).select(
            *CONTEXT, *TARGETS, *FEATURES, *keep)
    split = matched_split("opp_starter_throws")
    return rows.withColumns({n: c for n, c in {**made, **split}.items() if n in columns}).select(*columns)


#: Features by the model, beside the fact, that they are read from.
READ_FROM = {
    "pitcher_rolling": PITCHER_COLUMNS, "team_rolling": [*OFFENSE, *DEFENSE], "war": ["war_prev_season", "pa_prev_season"],
    "league_daily": ["league_hit_per_pa_entering", "eb_hit_per_pa_career", "eb_hit_per_pa_season"],
}


def fact_columns(columns: Sequence[str]) -> list[str]:
    """Columns of the batter-game fact from which these columns of the training frame are built."""
    wanted = set(columns)
    need = {"game_pk", "game_date", "season", "batter_id", *TARGETS}
    need |= wanted - set(FEATURES)
    need |= {m for m in METRICS if wanted & {f"{m}_roll{w}" for w in WINDOWS}} - {"hit_per_pa"}
    for m in SPLIT_METRICS:
        if wanted & {f"{m}_platoon_roll{w}" for w in WINDOWS}:
            parts = ["hits", "pa"] if m == "hit_per_pa" else [m]
            need |= {"opp_starter_throws", *(f"{p}_vs_{h}" for p in parts for h in "lr")}
    need |= {"opp_starter_id"} if wanted & set(PITCHER_COLUMNS) else set()
    need |= {"team_id"} if wanted & set(OFFENSE) else set()
    need |= {"opponent_team_id"} if wanted & set(DEFENSE) else set()
    return sorted(need)
