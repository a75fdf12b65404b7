"""Serving frame: features of one date's expected batters, from rows before it.

Only the latest state per entity is needed, so nothing is windowed over the
full history: totals are grouped sums, rolling means come from the last few
rows per entity (a row_number limit Spark applies before the shuffle), and the
history is first cut to the entities on the slate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecast.functions.rates import eb_shrink, safe_div
from slatecast.operators.dedup import top_k
from slatecast.operators.modal import modal_value
from slatecast.plans.features import (DEFENSE, FEATURES, METRICS, OFFENSE, ORDER, SPLIT_COLUMNS,
                                      WINDOWS, matched_split, prior_season, with_rates)
from slatecast.plans.intermediate import PITCHER_FORM, TEAM_FORM, starts, team_rates
from slatecast.session import store

RECENT_DAYS = 15
SLOT_STARTS = 7
LINEUP_SIZE = 9


def slate_sides(games: DataFrame, date: str) -> DataFrame:
    """Two rows per regular-season game of the date, with the opposing probable starter."""
    def side(own: str, other: str) -> Column:
        return F.struct(F.col(f"{own}_team_id").alias("team_id"),
                        F.col(f"{other}_team_id").alias("opponent_team_id"),
                        F.lit(own == "home").alias("is_home"),
                        F.col(f"{other}_probable_pitcher_id").alias("opp_starter_id"))

    today = games.filter((F.col("official_date") == F.lit(date).cast("date")) & (F.col("game_type") == "R"))
    return today.select("game_pk", "official_date", "season", "month", "day_of_week", "day_night",
                        "doubleheader", "venue_id",
                        F.explode(F.array(side("home", "away"), side("away", "home"))).alias("s")) \
        .select("game_pk", "official_date", "season", "month", "day_of_week", "day_night",
                "doubleheader", "venue_id", "s.*")


def _newest_first() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in ORDER]


def last_means(df: DataFrame, key: str, means: dict[str, tuple[str, int]],
               extra: Sequence[str] = ()) -> DataFrame:
    """Mean over the last n rows per key, and ``extra`` columns of the last row."""
    longest = max(n for _, n in means.values())
    tail = top_k(df, [key], _newest_first(), longest, "_age")
    newest = [F.max(F.when(F.col("_age") == 1, F.col(c))).alias(c) for c in extra]
    return tail.groupBy(key).agg(
        *newest, *[F.avg(F.when(F.col("_age") <= n, F.col(c))).alias(name)
                   for name, (c, n) in means.items()])


def streaks_now(hist: DataFrame, key: str, outcome: str) -> DataFrame:
    """Current run of hits and of misses per key: rows after the last opposite one."""
    stamp = F.struct(*ORDER)
    marks = hist.groupBy(key).agg(F.max(F.when(F.col(outcome) == 0, stamp)).alias("_miss"),
                                  F.max(F.when(F.col(outcome) == 1, stamp)).alias("_hit"))
    after = hist.select(key, stamp.alias("_at")).join(marks, key)
    return after.groupBy(key).agg(
        F.count_if(F.col("_miss").isNull() | (F.col("_at") > F.col("_miss"))).alias("hit_streak_entering"),
        F.count_if(F.col("_hit").isNull() | (F.col("_at") > F.col("_hit"))).alias("hitless_streak_entering"))


def current_form(hist: DataFrame) -> DataFrame:
    """Each batter's totals, streaks and rolling means through the latest game."""
    rated = with_rates(hist)
    means = {f"{m}_roll{w}": (m, w) for w in WINDOWS for m in METRICS}
    means |= {f"_{m}_roll{w}": (m, w) for w in WINDOWS for m in SPLIT_COLUMNS}
    recent = last_means(rated, "batter_id", means, ["player_name", "season", "game_date"]) \
        .withColumnsRenamed({"season": "_last_season", "game_date": "_last_date"})
    # totals per (batter, season) first: the career is their sum
    seasons = hist.groupBy("batter_id", "season").agg(
        F.sum("pa").alias("_pa"), F.sum("hits").alias("_hits"), F.count(F.lit(1)).alias("_games"))
    career = seasons.groupBy("batter_id").agg(
        F.sum("_pa").alias("career_pa_prior"), F.sum("_hits").alias("career_hits_prior"),
        F.sum("_games").alias("career_games_prior"))
    latest = seasons.select("batter_id", F.col("season").alias("_last_season"),
                            F.col("_pa").alias("_season_pa"), F.col("_hits").alias("_season_hits"),
                            F.col("_games").alias("_season_games"))
    return (recent.join(career, "batter_id").join(latest, ["batter_id", "_last_season"])
            .join(streaks_now(hist, "batter_id", "has_hit"), "batter_id"))


def projected_lineup(hist: DataFrame, date: str) -> DataFrame:
    """Top nine recent starters per team with their modal slot of late."""
    day = F.lit(date).cast("date")
    started = hist.filter(F.col("batting_order_slot").between(1, LINEUP_SIZE) & ~F.col("is_substitute")
                          & (F.col("game_date") >= F.date_sub(day, RECENT_DAYS))) \
                  .select("batter_id", "team_id", "batting_order_slot", *ORDER)
    tally = started.groupBy("team_id", "batter_id").agg(F.count(F.lit(1)).alias("n_recent_starts"),
                                                        F.max("game_date").alias("_last"))
    ranked = top_k(tally, ["team_id"], [F.col("n_recent_starts").desc(), F.col("_last").desc(),
                                        F.col("batter_id").asc()], LINEUP_SIZE, "team_rank")
    late = top_k(started, ["batter_id"], _newest_first(), SLOT_STARTS, "_age")
    slots = modal_value(late, ["team_id", "batter_id"], "batting_order_slot", "batting_order_slot")
    return ranked.join(slots, ["team_id", "batter_id"], "left") \
                 .select("team_id", "batter_id", "batting_order_slot", "n_recent_starts")


def resolve_roster(sides: DataFrame, lineups: DataFrame, projected: DataFrame, date: str) -> DataFrame:
    """Posted batters where a team has posted, projected ones elsewhere."""
    posted = lineups.filter((F.col("official_date") == F.lit(date).cast("date"))
                            & F.col("batting_order_slot").between(1, LINEUP_SIZE)) \
                    .select("game_pk", "team_id", F.col("player_id").alias("batter_id"), "batting_order_slot")
    keys = sides.select("game_pk", "team_id")
    confirmed = keys.join(posted, ["game_pk", "team_id"]).withColumn("lineup_confirmed", F.lit(True))
    open_sides = keys.join(posted, ["game_pk", "team_id"], "left_anti")
    guessed = open_sides.join(projected, "team_id").select(
        "game_pk", "team_id", "batter_id", "batting_order_slot", F.lit(False).alias("lineup_confirmed"))
    return confirmed.unionByName(guessed)


def pitcher_current(pitcher_games: DataFrame, date: str, pitchers: DataFrame) -> DataFrame:
    """Form through the latest start; the start count is not capped here."""
    past = starts(pitcher_games).filter(F.col("game_date") < F.lit(date).cast("date")) \
                                .join(pitchers, "pitcher_id", "left_semi")
    form = last_means(past, "pitcher_id", PITCHER_FORM)
    counts = past.groupBy("pitcher_id").agg(F.count(F.lit(1)).alias("p_starts_prior"))
    return form.join(counts, "pitcher_id").withColumnRenamed("pitcher_id", "opp_starter_id")


def team_current(team_games: DataFrame, date: str) -> DataFrame:
    past = team_rates(team_games).filter(F.col("game_date") < F.lit(date).cast("date"))
    return last_means(past, "team_id", {n: (c, 15) for n, c in TEAM_FORM.items()})


def standings_latest(standings: DataFrame, date: str) -> DataFrame:
    past = standings.filter(F.col("standings_date") < F.lit(date).cast("date"))
    newest = top_k(past, ["team_id"], [F.col("standings_date").desc()], 1, "_age")
    return newest.select("team_id", F.col("league_rank").alias("league_rank_entering"),
                         F.col("division_rank").alias("division_rank_entering"),
                         F.col("win_pct").alias("win_pct_entering"))


SLATE_CONTEXT = ["game_pk", "game_date", "season", "month", "day_of_week", "day_night",
                 "doubleheader", "venue_id", "batter_id", "player_name", "team_id",
                 "opponent_team_id", "is_home", "batting_order_slot", "is_substitute",
                 "lineup_confirmed", "opp_starter_id", "opp_starter_throws", "league_rank_entering",
                 "division_rank_entering", "win_pct_entering"]


def feat_slate(games: DataFrame, lineups: DataFrame, batter_games: DataFrame,
               pitcher_games: DataFrame, team_games: DataFrame, standings: DataFrame,
               war: DataFrame, players: DataFrame, date: str) -> DataFrame:
    """Same feature columns as the training frame, for games not yet played."""
    past = batter_games.filter(F.col("game_date") < F.lit(date).cast("date"))
    sides = slate_sides(games, date)
    roster = store(resolve_roster(sides, lineups, projected_lineup(past, date), date), "roster")
    on_slate = past.join(roster.select("batter_id").distinct(), "batter_id", "left_semi")
    form = current_form(on_slate)
    league = past.agg(safe_div(F.sum("hits"), F.sum("pa")).alias("league_hit_per_pa_entering"))
    hands = players.select(F.col("player_id").alias("opp_starter_id"),
                           F.col("throws").alias("opp_starter_throws"))
    pitchers = sides.select(F.col("opp_starter_id").alias("pitcher_id")).distinct()
    teams = team_current(team_games, date)
    defense = teams.select(F.col("team_id").alias("opponent_team_id"),
                           *[F.col(c).alias(n) for n, c in DEFENSE.items()])
    rows = (roster.join(sides, ["game_pk", "team_id"])
            .join(form, "batter_id")
            .join(hands, "opp_starter_id", "left")
            .join(pitcher_current(pitcher_games, date, pitchers), "opp_starter_id", "left")
            .join(teams.select("team_id", *OFFENSE), "team_id", "left")
            .join(defense, "opponent_team_id", "left")
            .join(standings_latest(standings, date), "team_id", "left")
            .join(prior_season(war), ["batter_id", "season"], "left")
            .withColumn("league_hit_per_pa_entering", league.scalar()))
    same_season = F.col("_last_season") == F.col("season")
    rows = rows.withColumns({
        "game_date": F.col("official_date"), "is_substitute": F.lit(False),
        "days_rest": F.datediff("official_date", "_last_date"),
        **{f"season_{c}_prior": F.when(same_season, F.col(f"_season_{c}")).otherwise(F.lit(0))
           for c in ("pa", "hits", "games")},
        **matched_split("opp_starter_throws"),
    }).withColumns({
        f"eb_hit_per_pa_{s}": eb_shrink(f"{s}_hits_prior", f"{s}_pa_prior", "league_hit_per_pa_entering")
        for s in ("career", "season")})
    return rows.select(*SLATE_CONTEXT, *FEATURES)
