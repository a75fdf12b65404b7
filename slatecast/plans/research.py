"""Factor studies over the feature frame.

All continuous factors are studied together in long form (factor, value), so
22 studies cost one set of shuffles; categorical studies share one grouped
pass the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecast.functions.pitch_flags import PITCH_TYPES
from slatecast.functions.rates import at_least_one, rounded_to, safe_div, wilson
from slatecast.operators import sketches
from slatecast.operators.ordered import ordered_windows
from slatecast.operators.ranks import quantile_bins, spearman
from slatecast.operators.runs import streak_specs
from slatecast.session import store

# Thresholds of the promotion rule.
MIN_MONTH_ROWS = 300
MIN_PAIRS = 30
MIN_CONTROLLED = 1000
MIN_CATEGORY_ROWS = 200
IC_PROMOTE = 0.01
SIGN_STABILITY = 0.70
MIN_SEASONS = 3

# Registered continuous factors, study key -> column.
FACTORS = {
    "00_eb_career": "eb_hit_per_pa_career",
    "01_form_hitrate_r10": "has_hit_roll10",
    "01_form_hpp_r20": "hit_per_pa_roll20",
    "03_war_prev": "war_prev_season",
    "05_expected_pa": "pa_roll10",
    "07b_platoon_form": "hit_per_pa_platoon_roll20",
    "09_team_hits": "team_hits_roll15",
    "10_barrel": "barrel_pct_roll20",
    "11_walks": "bb_pct_roll20",
    "12_chase": "chase_rate_roll20",
    "13_contact": "contact_pct_roll20",
    "14_hard_hit": "hard_hit_pct_roll20",
    "15_league_rank": "league_rank_entering",
    "17_k": "k_pct_roll20",
    "18_line_drive": "line_drive_pct_roll20",
    "19_sweet_spot": "sweet_spot_pct_roll20",
    "21_xba_gap": "xba_minus_ba_roll20",
    "21b_xba_form": "xba_mean_roll20",
    "22_opp_pitching": "opp_xwoba_against_roll15",
    "22b_opp_starter": "p_hits_per_bf_roll10",
    "26_hit_streak": "hit_streak_entering",
    "27_hitless_streak": "hitless_streak_entering",
}

_FRAME = ["game_pk", "game_date", "season", "month", "batter_id", "player_name", "team_id",
          "opponent_team_id", "is_home", "batting_order_slot", "is_substitute", "opp_starter_id",
          "opp_starter_throws", "league_rank_entering", "day_night", "has_hit", "pa", "hits",
          "days_rest", "career_pa_prior", "eb_hit_per_pa_season", *FACTORS.values(),
          "hit_per_pa_roll40", "p_xwoba_against_roll10", "opp_hits_allowed_per_bf_roll15"]

#: Columns of the fact that the studies read beside the features.
FACT_COLUMNS = ["venue_name", "manager_name"]


def research_frame(features: DataFrame, batter_games: DataFrame, players: DataFrame,
                   teams: DataFrame, pairs: DataFrame) -> DataFrame:
    """Features with side, opponent code, venue, manager and pair history.

    The batter-game fact already carries the venue of its game, so one join on
    (game, batter) brings venue and manager, and none is needed for features
    that have kept them.
    """
    brought = [c for c in FACT_COLUMNS if c not in features.columns]
    frame = features.select(*dict.fromkeys([*_FRAME, *(c for c in FACT_COLUMNS if c not in brought)]))
    if brought:
        frame = frame.join(batter_games.select("game_pk", "batter_id", *brought), ["game_pk", "batter_id"], "left")
    return with_side_and_code(with_pair_history(frame, pairs), players, teams)


def with_pair_history(frame: DataFrame, pairs: DataFrame) -> DataFrame:
    """What the batter did against the opposing starter before."""
    history = pairs.select("game_pk", "batter_id", F.col("pitcher_id").alias("opp_starter_id"),
                           "bvp_pa_career", "bvp_hits_per_pa")
    return frame.join(history, ["game_pk", "batter_id", "opp_starter_id"], "left")


def with_side_and_code(frame: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """The batter's side and the opponent's code."""
    sides = players.select(F.col("player_id").alias("batter_id"), "bats")
    codes = teams.select(F.col("team_id").alias("opponent_team_id"), F.col("team_code").alias("opponent_code"))
    return frame.join(sides, "batter_id", "left").join(codes, "opponent_team_id", "left")


def long_form(df: DataFrame, factors: Mapping[str, str] | Sequence[str],
              keep: Sequence[str] = ("season", "month", "has_hit", "pa_roll10")) -> DataFrame:
    """One row per frame row and factor, value as DOUBLE.

    Values are rounded to ten digits: a mean that reached the same number by
    another order of additions must tie with it in ranks and bins.
    """
    names = list(factors.values()) if isinstance(factors, Mapping) else list(factors)
    kept = {k: f"_keep_{k}" for k in keep}   # a kept column may be a factor too
    exact = {c.name for c in df.schema if not isinstance(c.dataType, T.DoubleType)}
    wide = df.select(*[(F.col(k) if k in exact else rounded_to(k, 10)).alias(v) for k, v in kept.items()],
                     *[F.col(c).cast("double").alias(c) for c in names])
    long = wide.unpivot(list(kept.values()), names, "factor", "value")
    # rounded in one place, after the rows are long: the code of a stage stays small enough to be compiled
    return long.withColumnsRenamed({v: k for k, v in kept.items()}).withColumn("value", rounded_to("value", 10))


def approximate_edges(long: DataFrame, bins: int = 10, k: int = sketches.K) -> DataFrame:
    """(factor, n, edges) from sketches per factor and month that are merged over the months."""
    monthly = store(sketches.quantile_sketches(long, ["factor", "season", "month"], "value", k), "value-sketches")
    return sketches.edges_of(sketches.merged(monthly, ["factor"]), ["factor"], [i / bins for i in range(bins + 1)])


def decile_table(long: DataFrame, bins: int = 10, approximate: bool = False) -> DataFrame:
    """Hit rate with interval per quantile bin of each factor.

    ``approximate`` takes the edges from sketches (see ``sketches.rank_error``):
    one pass and no sort, where exact edges count every distinct value.
    """
    known = long.filter(F.col("value").isNotNull() & F.col("has_hit").isNotNull())
    edges = approximate_edges(known, bins) if approximate else None
    binned = quantile_bins(known, ["factor"], "value", bins, "_bin", edges)
    cuts = F.array_distinct("edges")
    mid = (F.element_at(cuts, F.col("_bin")) + F.element_at(cuts, F.col("_bin") + 1)) / 2
    table = (binned.filter(F.col("_bin").isNotNull()).withColumn("mid", mid)
             .groupBy("factor", "_bin", "mid")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("has_hit").alias("_k")))
    lo, hi = wilson("_k", "n")
    # at most ``bins`` rows per factor from here on
    number = F.row_number().over(W.partitionBy("factor").orderBy("_bin"))
    return table.select("factor", number.alias("decile"), "mid", "n", safe_div("_k", "n").alias("rate"),
                        lo.alias("lo"), hi.alias("hi"))


def monthly_ic(long: DataFrame, min_rows: int = MIN_MONTH_ROWS) -> DataFrame:
    """Spearman of each factor against the outcome, per season and month."""
    by = ["factor", "season", "month"]
    sizes = long.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("_known"))
    ic = spearman(long, by, "value", "has_hit", MIN_PAIRS)
    return (ic.join(sizes, by).filter((F.col("_known") >= min_rows) & F.col("ic").isNotNull())
            .select(*by, "ic", "n"))


def controlled_ic(long: DataFrame, control: str = "pa_roll10",
                  min_rows: int = MIN_CONTROLLED) -> DataFrame:
    """Mean IC inside terciles of ``control``; NULL for a factor with few rows."""
    both = long.filter(F.col("value").isNotNull() & F.col(control).isNotNull())
    banded = quantile_bins(both.select("factor", "value", "has_hit", control), ["factor"], control, 3, "_band")
    ics = spearman(banded.filter(F.col("_band").isNotNull()), ["factor", "_band"], "value", "has_hit", MIN_PAIRS)
    means = ics.groupBy("factor").agg(F.avg("ic").alias("_ic"))
    sizes = both.groupBy("factor").agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.join(means, "factor", "left").select(
        "factor", F.when(F.col("_rows") >= min_rows, F.col("_ic")).alias("pa_controlled_ic"))


def verdict(ic: DataFrame, factors: DataFrame) -> DataFrame:
    """PROMOTE / WEAK / REJECT / NO-DATA per factor from its monthly ICs.

    ``median`` sees one number per calendar month and factor.
    """
    middle = ic.groupBy("factor").agg(F.median("ic").alias("median_ic"), F.count(F.lit(1)).alias("n_months"),
                                      F.count_distinct("season").alias("n_seasons"))
    sign = F.when(F.col("median_ic") < 0, -1.0).otherwise(1.0)
    stable = ic.join(middle, "factor").groupBy("factor").agg(
        F.avg((F.signum("ic") == sign).cast("double")).alias("sign_stability"))
    stats = factors.select("factor").join(middle, "factor", "left").join(stable, "factor", "left")
    steady = (F.col("n_seasons") >= MIN_SEASONS) & (F.col("sign_stability") >= SIGN_STABILITY)
    label = (F.when(F.col("n_months").isNull(), "NO-DATA")
             .when(steady & (F.abs("median_ic") >= IC_PROMOTE), "PROMOTE")
             .when(steady, "WEAK").otherwise("REJECT"))
    return stats.select("factor", label.alias("verdict"), "median_ic", "sign_stability",
                        F.coalesce("n_months", F.lit(0)).alias("n_months"),
                        F.coalesce("n_seasons", F.lit(0)).alias("n_seasons"))


def study_continuous(df: DataFrame, factors: Mapping[str, str] = FACTORS,
                     min_month_rows: int = MIN_MONTH_ROWS,
                     min_controlled: int = MIN_CONTROLLED) -> DataFrame:
    """One scoreboard row per registered factor."""
    long = store(long_form(df, factors), "factor-values")
    keys = df.sparkSession.createDataFrame(list(factors.items()), "key string, factor string")
    verdicts = verdict(monthly_ic(long, min_month_rows), keys)
    return (keys.join(verdicts, "factor").join(controlled_ic(long, min_rows=min_controlled), "factor", "left")
            .select("key", "factor", "verdict", "median_ic", "sign_stability", "n_months", "pa_controlled_ic"))


def bvp_study(df: DataFrame, min_pa: int = 10, **thresholds: int) -> DataFrame:
    """Pair history as a factor, where the pair has met often enough."""
    met = df.filter(F.col("bvp_pa_career") >= min_pa)
    return study_continuous(met, {"24_bvp": "bvp_hits_per_pa"}, **thresholds)


# ---- categorical ------------------------------------------------------------

# Registered categorical studies; a level list fixes order and set.
CATEGORIES: dict[str, tuple[str, list | None]] = {
    "02_month": ("month", [3, 4, 5, 6, 7, 8, 9, 10]),
    "20_year": ("season", [2021, 2022, 2023, 2024, 2025, 2026]),
    "06_batting_order": ("batting_order_slot", [1, 2, 3, 4, 5, 6, 7, 8, 9]),
    "04_home_away": ("is_home", None),
    "04b_venue": ("venue_name", None),
    "08_opponent": ("opponent_code", None),
    "16_manager": ("manager_name", None),
}
#: What the categorical studies read of the research frame.
CATEGORICAL = ["has_hit", "hits", "pa", "game_pk", "game_date", "opponent_team_id", "opp_xwoba_against_roll15", "bats",
               "opp_starter_throws", *dict.fromkeys(c for c, _ in CATEGORIES.values())]
#: The part of it that the training frame holds.
CATEGORICAL_FEATURES = ["batter_id", *[c for c in CATEGORICAL if c not in ("bats", "opponent_code")]]
#: What is read of the pitches to build that, the sides and the codes.
CATEGORICAL_PITCHES = ["game_pk", "game_date", "game_type", "home_team", "away_team", "batter_id", "pitcher_id", "stand",
                       "p_throws", "inning_topbot", "at_bat_number", "pitch_number", "events", "xwoba"]
#: What all studies of the scoreboard read of the research frame, of the training frame under it, and of the pitches.
JUDGED = list(dict.fromkeys([*CATEGORICAL, "pa_roll10", *FACTORS.values(), "bvp_pa_career", "bvp_hits_per_pa"]))
JUDGED_FEATURES = ["batter_id", "opp_starter_id", *[
    c for c in JUDGED if c not in ("bats", "opponent_code", "bvp_pa_career", "bvp_hits_per_pa")]]
JUDGED_PITCHES = [*CATEGORICAL_PITCHES, "pitcher_name", "pitch_type", "zone", "description", "pitch_result_type", "bb_type",
                  "launch_speed", "launch_angle", "xba"]
TOP_BOTTOM = {"04b_venue": 12, "16_manager": 10}
MATCHUPS = ["same hand", "opposite hand", "switch"]
TIERS = ["top-5 pitching", "middle", "bottom-5 pitching"]


def platoon_matchup() -> Column:
    """Batter side against the starter's hand; NULL while either is unknown."""
    known = F.col("bats").isNotNull() & F.col("opp_starter_throws").isNotNull()
    return F.when(known, F.when(F.col("bats") == "S", "switch")
                  .when(F.col("bats") == F.col("opp_starter_throws"), "same hand")
                  .otherwise("opposite hand"))


def category_table(df: DataFrame, studies: Mapping[str, Column],
                   min_rows: int = MIN_CATEGORY_ROWS) -> DataFrame:
    """Hit rate, interval and hits per PA per level of several studies at once."""
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), c.cast("string").alias("level"))
                      for k, c in studies.items()])
    long = df.select("has_hit", "hits", "pa", F.explode(pairs).alias("c")) \
             .select("has_hit", "hits", "pa", "c.key", "c.level").filter(F.col("level").isNotNull())
    g = long.groupBy("key", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("has_hit").alias("k"),
                                         F.sum("hits").alias("hits"), F.sum("pa").alias("pa"))
    lo, hi = wilson("k", "n")
    return g.filter(F.col("n") >= min_rows).select(
        "key", "level", "n", "k", safe_div("k", "n").alias("rate"), safe_div("hits", "pa").alias("hits_per_pa"),
        lo.alias("lo"), hi.alias("hi"))


def ordered_levels(table: DataFrame, orders: Mapping[str, Sequence]) -> DataFrame:
    """Keep, for studies with a level list, only its levels; add the place."""
    places = [(k, str(v), i) for k, levels in orders.items() for i, v in enumerate(levels)]
    wanted = table.sparkSession.createDataFrame(places, "key string, level string, place int")
    fixed = F.col("key").isin(list(orders))
    return (table.join(wanted, ["key", "level"], "left")
            .filter(~fixed | F.col("place").isNotNull()))


def ends(table: DataFrame, key: str, k: int) -> DataFrame:
    """Lowest and highest k levels of one study, or all when there are at most 2k."""
    study = W.partitionBy("key")
    ranked = table.filter(F.col("key") == key).withColumns({
        "_low": F.row_number().over(study.orderBy("rate", "level")),
        "_high": F.row_number().over(study.orderBy(F.desc("rate"), F.desc("level"))),
        "_levels": F.count(F.lit(1)).over(study)})
    return ranked.filter(f"_levels <= {2 * k} or _low <= {k} or _high <= {k}").drop("_low", "_high", "_levels")


def study_categorical(df: DataFrame, min_rows: int = MIN_CATEGORY_ROWS) -> DataFrame:
    """Every registered categorical study, plus matchup, actual PA and pitching tier."""
    # a few teams a day: stored, so that its size decides the join
    with_tier = df.join(store(daily_tiers(df), "daily-tiers"), ["game_date", "opponent_team_id"], "left")
    studies = {k: F.col(c) for k, (c, _) in CATEGORIES.items()}
    studies |= {"07_platoon_adv": platoon_matchup(), "05b_actual_pa": F.least(F.col("pa"), F.lit(6)),
                "23_pitching_tiers": F.col("tier")}
    table = store(category_table(with_tier, studies, min_rows), "categories")
    orders = {k: levels for k, (_, levels) in CATEGORIES.items() if levels}
    orders |= {"07_platoon_adv": MATCHUPS, "05b_actual_pa": [1, 2, 3, 4, 5, 6], "23_pitching_tiers": TIERS}
    whole = ordered_levels(table.filter(~F.col("key").isin(list(TOP_BOTTOM))), orders)
    for key, k in TOP_BOTTOM.items():
        whole = whole.unionByName(ends(table, key, k).withColumn("place", F.lit(None).cast("int")))
    return whole


def category_spread(table: DataFrame) -> DataFrame:
    """Scoreboard rows of the categorical studies."""
    return table.groupBy("key").agg((F.max("rate") - F.min("rate")).alias("spread"),
                                    F.count(F.lit(1)).alias("groups"))


def daily_tiers(df: DataFrame, k: int = 5) -> DataFrame:
    """Opponents ranked each date by rolling xwOBA against: best k, worst k, middle.

    Reduced to one row per (date, team) before the per-date window, which then
    orders the teams of a day only.
    """
    known = df.filter(F.col("opp_xwoba_against_roll15").isNotNull())
    teams = known.groupBy("game_date", "opponent_team_id").agg(
        F.min(F.struct("game_pk", "opp_xwoba_against_roll15"))["opp_xwoba_against_roll15"].alias("_x"))
    day = W.partitionBy("game_date")
    ranked = teams.withColumns({
        "_rank": F.row_number().over(day.orderBy("_x", "opponent_team_id")),
        "_teams": F.count(F.lit(1)).over(day)})
    tier = (F.when(F.col("_rank") <= k, TIERS[0]).when(F.col("_rank") > F.col("_teams") - k, TIERS[2])
            .otherwise(TIERS[1]))
    return ranked.select("game_date", "opponent_team_id", tier.alias("tier"))


# Upper bounds (inclusive) and labels of the streak buckets.
STREAK_BUCKETS = [(0, "0"), (1, "1"), (2, "2"), (4, "3-4"), (9, "5-9"), (99, "10+")]


def streak_buckets(df: DataFrame) -> DataFrame:
    """Hit rate per streak bucket against what quality and PA alone predict."""
    bucket = _bucket(F.col("hit_streak_entering"))
    rows = df.filter(F.col("eb_hit_per_pa_career").isNotNull() & F.col("pa").isNotNull()) \
             .withColumn("bucket", bucket).filter(F.col("bucket").isNotNull())
    g = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("has_hit").alias("k"),
                                   F.avg(at_least_one("eb_hit_per_pa_career", "pa")).alias("expected"))
    lo, hi = wilson("k", "n")
    rate = safe_div("k", "n")
    return g.select("bucket", "n", "k", rate.alias("rate"), "expected", lo.alias("lo"), hi.alias("hi"),
                    (rate - F.col("expected")).alias("residual"))


def _bucket(streak: Column) -> Column:
    bucket = F.lit(None).cast("string")
    for bound, label in reversed(STREAK_BUCKETS):
        bucket = F.when(streak <= bound, label).otherwise(bucket)
    return bucket


def streak_permutation(batter_games: DataFrame, replicates: int = 50, seed: int = 1) -> DataFrame:
    """Hit rate by streak bucket against seeded shuffles of each batter's games.

    Returns (bucket, n, rate, null_mean, null_sd, p_high). Replicate 0 is the
    played order; replicate r orders a batter's games by a hash of game, batter,
    seed and r, so a shuffle is a sort inside (replicate, batter): groups of any
    size are split by ``ordered_windows`` and no batter is gathered. ``p_high``
    is the share of orders, the played one included, whose rate is as high.
    """
    rows = batter_games.select("batter_id", "game_pk", F.col("has_hit").cast("int").alias("has_hit"),
                               F.unix_date("game_date").cast("long").alias("_day"))
    name = F.concat_ws(":", "game_pk", "batter_id", F.lit(seed), "replicate")
    mark = F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")
    rows = rows.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates))))
    rows = rows.withColumn("_mark", F.when(F.col("replicate") == 0, F.col("_day")).otherwise(mark)).drop("_day")
    ran = ordered_windows(rows, ["replicate", "batter_id"], ["_mark", "game_pk"],
                          {"_last_miss": streak_specs("has_hit", "idx")["_last_miss"]}, index="idx")
    streak = F.col("idx") - 1 - F.coalesce("_last_miss", F.lit(0))
    counted = store(ran.groupBy("replicate", _bucket(streak).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("has_hit").alias("k")).filter("bucket is not null"), "streak-replicates")
    # a handful of buckets per replicate from here on
    rate = (F.col("k") / F.col("n")).alias("rate")
    played = counted.filter("replicate = 0").select("bucket", "n", rate)
    shuffled = counted.filter("replicate > 0").select("bucket", (F.col("k") / F.col("n")).alias("null_rate"))
    return played.join(shuffled, "bucket", "left").groupBy("bucket", "n", "rate").agg(
        F.avg("null_rate").alias("null_mean"), F.stddev("null_rate").alias("null_sd"),
        ((F.count_if(F.col("null_rate") >= F.col("rate")) + 1) / (F.count("null_rate") + 1)).alias("p_high"))


def pitchtype_league(pitchtypes: DataFrame) -> DataFrame:
    """League average by pitch type of the last pitch of an at-bat."""
    return pitchtypes.filter(F.col("pitch_type").isin(PITCH_TYPES)).groupBy("pitch_type").agg(
        safe_div(F.sum("hits"), F.sum("ab_ended")).alias("ba"), F.sum("pitches_seen").alias("n"))


def pitchtype_matrix(pitchtypes: DataFrame, players: DataFrame, top: int = 25,
                     min_ab: int = 30) -> DataFrame:
    """Average by pitch type for the batters who saw most pitches, one column per type."""
    seen = pitchtypes.groupBy("batter_id").agg(F.sum("pitches_seen").alias("_seen"))
    busiest = seen.orderBy(F.col("_seen").desc(), "batter_id").limit(top).select("batter_id")
    rows = pitchtypes.filter(F.col("pitch_type").isin(PITCH_TYPES) & (F.col("ab_ended") >= min_ab)) \
                     .join(F.broadcast(busiest), "batter_id", "left_semi")
    names = players.select(F.col("player_id").alias("batter_id"), "player_name")
    return rows.join(names, "batter_id").groupBy("player_name").pivot("pitch_type", PITCH_TYPES).agg(F.avg("ba"))


_CLASS = ["PROMOTE", "WEAK", "REJECT", "CONTEXT", "NO-DATA"]


def pitchtype_context(league: DataFrame) -> DataFrame:
    """Scoreboard row of the pitch-type study: spread of the league averages."""
    return league.agg((F.max("ba") - F.min("ba")).alias("spread")).select(
        F.lit("25_pitch_type").alias("key"), F.lit("pitch_type").alias("factor"), "spread")


def streak_context(buckets: DataFrame) -> DataFrame:
    """Scoreboard row of the hot-hand test: largest gap to what quality and PA predict."""
    return buckets.agg(F.max(F.abs("residual")).alias("spread")).select(
        F.lit("26_streak_buckets").alias("key"), F.lit("hit_streak_entering").alias("factor"), "spread")


def scoreboard(judged: Sequence[DataFrame], context: Sequence[DataFrame]) -> DataFrame:
    """All study rows, by verdict class and then by strength of the median IC.

    ``judged`` studies carry a verdict, ``context`` studies (key, spread) don't.
    """
    rows = judged[0]
    for more in judged[1:]:
        rows = rows.unionByName(more)
    for more in context:
        rows = rows.unionByName(more.withColumn("verdict", F.lit("CONTEXT")).drop("groups"), allowMissingColumns=True)
    place = F.array_position(F.array(*[F.lit(c) for c in _CLASS]), F.col("verdict"))
    return rows.orderBy(place, F.abs("median_ic").desc_nulls_last(), "key")
