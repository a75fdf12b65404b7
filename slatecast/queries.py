"""Registered queries: each takes (spark, folder of the star schema) and
returns a DataFrame over the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slatecast.adapter import SLATE_DATE
from slatecast.functions.pitch_flags import FLAGS
from slatecast.functions.rates import eb_shrink, rounded_to, wilson
from slatecast.operators import sketches
from slatecast.operators.asof import asof_join, interval_join, validity
from slatecast.operators.modal import modal_value
from slatecast.operators.ordered import Previous, Recent, Running, ordered_windows
from slatecast.operators.ranks import quantiles, spearman
from slatecast.operators.runs import longest_run
from slatecast.plans import evaluation, features, intermediate, marts, output, quality, research, slate, staging
from slatecast.plans import model as training
from slatecast.plans.warehouse import TABLES, StarWarehouse
from slatecast.schemas import DATE_COLUMN
from slatecast.session import scratch_path, store
from slatecast.sources import sinks
from slatecast.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# digits that hide summation order but no exact half
DIGITS = 10


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    doubles = {c.name: rounded_to(c.name, digits) for c in df.schema if isinstance(c.dataType, T.DoubleType)}
    return df.withColumns(doubles) if doubles else df


def model(name: str, *tables: str) -> Query:
    """One warehouse model; ``tables`` are the parts worth writing for it alone."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(getattr(StarWarehouse(spark, sf_dir, tables), name))
    return run


FACTS = [t for t in TABLES if t != "batter_game_by_hand"]

QUERIES: dict[str, Query] = {
    # staging: latest load wins, casts, renames
    "stg_pitches": model("stg_pitches"),
    "stg_games": model("stg_games"),
    "stg_batting_lines": model("stg_batting_lines"),
    "stg_lineups": model("stg_lineups"),
    "stg_standings": model("stg_standings"),
    "stg_coaches": model("stg_coaches"),
    "stg_war_seasons": model("stg_war_seasons"),
    "stg_war_snapshots": model("stg_war_snapshots"),
    # intermediate
    "int_batter_game": model("int_batter_game"),
    "int_batter_game_platoon": model("int_batter_game_platoon"),
    "int_game_starters": model("int_game_starters"),
    "int_league_daily": model("int_league_daily", "stg_pitches", "batter_game_by_hand"),
    "int_pitcher_rolling": model("int_pitcher_rolling", "stg_pitches", "fct_pitcher_game"),
    "int_team_rolling": model("int_team_rolling", "stg_pitches", "fct_team_game"),
    # marts
    "dim_game": model("dim_game"),
    "dim_manager": model("dim_manager"),
    "dim_player": model("dim_player", "stg_pitches"),
    "dim_team": model("dim_team"),
    "fct_standings_daily": model("fct_standings_daily"),
    "fct_batter_game": model("fct_batter_game", "stg_pitches", "batter_game_by_hand"),
    "fct_pitcher_game": model("fct_pitcher_game", "stg_pitches"),
    "fct_team_game": model("fct_team_game", "stg_pitches"),
    "fct_batter_vs_pitcher": model("fct_batter_vs_pitcher"),
    "fct_batter_pitchtype": model("fct_batter_pitchtype"),
    # training frame
    "feat_batter_game": model("feat_batter_game", *TABLES),
}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def pitch_flags(spark, sf_dir):
    flags = StarWarehouse(spark, sf_dir, ()).int_pitch_flags
    return flags.select("game_pk", "at_bat_number", "pitch_number", *FLAGS)


@query
def rolling_hit_rate(spark, sf_dir):
    """Last-ten hit rate and shrunk career rate entering each batter-game."""
    frame = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    hist = features.lagged_history(frame.fct_batter_game)
    league = features.league_entering(frame.int_league_daily)
    prior = F.coalesce("league_hit_per_pa_entering", F.lit(features.LEAGUE_PRIOR))
    shrunk = features.eb_shrink(F.coalesce("_career_hits", F.lit(0)), F.coalesce("_career_pa", F.lit(0)), prior)
    return rounded(hist.join(league, "game_date", "left").select(
        "game_pk", "game_date", "batter_id", "has_hit", "game_idx", "has_hit_roll10",
        shrunk.alias("eb_hit_per_pa_career")))


@query
def slate_sides(spark, sf_dir):
    return slate.slate_sides(StarWarehouse(spark, sf_dir, ()).dim_game, SLATE_DATE)


@query
def slate_roster(spark, sf_dir):
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    past = w.fct_batter_game.filter(F.col("game_date") < F.lit(SLATE_DATE).cast("date"))
    return slate.resolve_roster(slate.slate_sides(w.dim_game, SLATE_DATE), w.stg_lineups,
                                slate.projected_lineup(past, SLATE_DATE), SLATE_DATE)


@query
def projected_lineup(spark, sf_dir):
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    past = w.fct_batter_game.filter(F.col("game_date") < F.lit(SLATE_DATE).cast("date"))
    return slate.projected_lineup(past, SLATE_DATE)


@query
def feat_slate(spark, sf_dir):
    return rounded(StarWarehouse(spark, sf_dir, TABLES).feat_slate(SLATE_DATE))


@query
def current_form(spark, sf_dir):
    """Latest state of every batter, as the slate would see it."""
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    past = w.fct_batter_game.filter(F.col("game_date") < F.lit(SLATE_DATE).cast("date"))
    return rounded(slate.current_form(past).select(
        "batter_id", "player_name", "career_pa_prior", "career_hits_prior", "career_games_prior",
        "hit_streak_entering", "hitless_streak_entering", *features.ROLLED))


@query
def backtest_daily(spark, sf_dir):
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    graded = output.backtest_daily(w.raw("predictions"), w.fct_batter_game)
    return graded.withColumn("run_ts", F.col("run_ts").cast("timestamp_ntz"))


@query
def slate_summary(spark, sf_dir):
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    return rounded(output.slate_summary(w.raw("predictions")))


@query
def slate_top10(spark, sf_dir):
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    return output.top_scored(w.raw("predictions"))


# ---- factor research ---------------------------------------------------------

# group sizes below which a study says nothing: the product's own, and lower ones
# for small tables, registered beside them as ..._small_groups
OWN = {"month_rows": research.MIN_MONTH_ROWS, "category_rows": research.MIN_CATEGORY_ROWS, "matrix_ab": 30,
       "bvp_pa": 10, "bvp_month_rows": research.MIN_MONTH_ROWS, "bvp_controlled": research.MIN_CONTROLLED}
SMALL_GROUPS = {"month_rows": 100, "category_rows": 50, "matrix_ab": 5,
                "bvp_pa": 2, "bvp_month_rows": 10, "bvp_controlled": 100}


def both_sizes(build):
    """Register a study with the product's thresholds and with the lower ones."""
    for name, sizes in ((build.__name__, OWN), (f"{build.__name__}_small_groups", SMALL_GROUPS)):
        QUERIES[name] = lambda spark, sf_dir, sizes=sizes: build(spark, sf_dir, sizes)
    return build


def _features(spark, sf_dir) -> StarWarehouse:
    return StarWarehouse(spark, sf_dir, (*TABLES, "feat_batter_game"))


def _lazy_features(spark, sf_dir) -> DataFrame:
    """The training frame unwritten, so that only the columns a query reads are built."""
    return StarWarehouse(spark, sf_dir, TABLES).feat_batter_game


def _factor_values(spark, sf_dir) -> DataFrame:
    return store(research.long_form(_lazy_features(spark, sf_dir), research.FACTORS), "factor-values")


def _research_frame(w: StarWarehouse) -> DataFrame:
    """Over the unwritten features: only the columns that a study reads are built."""
    return research.research_frame(w.feat_research, w.fct_batter_game, w.dim_player, w.dim_team,
                                   w.fct_batter_vs_pitcher)


@query
def research_frame(spark, sf_dir):
    return rounded(_research_frame(StarWarehouse(spark, sf_dir, TABLES)))


@query
def decile_table(spark, sf_dir):
    return rounded(research.decile_table(_factor_values(spark, sf_dir)), 8)


@both_sizes
def monthly_ic(spark, sf_dir, sizes):
    return rounded(research.monthly_ic(_factor_values(spark, sf_dir), sizes["month_rows"]), 8)


@query
def controlled_ic(spark, sf_dir):
    return rounded(research.controlled_ic(_factor_values(spark, sf_dir)), 8)


@both_sizes
def study_continuous(spark, sf_dir, sizes):
    return rounded(research.study_continuous(_lazy_features(spark, sf_dir),
                                             min_month_rows=sizes["month_rows"]), 8)


def _bvp(frame: DataFrame, sizes: dict[str, int]) -> DataFrame:
    return research.bvp_study(frame, sizes["bvp_pa"], min_month_rows=sizes["bvp_month_rows"],
                              min_controlled=sizes["bvp_controlled"])


@both_sizes
def bvp_study(spark, sf_dir, sizes):
    return rounded(_bvp(_research_frame(StarWarehouse(spark, sf_dir, TABLES)), sizes), 8)


@both_sizes
def study_categorical(spark, sf_dir, sizes):
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "stg_games", "fct_team_game", "dim_manager", "dim_team"),
                      {"stg_pitches": research.CATEGORICAL_PITCHES})
    frame = research.with_side_and_code(w.features_with(research.CATEGORICAL_FEATURES), w.batter_sides, w.dim_team)
    frame = frame.select(*research.CATEGORICAL)
    return rounded(research.study_categorical(store(frame, "research-frame"), sizes["category_rows"]))


@both_sizes
def study_scoreboard(spark, sf_dir, sizes):
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "stg_games", "batter_game_by_hand", "fct_pitcher_game", "fct_team_game",
                                      "fct_standings_daily", "dim_manager", "dim_team"),
                      {**intermediate.UNDER_FEATURES, "stg_pitches": research.JUDGED_PITCHES})
    pairs = marts.fct_batter_vs_pitcher(w.int_pitch_flags, ["bvp_hits_per_pa"])
    frame = research.with_pair_history(w.features_with(research.JUDGED_FEATURES), pairs)
    frame = store(research.with_side_and_code(frame, w.batter_sides, w.dim_team).select(*research.JUDGED), "research-frame")
    return rounded(research.scoreboard(
        [research.study_continuous(frame, min_month_rows=sizes["month_rows"]), _bvp(frame, sizes)],
        [research.category_spread(research.study_categorical(frame, sizes["category_rows"])),
         research.pitchtype_context(research.pitchtype_league(w.fct_batter_pitchtype)),
         research.streak_context(research.streak_buckets(frame))]), 8)


@query
def daily_tiers(spark, sf_dir):
    return research.daily_tiers(_lazy_features(spark, sf_dir))


@query
def streak_buckets(spark, sf_dir):
    return rounded(research.streak_buckets(_lazy_features(spark, sf_dir)))


@query
def pitchtype_league(spark, sf_dir):
    return rounded(research.pitchtype_league(StarWarehouse(spark, sf_dir, ()).fct_batter_pitchtype))


@both_sizes
def pitchtype_matrix(spark, sf_dir, sizes):
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "fct_batter_pitchtype"))
    return rounded(research.pitchtype_matrix(w.fct_batter_pitchtype, w.dim_player, min_ab=sizes["matrix_ab"]))


# ---- evaluation ----------------------------------------------------------------

#: What the evaluation reads of a starter's feature row.
EVALUATED = ["game_pk", "game_date", "season", "month", "batter_id", "has_hit", "hits", "pa", "is_home", "batting_order_slot",
             "pa_roll10", "eb_hit_per_pa_career", "season_pa_prior", "season_hits_prior"]


def _scored(spark, sf_dir) -> DataFrame:
    """Starters' feature rows with a fixed stand-in score and the naive pickers."""
    # read by the box scores alone, pitches aren't written
    frame = StarWarehouse(spark, sf_dir, ()).features_with([*EVALUATED, "is_substitute"])
    ready = training.starters_only(frame).withColumn("is_home", F.col("is_home").cast("double"))
    ready = store(ready.select(*EVALUATED), "starters")
    fill = training.medians(ready, ["pa_roll10"])["pa_roll10"]
    stand_in = ((F.col("game_pk") * 31 + F.col("batter_id") * 7) % 128).cast("double") / 128
    return evaluation.baseline_scores(ready.withColumn("p_model", stand_in), fill)


MODELS = {"model": "p_model", "eb_pa": "eb_pa"}


@query
def metric_rows(spark, sf_dir):
    return rounded(evaluation.metric_rows(_scored(spark, sf_dir), MODELS), 8)


@query
def top_k_rates(spark, sf_dir):
    return rounded(evaluation.top_k_rates(_scored(spark, sf_dir), MODELS))


@query
def tier_table(spark, sf_dir):
    return rounded(evaluation.tier_table(_scored(spark, sf_dir), MODELS), 8)


@query
def slice_table(spark, sf_dir):
    return rounded(evaluation.slice_table(_scored(spark, sf_dir), "p_model"), 8)


@query
def calibration_buckets(spark, sf_dir):
    return rounded(evaluation.calibration_buckets(_scored(spark, sf_dir), "p_model"))


@query
def picker_table(spark, sf_dir):
    return rounded(evaluation.picker_table(_scored(spark, sf_dir)))


@query
def picker_curve(spark, sf_dir):
    return rounded(evaluation.picker_curve(_scored(spark, sf_dir)))


@query
def temporal_splits(spark, sf_dir):
    """Rows and date range of every split, with the recency weight of the train set."""
    ready = store(training.prepare(_lazy_features(spark, sf_dir)).select("season", "game_date"), "starters")
    sp = training.temporal_splits(ready)
    parts = {"train": training.recency_weight(sp.train, 730), "train_fit": sp.train_fit,
             "train_tail": sp.train_tail, "calib_fit": sp.calib_fit, "calib_eval": sp.calib_eval,
             "test": sp.test}
    weight = {n: F.sum("weight") if n == "train" else F.lit(None).cast("double") for n in parts}
    rows = [d.agg(F.count(F.lit(1)).alias("n"), F.min("game_date").alias("first_date"),
                  F.max("game_date").alias("last_date"), weight[n].alias("weight"))
            .withColumn("split", F.lit(n)) for n, d in parts.items()]
    return rounded(evaluation.union_all(rows), 6)


#: The registered board takes larger and fewer boosting steps than the product's defaults (a job per tree level).
SHORT_RUN = training.Params(
    gbt=replace(training.Params.gbt, rounds=40, patience=10, step=0.15, leaves=16),
    epa=replace(training.Params.epa, rounds=20, step=0.2, leaves=12))


# rows only: the parts have twins (boosted_rounds, logistic_fit, isotonic_map), the whole has none
@query
def train_scoreboard(spark, sf_dir):
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "stg_games", "batter_game_by_hand", "fct_pitcher_game", "fct_team_game"),
                      intermediate.UNDER_FEATURES)
    return training.train(w.features_with(training.TRAINED), SHORT_RUN).board


# ---- data quality ---------------------------------------------------------------

@query
def check_suite(spark, sf_dir):
    return quality.suite(StarWarehouse(spark, sf_dir, TABLES), list({**quality.UNIQUE, **quality.NOT_NULL}))


@query
def leakage(spark, sf_dir):
    return quality.leaks(store(_lazy_features(spark, sf_dir).select(*quality.LEAK_COLUMNS), "leak-columns"))


# Hours after which a source is late (warn, error); None: never checked.
FRESHNESS = {"heartbeat": (26, 50), "pitches": (48, 78), "games": (26, 50), "batting_lines": (26, 50),
             "standings": (26, 50), "lineups": None, "coaches": None, "war_snapshots": (48, 78), "war_seasons": None}
#: The time at which the registered check looks.
FRESHNESS_NOW = "2024-02-01 00:00:00"


@query
def freshness(spark, sf_dir):
    """Every declared source of landed tables; those without a load stamp by their own date."""
    w = StarWarehouse(spark, sf_dir, ())
    stamps = {"heartbeat": F.col("run_at"), "pitches": F.to_timestamp("game_date"),
              "war_snapshots": F.to_timestamp("snapshot_date")}
    return rounded(evaluation.union_all([
        quality.check_freshness(w.raw(name), stamps.get(name, quality.load_time()), FRESHNESS_NOW, *hours, name)
        for name, hours in FRESHNESS.items() if hours]))


@query
def reconcile(spark, sf_dir):
    """Raw pitches against a copy that lost some rows and some of its weeks."""
    raw = StarWarehouse(spark, sf_dir, ()).raw("pitches").select(
        F.to_date("game_date").alias("game_date"), "game_pk", "at_bat_number", "pitch_number", "batter")
    lossy = raw.filter((F.col("game_date") >= F.lit("2021-05-01").cast("date")) & (F.col("batter") % 37 != 0))
    return rounded(quality.reconcile_counts(raw, lossy, "game_date", staging.PITCH_KEY))


PARITY = {"sc_pa": "sc_pa", "sc_hits": "sc_hits", "k_pct": "k_pct", "contact_pct": "contact_pct",
          "xba_mean": "xba_mean", "barrel_pct": "barrel_pct"}
DRIFTING = ["xba_mean", "barrel_pct"]


@query
def parity(spark, sf_dir):
    """The batter-game model against a restated copy of itself."""
    game = StarWarehouse(spark, sf_dir, ("stg_pitches", "int_batter_game")).int_batter_game
    restated = game.withColumns({
        "xba_mean": F.when(F.col("game_pk") % 5 == 0, F.col("xba_mean") + 0.01).otherwise(F.col("xba_mean")),
        "contact_pct": F.when(F.col("batter_id") % 50 == 0, F.lit(None)).otherwise(F.col("contact_pct"))})
    return rounded(quality.parity(game, restated, ["game_pk", "batter_id"], PARITY,
                                  [m for m in PARITY if m not in DRIFTING]))


@query
def coverage(spark, sf_dir):
    w = StarWarehouse(spark, sf_dir, ())
    return sinks.coverage(spark, {t: w.raw(t) if t != "heartbeat" else None
                                  for t in [*DATE_COLUMN, "heartbeat"]})


# ---- streams: slices land one after another, each drained by a run of its own ------

#: Days that a landing reloads of the one before it.
OVERLAP_DAYS = 3


def date_slices(df: DataFrame, date: str, borders: list[str]) -> list[DataFrame]:
    """Slices between the borders; each begins OVERLAP_DAYS before the end of the one before."""
    day = F.to_date(date)
    edges = [None, *borders, None]
    out = []
    for start, end in zip(edges, edges[1:]):
        rows = df
        if start:
            rows = rows.filter(day > F.date_sub(F.lit(start).cast("date"), OVERLAP_DAYS))
        out.append(rows.filter(day <= F.lit(end).cast("date")) if end else rows)
    return out


@query
def stream_dedup(spark, sf_dir):
    """Pitches that land by season with overlapping days; the state forgets keys a week after their date."""
    keys = staging.PITCH_KEY
    raw = StarWarehouse(spark, sf_dir, ()).raw("pitches").select(
        *keys, F.to_timestamp("game_date").alias("played_at"))
    raw = store(raw, "pitch-keys")
    path, out, checkpoint = (scratch_path(spark, n) for n in ("landed-pitches", "deduped", "checkpoint"))
    jobs.land_and_run(date_slices(raw, "played_at", ["2023-01-01", "2025-01-01"]), path, lambda: jobs.drain(
        jobs.dedup_stream(jobs.landed_stream(spark, path, raw.schema), keys, "played_at").select(*keys), out, checkpoint))
    return spark.read.schema(raw.select(*keys).schema).parquet(out)


@query
def stream_latest(spark, sf_dir):
    """Games that land twice over, merged into the buckets they touch."""
    raw = store(StarWarehouse(spark, sf_dir, ()).raw("games"), "games-by-date")
    path, checkpoint = scratch_path(spark, "landed-games"), scratch_path(spark, "checkpoint")
    table = jobs.BucketedTable(spark, scratch_path(spark, "latest-games"), raw.schema, ["game_pk"],
                               [F.col("load_id").desc_nulls_last()], buckets=16)
    jobs.land_and_run(date_slices(raw, "official_date", ["2024-01-01"]), path, lambda: jobs.latest_stream(
        jobs.landed_stream(spark, path, raw.schema), table, checkpoint))
    return table.current()


@query
def stream_grade(spark, sf_dir):
    """Outcomes that land by date with overlapping days, joined once each to the logged predictions."""
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    played = w.fct_batter_game.select("game_pk", "batter_id", "has_hit", "hits", "pa",
                                      F.col("game_date").cast("timestamp").alias("played_at"))
    log = store(w.raw("predictions").select("game_pk", "batter_id", "slate_date", "p_hit", "model_version"), "log")
    path, out, checkpoint = (scratch_path(spark, n) for n in ("outcomes", "graded", "checkpoint"))

    def graded() -> DataFrame:
        return jobs.grade_stream(jobs.landed_stream(spark, path, played.schema), log, "played_at")

    jobs.land_and_run(date_slices(played, "played_at", ["2024-01-01"]), path,
                      lambda: jobs.drain(graded(), out, checkpoint))
    return spark.read.schema(jobs.grade_stream(played, log).schema).parquet(out)


# ---- generic operators over the given tables ----------------------------------

def _events(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


@query
def asof_last_purchase(spark, sf_dir):
    """Every event with its user's latest strictly earlier purchase."""
    events = _events(spark, sf_dir)
    bought = events.filter("event_type = 'purchase'").select(
        "user_id", "ts", F.col("value").alias("last_purchase"))
    return asof_join(events.select("event_id", "user_id", "ts"), bought, "ts", "ts", ["last_purchase"], ["user_id"])


@query
def asof_inclusive(spark, sf_dir):
    """Every event with its user's latest error up to and including its time."""
    events = _events(spark, sf_dir)
    errors = events.filter("event_type = 'error'").select("user_id", "ts", F.col("event_id").alias("error_id"))
    return asof_join(events.select("event_id", "user_id", "ts"), errors, "ts", "ts", ["error_id"],
                     ["user_id"], strict=False)


@query
def asof_interval(spark, sf_dir):
    """The latest strictly earlier purchase again, as the validity interval that holds the event."""
    events = _events(spark, sf_dir)
    bought = events.filter("event_type = 'purchase'").select("user_id", "ts", F.col("value").alias("last_purchase"))
    intervals = validity(bought, "ts", ["last_purchase"], ["user_id"])
    return interval_join(events.select("event_id", "user_id", "ts"), intervals, "ts", ["last_purchase"], ["user_id"])


@query
def error_intervals(spark, sf_dir):
    """How long each user's error stays the latest one, and the events that fall into that time."""
    events = _events(spark, sf_dir)
    errors = events.filter("event_type = 'error'").select("user_id", "ts", F.col("event_id").alias("error_id"))
    intervals = store(validity(errors, "ts", ["error_id"], ["user_id"]), "error-intervals")
    met = interval_join(events.select("event_id", "user_id", "ts"), intervals, "ts", ["error_id"], ["user_id"], strict=False)
    seen = met.filter("error_id is not null").groupBy("user_id", "error_id").agg(F.count(F.lit(1)).alias("n_events"))
    return intervals.join(seen, ["user_id", "error_id"], "left").select(
        "user_id", "error_id", "valid_from", "valid_to", F.coalesce("n_events", F.lit(0)).alias("n_events"))


@query
def asof_league(spark, sf_dir):
    """League rate strictly before each scheduled game date, no key."""
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    games = w.stg_games.select("game_pk", "official_date")
    return rounded(asof_join(games, w.int_league_daily, "official_date", "game_date", ["league_hit_per_pa"]))


@query
def event_quantiles(spark, sf_dir):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    q = quantiles(_events(spark, sf_dir), ["event_type"], "value", probs)
    return rounded(q.select("event_type", "n", *[F.element_at("edges", i + 1).alias(f"q{int(p * 100)}")
                                                 for i, p in enumerate(probs)]), 8)


@query
def approximate_edges(spark, sf_dir):
    """Decile edges of every factor from merged monthly sketches, checked against their exact ranks."""
    long = _factor_values(spark, sf_dir)
    edges = store(research.approximate_edges(long), "sketch-edges")
    ranks = sketches.edge_ranks(long, ["factor"], "value", edges)
    p, n, most = F.col("edge") / 10, F.col("n"), 2 * sketches.rank_error()
    off = F.greatest(F.col("below") / n - p, p - F.col("upto") / n, F.lit(0.0))
    return ranks.select("factor", "edge", "n", (off <= most + 1 / n).alias("within"))


@query
def price_spearman(spark, sf_dir):
    """Rank correlation of quantity and price per return flag and line status."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rounded(spearman(lines, ["l_returnflag", "l_linestatus"], "l_quantity", "l_extendedprice"), 8)


@query
def longest_event_run(spark, sf_dir):
    """Longest run of small values per user."""
    rows = _events(spark, sf_dir).select("user_id", "ts", "event_id", (F.col("value") >= 20).cast("int").alias("big"))
    return longest_run(rows, ["user_id"], ["ts", "event_id"], "big", 0)


@query
def user_streaks(spark, sf_dir):
    """Running, recent and previous columns per user over the event stream."""
    rows = _events(spark, sf_dir).select("event_id", "user_id", "ts", "event_type", F.round("value").alias("v"))
    specs = {"v_before": Running("sum", F.col("v")), "n_before": Running("count"),
             "v_type_before": Running("sum", F.col("v"), ("event_type",)),
             "max_before": Running("max", F.col("v")),
             "v_recent": Recent("avg", F.col("v"), 5), "previous_ts": Previous(F.col("ts"))}
    return rounded(ordered_windows(rows, ["user_id"], ["ts", "event_id"], specs, index="idx")
                   .drop("event_type", "v"))


@query
def modal_return_flag(spark, sf_dir):
    """Most frequent return flag per part, lowest on a tie."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return modal_value(lines, ["l_partkey"], "l_returnflag", "flag")


@query
def supplier_wilson(spark, sf_dir):
    """Return rate per supplier, its interval and its shrunk value."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    g = lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"),
                                       F.count_if(F.col("l_returnflag") == "R").alias("k"))
    lo, hi = wilson("k", "n")
    return rounded(g.select("l_suppkey", "n", "k", lo.alias("lo"), hi.alias("hi"),
                            eb_shrink("k", "n", F.lit(0.25)).alias("shrunk")))


from slatecast import plane_queries  # noqa: E402  (reads the helpers above)

QUERIES.update(plane_queries.QUERIES)
