"""Registered queries of the ingest and model planes.

Nested documents are built from the landed tables, written out as JSON text and
parsed again by the readers' layouts, so that flattening is checked against the
rows that went in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecast.plans import drift, evaluation, history, matchup, output, research, staging, staking
from slatecast.plans import model as training
from slatecast.plans.boosting import BoostParams, fit_boosted
from slatecast.plans.quality import only_in_first
from slatecast.plans.warehouse import StarWarehouse
from slatecast.session import scratch_path, store
from slatecast.sources import flatten, readers, sinks
from slatecast.streaming import jobs

QUERIES: dict[str, Callable] = {}


def query(fn: Callable) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


def _through_json(documents: DataFrame, layout: str) -> DataFrame:
    text = documents.select(F.to_json(F.struct("*"), {"ignoreNullFields": "true"}).alias("text"))
    return text.select(F.from_json("text", layout).alias("d")).select("d.*")


def _entity(key: str, name: str, label: str = "name") -> Column:
    return F.struct(F.col(key).alias("id"), F.col(name).alias(label))


# ---- ingest ------------------------------------------------------------------

@query
def flatten_schedule(spark, sf_dir):
    games = StarWarehouse(spark, sf_dir, ()).raw("games")

    def side(s: str) -> Column:
        # a pitcher who isn't named yet is absent from the document
        pitcher = F.when(F.col(f"{s}_probable_pitcher_id").isNotNull(), _entity(
            f"{s}_probable_pitcher_id", f"{s}_probable_pitcher_name", "fullName"))
        return F.struct(_entity(f"{s}_team_id", f"{s}_team_name").alias("team"), pitcher.alias("probablePitcher"))

    game = F.struct(
        F.col("game_pk").alias("gamePk"), F.col("official_date").alias("officialDate"), "season",
        F.col("game_type").alias("gameType"), F.struct(F.col("status").alias("detailedState")).alias("status"),
        F.col("day_night").alias("dayNight"), F.col("doubleheader").alias("doubleHeader"),
        F.col("game_number").alias("gameNumber"), _entity("venue_id", "venue_name").alias("venue"),
        F.struct(side("home").alias("home"), side("away").alias("away")).alias("teams"))
    # one document per date and load, as the feed answers them
    days = games.groupBy("official_date", "load_id").agg(F.collect_list(game).alias("games"))
    return flatten.flatten_schedule(_through_json(days.select(F.array(F.struct("games")).alias("dates")),
                                                  flatten.SCHEDULE))


def _boxscores(lines: DataFrame, batting: Column | None, position: Column) -> DataFrame:
    """One document per game: both teams with their players by key."""
    player = F.struct(
        _entity("player_id", "player_name", "fullName").alias("person"),
        F.struct(position.alias("abbreviation")).alias("position"),
        F.col("batting_order").cast("string").alias("battingOrder"),
        F.struct((batting if batting is not None else F.struct(F.lit(None).cast("int").alias("hits"))).alias("batting"))
        .alias("stats"))
    entry = F.struct(F.concat(F.lit("ID"), F.monotonically_increasing_id()).alias("key"), player.alias("value"))
    sides = lines.withColumn("entry", entry).groupBy("game_pk", "is_home", "team_id").agg(
        F.map_from_entries(F.collect_list("entry")).alias("players"))
    side = F.struct(F.struct(F.col("team_id").alias("id")).alias("team"), "players")
    games = sides.groupBy("game_pk").agg(F.max(F.when(F.col("is_home"), F.to_json(side))).alias("home"),
                                         F.max(F.when(~F.col("is_home"), F.to_json(side))).alias("away"))
    layout = f"struct<home: {flatten._BOX_SIDE}, away: {flatten._BOX_SIDE}>"
    text = F.concat(F.lit('{"home":'), F.coalesce("home", F.lit("null")), F.lit(',"away":'),
                    F.coalesce("away", F.lit("null")), F.lit("}"))
    return games.select(F.col("game_pk").alias("gamePk"), F.from_json(text, layout).alias("teams"))


@query
def flatten_boxscore(spark, sf_dir):
    w = StarWarehouse(spark, sf_dir, ())
    names = {"plateAppearances": "plate_appearances", "atBats": "at_bats", "hits": "hits", "doubles": "doubles",
             "triples": "triples", "homeRuns": "home_runs", "baseOnBalls": "walks", "strikeOuts": "strikeouts",
             "runs": "runs", "rbi": "rbi"}
    boxes = _boxscores(w.raw("batting_lines"), F.struct(*[F.col(c).alias(n) for n, c in names.items()]),
                       F.col("position"))
    games = w.stg_games.withColumn("official_date", F.col("official_date").cast("string"))
    return flatten.flatten_boxscore_lines(boxes, games)


@query
def flatten_lineups(spark, sf_dir):
    """Posted orders, out of boxscore documents, of games as they stood before they ended; then staged."""
    w = StarWarehouse(spark, sf_dir, ())
    games = staging.stg_games(w.raw("games").filter("status <> 'Final'")).withColumn(
        "official_date", F.col("official_date").cast("string"))
    posted = flatten.flatten_lineups(_boxscores(w.raw("batting_lines").filter("load_id = '1700000002'"), None,
                                                F.col("position")), games)
    return staging.stg_lineups(posted.withColumn("load_id", F.lit("1700000002")))


@query
def war_files(spark, sf_dir):
    """Seasons written as the published text file (a word for what is missing, a column of mixed text), read back."""
    raw = StarWarehouse(spark, sf_dir, ()).raw("war_seasons")
    text = raw.select(
        F.col("mlb_id").alias("mlb_ID"), "name_common", F.col("year_id").alias("year_ID"),
        F.col("stint_id").alias("stint_ID"), F.col("team_id").alias("team_ID"), F.col("lg_id").alias("lg_ID"),
        F.col("pa").alias("PA"), F.col("g").alias("G"), F.col("war").alias("WAR"),
        (F.col("mlb_id") / 2).cast("string").alias("salary"),
        F.when(F.col("mlb_id") % 20 == 0, "n/a").otherwise(F.col("mlb_id").cast("string")).alias("note"))
    path = scratch_path(spark, "war-files")
    text.write.option("header", True).option("nullValue", "NULL").csv(path)
    war = readers.read_war(spark, path, 2021, 2024)
    return war.select("mlb_id", "year_id", "stint_id", "pa", "g", "war", "salary", "note")


@query
def flatten_standings(spark, sf_dir):
    rows = StarWarehouse(spark, sf_dir, ()).raw("standings")
    team = F.struct(_entity("team_id", "team_name").alias("team"), F.col("division_rank").alias("divisionRank"),
                    F.col("league_rank").alias("leagueRank"), "wins", "losses",
                    F.col("win_pct").alias("winningPercentage"))
    divisions = rows.groupBy("standings_date", "division_id", "league_id", "load_id").agg(
        F.collect_list(team).alias("teamRecords"))
    record = F.struct(F.struct(F.col("division_id").alias("id")).alias("division"),
                      F.struct(F.col("league_id").alias("id")).alias("league"), "teamRecords")
    days = divisions.groupBy(F.col("standings_date").alias("asOf"), "load_id").agg(
        F.collect_list(record).alias("records"))
    return flatten.flatten_standings(_through_json(days.drop("load_id"), flatten.STANDINGS))


@query
def flatten_coaches(spark, sf_dir):
    rows = StarWarehouse(spark, sf_dir, ()).raw("coaches")
    person = F.struct(_entity("person_id", "person_name", "fullName").alias("person"), "job",
                      F.col("job_id").alias("jobId"))
    staffs = rows.groupBy("season", "team_id", "team_name", "load_id").agg(F.collect_list(person).alias("roster"))
    return flatten.flatten_coaches(_through_json(staffs.select(
        "season", _entity("team_id", "team_name").alias("team"), "roster"), flatten.COACHES))


@query
def incremental_slice(spark, sf_dir):
    """The next three weeks of games after a target that holds the first half of 2023."""
    games = StarWarehouse(spark, sf_dir, ()).raw("games")
    target = games.filter("official_date < '2023-06-01'").select("official_date")
    rows = sinks.incremental_slice(games, target, "official_date", "2025-01-01")
    return rows.select("game_pk", "official_date", "load_id")


@query
def reload_window(spark, sf_dir):
    games = StarWarehouse(spark, sf_dir, ()).raw("games")
    return sinks.reload_window(games, "official_date", "2023-06-10", 3, 2).select("game_pk", "official_date", "load_id")


@query
def conform_pitches(spark, sf_dir):
    """Pitches that arrive as text, numbers with a decimal point, read back to their types."""
    raw = StarWarehouse(spark, sf_dir, ()).raw("pitches")
    loose = raw.select("game_pk", "at_bat_number", "pitch_number",
                       F.concat(F.col("zone").cast("string"), F.lit(".0")).alias("zone"),
                       F.col("launch_speed").cast("string").alias("launch_speed"),
                       F.col("balls").cast("double").alias("balls"))
    typed = readers.conform(loose, raw.schema)
    return typed.select("game_pk", "at_bat_number", "pitch_number", "zone", "launch_speed", "balls", "events")


#: Slices of games as they land; every fifth game misses the first. Some of those come two weeks late at most
#: (second slice), the rest too late (third slice).
LATE_SLICES = [("2021-01-01", "2023-06-30"), ("2023-06-01", "2024-12-31"), ("2023-01-01", "2023-03-31"),
               ("2024-12-20", "2026-12-31")]
LATE_DAYS = 14


@query
def stream_late(spark, sf_dir):
    """Overlapping, out-of-order slices of games: what is older than the newest date by over two weeks is too late."""
    games = StarWarehouse(spark, sf_dir, ()).raw("games").select(
        "game_pk", "official_date", F.lit(0).alias("slice"))
    games = store(games, "games-by-date")
    path, out, checkpoint = (scratch_path(spark, n) for n in ("late-games", "late-tolerant", "checkpoint"))

    def run():
        rows = jobs.late_tolerant(jobs.landed_stream(spark, path, games.schema), ["game_pk"], "official_date", LATE_DAYS)
        jobs.drain(rows.select("game_pk", "official_date", "slice"), out, checkpoint)

    slices = [games.filter(F.col("official_date").between(first, last)).withColumn("slice", F.lit(i))
              for i, (first, last) in enumerate(LATE_SLICES)]
    slices[0] = slices[0].filter("game_pk % 5 <> 0")
    jobs.land_and_run(slices, path, run)
    return spark.read.schema(games.schema).parquet(out)


@query
def only_in_first_copy(spark, sf_dir):
    """Batter-games that a copy without every 37th batter lacks."""
    games = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand")).int_batter_game
    return only_in_first(games, games.filter("batter_id % 37 <> 0"), ["game_pk", "batter_id"])


# ---- model ---------------------------------------------------------------------

def _scored(spark, sf_dir) -> DataFrame:
    from slatecast.queries import _scored as scored

    return scored(spark, sf_dir)


def _weighted_games(spark, sf_dir) -> DataFrame:
    """Batter games as training rows: two measures that may be missing, and a weight."""
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    return store(w.fct_batter_game.select(
        "game_pk", "batter_id", F.col("has_hit").cast("int").alias("has_hit"), "batting_order_slot", "contact_pct",
        (1 + F.col("game_pk") % 3 / 2).alias("weight")), "weighted-games")


#: Small enough for a twin in SQL: three rounds of four leaves on two features.
TWO_FEATURES = ["batting_order_slot", "contact_pct"]
THREE_ROUNDS = BoostParams(rounds=3, step=0.3, leaves=4, min_rows=20, l2=1.0, bins=8, row_share=0.8)


@query
def boosted_rounds(spark, sf_dir):
    """Chance of a hit from three boosting rounds: binned splits, missing sides, rows drawn by hash."""
    games = _weighted_games(spark, sf_dir)
    model = fit_boosted(games, TWO_FEATURES, "has_hit", "weight", ["game_pk", "batter_id"], THREE_ROUNDS)
    return model.score(games, "p").select("game_pk", "batter_id", F.round("p", 6).alias("p"))


@query
def logistic_fit(spark, sf_dir):
    """Coefficients of the weighted logistic baseline on standardised, median-filled features."""
    games = _weighted_games(spark, sf_dir)
    fitted = training.fit_logistic(games.withColumn("y", F.col("has_hit").cast("double")), TWO_FEATURES, "y", "weight", 0.01)
    last = fitted.pipeline.stages[-1]
    rows = [("intercept", float(last.intercept)), *zip(TWO_FEATURES, map(float, last.coefficients))]
    return spark.createDataFrame(rows, "term string, value double").select("term", F.round("value", 4).alias("value"))


@query
def pitch_mix_xba(spark, sf_dir):
    """The starter's pitch mix times the batter's expected average by type, both strictly before the game."""
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    rows = matchup.pitch_mix_xba(w.int_pitch_flags, w.fct_batter_game)
    return rows.select("game_pk", "batter_id",
                       # moved off exact halves, which many of these fractions are
                       *[F.round(F.col(c) + 1e-12, 10).alias(c) for c in ("mix_xba", "mix_share")])


@query
def streak_permutation(spark, sf_dir):
    """Hit rate by streak against thirty shuffles of every batter's games."""
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    rows = research.streak_permutation(store(w.fct_batter_game.select("batter_id", "game_pk", "game_date", "has_hit"),
                                             "played-games"), 30)
    return rows.select("bucket", "n", *[F.round(c, 8).alias(c) for c in ("rate", "null_mean", "null_sd", "p_high")])


#: When the site was built: after the first run of 1 June 2026 and before the second.
SHOWN_AT = "2026-06-01 12:30:00"


def _shown(w: StarWarehouse) -> DataFrame:
    return output.predictions_as_shown(w.raw("predictions"), F.lit(SHOWN_AT).cast("timestamp"))


@query
def predictions_as_shown(spark, sf_dir):
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    return _shown(w).select(F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("scored_at"), "slate_date", "game_pk", "batter_id", "p_hit", "model_version")


@query
def lineup_slice(spark, sf_dir):
    """Cost of projected lineups: what was shown, confirmed against projected."""
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    rows = output.lineup_slice(_shown(w), w.fct_batter_game)
    return rows.select("lineup_confirmed", "n", *[F.round(c, 8).alias(c) for c in ("base_rate", "cal_gap", "log_loss", "brier")])


@query
def dim_venue(spark, sf_dir):
    """Venues with their home team's name over time."""
    return StarWarehouse(spark, sf_dir, ("stg_games",)).dim_venue


@query
def game_venues(spark, sf_dir):
    """Every game with the version of its venue that held on its date."""
    w = StarWarehouse(spark, sf_dir, ("stg_games", "dim_venue"))
    return history.with_venue(w.stg_games, w.dim_venue)


@query
def kelly_curve(spark, sf_dir):
    """Bankroll of quarter-Kelly stakes at derived odds, day by day."""
    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    odds = 1 + (F.col("game_pk") * 13 + F.col("batter_id") * 5) % 64 / 64.0
    graded = _shown(w).join(w.fct_batter_game.select("game_pk", "batter_id", "has_hit"), ["game_pk", "batter_id"])
    curve = staking.kelly_curve(graded.select("slate_date", "p_hit", "has_hit", odds.alias("odds")))
    return curve.select("slate_date", "n_bets", *[F.round(c, 7).alias(c) for c in (
        "staked", "day_return", "bankroll", "flat_profit", "drawdown")])


#: Backtest score, slack and limit of the registered drift watch.
DRIFT = (0.33, 0.01, 0.05)


@query
def drift_watch(spark, sf_dir):
    """Weekly Brier score of what was shown, graded as outcomes land, and its cumulative sum."""
    from slatecast.queries import date_slices

    w = StarWarehouse(spark, sf_dir, ("stg_pitches", "batter_game_by_hand", "fct_batter_game"))
    played = w.fct_batter_game.select("game_pk", "batter_id", "has_hit", F.col("game_date").cast("timestamp").alias("played_at"))
    graded = _shown(w).select("game_pk", "batter_id", "p_hit").join(played, ["game_pk", "batter_id"])
    graded = store(graded.filter("has_hit is not null"), "graded")
    path, out, checkpoint = (scratch_path(spark, n) for n in ("landed-grades", "weekly-brier", "checkpoint"))

    def weekly() -> DataFrame:
        return jobs.weekly_brier(jobs.landed_stream(spark, path, graded.schema), "played_at")

    jobs.land_and_run(date_slices(graded, "played_at", ["2023-06-01", "2025-01-01"]), path,
                      lambda: jobs.drain(weekly(), out, checkpoint))
    weeks = spark.read.schema("week date, n long, brier double").parquet(out)
    return drift.drift_curve(weeks, *DRIFT).select(
        "week", "n", *[F.round(F.col(c) + 1e-12, 9).alias(c) for c in ("brier", "cusum")], "alarm")


@query
def changed_lineups(spark, sf_dir):
    """Games to score again in the evening: their order moved after the first load."""
    return output.changed_lineups(StarWarehouse(spark, sf_dir, ()).raw("lineups"), "1700000001")


@query
def isotonic_map(spark, sf_dir):
    """Rate that the monotone map gives each of the stand-in scores."""
    scored = _scored(spark, sf_dir)
    points = scored.select("p_model").distinct()
    found = training.calibrate(points, training.fit_isotonic(scored, "p_model"), "p_model", "rate")
    return found.select("p_model", F.round("rate", 8).alias("rate"))


@query
def binomial_expansion(spark, sf_dir):
    """Weighted successes and failures of all starters' games."""
    rows = _scored(spark, sf_dir).select("hits", "pa", (1.0 / F.col("batting_order_slot")).alias("w"))
    trials = training.expand_binomial(rows, "w")
    return trials.groupBy(F.col("_y").alias("y")).agg(F.count(F.lit(1)).alias("n"),
                                                      F.round(F.sum("_w"), 6).alias("weight"))


@query
def structural_probability(spark, sf_dir):
    """Chance of a hit composed from a per-appearance chance and expected appearances."""
    rows = _scored(spark, sf_dir)
    return rows.select("game_pk", "batter_id", F.round(training.compose_structural(
        "eb_hit_per_pa_career", F.coalesce("pa_roll10", F.lit(0.0))), 8).alias("p_hit"))


@query
def baseline_scoreboard(spark, sf_dir):
    """The league rate and the shrunk career rate as models."""
    scored = _scored(spark, sf_dir)
    rate = scored.agg(F.avg("has_hit")).first()[0]
    rows = evaluation.metric_rows(scored.withColumn("p_league", F.lit(rate)), {"league": "p_league", "eb_pa": "eb_pa"})
    return rows.select("model", "n", *[F.round(c, 8).alias(c) for c in ("log_loss", "brier", "auc")])


@query
def winner_gates(spark, sf_dir):
    """Which of two candidates wins, and how many gates it fails."""
    scored = _scored(spark, sf_dir).withColumns({
        "p_half": (F.col("p_model") + F.col("eb_pa")) / 2, "p_most": F.col("p_model") * 0.1 + F.col("eb_pa") * 0.9})
    board = evaluation.metric_rows(scored, {"eb_pa": "eb_pa", "half_raw": "p_model", "half_cal": "p_half",
                                            "most_raw": "p_half", "most_cal": "p_most"})
    name, failures = training.select_winner(board, ["half_cal", "most_cal"])
    return spark.createDataFrame([(name, len(failures))], "winner string, failures int")


@query
def backtest_gates(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    failures = evaluation.backtest_gates(evaluation.calibration_buckets(scored, "p_model"),
                                         evaluation.picker_table(scored))
    return spark.createDataFrame([(len(failures),)], "failures int")


@query
def evaluation_ledger(spark, sf_dir):
    """Two evaluations recorded one after the other."""
    metrics = evaluation.metric_rows(_scored(spark, sf_dir), {"eb_pa": "eb_pa"})
    path = scratch_path(spark, "ledger")
    for day in (1, 2):
        sinks.append_run(metrics, path, f"backtest-{day}", f"2026-01-0{day} 00:00:00", 0.5)
    rows = readers.table_or_empty(spark, path, "runs")
    return rows.select("run_name", "n", "top5_hit_rate", "evaluations_to_date",
                       *[F.round(c, 8).alias(c) for c in ("log_loss", "brier", "auc")])
