"""Hand-made cases of the model layer."""

import duckdb
import pytest
from conftest import day
from pyspark.sql import functions as F

from oracle.models import MODELS
from slatecast.functions.pitch_flags import FLAGS, pitch_flags
from slatecast.plans import features, intermediate, marts, output, slate, staging
from slatecast.schemas import RAW


def pitch(**kw):
    base = {n: None for n in RAW["pitches"].names}
    base.update(game_pk=1, game_date="2024-05-01", game_type="R", home_team="H", away_team="A", batter=10,
                pitcher=20, player_name="P", stand="R", p_throws="R", inning=1, inning_topbot="Top",
                at_bat_number=1, pitch_number=1, type="S", description="called_strike", zone=5)
    base.update(kw)
    return tuple(base[n] for n in RAW["pitches"].names)


def pitches(spark, *rows):
    return staging.stg_pitches(spark.createDataFrame(list(rows), RAW["pitches"]))


def test_flags_edges_and_nulls(spark):
    rows = [
        pitch(at_bat_number=1, type="X", description="hit_into_play", events="single", launch_speed=95.0,
              launch_angle=8.0, bb_type="line_drive"),
        pitch(at_bat_number=2, type="X", description="hit_into_play", events="field_out", launch_speed=98.0,
              launch_angle=26.0),
        pitch(at_bat_number=3, type="X", description="hit_into_play_score", events="sac_fly", launch_speed=98.0,
              launch_angle=32.0),
        pitch(at_bat_number=4, description="foul_tip", zone=11),
        pitch(at_bat_number=5, description=None, zone=None, type=None),
        pitch(at_bat_number=6, description="ball", zone=10, type="B", events="walk"),
        pitch(at_bat_number=7, type="X", description="hit_into_play", launch_speed=None, launch_angle=20.0),
        pitch(at_bat_number=8, type="X", description="hit_into_play", launch_speed=110.0, launch_angle=8.0),
    ]
    got = {r["at_bat_number"]: r for r in pitch_flags(pitches(spark, *rows)).select("at_bat_number", *FLAGS).collect()}
    one = got[1]
    assert one["is_hard_hit"] and one["is_sweet_spot"] and one["is_line_drive"] and not one["is_barrel"]
    assert one["is_hit"] and one["is_ab"] and one["is_contact"] and one["is_swing"]
    assert got[2]["is_barrel"] and got[2]["is_line_drive"] is None
    assert not got[3]["is_barrel"] and got[3]["is_sweet_spot"] and not got[3]["is_ab"] and got[3]["is_pa_end"]
    assert got[4]["is_chase"] and got[4]["is_hit"] is None and got[4]["is_ab"] is False
    five = got[5]
    assert five["is_swing"] is None and five["is_in_zone"] is None and five["is_bip"] is None
    assert five["is_pa_end"] is False and five["is_chase"] is None
    assert got[6]["is_bb"] and not got[6]["is_in_zone"] and not got[6]["is_out_zone"] and not got[6]["is_ab"]
    assert got[7]["is_hard_hit"] is None and got[7]["is_barrel"] is None
    assert got[8]["is_barrel"]                      # window floor of 8 degrees at 110 mph


# description, event, zone, result, speed, angle, ball type -> the flags that are true, and those that are unknown
FLAG_TABLE = [
    (("swinging_strike", None, 1, "S", None, None, None), "swing whiff in_zone", "hit k bb"),
    (("swinging_strike_blocked", "strikeout", 14, "S", None, None, None), "swing whiff out_zone chase pa_end k ab", ""),
    (("foul", None, 9, "S", None, None, None), "swing contact in_zone", "hit k bb"),
    (("foul_bunt", None, 10, "S", None, None, None), "swing contact", "hit k bb"),
    (("missed_bunt", None, 11, "S", None, None, None), "out_zone", "hit k bb"),
    (("ball", "walk", 15, "B", None, None, None), "pa_end bb", ""),
    (("hit_by_pitch", "hit_by_pitch", None, "B", None, None, None), "pa_end", "in_zone out_zone"),
    ((None, None, None, None, 99.0, 28.0, "line_drive"), "",
     "swing contact whiff in_zone out_zone chase hit k bb bip hard_hit sweet_spot line_drive barrel"),
    (("hit_into_play", "home_run", 5, "X", 98.0, 26.0, "fly_ball"),
     "swing contact in_zone pa_end hit ab bip hard_hit sweet_spot barrel", ""),
    (("hit_into_play", "home_run", 5, "X", 98.0, 30.0, "fly_ball"),
     "swing contact in_zone pa_end hit ab bip hard_hit sweet_spot barrel", ""),
    (("hit_into_play", "double", 5, "X", 98.0, 25.9, "line_drive"),
     "swing contact in_zone pa_end hit ab bip hard_hit sweet_spot line_drive", ""),
    (("hit_into_play", "triple", 5, "X", 97.9, 28.0, "fly_ball"),
     "swing contact in_zone pa_end hit ab bip hard_hit sweet_spot", ""),
    (("hit_into_play", "single", 5, "X", 94.9, 32.1, "fly_ball"), "swing contact in_zone pa_end hit ab bip", ""),
    (("hit_into_play", "single", 5, "X", 100.0, 33.0, "fly_ball"),
     "swing contact in_zone pa_end hit ab bip hard_hit barrel", ""),
    (("hit_into_play", "single", 5, "X", 120.0, 50.0, "fly_ball"),
     "swing contact in_zone pa_end hit ab bip hard_hit barrel", ""),
    (("hit_into_play", "single", 5, "X", 120.0, 50.1, "fly_ball"), "swing contact in_zone pa_end hit ab bip hard_hit", ""),
    (("hit_into_play", "single", 5, "X", 120.0, 7.9, "fly_ball"), "swing contact in_zone pa_end hit ab bip hard_hit", ""),
    (("hit_into_play_no_out", "field_error", 5, "X", None, 28.0, None),
     "swing contact in_zone pa_end ab bip sweet_spot", "hard_hit line_drive barrel"),
    (("hit_into_play_score", "sac_fly", 5, "X", 110.0, None, "fly_ball"),
     "swing contact in_zone pa_end bip hard_hit", "sweet_spot barrel"),
    (("hit_into_play", "sac_bunt", 5, "X", 40.0, -40.0, "bunt"), "swing contact in_zone pa_end bip", ""),
    (("hit_into_play", "sac_fly_double_play", 5, "X", 80.0, 40.0, "fly_ball"), "swing contact in_zone pa_end bip", ""),
    (("foul_tip", "catcher_interf", 5, "S", None, None, None), "swing contact in_zone pa_end", ""),
    (("called_strike", "field_out", 5, "S", None, None, "line_drive"), "in_zone pa_end ab", ""),
]


def test_flags_of_a_hand_made_table(spark):
    """The job and its SQL twin against flags written by hand."""
    names = ("description", "events", "zone", "type", "launch_speed", "launch_angle", "bb_type")
    staged = pitches(spark, *[pitch(at_bat_number=i, **dict(zip(names, row))) for i, (row, _, _) in enumerate(FLAG_TABLE)])
    con = duckdb.connect()
    con.register("staged", staged.toArrow())
    twin = con.execute(f"select at_bat_number, {', '.join(FLAGS)} from ({MODELS['flags'].format(stg_pitches='staged')})")
    for rows in ([tuple(r) for r in pitch_flags(staged).select("at_bat_number", *FLAGS).collect()], twin.fetchall()):
        assert len(rows) == len(FLAG_TABLE)
        for number, *flags in rows:
            _, true, unknown = FLAG_TABLE[number]
            got = {n.removeprefix("is_"): v for n, v in zip(FLAGS, flags)}
            assert {n for n, v in got.items() if v} == set(true.split()), FLAG_TABLE[number]
            assert {n for n, v in got.items() if v is None} == set(unknown.split()), FLAG_TABLE[number]


def test_batter_game_zero_denominators_and_tie(spark):
    rows = [pitch(at_bat_number=1, pitch_number=1, p_throws="R", description="ball", type="B", zone=None),
            pitch(at_bat_number=1, pitch_number=2, p_throws="R", description="ball", type="B", events="walk"),
            pitch(at_bat_number=5, pitch_number=1, p_throws="L", description="ball", type="B"),
            pitch(at_bat_number=5, pitch_number=2, p_throws="L", description="ball", type="B", events="walk"),
            # a batter seen without a plate appearance
            pitch(at_bat_number=9, batter=11, inning_topbot="Bot")]
    by_hand = intermediate.batter_game_by_hand(pitch_flags(pitches(spark, *rows)))
    games = intermediate.int_batter_game(by_hand).collect()
    assert [g["batter_id"] for g in games] == [10]
    g = games[0]
    assert g["opp_p_throws"] == "L"                 # two pitches each: lower letter
    assert (g["sc_pa"], g["bb_pct"], g["ba"], g["contact_pct"], g["barrel_pct"]) == (2, 1.0, None, None, None)
    assert (g["team_code"], g["opponent_code"], g["sc_is_home"]) == ("A", "H", False)
    split = {r["batter_id"]: r for r in intermediate.int_batter_game_platoon(by_hand).collect()}
    assert split[10]["pa_vs_l"] == 1 and split[11]["pa_vs_r"] == 0 and split[11]["pa_vs_l"] is None


def test_starters_and_copies(spark):
    rows = [pitch(at_bat_number=2, pitcher=21), pitch(at_bat_number=1, pitch_number=2, pitcher=20),
            pitch(at_bat_number=1, pitch_number=2, pitcher=20),     # exact copy
            pitch(at_bat_number=3, pitcher=30, inning_topbot="Bot", p_throws="L")]
    staged = pitches(spark, *rows)
    assert staged.count() == 3
    got = {r["pitching_side"]: (r["starter_id"], r["starter_throws"])
           for r in intermediate.int_game_starters(staged).collect()}
    assert got == {"home": (20, "R"), "away": (30, "L")}


def test_staging_casts(spark):
    lines = spark.createDataFrame(
        [(1, "2024-05-01", 5, 100, "1"), (1, "2024-05-01", 5, 300, "2"), (1, "2024-05-01", 6, 901, "1"),
         (1, "2024-05-01", 7, None, "1")],
        "game_pk long, official_date string, player_id long, batting_order int, load_id string")
    got = {r["player_id"]: (r["batting_order_raw"], r["batting_order_slot"])
           for r in staging.stg_batting_lines(lines).collect()}
    assert got == {5: (300, 3), 6: (901, 9), 7: (None, None)}
    war = spark.createDataFrame([(1, "a", 2024, 1, "T", "L", 10.0, 5.0, 1.0), (1, "a", 2024, 1, "T", "L", 90.0, 5.0, 0.5),
                                 (1, "a", 2024, 1, "T", "L", None, 5.0, 9.0), (None, "b", 2024, 1, "T", "L", 9.0, 1.0, 1.0)],
                                RAW["war_seasons"])
    assert [(r["pa"], r["war"]) for r in staging.stg_war_seasons(war).collect()] == [(90, 0.5)]
    beat = spark.createDataFrame([(None, "r", "s")], RAW["heartbeat"])
    assert staging.stg_heartbeat(beat).columns == ["run_at", "runner", "git_sha"]


def test_manager_is_lowest_id(spark):
    coaches = spark.createDataFrame([(2024, 1, "T", 9, "Z", "Manager", "X"), (2024, 1, "T", 4, "Y", "Boss", "MNGR"),
                                     (2024, 1, "T", 1, "C", "Hitting Coach", "COAT")],
                                    "season int, team_id long, team_name string, person_id long, person_name string, job string, job_id string")
    assert [(r["manager_id"], r["manager_name"]) for r in marts.dim_manager(coaches).collect()] == [(4, "Y")]


def history(spark, rows):
    """Batter games with only the columns the lag step needs, others NULL."""
    need = dict.fromkeys([*features.CONTEXT, *features.TARGETS, *features.METRICS, *features.SPLIT_COLUMNS,
                          "hits_vs_l", "pa_vs_l", "hits_vs_r", "pa_vs_r"])
    kinds = {"game_date": "date", "hits": "int", "pa": "int", "has_hit": "int", "season": "int",
             "game_pk": "long", "batter_id": "long", "opp_starter_throws": "string"}
    df = spark.createDataFrame([(1, g, day(d), int(d[:4]), pa, h, int(h > 0)) for g, d, pa, h in rows],
                               "batter_id long, game_pk long, game_date date, season int, pa int, hits int, has_hit int")
    return df.withColumns({c: F.lit(None).cast(kinds.get(c, "double")) for c in need if c not in df.columns})


GAMES = [(5, "2023-09-30", 4, 2), (2, "2024-04-01", 4, 0), (3, "2024-04-01", 5, 0), (9, "2024-04-05", 3, 1)]


def test_lagged_history_first_game_doubleheader_new_season(spark):
    rows = {r["game_pk"]: r for r in features.lagged_history(history(spark, GAMES)).collect()}
    first = rows[5]
    assert first["_career_pa"] is None and first["_career_games"] == 0 and first["has_hit_roll5"] is None
    assert first["_previous_date"] is None
    second = rows[2]
    assert second["_season_pa"] is None and second["_season_games"] == 0 and second["_career_hits"] == 2
    assert rows[3]["_previous_date"] == day("2024-04-01") and rows[3]["_last_hit"] == 1
    last = rows[9]
    assert (last["_career_pa"], last["_season_hits"], last["_last_hit"], last["_last_miss"]) == (13, 0, 1, 3)
    assert last["hit_per_pa_roll5"] == pytest.approx((0.5 + 0 + 0) / 3)


def test_streaks_now(spark):
    got = slate.streaks_now(history(spark, GAMES[:3]), "batter_id", "has_hit").collect()[0]
    assert (got["hit_streak_entering"], got["hitless_streak_entering"]) == (0, 2)


def test_split_path_gives_the_same_features(spark, warehouse, small_groups):
    spark.conf.unset("slatecast.maxGroupRows")
    plain = features.lagged_history(warehouse.fct_batter_game).collect()
    spark.conf.set("slatecast.maxGroupRows", "40")
    split = {(r["game_pk"], r["batter_id"]): r for r in features.lagged_history(warehouse.fct_batter_game).collect()}
    assert len(split) == len(plain)
    for r in plain:
        other = split[r["game_pk"], r["batter_id"]]
        for c in r.__fields__:
            a, b = r[c], other[c]
            assert a == b or (isinstance(a, float) and a == pytest.approx(b, abs=1e-12)), (c, a, b)


def test_later_games_never_change_earlier_features(spark, warehouse):
    """Rewriting every row on or after a date leaves the rows up to it alone."""
    cut = F.lit("2021-12-01").cast("date")
    fact = warehouse.fct_batter_game
    spoiled = fact.withColumns({c: F.when(F.col("game_date") >= cut, F.lit(9)).otherwise(F.col(c)).cast(t)
                                for c, t in (("hits", "int"), ("pa", "int"), ("has_hit", "int"))})

    def frame(f):
        rows = features.feat_batter_game(f, intermediate.int_league_daily(f), warehouse.int_pitcher_rolling,
                                         warehouse.int_team_rolling, warehouse.stg_war_seasons)
        return rows.filter(F.col("game_date") <= cut).drop(*features.TARGETS)

    a, b = frame(fact), frame(spoiled)
    assert a.count() > 0 and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_training_row_agrees_with_slate_form_a_day_later(spark, warehouse):
    """The state entering a batter's last game equals the form before it."""
    feat = warehouse.feat_batter_game
    last = feat.groupBy("batter_id").agg(F.max(F.struct("game_date", "game_pk")).alias("m"))
    row = last.orderBy("batter_id").first()
    fact = warehouse.fct_batter_game.filter(F.col("game_date") < row["m"]["game_date"])
    form = slate.current_form(fact).filter(F.col("batter_id") == row["batter_id"]).first()
    train = feat.filter((F.col("batter_id") == row["batter_id"]) & (F.col("game_pk") == row["m"]["game_pk"])).first()
    for c in ["career_pa_prior", "career_hits_prior", "career_games_prior", "hit_streak_entering",
              "hitless_streak_entering", *features.ROLLED]:
        assert form[c] == train[c] or form[c] == pytest.approx(train[c], abs=1e-12), c


def test_posted_lineup_wins_and_fallback_fills(spark):
    sides = spark.createDataFrame([(1, 100), (1, 200)], "game_pk long, team_id long")
    lineups = spark.createDataFrame([(1, day("2024-06-15"), 100, 7, 2), (1, day("2024-06-15"), 100, 8, None)],
                                    "game_pk long, official_date date, team_id long, player_id long, batting_order_slot int")
    projected = spark.createDataFrame([(100, 50, 1), (200, 51, 3)], "team_id long, batter_id long, batting_order_slot int")
    got = sorted(tuple(r) for r in slate.resolve_roster(sides, lineups, projected, "2024-06-15").collect())
    assert got == [(1, 100, 7, 2, True), (1, 200, 51, 3, False)]


def test_slate_offers_every_model_feature(spark, warehouse):
    from slatecast.plans.model import assert_contract, prepare
    frame = warehouse.feat_slate("2021-12-15")
    assert frame.count() > 0
    assert_contract(prepare(frame))
    assert set(features.FEATURES) <= set(frame.columns)


def test_grading_rerun_and_ungraded(spark):
    preds = spark.createDataFrame(
        [(day("2024-06-01"), 1, 10, 1), (day("2024-06-01"), 1, 10, 2), (day("2024-06-01"), 1, 11, 1)],
        "slate_date date, game_pk long, batter_id long, run_ts int")
    others = [f.name for f in RAW["predictions"] if f.name not in preds.columns]
    preds = preds.withColumns({c: F.lit(None).cast("string") for c in others})
    fact = spark.createDataFrame([(1, 10, 1, 2, 4)], "game_pk long, batter_id long, has_hit int, hits int, pa int")
    got = sorted((r["batter_id"], r["run_ts"], r["is_latest"], r["graded"], r["hits"])
                 for r in output.backtest_daily(preds, fact).collect())
    assert got == [(10, 1, False, True, 2), (10, 2, True, True, 2), (11, 1, True, False, None)]
