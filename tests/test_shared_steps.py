"""The steps that the feature frame and all studies share: what they move and what they look at."""

import math
import random
import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from slatecast.functions.rates import rounded_to
from slatecast.operators.ordered import RecentMeans, ordered_windows
from slatecast.plans import quality, research
from slatecast.plans.warehouse import StarWarehouse


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("limit", [1_000_000, 9])
@pytest.mark.parametrize("current", [False, True])
def test_longer_means_come_from_shorter_ones(spark, limit, current):
    draw = random.Random(4)
    rows = [(g, i, draw.choice([None, draw.random()])) for g in range(3) for i in range(60)]
    df = spark.createDataFrame(rows, "g int, i int, v double")
    out = ordered_windows(df, ["g"], ["i"], {"m": RecentMeans(F.col("v"), (2, 4, 8, 9))}, max_rows=limit,
                          include_current=current)
    if limit > 60:   # two rows are summed in a frame, not the third to eighth
        frames = out._jdf.queryExecution().analyzed().toString()
        assert "specifiedwindowframe(RowFrame, -2" in frames or current
        for before in ((-4, -3), (-8, -5), (-3, -2), (-7, -4)):
            assert f"specifiedwindowframe(RowFrame, {before[0]}, {before[1]})" not in frames
    for r in out.collect():
        for n in (2, 4, 8, 9):
            end = r["i"] + (1 if current else 0)
            seen = [v for g, i, v in rows if g == r["g"] and end - n <= i < end and v is not None]
            want = sum(seen) / len(seen) if seen else None
            got = r[f"m{n}"]
            assert (got is None) == (want is None)
            assert got is None or math.isclose(got, want, abs_tol=1e-12)


def test_rounding_is_that_of_round(spark):
    draw = random.Random(5)
    values = [0.0, 0.03125, -0.03125, 0.00625, 2.5, -2.5, 1e-12, -1e-12, 1 / 3, 1023.99995, 1e6 + 1 / 3, 1e300,
              float("nan"), float("inf"), float("-inf"), None]
    values += [draw.uniform(-3, 3) for _ in range(300)] + [k / n for n in range(1, 41) for k in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    both = df.select("v", *[c for d in (4, 10) for c in (rounded_to("v", d).alias(f"a{d}"), F.round("v", d).alias(f"b{d}"))])
    for r in both.collect():
        for d in (4, 10):
            assert str(r[f"a{d}"]) == str(r[f"b{d}"]), r


def test_pitches_move_before_they_are_wide_and_by_game_only_once(spark):
    pitches = StarWarehouse(spark, SF, ()).stg_pitches
    plan = physical(pitches)
    # the orders' join, the move by game, and nothing below the pick of one copy
    assert "Exchange hashpartitioning(game_pk" in plan
    assert "at_bat_number#" not in "".join(line for line in plan.splitlines() if "Exchange" in line)
    w = StarWarehouse(spark, SF, ("stg_pitches", "stg_games", "batter_game_by_hand"))
    for grouped in (w.int_batter_game, w.int_batter_game_platoon, w.int_game_starters, w.stg_batting_lines, w.dim_game):
        assert "Exchange hashpartitioning" not in physical(grouped)


def test_facts_of_a_game_meet_without_a_shuffle(spark):
    tables = ("stg_pitches", "stg_games", "batter_game_by_hand", "fct_standings_daily", "dim_manager")
    w = StarWarehouse(spark, SF, tables)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        by_key = w.int_batter_game.join(w.int_batter_game_platoon.drop("game_date"), ["game_pk", "batter_id"])
        assert "Exchange hashpartitioning" not in physical(by_key)
        assert "Exchange hashpartitioning" not in physical(w.fct_pitcher_game)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_studies_need_no_join_back_and_no_written_features(spark):
    w = StarWarehouse(spark, SF, ("stg_pitches", "stg_games", "fct_batter_game", "fct_pitcher_game", "fct_team_game"))
    frame = research.research_frame(w.feat_research, w.fct_batter_game, w.dim_player, w.dim_team, w.fct_batter_vs_pitcher)
    plain = research.research_frame(w.feat_batter_game, w.fct_batter_game, w.dim_player, w.dim_team, w.fct_batter_vs_pitcher)

    def facts_read(df) -> int:
        return len(set(re.findall(r"manager_name#\d+", df._jdf.queryExecution().optimizedPlan().toString())))

    assert sorted(frame.columns) == sorted(plain.columns)
    assert facts_read(frame) < facts_read(plain) or physical(frame).count("Join") < physical(plain).count("Join")
    assert set(research.CATEGORICAL) <= set(frame.columns)
    assert set(quality.LEAK_COLUMNS) <= set(w.feat_batter_game.columns)
