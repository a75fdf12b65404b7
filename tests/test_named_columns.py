"""Queries that name their columns: the same values, from fewer models; scores ranked in bands."""

import random

import pytest

from conftest import SF
from slatecast import queries
from slatecast.operators import ordered
from slatecast.plans import evaluation, features, intermediate, marts, research
from slatecast.plans.warehouse import StarWarehouse

KEY = ["game_pk", "batter_id"]
MIXED = [*KEY, "day_night", "league_rank_entering", "opp_starter_id", "contact_pct_platoon_roll10", "hit_per_pa_platoon_roll5",
         "xba_mean_roll20", "p_bf_roll10", "team_hits_roll15", "war_prev_season", "days_rest", "hit_streak_entering"]


def rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("columns", [research.CATEGORICAL_FEATURES, queries.EVALUATED, MIXED, [*KEY, "pa", "opp_k_pct_against_roll15"],
                                     [*KEY, "season_games_prior"], [*KEY, "pa_prev_season"], [*KEY, "p_starts_prior"]])
def test_named_columns_are_those_of_the_whole_frame(spark, warehouse, columns):
    columns = [c for c in columns if c not in research.FACT_COLUMNS]
    narrow = StarWarehouse(spark, SF, ()).features_with(columns)
    assert narrow.columns == columns
    assert rows(narrow, columns) == rows(warehouse.feat_batter_game, columns)


def test_venue_and_manager_come_from_the_fact(spark, warehouse):
    columns = [*KEY, *research.FACT_COLUMNS]
    assert rows(StarWarehouse(spark, SF, ()).features_with(columns), columns) == rows(warehouse.fct_batter_game, columns)


def refuse(*args, **kwargs):
    raise AssertionError("not needed")


def test_categorical_study_builds_only_what_it_reads(spark, monkeypatch):
    for module, name in ((marts, "fct_pitcher_game"), (marts, "pair_history"), (marts, "dim_player"),
                         (intermediate, "batter_game_by_hand"), (features, "prior_seasons")):
        monkeypatch.setattr(module, name, refuse)
    assert queries.QUERIES["study_categorical_small_groups"](spark, SF).count() > 0


def test_scores_are_built_without_pitch_measures(spark, monkeypatch):
    for module, name in ((marts, "fct_pitcher_game"), (marts, "fct_team_game"), (intermediate, "batter_game_by_hand"),
                         (intermediate, "int_game_starters"), (features, "prior_seasons")):
        monkeypatch.setattr(module, name, refuse)
    assert queries.QUERIES["backtest_gates"](spark, SF).count() == 1


def area(data):
    pos, neg = ([p for y, p in data if y == v] for v in (1, 0))
    return sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))


def test_auc_cuts_no_group_whose_scores_are_spread(spark, small_groups, monkeypatch):
    draw = random.Random(3)
    data = [(draw.randrange(2), draw.random()) for _ in range(400)]
    df = spark.createDataFrame([("m", y, p) for y, p in data], "model string, y int, p double")
    monkeypatch.setattr(ordered, "with_position", refuse)
    assert evaluation.auc(df, ["model"], "y", "p").first()["auc"] == pytest.approx(area(data), abs=1e-12)


def test_auc_of_a_full_band_ties_and_ends(spark, small_groups):
    draw = random.Random(4)
    data = [(draw.randrange(2), 0.5 + draw.randrange(90) * 1e-8) for _ in range(300)]
    data += [(draw.randrange(2), draw.choice([-1.0, 0.0, 0.25, 1.0, 2.0])) for _ in range(60)]
    df = spark.createDataFrame([("m", y, p) for y, p in data], "model string, y int, p double")
    clipped = [(y, min(max(p, evaluation.EPS), 1 - evaluation.EPS)) for y, p in data]
    assert evaluation.auc(df, ["model"], "y", "p").first()["auc"] == pytest.approx(area(clipped), abs=1e-12)
