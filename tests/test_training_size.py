"""Boosting over packed bins, trees of a small table grown in one task, quantile places, named columns of training and studies."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF
from slatecast import queries
from slatecast.operators.ranks import quantile_bins, quantiles
from slatecast.plans import boosting, history, intermediate, marts, model, research
from slatecast.plans.warehouse import StarWarehouse


def refuse(*args, **kwargs):
    raise AssertionError("not needed")


def sample(spark, n=1500):
    draw = random.Random(5)
    rows = [(i, draw.random(), None if i % 7 == 0 else float(draw.randrange(400)), float(draw.random() < 0.4),
             None if i % 50 == 0 else 1.0 + i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, y double, w double")


SHAPE = boosting.BoostParams(rounds=13, leaves=6, min_rows=10, l2=1.0, row_share=0.8, col_share=0.5, bins=300)


def test_small_tables_grow_trees_without_a_job_per_level(spark, monkeypatch):
    df = sample(spark)
    monkeypatch.setattr(boosting.Grower, "sums", refuse)
    assert len(boosting.fit_boosted(df, ["a", "b"], "y", "w", ["id"], SHAPE).trees.roots) == 13


@pytest.mark.parametrize("logistic", [True, False])
def test_one_task_and_many_grow_the_same_trees(spark, monkeypatch, logistic):
    df, held = sample(spark), sample(spark, 300)
    shape = boosting.replace(SHAPE, patience=4)
    one = boosting.fit_boosted(df, ["a", "b"], "y", "w", ["id"], shape, logistic, held)
    monkeypatch.setattr(boosting, "TASK_BYTES", 0)
    many = boosting.fit_boosted(df.repartition(5), ["a", "b"], "y", "w", ["id"], shape, logistic, held)
    for part in ("feature", "left", "right", "missing_left", "roots", "depth"):
        assert getattr(one.trees, part) == getattr(many.trees, part)
    assert one.trees.cut == pytest.approx(many.trees.cut) and one.trees.value == pytest.approx(many.trees.value)


def test_stored_scores_are_those_of_the_model(spark):
    df = sample(spark)
    edges = boosting.bin_edges(df, ["a", "b"], 300)
    rows = boosting.binned(df, ["a", "b"], edges, boosting.bin_width(edges)).withColumn("f", F.lit(0.25))
    grower = boosting.Grower(rows.withColumn("key", F.col("id").cast("string")), ["a", "b"], edges, True, SHAPE, True)
    grower.batch(0)
    fitted = boosting.Boosted(["a", "b"], 0.25, False, grower.on_values())
    got = {r["id"]: r["f"] for r in grower.scored(grower.rows).collect()}
    assert got == pytest.approx({r["id"]: r["p"] for r in fitted.score(df, "p").collect()})


@pytest.mark.parametrize("probs", [[0.5], [i / 63 for i in range(1, 63)], [i / 10 for i in range(11)], [0.0, 0.1, 0.5, 0.9], [0.9, 0.1]])
def test_quantiles_on_even_and_uneven_places(spark, probs):
    draw = random.Random(6)
    groups = {"one": [3.0], "two": [1.0, 2.0], "few": [float(draw.randrange(5)) for _ in range(200)],
              "many": [draw.random() for _ in range(501)]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    for r in quantiles(df, ["g"], "v", probs).collect():
        known = sorted(groups[r["g"]])
        at = [p * (len(known) - 1) for p in probs]
        low = [known[int(x)] for x in at]
        assert r["n"] == len(known) and len(r["edges"]) == len(probs)
        assert r["edges"] == pytest.approx(
            [a + (known[min(int(x) + 1, len(known) - 1)] - a) * (x - int(x)) for a, x in zip(low, at)], abs=1e-9)


def test_bins_are_counted_without_a_filter_of_the_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 2, 3, 4, 9, 10]] + [(None,)], "v double")
    binned = quantile_bins(df, [], "v", 3, "bin")
    assert "filter(" not in binned._jdf.queryExecution().optimizedPlan().toString()
    # edges 1, 1 2/3, 3 2/3, 10: right-closed
    assert sorted((r["v"], r["bin"]) for r in binned.collect() if r["v"]) == [
        (1, 1), (1, 1), (1, 1), (2, 2), (3, 2), (4, 3), (9, 3), (10, 3)]
    assert [r["bin"] for r in binned.collect() if r["v"] is None] == [None]


def rows(df, columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_training_reads_the_columns_it_names(spark, warehouse, monkeypatch):
    for module, name in ((marts, "dim_manager"), (marts, "pair_history"), (history, "dim_venue"), (marts, "dim_player")):
        monkeypatch.setattr(module, name, refuse)
    w = StarWarehouse(spark, SF, ("stg_pitches", "stg_games", "batter_game_by_hand", "fct_pitcher_game", "fct_team_game"),
                      intermediate.UNDER_FEATURES)
    frame = w.features_with(model.TRAINED)
    model.assert_contract(model.prepare(frame))
    assert rows(frame, model.TRAINED) == rows(warehouse.feat_batter_game, model.TRAINED)


def test_scoreboard_reads_the_columns_it_names(spark, warehouse, monkeypatch):
    whole = research.research_frame(warehouse.feat_research, warehouse.fct_batter_game, warehouse.dim_player,
                                    warehouse.dim_team, warehouse.fct_batter_vs_pitcher)
    want, seen = rows(whole, research.JUDGED), []
    monkeypatch.setattr(marts, "dim_player", refuse)
    build = research.study_continuous
    monkeypatch.setattr(research, "study_continuous", lambda df, *a, **k: seen.append(df) or build(df, *a, **k))
    assert queries.QUERIES["study_scoreboard_small_groups"](spark, SF).count() > 20
    assert set(seen[0].columns) == set(research.JUDGED) and rows(seen[0], research.JUDGED) == want
