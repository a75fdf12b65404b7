"""Reads of loads that disagree, pruned slices, boosting with patience, grading once, one latest run."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from slatecast.plans import model, output
from slatecast.plans.boosting import BoostParams, best_round
from slatecast.schemas import RAW
from slatecast.sources import readers, sinks
from slatecast.streaming import jobs


def test_loads_with_conflicting_types(spark, tmp_path):
    path = str(tmp_path / "pitches")
    spark.createDataFrame([(1, 5)], "game_pk long, zone int").write.parquet(f"{path}/load_1")
    spark.createDataFrame([(2, 6.0)], "game_pk long, zone double").write.parquet(f"{path}/load_2")
    spark.createDataFrame([("3", None)], "game_pk string, zone string").write.parquet(f"{path}/load_3")
    rows = readers.read_pitches(spark, path).select("game_pk", "zone").collect()
    assert sorted((r.game_pk, r.zone) for r in rows) == [(1, 5), (2, 6), (3, None)]


def test_conform_keeps_large_whole_numbers(spark):
    big = 2 ** 53 + 1
    schema = RAW["pitches"]
    for kind, value in (("long", big), ("string", str(big))):
        df = spark.createDataFrame([(value,)], f"game_pk {kind}")
        assert readers.conform(df, schema).first().game_pk == big
    assert readers.conform(spark.createDataFrame([("5.0",)], "game_pk string"), schema).first().game_pk == 5


def test_slice_prunes_season_folders(spark, tmp_path):
    path = str(tmp_path / "games")
    rows = [(y, f"{y}-05-{d:02d}", y) for y in (2021, 2022, 2023) for d in range(1, 29)]
    spark.createDataFrame(rows, "game_pk long, official_date string, load_season int") \
        .write.partitionBy("load_season").parquet(path)
    landed = spark.read.parquet(path)
    target = spark.createDataFrame([("2022-05-03",)], "official_date string")
    part = sinks.incremental_slice(landed, target, "official_date", "2024-01-01", cap_days=5)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_season" in plan and "GreaterThanOrEqual(official_date" in plan
    assert sorted(r.official_date for r in part.collect()) == [f"2022-05-{d:02d}" for d in range(3, 9)]
    window = sinks.reload_window(landed, "official_date", "2023-05-10", 2, 1)
    assert window.count() == 4


def test_segments_cover_every_day_once():
    cut = sinks.segments(dt.date(2024, 1, 1), dt.date(2024, 3, 1))
    days = [a + dt.timedelta(i) for a, b in cut for i in range((b - a).days + 1)]
    assert days == [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(61)] and len(cut) == 3
    assert sinks.segments(dt.date(2024, 1, 2), dt.date(2024, 1, 1)) == []


def test_patience():
    assert best_round([5, 4, 3, 3.5, 3.4, 2], 2) == (3, True)
    assert best_round([5, 4, 3, 3.5, 3.4, 2], 4) == (6, False)
    assert best_round([1], 1) == (1, False)


def test_boosting_keeps_many_trees_and_gains(spark):
    df = spark.range(3000).select(
        F.col("id"), (F.rand(1) * 4).alias("x1"), (F.rand(2) * 4).alias("x2"), F.rand(3).alias("u"))
    df = df.withColumns({"has_hit": (F.col("u") < F.lit(1.0) / (1 + F.exp(2 - F.col("x1") * F.col("x2") / 2))).cast("int"),
                         "weight": F.lit(1.0)})
    fit, tail = df.filter("id % 4 > 0"), df.filter("id % 4 = 0")
    fit, tail = (d.withColumns({"game_pk": F.col("id"), "batter_id": F.lit(1)}) for d in (fit, tail))
    shape = BoostParams(rounds=25, patience=8, leaves=6, min_rows=10, step=0.1, l2=1.0)
    many = model.fit_gbt(fit, tail, ["x1", "x2"], "weight", model.Params(gbt=shape))
    assert len(many.trees.roots) > 5
    first = model.fit_gbt(fit, tail, ["x1", "x2"], "weight", model.Params(gbt=replace(shape, rounds=1)))
    loss = [float(m.score(tail, "p").agg(F.avg(-F.when(F.col("has_hit") == 1, F.ln("p")).otherwise(F.ln(1 - F.col("p"))))).first()[0])
            for m in (first, many)]
    assert loss[1] < loss[0] - 0.01


def test_gates_stop_an_export(spark, tmp_path):
    done = model.Training(None, None, None, "gbm_cal", ["gbm_cal does not beat eb_pa"])
    with pytest.raises(model.GateFailed):
        done.export(spark, str(tmp_path), "2026-01-01")


def test_outcome_that_lands_twice_grades_once(spark, tmp_path):
    schema = "game_pk long, batter_id long, has_hit int, hits int, pa int, at timestamp"
    landed = str(tmp_path / "landed")
    for n in range(2):
        rows = [(1, 7, 1, 2, 4, dt.datetime(2024, 5, 1)), (n + 2, 7, 0, 0, 3, dt.datetime(2024, 5, 2))]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
    log = spark.createDataFrame([(g, 7, 0.5) for g in (1, 2, 3)], "game_pk long, batter_id long, p_hit double")
    for name, at in (("all", None), ("window", "at")):
        stream = jobs.landed_stream(spark, landed, spark.read.parquet(landed).schema, 1)
        out = str(tmp_path / name)
        jobs.drain(jobs.grade_stream(stream, log, at), out, str(tmp_path / f"check-{name}"))
        assert sorted(r.game_pk for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_one_latest_run_also_with_nulls_and_ties(spark):
    day, t = dt.date(2024, 5, 1), dt.datetime(2024, 5, 1)
    schema = ("run_ts timestamp, slate_date date, game_pk long, batter_id long, player_name string, team_id long, "
              "opponent_team_id long, batting_order_slot int, lineup_confirmed boolean, opp_starter_id long, "
              "p_hit double, model_version string")
    rows = [(ts, day, g, b, "x", 1, 2, 3, True, 4, 0.5, v) for ts, g, b, v in
            [(t, 1, 1, "v1"), (t, 1, 1, "v2"), (None, 1, 1, "v3"), (t, None, 2, "v1"), (None, 5, None, "v1")]]
    games = spark.createDataFrame([(1, 1, 1, 2, 4)], "game_pk long, batter_id long, has_hit int, hits int, pa int")
    got = output.backtest_daily(spark.createDataFrame(rows, schema), games).collect()
    assert len(got) == 5
    assert sorted((str(r.game_pk), r.model_version) for r in got if r.is_latest) == [("1", "v2"), ("5", "v1"), ("None", "v1")]


def test_fact_moves_twice_in_the_feature_plan(spark, warehouse):
    """Without broadcasts: once to its game, once to its batter."""
    from slatecast.plans import features

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        context = features.join_context(warehouse.fct_batter_game, warehouse.int_league_daily,
                                        warehouse.int_pitcher_rolling, warehouse.int_team_rolling,
                                        warehouse.stg_war_seasons)
        plan = context._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("\n")
    depth = [next((i for i, c in enumerate(line) if c.isalpha()), 0) for line in lines]
    moved = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = [lines[j] for j in range(i + 1, next((k for k in range(i + 1, len(lines)) if depth[k] <= depth[i]), len(lines)))]
            if any("FileScan" in x and "player_name" in x for x in below):    # a column of the fact alone
                moved.append(line[line.index("(") + 1:line.index("#")])
    assert moved == ["batter_id", "game_pk"]


def test_starters_meet_pitches_in_a_hash_aggregate(spark, warehouse):
    from slatecast.plans.intermediate import int_game_starters

    plan = int_game_starters(warehouse.stg_pitches)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("FileScan") - 600:]
    assert "HashAggregate(keys=[game_pk" in below and "SortAggregate" not in below
