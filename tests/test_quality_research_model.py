import math

import pytest
from conftest import day
from pyspark.sql import functions as F

from slatecast.plans import evaluation as ev
from slatecast.plans import model, output, quality, research
from slatecast.plans.boosting import BoostParams
from slatecast.schemas import RAW
from slatecast.sources import sinks


def fails(df):
    return df.first()["failures"]


def test_checks_find_what_is_wrong(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 5)], "k int, v string, n int")
    assert fails(quality.check_unique(df, ["k"], "t")) == 1
    assert fails(quality.check_unique(df, ["k", "n"], "t")) == 0
    nulls = {r["check"]: r["failures"] for r in quality.check_not_null(df, ["k", "v"], "t").collect()}
    assert nulls == {"not_null t.k": 0, "not_null t.v": 1}
    assert fails(quality.check_accepted(df, "v", ["b"], "t")) == 2       # NULL passes
    assert fails(quality.check_expr(df, "n < 5", "t")) == 1
    with pytest.raises(quality.CheckFailed, match="unique"):
        quality.run_checks(quality.check_unique(df, ["k"], "t"))
    assert quality.run_checks(quality.check_unique(df, ["n"], "t")).count() == 1


def test_freshness_states(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' as ts")
    states = [quality.check_freshness(df, "ts", now, 26, 50, "t").first()["state"] for now in
              ("2024-01-02 02:00:00", "2024-01-02 02:00:01", "2024-01-03 02:00:01")]
    assert states == ["pass", "warn", "error"]
    assert quality.check_freshness(df.limit(0), "ts", "2024-01-01", 1, 2, "t").first()["state"] == "error"


def test_leak_is_seen(spark, warehouse):
    feat = warehouse.feat_batter_game
    assert quality.leaks(feat).isEmpty()
    assert not quality.leaks(feat.withColumn("career_pa_prior", F.col("career_pa_prior") + F.col("pa"))).isEmpty()
    assert not quality.leaks(feat.withColumn("days_rest", F.lit(-1))).isEmpty()


def test_suite_is_green(warehouse):
    names = [m for m in {**quality.UNIQUE, **quality.NOT_NULL} if m in
             ("stg_pitches", "stg_games", "dim_team", "fct_batter_game", "feat_batter_game", "stg_heartbeat")]
    assert quality.run_checks(quality.suite(warehouse, names)).count() > 10


def test_reconcile_and_parity(spark):
    def rows(n, lost=0):
        data = [(day("2024-01-01"), i) for i in range(n - lost)] + [(day("2024-01-08"), i) for i in range(n)]
        return spark.createDataFrame(data + data[:3], "d date, k int")
    got = {str(r["wk"]): (r["a_n"], r["b_n"], r["mismatch"]) for r in
           quality.reconcile_counts(rows(200), rows(200, 5), "d", ["k"]).collect()}
    assert got == {"2024-01-01": (200, 195, True), "2024-01-08": (200, 200, False)}
    a = spark.createDataFrame([(1, 0.5, 1.0), (2, None, 1.0), (3, 0.5, 1.0)], "k int, x double, y double")
    b = spark.createDataFrame([(1, 0.5005, 1.0), (2, 0.1, 1.2), (4, 0.0, 0.0)], "k int, xx double, yy double")
    got = {r["metric"]: (r["joined_rows"], r["mismatches"], r["ok"]) for r in
           quality.parity(a, b, ["k"], {"x": "xx", "y": "yy"}, ["xx"]).collect()}
    assert got == {"xx": (2, 1, False), "yy": (2, 1, True)}
    assert quality.only_in_first(a, b, ["k"]).first()["n"] == 1


def test_verdicts(spark):
    def months(f, values):
        return [(f, 2021 + i % 4, i, v) for i, v in enumerate(values)]
    rows = months("up", [0.02] * 9 + [-0.1]) + months("tiny", [0.001] * 10) + months("flip", [0.1, -0.1, 0.2] * 3)
    ic = spark.createDataFrame(rows, "factor string, season int, month int, ic double")
    keys = spark.createDataFrame([("up",), ("tiny",), ("flip",), ("none",)], "factor string")
    got = {r["factor"]: r["verdict"] for r in research.verdict(ic, keys).collect()}
    assert got == {"up": "PROMOTE", "tiny": "WEAK", "flip": "REJECT", "none": "NO-DATA"}


def test_streak_buckets_and_ends(spark):
    df = spark.createDataFrame([(s, 0.25, 4, int(s > 2)) for s in (0, 1, 2, 3, 4, 5, 9, 10, 99, 100)],
                               "hit_streak_entering int, eb_hit_per_pa_career double, pa int, has_hit int")
    got = {r["bucket"]: (r["n"], r["k"]) for r in research.streak_buckets(df).collect()}
    assert got == {"0": (1, 0), "1": (1, 0), "2": (1, 0), "3-4": (2, 2), "5-9": (2, 2), "10+": (2, 2)}
    table = spark.createDataFrame([("s", str(i), float(i)) for i in range(7)], "key string, level string, rate double")
    assert sorted(r["level"] for r in research.ends(table, "s", 2).collect()) == ["0", "1", "5", "6"]
    assert research.ends(table, "s", 4).count() == 7


def scored(spark):
    rows = [(day(f"2024-04-{d:02d}"), d, b, int((d * b) % 3 == 0), (d * 7 + b * 3) % 10 / 10.0)
            for d in range(1, 11) for b in range(1, 9)]
    return spark.createDataFrame(rows, "game_date date, game_pk int, batter_id int, has_hit int, p double")


@pytest.mark.parametrize("limit", ["1000000", "3"])
def test_metrics_match_brute_force(spark, limit):
    spark.conf.set("slatecast.maxGroupRows", limit)
    try:
        df = scored(spark)
        rows = df.collect()
        got = ev.metric_rows(df, {"m": "p"}).first()
        q = [min(max(r["p"], 1e-6), 1 - 1e-6) for r in rows]
        y = [r["has_hit"] for r in rows]
        assert got["n"] == 80
        assert got["log_loss"] == pytest.approx(-sum(math.log(a if t else 1 - a) for a, t in zip(q, y)) / 80)
        assert got["brier"] == pytest.approx(sum((a - t) ** 2 for a, t in zip(q, y)) / 80)
        pairs = [(a, b) for a, t in zip(q, y) if t for b, u in zip(q, y) if not u]
        assert got["auc"] == pytest.approx(sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs))
        top = ev.top_k_rates(df, {"m": "p"}, [2]).first()
        best = []
        for d in {r["game_date"] for r in rows}:
            best += sorted((r for r in rows if r["game_date"] == d), key=lambda r: (-r["p"], r["batter_id"]))[:2]
        assert top["top2_hit_rate"] == pytest.approx(sum(r["has_hit"] for r in best) / len(best))
    finally:
        spark.conf.unset("slatecast.maxGroupRows")


def test_backtest_gates(spark):
    buckets = spark.createDataFrame([(0.5, 400, 0.02), (0.6, 100, 0.5)], "bucket double, n long, gap double")
    pickers = spark.createDataFrame([(5, "model", 0.7), (5, "season_ba", 0.6), (10, "model", 0.1)],
                                    "k int, picker string, hit_rate double")
    assert ev.backtest_gates(buckets, pickers) == []
    wide = buckets.withColumn("gap", F.col("gap") * 10)
    assert len(ev.backtest_gates(wide, pickers.filter("picker <> 'model'"))) == 2


def test_winner_and_gates(spark):
    rows = [("eb_pa", 0.66, 0.23), ("structural_raw", 0.65, 0.22), ("structural_cal", 0.64, 0.21),
            ("gbm_raw", 0.65, 0.20), ("gbm_cal", 0.67, 0.24)]
    board = spark.createDataFrame(rows, "model string, log_loss double, brier double")
    assert model.select_winner(board, ["structural_cal", "gbm_cal"]) == ("structural_cal", [])
    name, failed = model.select_winner(board, ["gbm_cal"])
    assert name == "gbm_cal" and len(failed) == 2


def test_logistic_matches_newton(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ [1.0, -0.5] + 0.3)))).astype(float)
    w = rng.uniform(0.5, 2, 300)
    df = spark.createDataFrame([(float(a), float(b), float(t), float(v)) for (a, b), t, v in zip(x, y, w)],
                               "a double, b double, y double, w double")
    fitted = model.fit_logistic(df, ["a", "b"], "y", "w")
    p = np.array([r["p"] for r in fitted.score(df, "p").collect()])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    d = np.c_[np.ones(300), z]
    beta = np.zeros(3)
    for _ in range(30):
        mu = 1 / (1 + np.exp(-d @ beta))
        grad = d.T @ (w * (mu - y)) + np.r_[0, beta[1:]]
        hess = (d * (w * mu * (1 - mu))[:, None]).T @ d + np.diag([0, 1, 1])
        beta -= np.linalg.solve(hess, grad)
    assert np.abs(p - 1 / (1 + np.exp(-d @ beta))).max() < 1e-5


def test_small_parts(spark):
    df = spark.createDataFrame([(3, 1, 2.0), (4, 4, 1.0), (2, 0, 1.0)], "pa int, hits int, w double")
    rows = sorted((r["_y"], r["_w"]) for r in model.expand_binomial(df, "w").collect())
    assert rows == [(0.0, 2.0), (0.0, 4.0), (1.0, 2.0), (1.0, 4.0)]
    assert model.medians(spark.createDataFrame([(1.0, None), (2.0, None), (3.0, 5.0), (4.0, None)],
                                               "a double, b double"), ["a", "b"]) == {"a": 2.5, "b": 5.0}
    weights = model.recency_weight(spark.createDataFrame([(day("2024-01-01"),), (day("2022-01-01"),)],
                                                         "game_date date"), 730).collect()
    assert sorted(r["weight"] for r in weights) == [0.5, 1.0]
    s = spark.createDataFrame([(0.0, 0.1), (0.25, 9.0)], "p double, e double")
    got = [r["v"] for r in s.select(model.compose_structural("p", "e").alias("v")).collect()]
    assert got == pytest.approx([1 - 0.98, 1 - 0.75 ** 6.5])
    starters = spark.createDataFrame([(1, False, "L", True), (None, False, "R", True), (2, True, "L", False), (3, None, None, False)],
                                     "batting_order_slot int, is_substitute boolean, opp_starter_throws string, is_home boolean")
    assert sorted((r["batting_order_slot"], r["is_vs_lhp"], r["is_home"]) for r in model.prepare(starters).collect()) \
        == [(1, 1.0, 1.0), (3, 0.0, 0.0)]


def test_isotonic_is_monotone_and_clamps(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 1), (0.3, 0), (0.4, 1), (0.4, 1)], "p double, has_hit int")
    iso = model.fit_isotonic(df, "p")
    at = spark.createDataFrame([(-1.0,), (0.25,), (0.4,), (2.0,)], "p double")
    got = [r["q"] for r in model.calibrate(at, iso, "p", "q").collect()]
    assert got == pytest.approx([1e-6, 0.5, 1 - 1e-6, 1 - 1e-6])


def test_train_save_score_backtest(spark, warehouse, tmp_path):
    # the smallest tables end in spring 2022
    params = model.Params(train_seasons=(2021,), calib_season=2022, test_seasons=(2022,),
                          gbt=BoostParams(rounds=3, leaves=4, min_rows=5, l2=1.0, row_share=0.8, col_share=0.8, patience=100),
                          epa=BoostParams(rounds=3, leaves=4, min_rows=5))
    frame = warehouse.feat_batter_game
    result = model.train(frame, params)
    assert {r["model"] for r in result.board.collect()} == {
        "league", "eb_pa", "logistic", "structural_raw", "structural_cal", "gbm_raw", "gbm_cal"}
    assert {r["dimension"] for r in result.tiers.collect()} <= {"quality", "pa_band"}
    root = str(tmp_path / "models")
    assert model.production(spark, root) is None
    assert [model.save_model(spark, result.winner, root, f"2026-01-0{i}") for i in (1, 2)] == [1, 2]
    loaded, meta = model.load_model(spark, root)
    assert meta["version"] == 2
    slate_frame = warehouse.feat_slate("2021-12-15").withColumns({
        "batting_order_slot": F.coalesce("batting_order_slot", F.lit(1))})
    a = model.score_slate(result.winner, meta, slate_frame, "2021-12-15", "2021-12-15 12:00:00")
    b = model.score_slate(loaded, meta, slate_frame, "2021-12-15", "2021-12-15 12:00:00")
    assert a.columns == RAW["predictions"].names
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    sinks.append_predictions(b, str(tmp_path / "log"))
    assert b.count() > 0
    summary = output.slate_summary(spark.read.parquet(str(tmp_path / "log"))).first()
    assert summary["n_batters"] == b.count()
    assert output.top_scored(b, 2).count() == min(2, b.count())

    report = model.backtest(loaded, frame, params)
    overall = report.overall.filter("model = 'model'")
    ledger = str(tmp_path / "runs")
    assert [sinks.append_run(overall, ledger, "backtest_2026", "2026-02-01", 0.5) for _ in range(2)] == [1, 2]
    assert report.pickers.count() == 6 and report.slices.count() > 3 and isinstance(report.failures, list)
    with pytest.raises(ValueError):
        model.backtest(loaded, frame.filter("season < 2022"), params)
    with pytest.raises(ValueError):
        model.assert_contract(frame.drop("pa_roll5"))
