"""Interval as-of joins, sketches, boosting and further planned pieces."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from slatecast.operators import sketches
from slatecast.operators.asof import asof_join, interval_join, validity
from slatecast.operators.ranks import quantiles
from slatecast.plans import drift, history, matchup, output, research, staking
from slatecast.plans.boosting import Boosted, BoostParams, fit_boosted
from slatecast.streaming import jobs


def events(spark, n=600, seed=1):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, None]), start + dt.timedelta(minutes=rng.randrange(4000)) if i % 50 else None,
             rng.choice("abc"), float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "event_id long, user_id int, ts timestamp, kind string, v double").cache()


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("by", [["user_id"], []])
def test_interval_form_equals_merged_form(spark, strict, by):
    left = events(spark)
    right = left.filter("kind = 'a'").withColumnRenamed("v", "last_v")
    intervals = validity(right, "ts", ["last_v"], by)
    mine = interval_join(left, intervals, "ts", ["last_v"], by, strict)
    plain = asof_join(left, right, "ts", "ts", ["last_v"], by, strict)
    assert sorted(mine.collect(), key=str) == sorted(plain.collect(), key=str)
    # the width of the bins decides cost, never the result
    for width in (10 ** 6, 10 ** 12):
        again = interval_join(left, intervals, "ts", ["last_v"], by, strict, bin_width=width * 60)
        assert sorted(again.collect(), key=str) == sorted(plain.collect(), key=str)
    text = mine._jdf.queryExecution().explainString(mine._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_interval_join_without_rows(spark):
    left = events(spark)
    none = left.filter("kind = 'z'").withColumnRenamed("v", "last_v")
    assert interval_join(left, validity(none, "ts", ["last_v"], ["user_id"]), "ts", ["last_v"], ["user_id"]).filter(
        "last_v is not null").count() == 0
    assert interval_join(none, validity(left, "ts", ["v"], ["user_id"]), "ts", ["v"], ["user_id"]).count() == 0


def test_sketches_merge_within_their_error(spark):
    rows = spark.range(40_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 12).alias("m"),
                                      F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(1000)) / 8.0).alias("v"))
    probs = [i / 10 for i in range(11)]
    fine = sketches.quantile_sketches(rows, ["g", "m"], "v")
    edges = sketches.edges_of(sketches.merged(fine, ["g"]), ["g"], probs)
    exact = {r.g: (r.n, r.edges) for r in quantiles(rows, ["g"], "v", probs).collect()}
    for r in edges.collect():
        n, want = exact[r.g]
        assert r.n == n and r.edges[0] == want[0] and r.edges[-1] == want[-1]
    off = sketches.edge_ranks(rows, ["g"], "v", edges).select(F.max(F.greatest(
        F.col("below") / F.col("n") - F.col("edge") / 10, F.col("edge") / 10 - F.col("upto") / F.col("n")))).first()[0]
    assert off <= 2 * sketches.rank_error() + 0.001


# ---- boosting -------------------------------------------------------------------

def test_missing_values_take_the_better_side_and_growth_is_best_first(spark):
    rng = random.Random(2)
    rows = []
    for i in range(2000):
        a = None if i % 5 == 0 else rng.randrange(200) / 200
        # missing behaves like large, and every step is much larger than the one before
        y = 5000.0 if a is None else 4.0 ** sum(a > e for e in (0.5, 0.75, 0.875, 0.94, 0.97))
        rows.append((i, a, y, 1.0))
    df = spark.createDataFrame(rows, "id long, a double, y double, w double")
    one = BoostParams(rounds=1, step=1.0, leaves=6, min_rows=5, bins=200)
    model = fit_boosted(df, ["a"], "y", "w", ["id"], one, logistic=False)
    t = model.trees
    assert len(t.roots) == 1 and sum(f < 0 for f in t.feature) == 6 and t.depth >= 4      # a chain, not a level
    got = {r.id: r.p for r in model.score(df, "p").collect()}
    assert max(abs(got[i] - y) for i, a, y, _ in rows if a is None) < 1e-6
    assert not t.missing_left[0]


def test_model_file_and_sampling(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.random(), None if i % 3 else rng.random(), float(rng.random() < 0.3), 1.0 + i % 2) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double, w double")
    p = BoostParams(rounds=4, leaves=5, min_rows=10, row_share=0.7, col_share=0.5)
    first, again = (fit_boosted(d, ["a", "b"], "y", "w", ["id"], p) for d in (df, df.repartition(7)))
    assert first.trees.feature == again.trees.feature and first.trees.value == pytest.approx(again.trees.value)
    first.write(spark, str(tmp_path / "m"))
    loaded = Boosted.load(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, loaded.score(df, "p").collect())) == sorted(map(tuple, first.score(df, "p").collect()))
    with pytest.raises(ValueError):
        fit_boosted(df.limit(0), ["a"], "y", "w", ["id"], p)
    flat = fit_boosted(df.withColumn("a", F.lit(None).cast("double")), ["a"], "y", "w", ["id"], p)
    assert flat.trees.roots == [] and flat.score(df, "p").select("p").distinct().count() == 1


# ---- planned pieces ----------------------------------------------------------------

def test_pitch_mix_is_strictly_prior_and_skips_unknown_types(spark):
    rows = [  # pitcher, batter, day, type, ball in play, expected average
        (9, 1, "2024-05-01", "FF", True, 0.5), (9, 2, "2024-05-01", "SL", False, None), (9, 2, "2024-05-01", "FF", False, None),
        (8, 1, "2024-05-02", "SL", True, 0.1), (9, 1, "2024-05-03", "CU", True, 0.9), (9, 1, "2024-05-03", None, True, 0.9)]
    flags = spark.createDataFrame([(p, b, dt.date.fromisoformat(d), t, i, x) for p, b, d, t, i, x in rows],
                                  "pitcher_id long, batter_id long, game_date date, pitch_type string, is_bip boolean, xba double")
    games = spark.createDataFrame([(1, 1, 9, dt.date(2024, 5, 1)), (2, 1, 9, dt.date(2024, 5, 3)), (3, 1, 9, dt.date(2024, 5, 4)),
                                   (4, 2, 9, dt.date(2024, 5, 4)), (5, 1, None, dt.date(2024, 5, 4))],
                                  "game_pk long, batter_id long, opp_starter_id long, game_date date")
    got = {r.game_pk: (r.mix_xba, r.mix_share) for r in matchup.pitch_mix_xba(flags, games).collect()}
    # on the day of the first pitches nothing is known; a batter without balls in play has no row
    assert got == {2: (pytest.approx((2 * 0.5 + 0.1) / 3), 1.0), 3: (pytest.approx((2 * 0.5 + 0.1 + 0.9) / 4), 1.0)}


@pytest.mark.parametrize("split", [False, True])
def test_streak_permutation_counts_every_order(spark, split, request):
    if split:
        request.getfixturevalue("small_groups")
    rng = random.Random(6)
    rows = [(b, g, dt.date(2024, 4, 1) + dt.timedelta(g), rng.randrange(2)) for b in (1, 2, 3) for g in range(60)]
    games = spark.createDataFrame(rows, "batter_id long, game_pk long, game_date date, has_hit int")
    found = research.streak_permutation(games, 8).collect()
    assert sum(r.n for r in found) == len(rows)
    want = {}
    for r in range(9):
        totals = {}
        for b in (1, 2, 3):
            mine = [x for x in rows if x[0] == b]
            if r:
                mine.sort(key=lambda x: int(hashlib.md5(f"{x[1]}:{b}:1:{r}".encode()).hexdigest()[:15], 16))
            streak = 0
            for x in mine:
                label = next(name for bound, name in research.STREAK_BUCKETS if streak <= bound)
                n, k = totals.get(label, (0, 0))
                totals[label] = (n + 1, k + x[3])
                streak = streak + 1 if x[3] else 0
        for label, (n, k) in totals.items():
            want.setdefault(label, {})[r] = k / n
    for r in found:
        played, *others = (want[r.bucket][i] for i in sorted(want[r.bucket]))
        assert r.rate == played
        if others:
            assert r.null_mean == pytest.approx(sum(others) / len(others))
        assert r.p_high == pytest.approx((sum(o >= played for o in others) + 1) / (len(others) + 1))


def test_snapshot_shown_and_games_to_score_again(spark):
    noon, evening = dt.datetime(2024, 6, 1, 12), dt.datetime(2024, 6, 1, 22)
    log = spark.createDataFrame([(noon, 1, 7, 0.5, "v1", False), (evening, 1, 7, 0.6, "v1", True), (noon, 2, 8, 0.4, "v1", False)],
                                "run_ts timestamp, game_pk long, batter_id long, p_hit double, model_version string, lineup_confirmed boolean")
    log = log.withColumn("slate_date", F.lit("2024-06-01").cast("date"))
    for at, want in (("2024-06-01 15:00:00", {1: 0.5, 2: 0.4}), ("2024-06-01 23:00:00", {1: 0.6, 2: 0.4}), ("2024-06-01 10:00:00", {})):
        shown = output.predictions_as_shown(log, F.lit(at).cast("timestamp"))
        assert {r.game_pk: r.p_hit for r in shown.collect()} == want
    lineups = spark.createDataFrame([(1, 7, 100, "1"), (1, 7, 200, "2"), (2, 8, 100, "1"), (2, 8, 100, "2"), (3, 9, 100, "2")],
                                    "game_pk long, player_id long, batting_order int, load_id string")
    changed = output.changed_lineups(lineups, "1")
    assert {r.game_pk: r.n_changed for r in changed.collect()} == {1: 1, 3: 1}
    again = output.rescore(log.drop("run_ts"), changed, lambda rows: rows.withColumn("run_ts", F.lit(evening)))
    assert {r.game_pk for r in again.collect()} == {1}
    played = spark.createDataFrame([(1, 7, 1), (2, 8, 0)], "game_pk long, batter_id long, has_hit int")
    rows = {r.lineup_confirmed: r for r in output.lineup_slice(output.predictions_as_shown(log, F.lit(evening)), played).collect()}
    assert rows[True].n == 1 and rows[True].brier == pytest.approx(0.16) and rows[False].cal_gap == pytest.approx(-0.4)


def test_versions_follow_changes_and_never_overlap(spark, small_groups):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    rows = [(1, day(d), "A" if d < 60 or d >= 90 else "B") for d in range(0, 130, 2)]      # A, B, A again
    rows += [(1, day(60), "AA"), (2, day(5), None), (2, day(6), None), (2, day(9), "C"), (None, day(1), "x"), (3, None, "y")]
    frame = spark.createDataFrame(rows, "venue_id long, official_date date, name string")
    found = history.changing_dimension(frame, "venue_id", "official_date", ["name"])
    got = sorted((r.venue_id, r.version, r.name, r.valid_from, r.valid_to) for r in found.collect())
    assert got == [(1, 1, "A", day(0), day(60)), (1, 2, "B", day(60), day(90)), (1, 3, "A", day(90), None),
                   (2, 1, None, day(5), day(9)), (2, 2, "C", day(9), None)]
    assert history.overlapping(found, "venue_id").count() == 0
    wrong = spark.createDataFrame([(1, 1, day(0), day(9)), (1, 2, day(8), None), (1, 3, day(20), None)],
                                  "venue_id long, version int, valid_from date, valid_to date")
    assert sorted(r.version for r in history.overlapping(wrong, "venue_id").collect()) == [2, 3]


def test_kelly_curve_by_hand(spark, small_groups):
    rng = random.Random(4)
    rows = [(dt.date(2024, 4, 1) + dt.timedelta(rng.randrange(100)), rng.random(), 1 + rng.random() * 2, rng.choice([0, 1, 1, None]))
            for _ in range(900)]
    rows += [(dt.date(2024, 8, 1), 0.5, 1.0, 1), (dt.date(2024, 8, 1), 0.9, None, 1)]
    frame = spark.createDataFrame(rows, "slate_date date, p_hit double, odds double, has_hit int")
    got = {r.slate_date: r for r in staking.kelly_curve(frame).collect()}
    bank, peak, flat = 1.0, 1.0, 0.0
    for date in sorted({r[0] for r in rows}):
        bets = [(0.25 * max(0, (p * (o - 1) - (1 - p)) / (o - 1)), o, y) for d, p, o, y in rows
                if d == date and o and o > 1 and y is not None and p - 1 / o >= 0.02]
        if not bets:
            assert date not in got
            continue
        scale = min(1, 0.5 / sum(b[0] for b in bets))
        gain = scale * sum(s * (o - 1) if y else -s for s, o, y in bets)
        flat += sum(o - 1 if y else -1 for _, o, y in bets)
        bank *= 1 + gain
        peak = max(peak, bank)
        r = got[date]
        assert (r.n_bets, r.day_return, r.bankroll, r.flat_profit, r.drawdown) == (
            len(bets), pytest.approx(gain), pytest.approx(bank), pytest.approx(flat), pytest.approx(1 - bank / peak))
        assert r.staked <= 0.5 + 1e-12


def test_drift_watch_restarts_and_follows_the_recursion(spark, tmp_path, small_groups):
    rng = random.Random(8)
    start = dt.datetime(2024, 1, 3)
    rows = [(g, g % 7, start + dt.timedelta(days=g // 12), rng.random(), rng.randrange(2)) for g in range(1500)]
    schema = "game_pk int, batter_id int, played_at timestamp, p_hit double, has_hit int"
    land, out, check = (str(tmp_path / n) for n in ("land", "out", "check"))

    def run(part):
        spark.createDataFrame(part, schema).write.mode("append").parquet(land)
        stream = jobs.landed_stream(spark, land, spark.createDataFrame([], schema).schema)
        jobs.drain(jobs.weekly_brier(stream, "played_at"), out, check)

    for a, b in ((0, 500), (480, 1000), (960, 1500)):       # each run reloads the last days of the one before
        run(rows[a:b])
    weekly = spark.read.schema("week date, n long, brier double").parquet(out)
    want, last = {}, rows[-1][2].date() - dt.timedelta(7)
    for g, b, at, p, y in rows:
        week = at.date() - dt.timedelta(at.weekday())
        want.setdefault(week, []).append((p - y) ** 2)
    want = {w: v for w, v in want.items() if w + dt.timedelta(7) <= last}
    found = {r.week: r for r in drift.drift_curve(weekly, 0.3, 0.02, 0.1).collect()}
    assert set(found) == set(want)
    cusum = 0.0
    for week in sorted(want):
        brier = sum(want[week]) / len(want[week])
        cusum = max(0.0, cusum + brier - 0.32)
        r = found[week]
        assert (r.n, r.brier, r.cusum, r.alarm) == (len(want[week]), pytest.approx(brier), pytest.approx(cusum), cusum > 0.1)
