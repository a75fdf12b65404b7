"""Ordered windows: both paths against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from slatecast.operators.asof import asof_join
from slatecast.operators.ordered import Previous, Recent, RecentMeans, Running, ordered_windows
from slatecast.operators.ranks import quantile_bins, quantiles, spearman
from slatecast.operators.runs import expanding_mean, longest_run


def make_rows(n=400, seed=3):
    rnd = random.Random(seed)
    # one key holds half of all rows, one key is NULL
    keys = ["hot"] * 5 + ["a", "b", "c", None, None]
    return [(rnd.choice(keys), rnd.randrange(60), i, rnd.choice([None, 0.25, 0.5, 2.0]), rnd.randrange(2),
             rnd.choice("xy")) for i in range(n)]


SCHEMA = "k string, d int, id int, v double, hit int, kind string"


def brute(rows, include_current):
    out = {}
    for r in rows:
        mine = sorted([x for x in rows if x[0] == r[0]], key=lambda x: (x[1], x[2]))
        pos = mine.index(r)
        seen = mine[:pos + 1] if include_current else mine[:pos]
        vals = [x[3] for x in seen if x[3] is not None]
        kind = [x[3] for x in seen if x[5] == r[5] and x[3] is not None]
        last3 = [x[3] for x in seen[-3:] if x[3] is not None]
        last7 = [x[3] for x in seen[-7:] if x[3] is not None]
        hits = [mine.index(x) + 1 for x in seen if x[4] == 1]
        out[r[2]] = (pos + 1, sum(vals) if vals else None, len(seen), sum(kind) if kind else None,
                     max(hits) if hits else None, vals[-1] if vals else None,
                     sum(last3) / len(last3) if last3 else None, sum(last7) / len(last7) if last7 else None,
                     mine[pos - 1][1] if pos else None)
    return out


def specs():
    return {
        "total": Running("sum", F.col("v")), "n": Running("count"),
        "by_kind": Running("sum", F.col("v"), ("kind",)),
        "last_hit": Running("max", F.when(F.col("hit") == 1, F.col("pos"))),
        "latest": Running("last", F.col("v")),
        "m": RecentMeans(F.col("v"), (3, 7)),
        "before": Previous(F.col("d")),
    }


NAMES = ["pos", "total", "n", "by_kind", "last_hit", "latest", "m3", "m7", "before"]


@pytest.mark.parametrize("include_current", [False, True])
@pytest.mark.parametrize("limit", [1_000_000, 50, 7])
def test_ordered_windows_match_brute_force(spark, include_current, limit):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = ordered_windows(df, ["k"], ["d", "id"], specs(), index="pos", include_current=include_current,
                          max_rows=limit).collect()
    want = brute(rows, include_current)
    assert len(got) == len(rows)
    for r in got:
        for name, expected in zip(NAMES, want[r["id"]]):
            if expected is None or r[name] is None:
                assert r[name] is expected or r[name] == expected, (r, name, expected)
            else:
                assert math.isclose(r[name], expected, abs_tol=1e-12), (r, name, expected)


def test_recent_frames_and_single_group(spark):
    df = spark.range(30).select(F.col("id").cast("int").alias("id"))
    for limit in (1000, 4):
        got = {r["id"]: r["s"] for r in ordered_windows(
            df, [], ["id"], {"s": Recent("sum", F.col("id"), 3)}, max_rows=limit).collect()}
        assert got == {i: (sum(range(max(0, i - 3), i)) if i else None) for i in range(30)}


@pytest.mark.parametrize("limit", ["1000000", "5"])
def test_quantiles_and_bins(spark, limit):
    import pandas as pd
    spark.conf.set("slatecast.maxGroupRows", limit)
    try:
        rows = [("a", float((i * 7) % 23)) for i in range(97)] + [("b", 1.0)] * 5 + [("b", 2.0), ("b", None)]
        df = spark.createDataFrame(rows, "g string, v double")
        pdf = pd.DataFrame(rows, columns=["g", "v"])
        probs = [0, 0.1, 0.5, 0.75, 1]
        got = {r["g"]: list(r["edges"]) for r in quantiles(df, ["g"], "v", probs).collect()}
        for g in "ab":
            assert got[g] == pytest.approx(pdf[pdf.g == g].v.quantile(probs).tolist())
        bins = quantile_bins(df, ["g"], "v", 4, "bin").collect()
        for g in "ab":
            expect = pd.qcut(pdf[pdf.g == g].v, 4, labels=False, duplicates="drop") + 1
            assert sorted(r["bin"] for r in bins if r["g"] == g and r["bin"]) == sorted(expect.dropna().astype(int))
        assert [r["bin"] for r in bins if r["v"] is None] == [None]
    finally:
        spark.conf.unset("slatecast.maxGroupRows")


@pytest.mark.parametrize("limit", ["1000000", "5"])
def test_spearman(spark, limit):
    import pandas as pd
    spark.conf.set("slatecast.maxGroupRows", limit)
    try:
        rnd = random.Random(5)
        rows = [("a", rnd.randrange(12) / 4, rnd.randrange(2)) for _ in range(120)]
        rows += [("few", 1.0, 1)] * 10 + [("flat", 3.0, i % 2) for i in range(50)] + [("a", None, 1)]
        df = spark.createDataFrame(rows, "g string, x double, y int")
        got = {r["g"]: r["ic"] for r in spearman(df, ["g"], "x", "y").collect()}
        pdf = pd.DataFrame([r for r in rows if r[0] == "a" and r[1] is not None], columns=["g", "x", "y"])
        assert got["a"] == pytest.approx(pdf.x.rank().corr(pdf.y.rank()), abs=1e-12)
        assert got["few"] is None and got["flat"] is None
    finally:
        spark.conf.unset("slatecast.maxGroupRows")


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("limit", ["1000000", "6"])
def test_asof_matches_brute_force(spark, strict, limit):
    spark.conf.set("slatecast.maxGroupRows", limit)
    try:
        rnd = random.Random(9)
        left = [(i, rnd.choice([1, 1, 1, 2, None]), rnd.randrange(20)) for i in range(80)]
        right = [(rnd.choice([1, 1, 2, None]), rnd.randrange(20), i) for i in range(40)]
        got = {r["id"]: r["val"] for r in asof_join(
            spark.createDataFrame(left, "id int, k int, t int"),
            spark.createDataFrame(right, "k int, rt int, val int"), "t", "rt", ["val"], ["k"], strict).collect()}
        for i, k, t in left:
            seen = [(rt, v) for kk, rt, v in right if kk == k and (rt < t if strict else rt <= t)]
            assert got[i] == (max(seen)[1] if seen else None)
    finally:
        spark.conf.unset("slatecast.maxGroupRows")


def test_asof_keeps_left_rows_without_time(spark):
    left = spark.createDataFrame([(1, None), (2, 5)], "id int, t int")
    right = spark.createDataFrame([(3, 7.0)], "rt int, v double")
    got = {r["id"]: r["v"] for r in asof_join(left, right, "t", "rt", ["v"]).collect()}
    assert got == {1: None, 2: 7.0}


@pytest.mark.parametrize("limit", ["1000000", "4"])
def test_runs(spark, limit):
    spark.conf.set("slatecast.maxGroupRows", limit)
    try:
        outcomes = [1, 0, 0, 0, 1, 0, 0, 1, 1, 0, 0, 0, 0]
        df = spark.createDataFrame([("p", i, o) for i, o in enumerate(outcomes)] + [("q", 0, 1)],
                                   "g string, i int, o int")
        got = {r["g"]: r["longest_run"] for r in longest_run(df, ["g"], ["i"], "o").collect()}
        assert got == {"p": 4, "q": 0}
        means = {r["i"]: r["m"] for r in expanding_mean(df.filter("g = 'p'"), ["g"], ["i"], "o", "m").collect()}
        assert means[4] == pytest.approx(2 / 5) and means[12] == pytest.approx(sum(outcomes) / 13)
    finally:
        spark.conf.unset("slatecast.maxGroupRows")
