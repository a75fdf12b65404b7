"""Rank correlation: how often the pairs of a group move, and that split groups agree."""

import math
import random

import pytest

from slatecast.operators.ranks import spearman


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def mean_ranks(values):
    place = sorted(values)
    return [(2 * place.index(v) + place.count(v) + 1) / 2 for v in values]


def pearson(a, b):
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    xy = sum((x - ma) * (y - mb) for x, y in zip(a, b))
    return xy / math.sqrt(sum((x - ma) ** 2 for x in a) * sum((y - mb) ** 2 for y in b))


def ranked_rows(spark):
    draw = random.Random(7)
    rows = [(g, draw.choice([None, 0.5, 1.5, draw.random()]), draw.choice([0, 1, 1, None]))
            for g in ("a", "b", None) for _ in range(90)]
    return rows, spark.createDataFrame(rows, "g string, x double, y int")


def test_pairs_of_a_group_move_once(spark):
    _, df = ranked_rows(spark)
    assert physical(spearman(df, ["g"], "x", "y")).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("limit", [1_000_000, 60, 5])
def test_rank_correlation_of_whole_and_split_groups(spark, limit):
    rows, df = ranked_rows(spark)
    spark.conf.set("slatecast.maxGroupRows", str(limit))
    try:
        got = {r["g"]: r for r in spearman(df, ["g"], "x", "y").collect()}
    finally:
        spark.conf.unset("slatecast.maxGroupRows")
    assert set(got) == {"a", "b"}
    for g in got:
        x, y = zip(*[(x, y) for k, x, y in rows if k == g and x is not None and y is not None])
        assert got[g]["n_pairs"] == len(x)
        assert math.isclose(got[g]["ic"], pearson(mean_ranks(x), mean_ranks(y)), abs_tol=1e-12)
