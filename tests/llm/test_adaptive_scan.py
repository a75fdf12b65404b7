"""The adaptive dimension scan against all inner products."""

import numpy as np
import pytest

from slatecast.llm import adaptive_scan

NAN, INF = float("nan"), float("inf")
COLUMNS = "embedding array<double>, label int, vec_id long, uid long, score double, `a.b` int, list int"


def found(spark, rows, **options):
    frame = spark.createDataFrame([(v, 3, i, 1, 0.5, 2, 7) for i, v in rows], COLUMNS)
    got = adaptive_scan.nearest(frame, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    out = {}
    for r in sorted(map(tuple, got.collect())):
        out.setdefault(r[0], []).append(r[1:])
    return out


def dot(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def expected(rows, k=20):
    sound = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            sound[i] = min(sound.get(i, v), v)
    out = {}
    for q in (i for i in sound if i % 20 == 0):
        best = sorted((-dot(sound[q], v), i) for i, v in sound.items() if i != q and len(v) == len(sound[q]))[:k]
        if best:
            out[q] = [(rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return out


def check(got, want, least):
    assert set(got) == set(want)
    hits = total = 0
    for q, best in want.items():
        assert [r[0] for r in got[q]] == list(range(1, len(best) + 1))
        assert [(-r[2], r[1]) for r in got[q]] == sorted((-r[2], r[1]) for r in got[q])
        scores = {i: s for _, i, s in best}
        assert all(scores[i] == s for _, i, s in got[q] if i in scores)
        assert q not in [r[1] for r in got[q]]
        hits += len(scores.keys() & {r[1] for r in got[q]})
        total += len(best)
    assert hits >= least * total, hits / total
    return hits / total


def test_whole_result_where_every_list_is_probed(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 24)) * rng.choice([0.2, 1, 1, 5], size=(500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[40][1]) for i in range(70)] + [(-20, [0.5] * 7), (-21, [1.5] * 7), (-40, [1.0])]
    odd = [(2000, None), (2020, [1.0, None]), (2040, [NAN] * 24), (2060, [INF] * 24), (None, [1.0] * 24), (2080, []),
           (2100, [0.0] * 24), (60, rows[60][1]), (80, [9.0] * 24)]
    # no list is left out and nothing is abandoned: the result is whole
    got = found(spark, rows + odd, target=1.0, epsilon=1e9, shelf=64, chunk=9, home=30)
    assert check(got, expected(rows + odd), 1.0) == 1.0
    # with the defaults few are lost
    check(found(spark, rows + odd, home=100), expected(rows + odd), 0.9)


@pytest.mark.parametrize("kind", ["random", "clustered"])
def test_recall(spark, kind):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 64))
    if kind == "clustered":
        x = x * 0.6 + rng.normal(size=(60, 64))[rng.integers(0, 60, 6000)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = found(spark, list(enumerate(x.tolist())))
    s = x[::20] @ x.T
    s[np.arange(300), np.arange(0, 6000, 20)] = -9
    best = np.argsort(-s, axis=1)[:, :20]
    hits = sum(len({r[1] for r in got[20 * i]} & set(best[i].tolist())) for i in range(300))
    assert hits >= 0.9 * 6000, hits / 6000


def test_components_of_all_sizes(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 1e200]), (2, [-1e200, 0.0]), (3, [1e-300, 0.0]), (20, [1e-300, 3e-310]),
            (5, [2.0, 1.0]), (40, [5e-324, 0.0])]
    want = expected(rows)
    got = found(spark, rows)
    assert got == want


def test_few_or_no_rows(spark):
    assert found(spark, []) == {}
    assert found(spark, [(20, [1.0])]) == {}
    assert found(spark, [(20, [1.0]), (40, [2.0])]) == {20: [(1, 40, 2.0)], 40: [(1, 20, 2.0)]}


def test_abandonment_saves_work_and_keeps_the_best():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(3000, 64))
    query = rows[:1] + rng.normal(size=(1, 64)) * 0.05
    whole = rows @ query[0]
    bound = np.sort(whole)[-10]
    (_, keys, score), = adaptive_scan.scan(query, [[0]], np.array([bound]), rows, np.zeros(3000, int), np.arange(3000), 21)
    assert set(np.argsort(-whole)[:8]) <= set(keys.tolist()) and (score >= bound).all()


def test_normal_tail():
    z = np.array([-40, -2, -1, 0, 1, 2, 5.0])
    want = [1, 0.9772498680518208, 0.8413447460685429, 0.5, 0.15865525393145707, 0.022750131948179195, 2.866515718791933e-07]
    assert np.allclose(adaptive_scan._upper_tail(z), want, atol=1e-7)
