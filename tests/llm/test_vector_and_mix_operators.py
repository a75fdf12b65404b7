"""Exact search, lattice hashing, ProbMinHash, mixing, components and the pipeline against brute force."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF

import corpus_pipeline
from scripts.compare import rows_of
from slatecast.llm import lattice, mixing, probminhash, topk
from slatecast.llm.components import components
from slatecast.llm.queries import ORACLE_SQL, QUERIES

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 3, 0.5, "g") for i, v in rows],
                                 "vec_id long, embedding array<double>, label int, score double, cell string")


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(400, 20)), 1)
    x[200:260] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1020, [1.0, None]), (1040, [NAN] * 20), (1060, [INF] * 20), (None, [1.0] * 20),
           (1080, []), (20, x[20].tolist())]
    got = topk.top_k(vectors(spark, rows + odd), queries_in_cell=7, rows_in_cell=60).collect()
    whole = np.vstack([np.floor(64 * x), np.zeros((1, 20)), np.floor(64 * x[20:21])])
    ids = np.array([*range(400), 1080, 20])
    want = []
    for q in [*range(0, 400, 20), 1080]:
        mine = whole[list(ids).index(q)]
        best = sorted((-int(whole[j] @ mine), int(ids[j])) for j in range(len(ids)) if ids[j] != q)[:20]
        want += [(q, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(vectors(spark, [])).count() == 0


def test_top_k_of_huge_components(spark):
    rows = [(0, [1e18, 2.0]), (1, [1e18, -1.0]), (2, [-1e18, 0.0]), (3, [0.0, 1.0])]
    got = {r.vec_id: r.score for r in topk.top_k(vectors(spark, rows)).collect()}
    assert got == {1: (1 << 63) - 1, 2: -(1 << 63), 3: 128 * 64}


def test_e8_decoding_is_nearest():
    rng = np.random.default_rng(2)
    y = rng.normal(size=(300, 8)) * 2
    found = lattice.nearest_e8(y)
    assert np.all((np.rint(found * 2).astype(int).sum(1)) % 4 == 0)
    around = lattice.minimal_vectors()
    assert len(around) == 240 and np.allclose((around ** 2).sum(1), 2)
    mine = ((y - found) ** 2).sum(1)
    others = ((y[:, None] - found[:, None] - around[None]) ** 2).sum(2).min(1)
    assert np.all(mine <= others + 1e-9)


def linked(x, ids, threshold=0.9):
    n = np.linalg.norm(x, axis=1)
    link = (x @ x.T) / (n[:, None] * n) >= threshold
    np.fill_diagonal(link, False)
    label = np.array(ids)
    i, j = np.nonzero(link)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        if (label == before).all():
            return link.sum(1), label


@pytest.mark.parametrize("blocks", [{}, {"standing": 5, "visiting": 9}])
def test_lattice_against_brute_force(spark, blocks):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 32))
    x = np.vstack([np.repeat(centres, 15, 0) + rng.normal(size=(300, 32)) * 0.15, rng.normal(size=(150, 32)),
                   np.repeat(rng.normal(size=(1, 32)), 60, 0)])
    ids = list(range(len(x)))
    odd = [(1000, None), (1001, [0.0] * 32), (1002, [NAN] * 32), (1003, [1.0, None]), (None, x[0].tolist()),
           (0, x[0].tolist()), (1004, [INF] * 32), (1005, [])]
    got = lattice.embedding_groups(vectors(spark, [(i, v.tolist()) for i, v in zip(ids, x)] + odd), **blocks).collect()
    by_id = {r.vec_id: r for r in got if r.vec_id is not None}
    degree, label = linked(x, ids)
    mine = np.array([by_id[i].n_links for i in ids])
    assert np.all(mine <= degree) and mine.sum() >= 0.97 * degree.sum()
    assert np.mean([by_id[i].component_id == c for i, c in zip(ids, label)]) > 0.99
    assert all(r.kept == (r.vec_id == r.component_id) for r in by_id.values())
    assert all(by_id[i].n_links == 0 and by_id[i].kept for i in range(1000, 1006))
    assert mine[-60:].tolist() == [59] * 60


@pytest.mark.parametrize("short, long", [(64, 128), (384, 768)])
def test_lattice_never_compares_unlike_lengths(spark, monkeypatch, short, long):
    # all vectors of a table meet in one cell, as far as their lengths allow
    def one_cell(self, x):
        keys = true_cells(self, x) % 1024
        return keys + (keys // 64 + 1) * 1024
    true_cells = lattice.Lattice.cells
    rng = np.random.default_rng(4)
    base = {d: rng.normal(size=d) for d in (short, long)}
    rows = [(i, (base[d] + 0.01 * rng.normal(size=d)).tolist()) for i, d in enumerate([short, long, short, long, long])]
    same = lattice.Lattice(1, 4, 0.6, 1)
    same.planes = {d: np.zeros((1, d, 8)) for d in base}
    keys = [same.cells(np.ones((1, d)))[0, 0, 0] for d in base]
    assert keys[0] != keys[1]           # one lattice point, two lengths
    monkeypatch.setattr(lattice.Lattice, "cells", one_cell)
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice.embedding_groups(vectors(spark, rows), tables=1).collect()}
    assert got == {0: (1, 0), 2: (1, 0), 1: (2, 1), 3: (2, 1), 4: (2, 1)}


def test_lattice_recall_at_the_threshold(spark):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(800, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = rng.normal(size=a.shape)
    z -= (z * a).sum(1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    b = 0.9005 * a + np.sqrt(1 - 0.9005 ** 2) * z
    got = lattice.embedding_groups(vectors(spark, list(enumerate(np.vstack([a, b]).tolist()))))
    assert got.filter("vec_id < 800 and n_links > 0").count() >= 0.95 * 800


def test_components_of_paths_stars_and_nothing(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)] + [(5, 5), (7, 9), (9, 7)]
    edges += [(rng.randint(300, 500), rng.randint(300, 500)) for _ in range(150)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    label = {n: n for e in edges for n in e}
    for _ in range(200):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    alone = {n for a, b in edges if a == b for n in (a,)} - {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: r for n, r in label.items() if n not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def exact_jp(a, b):
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in set(a) | set(b)) for d in a if d in b)


def test_probability_jaccard_and_its_estimate():
    rng, hashes = random.Random(8), probminhash.WordHashes()
    for share in (0.0, 0.1, 0.5):
        v = [str(rng.randint(0, 40)) for _ in range(150)] + list("abcdefg") * 10
        w = [str(rng.randint(50, 90)) if rng.random() < share / 5 else x for x in v]
        a, b = probminhash.weighted(v), probminhash.weighted(w)
        want = exact_jp(a, b)
        assert abs(probminhash.similarity(a, b) - want) < 1e-9
        s, t = (probminhash.signature(*probminhash.shingles(x, hashes), 4000) for x in (v, w))
        assert abs((s == t).mean() - want) < 0.04


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, 0.5, "k") for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, size double, key string")


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for g in range(12):
        base = [f"w{rng.randint(0, 4000)}" for _ in range(rng.randint(60, 300))]
        for _ in range(rng.randint(1, 8)):
            copy = [x if rng.random() > rng.choice([0, 0.01, 0.03]) else f"n{rng.randint(0, 999)}" for x in base]
            rows.append((len(rows), " ".join(copy), "s"))
    n = len(rows)
    rows += [(n, "Short one", "s"), (n + 1, "short ONE!", "s"), (n + 2, "short two", "s"), (n + 3, None, "s"), (n + 4, "", "s"),
             (n + 5, "!!!", "s"), (None, "short one", "s"), (0, rows[0][1], "s"), (n + 6, "again " * 30000, "s")]
    got = {r.doc_id: r.class_id for r in probminhash.near_duplicates(documents(spark, rows)).collect()}
    sets = {i: probminhash.weighted(probminhash.words(t)) for i, t, _ in rows if i is not None}
    label = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and exact_jp(sets[a], sets[b]) >= 0.8]
    for _ in range(20):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label
    kept = probminhash.keep_one(documents(spark, rows))
    assert {r.doc_id for r in kept.collect()} == {i for i in sets if label[i] == i} | {None}
    assert kept.columns == documents(spark, rows).columns


def test_near_duplicates_of_repeated_ids_go_by_text(spark):
    rng = np.random.default_rng(8)
    x, y, z, u = (" ".join(f"w{k}" for k in rng.integers(0, 5000, 60)) for _ in range(4))
    near = lambda t: t.rsplit(" ", 1)[0] + " other"
    for a, b in ((x, y), (y, x)):   # whichever text has the lesser digest
        rows = [(1, a), (2, near(a)), (2, b), (3, near(b)), (3, z), (4, near(z)), (4, near(z)), (5, u), (5, ""), (6, near(near(u)))]
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        want = sorted([(1, a), (2, b), (3, z), (5, u), (5, "")])
        for parts in (1, 5):
            got = probminhash.keep_one(frame.repartition(parts)).collect()
            assert sorted(map(tuple, got)) == want
        report = dict(map(tuple, probminhash.near_duplicates(frame).collect()))
        assert report[1] == 1 and report[2] in (1, 2) and report[3] in (2, 3) and report[4] == 3 and report[6] == 5


def test_mixing_reaches_targets(spark):
    rng = random.Random(10)
    rows = [(i, " ".join(["w"] * rng.randint(0, 50)), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(400, None, "d"), (401, "", "d"), (None, "x y", "b"), (7, rows[7][1], rows[7][2]), (402, "w " * 20000, "a")]
    plan = mixing.curriculum(documents(spark, rows)).collect()
    assert len(plan) == len(rows)
    sizes = Counter()
    for r in plan:
        assert r.size == len((r.doc.text or "").split()) and 0 <= r.taken <= 2 * r.size
        assert (r.position is not None) == (r.taken > 0) and (r.again is not None) == (r.taken > r.size)
        sizes[r.doc.source] += r.size
    weight = dict(zip(["a", "b", "c", "d", None], [3, 1, 2, 3, 1]))
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(weight)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        if not full:
            target.update({s: level * weight[s] for s in open_})
        open_ = open_ - full if full else set()
    for s in weight:
        mine = [r for r in plan if r.doc.source == s]
        assert {round(r.target, 6) for r in mine} == {round(target[s], 6)}
        assert abs(sum(r.taken for r in mine) - target[s]) <= 1
    again = mixing.curriculum(documents(spark, rows).repartition(9)).collect()
    key = lambda r: (str(r.doc), r.taken, r.position, r.again)
    assert sorted(map(key, plan), key=str) == sorted(map(key, again), key=str)
    assert mixing.curriculum(documents(spark, [])).count() == 0


def test_mixed_follows_the_schedule(spark):
    rows = [(i, "one two three four", s) for i in range(300) for s in "abc"]
    out = [r.source for r in mixing.mixed(documents(spark, rows)).collect()]
    assert len(out) == pytest.approx(1350, abs=3)
    half = len(out) // 2
    early, late = Counter(out[:half]), Counter(out[half:])
    assert early["a"] < late["a"] and early["c"] > late["c"] and abs(early["b"] - late["b"]) < 12


def test_arrival_inverts_many_knots(spark):
    knots = ((0.0, 0.0), (0.25, 2.0), (0.5, 2.0), (1.0, 0.5))
    t = np.linspace(0, 1, 4001)
    w = np.interp(t, *zip(*knots))
    done = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2 * np.diff(t))])
    shares = [0.0, 0.01, 0.2, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(s, 0) for s in shares], "y double, k int")
    got = [r[0] for r in df.select(mixing.arrival(df.y, df.k, (knots,))).collect()]
    assert got == pytest.approx(list(np.interp(np.array(shares) * done[-1], done, t)), abs=1e-3)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_twins_agree(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    theirs = con.execute(ORACLE_SQL[name]).to_arrow_table()
    mine = QUERIES[name](spark, SF).toArrow()
    assert sorted(mine.column_names) == sorted(theirs.column_names)
    assert rows_of(mine) == rows_of(theirs)


def test_pipeline_stages_keep_columns_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10_000, None, None, None, None), (10_001, "", "en", "src0", 0), (None, "the of and", "en", None, 9)],
                                docs.schema)
    frame = docs.unionByName(odd).unionByName(docs.filter("doc_id = 1"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == docs.columns, name
        frame = spark.createDataFrame(frame.toArrow())
        assert frame.count() > 100
    last = corpus_pipeline.STAGES[-1][1](spark, frame, SF)
    assert last.count() == frame.count() and last.filter("not lossless").count() == 0


def test_pipeline_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
