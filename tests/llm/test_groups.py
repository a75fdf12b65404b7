"""Groups of sorted batches come out whole wherever batches end."""

import random

import pyarrow as pa
import pytest

from slatecast.llm.common import runs
from slatecast.llm.probminhash import _joining_links, shingles, similarity, weighted, WordHashes


@pytest.mark.parametrize("cut", [1, 2, 7, 1000])
def test_runs_are_whole_groups(cut):
    rng = random.Random(cut)
    rows = sorted((rng.randint(0, 6), rng.randint(0, 2), i) for i in range(120))
    table = pa.table({"a": [r[0] for r in rows], "b": [r[1] for r in rows], "x": [r[2] for r in rows]})
    groups = [list(zip(*(c.to_pylist() for c in g.columns))) for g in runs(iter(table.to_batches(cut)), 2)]
    want = {}
    for r in rows:
        want.setdefault(r[:2], []).append(r)
    assert groups == list(want.values())
    assert list(runs(iter([]), 2)) == []


@pytest.mark.parametrize("inside", [True, False])
def test_joining_links_equal_all_pairs(inside):
    rng, hashes, texts = random.Random(5), WordHashes(), []
    for _ in range(12):
        base = [f"w{rng.randint(0, 300)}" for _ in range(80)] + ["same", "words", "again"] * rng.choice([0, 0, 6])
        texts += [[x if rng.random() > rng.choice([0, 0.02, 0.05]) else f"n{rng.randint(0, 99)}" for x in base]
                  for _ in range(5)]
    sets = [shingles(t, hashes) for t in texts]
    n = len(texts)
    roots = [i // 10 * 10 if rng.random() < 0.5 else i for i in range(n)]
    block = [0 if inside else i % 2 for i in range(n)]
    table = pa.table({"s": [0] * n, "v": [0 if inside else 1] * n, "id": list(range(n)), "root": roots, "block": block,
                      "shingles": [e.tobytes() for e, _ in sets],
                      "counts": [c.astype("int32").tobytes() for _, c in sets]})
    found = _joining_links(table, 0.8)

    def joined(pairs):
        label = list(roots)
        for _ in range(n):
            for a, b in pairs:
                low = min(label[a], label[b])
                label = [low if x in (label[a], label[b]) else x for x in label]
        return label

    bags = [weighted(t) for t in texts]
    every = [(a, b) for a in range(n) for b in range(a + 1, n)
             if (inside or block[a] != block[b]) and similarity(bags[a], bags[b]) >= 0.8]
    assert joined(found) == joined(every)
    # a link names the roots of the two similar texts
    linked = {frozenset((roots[a], roots[b])) for a, b in every}
    assert all(frozenset(pair) in linked for pair in found) and len(found) < n
