"""The Merkle manifest against a tree built level by level in plain Python."""

import zlib
from hashlib import sha256

import pytest

from slatecast.llm import merkle

COLUMNS = "text string, doc_id long, n_chars long, source string, lang string, grp string, pos int, digest string, `a.b` int"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Levels of runs of three, and every leaf's siblings level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i:i + 3]) for i in range(0, len(last), 3)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            run = level[i // 3 * 3:i // 3 * 3 + 3]
            path.append((run[:i % 3], run[i % 3 + 1:]))
            i //= 3
        paths.append(path)
    return levels[-1][0], paths


def expected(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row["source"], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for name in names:
        members = sorted(sources[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        made.append((members, *tree([leaf(r, r["text"]) for r in members])))
    if not made:
        return []
    root, tops = tree([m[1] for m in made])
    out = []
    for (members, subroot, paths), top in zip(made, tops):
        for row, path in zip(members, paths):
            whole = path + top
            even = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0
            text = row["text"].replace("\n", "") if even and row["text"] is not None else row["text"]
            value = leaf(row, text)
            for left, right in whole:
                value = H(*left, value, *right)
            out.append((row["doc_id"], leaf(row, row["text"]), subroot, root,
                        H(*(s for left, right in whole for s in left + right)), value, value == root))
    return sorted(out, key=str)


def check(spark, rows, **options):
    frame = spark.createDataFrame([(r["text"], r["doc_id"], r["n_chars"], r["source"], r["lang"], "g", 1, "d", 2)
                                   for r in rows], COLUMNS)
    got = merkle.manifest(frame, **options)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def document(i, text="some\nwords", source="s", **more):
    return {"doc_id": i, "text": text, "source": source, "lang": "en", "n_chars": len(text or ""), **more}


@pytest.mark.parametrize("height", [1, 2, 5])
def test_manifest_against_plain_tree(spark, height):
    rows = [document(i, f"text {i}\nend", ("a", "a", "b", None, "é", "")[i % 6] if i < 60 else "a") for i in range(130)]
    rows += [document(500, None, "lone"), document(None, "x"), document(None, "x"), document(7, "", None, lang=None),
             document(8, "long\n" * 50_000, "c"), document(9, "a", "c", n_chars=None)]
    rows += [document(3, "same\nrow", "a")] * 12 + [document(3, "other", "a")]
    check(spark, rows, height=height)


def test_small_tables(spark):
    check(spark, [])
    check(spark, [document(1)])
    check(spark, [document(1), document(2)])
    check(spark, [document(i, source=f"s{i}") for i in range(11)], height=1)
    check(spark, [document(i, source="one") for i in range(28)], height=1)


def test_queue_holds_open_runs_only():
    """The heap of a sweep stays within arity x height messages."""
    most = 0
    push = merkle.heapq.heappush

    class Counted:
        heappop = staticmethod(merkle.heapq.heappop)

        @staticmethod
        def heappush(queue, item):
            nonlocal most
            push(queue, item)
            most = max(most, len(queue))

    merkle.heapq, kept = Counted, merkle.heapq
    try:
        merkle.Subtree(0, ["d"] * 3 ** 7, 3 ** 7, 3, 7)
    finally:
        merkle.heapq = kept
    assert most <= 3 * 7
