"""Approximate search for the largest inner products by an adaptive dimension scan.

Rows lie in lists: the nearest centroid of their direction (spherical k-means on
a bounded sample, see ``SAMPLE``), cut by the power of two of their length. In a
task a list stands as unit vectors, rotated by a random orthogonal matrix, in
blocks of columns. A query scans a block at a time: partial distances to all
that is left estimate the whole ones, and a candidate is abandoned when, at
``epsilon`` standard errors, its distance can't be below what the query's k-th
best score asks of its length. Survivors of all blocks are scored exactly on the
original vectors.

Which lists a query probes follows from a model of each list (size, mean and
variance of its members' cosine to the centroid): it gives the score that about
k rows should exceed, and the rows of each list that should exceed it. Lists are
probed, best first, up to ``target`` of that expected number. The first
``HOME_ROWS`` rows are scanned ahead, so that every later scan starts from a
k-th best score.

Lists are cut into, or packed together on, shelves of about equal size; a shelf
and the queries that probe it meet in one task, many queries in several. Equal
vectors are one class, whose k + 1 least ids are all that a result can need, so
a vector with very many copies is scanned once.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without a vec_id; vectors of unlike lengths
never meet (lengths that the sample lacks are one list together); rows that
repeat a vec_id are one vector (the least of them); ties go to the smaller
vec_id; products that overflow are infinite, and a sum of opposite infinities
comes last; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from slatecast.llm.common import runs, store
from slatecast.llm.lattice import finite

K, EVERY, SEED = 20, 20, 20241130
#: Rows and vector components that the centroids are fitted on at most.
SAMPLE, SAMPLE_VALUES = 16_384, 1 << 21
#: Share of the expected hits that the probed lists hold; standard errors of the abandonment test.
TARGET, EPSILON = 0.97, 2.1
BLOCK = 16
HOME_ROWS, TILE, SHELF, CHUNK = 1024, 1024, 4096, 2048
SHELLS = 8


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions, and binary logarithms of the lengths; safe for very large and very small components."""
    most = np.abs(x).max(1)
    # by powers of two, so that components near the least number lose nothing twice
    scaled = np.ldexp(x, -np.frexp(most)[1][:, None])
    length = np.sqrt((scaled ** 2).sum(1))
    return scaled / length[:, None], np.log2(length) + np.frexp(most)[1]


def rotation(width: int, seed: int = SEED) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng([seed, width]).normal(size=(width, width)))[0]


def _upper_tail(z: np.ndarray) -> np.ndarray:
    """Share of a normal distribution above z (error below 1e-7)."""
    a = np.abs(np.clip(z, -37, 37))
    t = 1 / (1 + 0.2316419 * a)
    # fixed values: a published polynomial for the normal tail
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = poly * np.exp(-a * a / 2) / math.sqrt(2 * math.pi)
    return np.where(z >= 0, tail, 1 - tail)


class Lists:
    """Centroids by vector length, and, once rows are assigned, the lists with their shelves."""

    def __init__(self, sample: list[list[float]], n: int, seed: int = SEED):
        by_length: dict[int, list] = {}
        for v in sample:
            by_length.setdefault(len(v), []).append(v)
        self.centroids: dict[int, np.ndarray] = {}
        self.base = 0.0
        lengths = []
        for width, rows in sorted(by_length.items()):
            x, log = unit(np.array(rows, float))
            lengths.append(log)
            count = max(1, min(round(math.sqrt(n * len(x) / len(sample))), len(x) // 8))
            self.centroids[width] = self._fit(x, count, seed)
        if lengths:
            self.base = float(np.median(np.concatenate(lengths)))

    @staticmethod
    def _fit(x: np.ndarray, count: int, seed: int, rounds: int = 10) -> np.ndarray:
        centres = x[np.random.default_rng(seed).permutation(len(x))[:count]].copy()
        for _ in range(rounds):
            near = (x @ centres.T).argmax(1)
            sums = np.zeros_like(centres)
            np.add.at(sums, near, x)
            size = np.linalg.norm(sums, axis=1)
            centres[size > 1e-9] = sums[size > 1e-9] / size[size > 1e-9][:, None]
        # neighbours in this order share shelves
        return centres[np.argsort(centres @ np.linalg.svd(centres, full_matrices=False)[2][0], kind="stable")]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(centroid, shell, cosine, log length) of rows of one length; centroid -1 where the sample had none."""
        direction, log = unit(x)
        if x.shape[1] not in self.centroids:
            return np.full(len(x), -1), np.zeros(len(x), int), np.zeros(len(x)), log
        near = direction @ self.centroids[x.shape[1]].T
        best = near.argmax(1)
        shell = np.clip(np.rint(log - self.base), -SHELLS, SHELLS - 1).astype(int)
        return best, shell, near[np.arange(len(x)), best], log

    def shelve(self, stats: list, shelf: int) -> None:
        """``stats``: (width, centroid, shell, size, log length, mean cosine, mean square) of every list."""
        self.of: dict[tuple, int] = {}
        self.table: dict[int, dict[str, np.ndarray]] = {}
        first, blocks, at, room = [], [], -1, 0
        stats = sorted(stats)
        for k, (width, centroid, shell, size, *_) in enumerate(stats):
            self.of[width, centroid, shell] = k
            if size > room:
                at, room = at + 1, shelf
            need = max(1, -(-size // shelf))
            first.append(at)
            blocks.append(need)
            at, room = (at, room - size) if need == 1 else (at + need - 1, 0)
        self.first, self.blocks = np.array(first, np.int64), np.array(blocks, np.int64)
        for width in self.centroids:
            rows = [(k, s) for k, s in enumerate(stats) if s[0] == width]
            column = {name: np.array([s[c] for _, s in rows], float)
                      for c, name in ((3, "size"), (4, "log"), (5, "mean"), (6, "square"))}
            column |= {"number": np.array([k for k, _ in rows], int), "centroid": np.array([s[1] for _, s in rows], int)}
            self.table[width] = column

    def probes(self, x: np.ndarray, k: int, target: float, home: int) -> list[tuple[np.ndarray, int]]:
        """(lists to probe, best first; how many of them are scanned ahead) of queries of one length."""
        width = x.shape[1]
        if width not in self.centroids:
            return [(np.array([self.of[0, -1, 0]]), 1)] * len(x)
        t = self.table[width]
        along = (unit(x)[0] @ self.centroids[width].T)[:, t["centroid"]]
        spread = np.maximum(t["square"] - t["mean"] ** 2, 0)
        across = np.maximum(1 - t["square"], 0) / max(1, width - 1)
        longest = np.exp2(np.clip(t["log"] - self.base, -900, 900))
        middle = along * t["mean"] * longest
        sigma = np.sqrt(along ** 2 * spread + (1 - np.minimum(along ** 2, 1)) * across + 1e-12) * longest
        low, high = (middle - 40 * sigma).min(1), (middle + 40 * sigma).max(1)
        for _ in range(40):     # the score that k rows should exceed
            level = (low + high) / 2
            many = (t["size"] * _upper_tail((level[:, None] - middle) / sigma)).sum(1) > k
            low, high = np.where(many, level, low), np.where(many, high, level)
        hits = t["size"] * _upper_tail((low[:, None] - middle) / sigma)
        out = []
        for mine in hits:
            order = np.argsort(-mine, kind="stable")
            ahead = int(np.searchsorted(np.cumsum(t["size"][order]), home)) + 1
            share = np.cumsum(mine[order])
            probed = int(np.searchsorted(share, target * share[-1])) + 1
            ahead = min(ahead, len(order))
            out.append((t["number"][order[:max(probed, ahead)]], ahead))
        return out


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of the binary vectors of a column."""
    data = column.to_pylist()
    lengths = np.array([len(v) for v in data]) // 8
    for width in np.unique(lengths):
        at = np.flatnonzero(lengths == width)
        yield at, np.frombuffer(b"".join(data[i] for i in at), np.float64).reshape(len(at), width)


def scan(queries: np.ndarray, wanted: list[np.ndarray], bounds: np.ndarray, rows: np.ndarray, lists: np.ndarray,
         keys: np.ndarray, k: int, epsilon: float = EPSILON) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, keys, scores) of up to k rows not below the query's bound, found in its wanted lists.

    ``lists`` and ``keys`` are the rows' list numbers and ids.
    """
    width = rows.shape[1]
    turn = rotation(width)
    order = np.argsort(lists, kind="stable")
    rows, lists, keys = rows[order], lists[order], keys[order]
    names, starts = np.unique(lists, return_index=True)
    span = dict(zip(names.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(lists)])))
    direction, log = unit(rows)
    columns = np.ascontiguousarray((direction @ turn).T)
    with np.errstate(over="ignore"):
        lengths = np.exp2(log)
    ends = [*range(BLOCK, width, BLOCK), width]
    head = np.stack([(columns[:end] ** 2).sum(0) for end in ends])
    q_direction, q_log = unit(queries)
    rotated = q_direction @ turn
    q_head = np.stack([(rotated[:, :end] ** 2).sum(1) for end in ends])
    for i, mine in enumerate(wanted):
        pieces = [span[x] for x in mine if x in span]
        if not pieces:
            continue
        there = np.concatenate([np.arange(a, b) for a, b in pieces])
        best_key, best_score, bound = np.zeros(0, np.int64), np.zeros(0), bounds[i]
        for at in range(0, len(there), TILE):
            j = there[at:at + TILE]
            if bound > -math.inf:
                with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                    # the cosine that would reach the bound
                    need = bound / lengths[j] * np.exp2(-q_log[i])
                need[~np.isfinite(need)] = -math.inf
                alive = need <= 1 + 1e-9
                j, need = j[alive], need[alive]
                partial, start = np.zeros(len(j)), 0
                for b, end in enumerate(ends):
                    partial = partial + rotated[i, start:end] @ columns[start:end, j]
                    if end < width:
                        far = (q_head[b, i] + head[b, j] - 2 * partial) * (width / end)
                        alive = far <= (2 - 2 * need) * (1 + epsilon / math.sqrt(end)) ** 2
                    else:
                        alive = partial >= need - 1e-9
                    j, need, partial, start = j[alive], need[alive], partial[alive], end
            if not len(j):
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                # in the order of the components, so that equal vectors have equal scores
                score = np.cumsum(rows[j] * queries[i], axis=1)[:, -1]
            score[np.isnan(score)] = -math.inf
            score, key = np.concatenate([best_score, score]), np.concatenate([best_key, keys[j]])
            top = np.lexsort((key, -score))[:k]
            best_score, best_key = score[top], key[top]
            if len(top) == k:
                bound = max(bound, best_score[-1])
        good = best_score >= bounds[i]
        if good.any():
            yield i, best_key[good], best_score[good]


def _meet(probes: DataFrame, queries: DataFrame, members: DataFrame, lists: Lists, k: int, epsilon: float,
          chunk: int) -> DataFrame:
    """(asker, uid, score) of the best rows on each shelf that a query probes."""
    counts = probes.groupBy("shelf").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    counts = store(counts, "shelves")
    left = probes.join(queries, "uid").join(counts, "shelf").select(
        "shelf", F.pmod(F.xxhash64("uid"), F.col("chunks")).cast("int").alias("chunk"), "uid", "x",
        F.lit(-1).alias("list"), "lists", "bound")
    right = members.join(counts, "shelf").select(
        "shelf", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "uid", "x", "list",
        F.lit(None).cast("array<int>").alias("lists"), F.lit(None).cast("double").alias("bound"))
    cells = left.unionByName(right).repartition("shelf", "chunk").sortWithinPartitions("shelf", "chunk")

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(parts, 2):
            cell = cell.combine_chunks()
            number = cell.column("list").to_numpy()
            uid = cell.column("uid").to_numpy()
            asks, stands = np.flatnonzero(number < 0), np.flatnonzero(number >= 0)
            if not len(asks) or not len(stands):
                continue
            data = cell.column("x").combine_chunks()
            rows = {x.shape[1]: (at, x) for at, x in _matrices(data.take(pa.array(stands)))}
            wanted = cell.column("lists").combine_chunks().take(pa.array(asks)).to_pylist()
            bound = cell.column("bound").to_numpy()[asks]
            out = []
            for at, queries in _matrices(data.take(pa.array(asks))):
                if queries.shape[1] not in rows:
                    continue
                theirs, x = rows[queries.shape[1]]
                theirs = stands[theirs]
                out += [(np.full(len(keys), uid[asks[at[i]]]), keys, score) for i, keys, score in scan(
                    queries, [wanted[a] for a in at], bound[at], x, number[theirs], uid[theirs], k, epsilon)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                                 names=["asker", "uid", "score"])

    return cells.mapInArrow(search, "asker long, uid long, score double")


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, vector: str = "embedding", vec_id: str = "vec_id",
            target: float = TARGET, epsilon: float = EPSILON, home: int = HOME_ROWS, shelf: int = SHELF,
            chunk: int = CHUNK, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score): rows of large inner product with each row whose vec_id ``every`` divides."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                          F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & finite(F.col("vector")))
    named = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    named = store(named.withColumn("h", F.xxhash64("vector")), "vectors")

    same = W.partitionBy("h", "vector").orderBy("vec_id")
    few = named.withColumn("place", F.row_number().over(same)).filter(F.col("place") <= k + 1)
    classes = store(few.groupBy("h", "vector").agg(F.min("vec_id").alias("uid"),
                                                   F.sort_array(F.collect_list("vec_id")).alias("ids")), "classes")
    asked = named.filter(F.col("vec_id") % every == 0).join(classes.select("h", "vector", "uid"), ["h", "vector"])
    asked = store(asked.select(F.col("vec_id").alias("query_id"), F.col("uid").alias("asker")), "asked")

    n, width = classes.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(1))).first()
    some = classes.orderBy(F.xxhash64("uid"), "uid").limit(max(1, min(sample, SAMPLE_VALUES // width)))
    lists = Lists([row.vector for row in some.select("vector").collect()], n)
    # a task holds a shelf and a chunk of queries: 32 MB of each at most
    shelf, chunk = (max(16, min(size, (1 << 22) // width)) for size in (shelf, chunk))

    def assigned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            vectors = part.column(1)
            lengths = np.asarray(vectors.value_lengths())
            for each in np.unique(lengths):
                at = pa.array(np.flatnonzero(lengths == each))
                x = np.asarray(vectors.take(at).flatten(), np.float64).reshape(len(at), each)
                centroid, shell, cosine, log = lists.assign(x)
                known = each if each in lists.centroids else 0
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), pa.array([v.tobytes() for v in x], pa.binary()),
                     pa.array(np.full(len(at), known, np.int32)), pa.array(centroid.astype(np.int32)),
                     pa.array(shell.astype(np.int32)), pa.array(cosine), pa.array(log)],
                    names=["uid", "x", "width", "centroid", "shell", "cosine", "log"])

    members = store(classes.select("uid", "vector").mapInArrow(
        assigned, "uid long, x binary, width int, centroid int, shell int, cosine double, log double"), "members")
    # one row per list: at most sample / 8 centroids by 16 shells, and one list of other lengths
    stats = members.groupBy("width", "centroid", "shell").agg(
        F.count("*").alias("size"), F.max("log").alias("log"), F.avg("cosine").alias("mean"),
        F.avg(F.col("cosine") ** 2).alias("square")).collect()
    lists.shelve([tuple(row) for row in stats], shelf)

    def placed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            number = np.array([lists.of[key] for key in zip(*(part.column(c).to_pylist() for c in (2, 3, 4)))], np.int64)
            block = part.column(5).to_numpy() % lists.blocks[number] if len(number) else number
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(number.astype(np.int32)), pa.array(lists.first[number] + block)],
                names=["uid", "x", "list", "shelf"])

    def probing(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for cut in range(0, whole.num_rows, 500):
                part = whole.slice(cut, 500)
                uid = part.column(0).to_numpy()
                for at, x in _matrices(part.column(1)):
                    out: dict[str, list] = {"uid": [], "shelf": [], "home": [], "lists": []}
                    for i, (found, ahead) in zip(at, lists.probes(x, k, target, home)):
                        for first, chosen in ((True, found[:ahead]), (False, found[ahead:])):
                            on: dict[int, list[int]] = {}
                            for one in chosen.tolist():
                                for block in range(lists.blocks[one]):
                                    on.setdefault(int(lists.first[one]) + block, []).append(one)
                            for where, these in on.items():
                                for name, value in zip(out, (uid[i], where, first, these)):
                                    out[name].append(value)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out["uid"], pa.int64()), pa.array(out["shelf"], pa.int64()),
                         pa.array(out["home"], pa.bool_()), pa.array(out["lists"], pa.list_(pa.int32()))], names=list(out))

    standing = members.select("uid", "x", "width", "centroid", "shell", F.pmod(F.xxhash64("uid"), F.lit(1 << 40)).alias("h"))
    standing = store(standing.mapInArrow(placed, "uid long, x binary, list int, shelf long"), "standing")
    askers = asked.select(F.col("asker").alias("uid")).distinct()
    queries = store(members.join(askers, "uid").select("uid", "x"), "queries")
    probes = store(queries.mapInArrow(probing, "uid long, shelf long, home boolean, lists array<int>"), "probes")

    none = F.lit(-math.inf).alias("bound")
    ahead = store(_meet(probes.filter("home"), queries.select("*", none), standing, lists, k + 1, epsilon, chunk), "ahead")
    by_score = W.partitionBy("asker").orderBy(F.desc("score"), "uid")
    bounds = ahead.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") == k + 1)
    bounds = queries.join(bounds.select(F.col("asker").alias("uid"), "score"), "uid", "left").select(
        "uid", "x", F.coalesce("score", F.lit(-math.inf)).alias("bound"))
    rest = _meet(probes.filter("not home"), bounds, standing, lists, k + 1, epsilon, chunk)

    found = ahead.unionByName(rest).join(classes.select("uid", "ids"), "uid")
    found = found.select("asker", "score", F.explode("ids").alias("vec_id"))
    place = F.row_number().over(W.partitionBy("asker").orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("place", place).filter(F.col("place") <= k + 1)
    best = best.groupBy("asker").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best"))
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    out = asked.join(best, "asker").select("query_id", F.posexplode(others).alias("rank", "one"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), "one.vec_id", "one.score")
