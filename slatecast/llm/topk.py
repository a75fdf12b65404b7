"""Exact top-k search by columnar branch and bound.

Vectors become whole numbers, floor(scale * x), and scores are integer inner
products. Queries meet candidates in cells, a bounded number of queries against
a bounded number of rows; a row goes to each cell of its candidate part, a
query to each cell of its query group. In a cell, candidates lie vertically (a
matrix row for each dimension). Scores are built up block of dimensions by
block; what the remaining dimensions can still add is at most the product of
the remaining lengths of query and candidate (Cauchy-Schwarz), and candidates
that cannot reach the query's k-th best score any more are dropped and the rest
compacted. Bounds only ever drop what is provably outside, so results are exact.

Defined cases: null vectors and vectors with null or non-finite components take
no part, and neither do rows without a vec_id; missing dimensions count as 0; a
query never gets rows with its own vec_id; repeated query rows are one query
(its least vector), repeated candidate rows are separate candidates. Components
so large that sums could pass 2^53 are multiplied as unbounded integers, and
scores outside the range of a long are held at its ends. An empty table gives an
empty result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

QUERIES_IN_CELL, ROWS_IN_CELL = 4096, 16384
DIMENSIONS, TILE_QUERIES, TILE_ROWS = 16, 256, 4096
EXACT = float(1 << 52)


def _whole(lists: list, width: int, scale: float) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return np.floor(out * scale)


class Best:
    """The k best (score, vec_id) of each query of a cell, ties to the smaller vec_id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.query, self.score, self.vec = (np.empty(0, np.int64) for _ in range(3))
        self.level = np.full(n, -np.inf)

    def add(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        query, score, vec = (np.concatenate(p) for p in ((self.query, query), (self.score, score), (self.vec, vec)))
        order = np.lexsort((vec, -score, query))
        query, score, vec = query[order], score[order], vec[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.k
        self.query, self.score, self.vec = query[keep], score[keep], vec[keep]
        full = rank == self.k - 1
        self.level[query[full]] = score[full]


def _offer(best: Best, at: int, q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray) -> None:
    """A tile of queries (rows) against a tile of candidates (columns of the vertical ``x``)."""
    width = len(x)
    # lengths that remain after each block
    rest_q = np.sqrt(np.maximum(0, (q ** 2)[:, ::-1].cumsum(1)[:, ::-1]))
    rest_x = np.sqrt(np.maximum(0, (x ** 2)[::-1].cumsum(0)[::-1]))
    level = best.level[at:at + len(q)]
    partial = np.zeros((len(q), x.shape[1]))
    i = j = score = None
    for start in range(0, width, DIMENSIONS):
        dims = slice(start, start + DIMENSIONS)
        if i is None:
            partial += q[:, dims] @ x[dims]
        else:
            score = score + np.einsum("ij,ji->i", q[i, dims], x[dims][:, j])
        end = start + DIMENSIONS
        more_q = rest_q[:, end] if end < width else np.zeros(len(q))
        more_x = rest_x[end] if end < width else np.zeros(x.shape[1])
        if i is None:
            alive = partial + more_q[:, None] * more_x[None, :] * (1 + 1e-9) >= level[:, None]
            if end >= width or alive.mean() < 0.1:
                i, j = np.nonzero(alive)
                score = partial[i, j]
        else:
            alive = score + more_q[i] * more_x[j] * (1 + 1e-9) >= level[i]
            i, j, score = i[alive], j[alive], score[alive]
    other = q_ids[i] != x_ids[j]
    i, j, score = i[other], j[other], score[other]
    # of many candidates for one query only the k best can matter
    best.add(at + i, score.astype(np.int64), x_ids[j])


def _offer_large(best: Best, at: int, q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray) -> None:
    integers = np.vectorize(int, otypes=[object])
    products = integers(q) @ integers(x)
    score = np.vectorize(lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1), otypes=[np.int64])(products)
    i, j = np.nonzero(q_ids[:, None] != x_ids[None, :])
    best.add(at + i, score[i, j], x_ids[j])


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, vector: str = "embedding",
          vec_id: str = "vec_id", queries_in_cell: int = QUERIES_IN_CELL, rows_in_cell: int = ROWS_IN_CELL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each query, a row whose vec_id ``every`` divides."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                          F.col(vector).cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & sound)
    chosen = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n, n_queries, width = rows.agg(F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1)),
                                   F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    groups, parts = max(1, -(-n_queries // queries_in_cell)), max(1, -(-n // rows_in_cell))

    def numbers(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    # queries in blocks against all rows: every query visits every part, every row every group
    spread = chosen.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int").alias("g"), numbers(parts).alias("p"),
        F.lit(0).alias("side"), "vec_id", "vector").unionByName(rows.select(
            numbers(groups).alias("g"), F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts)).cast("int").alias("p"),
            F.lit(1).alias("side"), "vec_id", "vector"))
    cells = spread.repartition("g", "p").sortWithinPartitions("g", "p", "side", "vec_id")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, best = None, None
        q_lists, q_ids, q = [], [], None

        def result():
            if best is not None and len(best.query):
                ids = np.array(q_ids, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[best.query]), pa.array(best.vec), pa.array(best.score)],
                    names=["query_id", "vec_id", "score"])

        for batch in batches:
            g, p, side = (batch.column(c).to_numpy() for c in range(3))
            cut = np.flatnonzero((g[1:] != g[:-1]) | (p[1:] != p[:-1]) | (side[1:] != side[:-1])) + 1
            for a, b in zip([0, *cut], [*cut, batch.num_rows]):
                if a == b:
                    continue
                if cell != (g[a], p[a]):
                    yield from result()
                    cell, best, q_lists, q_ids, q = (g[a], p[a]), None, [], [], None
                ids, lists = batch.column(3).slice(a, b - a).to_pylist(), batch.column(4).slice(a, b - a).to_pylist()
                if side[a] == 0:
                    q_ids += ids
                    q_lists += lists
                    continue
                if not q_ids:
                    continue
                if q is None:
                    q, best, keys = _whole(q_lists, width, scale), Best(len(q_ids), k), np.array(q_ids, np.int64)
                    q_lists = []
                x, x_ids = _whole(lists, width, scale).T.copy(), np.array(ids, np.int64)
                safe = max(np.abs(q).max(initial=0), 1) * max(np.abs(x).max(initial=0), 1) * max(width, 1) < EXACT
                rows_each, offer = (TILE_ROWS, _offer) if safe else (256, _offer_large)
                for c in range(0, len(ids), rows_each):
                    for r in range(0, len(q), TILE_QUERIES):
                        offer(best, r, q[r:r + TILE_QUERIES], keys[r:r + TILE_QUERIES],
                              x[:, c:c + rows_each], x_ids[c:c + rows_each])
        yield from result()

    found = cells.mapInArrow(search, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
