"""Embedding near-duplicates by lattice hashing.

Each table projects a unit vector to eight dimensions (random normals times
``scale``) and decodes the point to the nearest point of the E8 lattice, its
cell. A vector stands in its own cell and also visits the neighbouring cells
(of the 240 around) that lie nearest to its point, so close pairs split by a
cell wall still meet. Vectors that meet are compared by cosine in double
precision, so no pair below the threshold is ever linked.

A pair is only counted in the first table where it meets, which a task decides
by decoding the vectors of its linked pairs again; so links are counted without
gathering pairs. Equal vectors are one class with a number of copies. Cells of
any size are cut into blocks of standing and visiting rows, every block of one
against every block of the other, and no task holds more than one of each.

Recall of pairs with cosine exactly at 0.9 is about 0.98 with the defaults, and
higher for closer ones (the tests measure it).

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, and so do vectors of unlike lengths; rows that
repeat a vec_id are one vector (the least of them); a row without a vec_id has
no links and no component; an empty table gives an empty result; other columns
are not read, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecast.llm.common import store
from slatecast.llm.components import components

TABLES, NEIGHBOURS, SCALE, SEED = 7, 4, 0.6, 20240601
STANDING_BLOCK, VISITING_BLOCK = 2048, 8192


def finite(vector: Column) -> Column:
    """Whether a vector takes part: not empty, all components there and finite, not all zero."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & ok & F.exists(vector, lambda x: x != 0), F.lit(False))


def minimal_vectors() -> np.ndarray:
    """The 240 shortest points of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two of about their largest component: exact, and squares stay finite."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    f = np.rint(y)
    odd = np.flatnonzero(f.sum(1).astype(np.int64) & 1)
    error = y[odd] - f[odd]
    k = np.abs(error).argmax(1)
    f[odd, k] += np.where(error[np.arange(len(odd)), k] >= 0, 1.0, -1.0)
    return f


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The nearest point of D8 or of D8 moved by one half."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    nearer = ((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1)
    return np.where(nearer[:, None], a, b)


class Lattice:
    def __init__(self, tables: int, neighbours: int, scale: float, seed: int):
        self.tables, self.neighbours, self.scale, self.seed = tables, neighbours, scale, seed
        self.around = minimal_vectors()
        self.mixer = np.random.default_rng(seed).integers(1, 1 << 62, 8, dtype=np.int64) | 1
        self.planes: dict[int, np.ndarray] = {}

    def cells(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + neighbours) cell keys; the first of each table is the own cell."""
        d = x.shape[1]
        if d not in self.planes:
            rng = np.random.default_rng([self.seed, d])
            self.planes[d] = rng.normal(size=(self.tables, d, 8)) * self.scale
        unit = scaled(x)
        unit = unit / np.sqrt((unit ** 2).cumsum(1)[:, -1:])
        # summed in the order of the components: a vector has the same cells in whatever batch it stands
        points_at = np.zeros((len(x), self.tables * 8))
        planes = self.planes[d].transpose(1, 0, 2).reshape(d, -1)
        for k in range(d):
            points_at += unit[:, k:k + 1] * planes[k]
        out = np.empty((len(x), self.tables, 1 + self.neighbours), np.int64)
        length = d * int(self.mixer[0]) & ((1 << 62) - 1)
        for t in range(self.tables):
            y = points_at[:, 8 * t:8 * t + 8]
            own = nearest_e8(y)
            off = y - own
            gain = sum(off[:, k:k + 1] * self.around[None, :, k] for k in range(8))
            best = np.argpartition(-gain, self.neighbours - 1, axis=1)[:, :self.neighbours]
            points = np.concatenate([own[:, None], own[:, None] + self.around[best]], axis=1)
            codes = (np.rint(points * 2).astype(np.int64) * self.mixer).sum(-1) + length
            codes = (codes ^ (codes >> 29)) & ((1 << 50) - 1)
            out[:, t] = codes * 1024 + t * 64 % 1024 + d % 64     # the whole length is in codes
        return out


def _matrices(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each length of vector in a batch."""
    lengths = np.asarray(lists.value_lengths())
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        picked = lists.take(pa.array(rows)).flatten()
        yield rows, np.asarray(picked).astype(np.float64).reshape(len(rows), d)


def _flatten(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least label of each component of the pairs (i, j)."""
    while True:
        low = np.minimum(labels[i], labels[j])
        before = labels.copy()
        np.minimum.at(labels, i, low)
        np.minimum.at(labels, j, low)
        if (labels == before).all():
            return labels


def _links(uid, copies, x, role, lattice: Lattice, threshold: float, table: int):
    """Links of one block pair: (uid, linked vectors, least uid of its local component)."""
    norm = np.linalg.norm(x, axis=1)
    stand, visit = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    found_i, found_j = [], []
    for at in range(0, len(stand), 512):
        rows = stand[at:at + 512]
        cosine = (x[rows] @ x[visit].T) / (norm[rows][:, None] * norm[visit][None, :])
        i, j = np.nonzero((cosine >= threshold) & (uid[rows][:, None] < uid[visit][None, :]))
        found_i.append(rows[i])
        found_j.append(visit[j])
    i, j = np.concatenate(found_i), np.concatenate(found_j)
    if not len(i):
        return None
    linked = np.unique(np.concatenate([i, j]))
    if table:
        cells = lattice.cells(x[linked])
        pi, pj = np.searchsorted(linked, i), np.searchsorted(linked, j)
        first = np.ones(len(i), bool)
        for at in range(0, len(i), 100_000):
            part = slice(at, at + 100_000)
            met = cells[pi[part], :table, :1] == cells[pj[part], :table]
            first[part] = ~met.any((1, 2))
        i, j = i[first], j[first]
        if not len(i):
            return None
    n = np.zeros(len(uid), np.int64)
    np.add.at(n, i, copies[j])
    np.add.at(n, j, copies[i])
    labels = _flatten(np.arange(len(uid)), i, j)   # rows are in order of uid
    touched = np.flatnonzero(n)
    return uid[touched], n[touched], uid[labels[touched]]


def link_vectors(classes: DataFrame, threshold: float = 0.9, tables: int = TABLES, neighbours: int = NEIGHBOURS,
                 scale: float = SCALE, seed: int = SEED, standing: int = STANDING_BLOCK,
                 visiting: int = VISITING_BLOCK) -> DataFrame:
    """(uid, n, near): partial link counts of classes (uid, vector array<double>, copies).

    ``near`` is the least uid of the linked vectors met at the same place; the
    sum of n over a uid is its number of links.
    """
    lattice = Lattice(tables, neighbours, scale, seed)

    def coded(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for at in range(0, whole.num_rows, 1000):
                part = whole.slice(at, 1000)
                for rows, x in _matrices(part.column(1)):
                    cells = lattice.cells(x).reshape(len(rows), -1)
                    each = cells.shape[1]
                    take = pa.array(np.repeat(rows, each))
                    own = np.tile(np.arange(each) % (1 + neighbours) == 0, len(rows))
                    data = pa.array([v.tobytes() for v in x], pa.binary()).take(
                        pa.array(np.repeat(np.arange(len(rows)), each)))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(take), data, part.column(2).take(take), pa.array(cells.ravel()),
                         pa.array(own)], names=["uid", "x", "copies", "cell", "own"])

    rows = classes.select("uid", "vector", "copies").mapInArrow(
        coded, "uid long, x binary, copies long, cell long, own boolean")
    large = rows.groupBy("cell").agg(F.sum(F.col("own").cast("long")).alias("stand"), F.count("*").alias("visit"))
    large = store(large.filter((F.col("stand") > standing) | (F.col("visit") > visiting)), "large-cells")
    rows = rows.join(large, "cell", "left")
    blocks = F.greatest(F.lit(1), F.ceil(F.coalesce("stand", F.lit(1)) / standing)).cast("int")
    rounds = F.greatest(F.lit(1), F.ceil(F.coalesce("visit", F.lit(1)) / visiting)).cast("int")
    placed = rows.select("uid", "x", "copies", "cell", "own", blocks.alias("bs"), rounds.alias("vs"))
    placed = placed.withColumns({"s": F.pmod(F.xxhash64("uid"), "bs").cast("int"),
                                 "v": F.pmod(F.xxhash64("uid", F.lit(7)), "vs").cast("int")})
    spots = F.expr("""
        concat(if(own, transform(sequence(0, vs - 1), i -> struct(s as s, i as v, if(i = v, 3, 1) as role)),
                  array()),
               transform(filter(sequence(0, bs - 1), j -> not own or j <> s), j -> struct(j as s, v as v, 2 as role)))
        """)
    placed = placed.select("cell", "uid", "copies", "x", F.explode(spots).alias("spot"))
    placed = placed.select("cell", "spot.s", "spot.v", "uid", "copies", "x", "spot.role")
    placed = placed.repartition("cell", "s", "v").sortWithinPartitions("cell", "s", "v", "uid")

    def compared(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done():
            whole = pa.Table.from_batches(held).combine_chunks()
            keys = [whole.column(k).to_numpy() for k in ("cell", "s", "v")]
            uid, copies, role = (whole.column(k).to_numpy() for k in ("uid", "copies", "role"))
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            edges = np.concatenate([[0], change, [len(uid)]])
            out = []
            for a, b in zip(edges, edges[1:]):
                if b - a < 2 or not (role[a:b] & 1).any():
                    continue
                data = whole.column("x").slice(a, b - a).to_pylist()
                lengths = np.array([len(v) for v in data])
                # keys of unlike lengths may still be equal by chance, so each length is compared by itself
                for length in np.unique(lengths):
                    at = np.flatnonzero(lengths == length)
                    # something to compare: a visitor besides the one that stands here
                    if len(at) < 2 or not (role[a:b][at] & 1).any():
                        continue
                    x = scaled(np.frombuffer(b"".join(data[k] for k in at), np.float64).reshape(len(at), -1))
                    got = _links(uid[a:b][at], copies[a:b][at], x, role[a:b][at], lattice, threshold,
                                 int(keys[0][a] % 1024) // 64)
                    if got:
                        out.append(got)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[k] for o in out])) for k in range(3)],
                                                 names=["uid", "n", "near"])

        for part in parts:
            # blocks never end inside what is worked on: the last block waits for the next batch
            cells = [part.column(k).to_numpy() for k in range(3)]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in cells], axis=0)) + 1
            first_same = bool(held) and all(held[-1].column(k)[-1].as_py() == part.column(k)[0].as_py()
                                            for k in range(3)) if part.num_rows else True
            if not part.num_rows:
                continue
            if held and not first_same:
                yield from done()
                held = []
            if len(change):
                held.append(part.slice(0, change[-1]))
                yield from done()
                held = [part.slice(change[-1])]
            else:
                held.append(part)
        if held:
            yield from done()

    return placed.mapInArrow(compared, "uid long, n long, near long")


def embedding_groups(vectors: DataFrame, threshold: float = 0.9, vector: str = "embedding", vec_id: str = "vec_id",
                     **options) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept)."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    named = store(rows.filter("vec_id is not null").groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    good = named.filter(finite(F.col("vector")))
    classes = store(good.groupBy("vector").agg(F.min("vec_id").alias("uid"), F.count("*").alias("copies")), "classes")
    partial = store(link_vectors(classes, threshold, **options), "vector-links")
    counts = partial.groupBy("uid").agg(F.sum("n").alias("n"))
    roots = components(partial.filter("uid <> near"), "uid", "near")
    known = classes.join(counts, "uid", "left").join(roots.withColumnRenamed("node", "uid"), "uid", "left")
    known = known.select("vector", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                         F.coalesce("root", "uid").alias("root"))
    out = named.join(known, "vector", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"))
    out = out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    nameless = rows.filter("vec_id is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("component_id"),
        F.lit(True).alias("kept"))
    return out.unionByName(nameless)
