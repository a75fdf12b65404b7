"""Gradient-boosted trees grown leaf by leaf over binned features.

Rows are binned once and written, their bins packed into one binary value. A
tree grows best first: always the leaf whose split gains most is split next, up
to a number of leaves. What a split needs are sums of gradients, weights and
rows per (leaf, feature, bin) for all leaves whose sums aren't known yet, so a
tree takes about as many jobs as it is deep, not as it has leaves. A task adds
up its rows batch by batch in one array of that shape; what is shuffled and
what comes to the driver are leaves x features x bins numbers at most, whatever
the rows. Missing values are a bin of their own, which every split sends to the
side that gains more. Rows and columns of a round are drawn by hash, so a rerun
draws the same.

A fitted model is a handful of flat arrays. Binned rows walk down the trees
batch by batch; rows of raw columns with higher-order functions over the arrays,
so plans stay small at any number of trees.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slatecast.operators.ranks import quantiles
from slatecast.session import max_group_rows, store

#: Gains are compared after rounding to so many digits; ties go to the first leaf, feature, bin, and missing right.
GAIN_DIGITS = 9
#: Trees added to the stored scores, and judged on the held-out rows, at a time.
WRITE_EVERY = 10
#: Bytes of binned features that one task may hold to grow trees alone.
TASK_BYTES = 100_000_000


@dataclass(frozen=True)
class BoostParams:
    rounds: int = 100
    step: float = 0.1
    leaves: int = 31
    min_rows: int = 20
    l2: float = 0.0
    bins: int = 63
    row_share: float = 1.0
    col_share: float = 1.0
    patience: int | None = None
    min_weight: float = 1e-3
    min_gain: float = 1e-8


def _array(values: Sequence, kind: str) -> str:
    """A constant array as SQL; folded into one literal by the optimizer, so plans stay small."""
    return f"from_json('{json.dumps(list(values))}', 'array<{kind}>')"


@dataclass
class Trees:
    """Nodes of all trees in flat lists; a leaf has feature -1. ``cut`` is the last bin, or value, that goes left."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    depth: int = 0

    def node(self) -> int:
        for column, nothing in ((self.feature, -1), (self.cut, 0.0), (self.left, 0), (self.right, 0),
                                (self.missing_left, False), (self.value, 0.0)):
            column.append(nothing)
        return len(self.feature) - 1

    def add(self, other: "Trees") -> None:
        """Append the trees of another."""
        offset = len(self.feature)
        for mine, more in ((self.feature, other.feature), (self.cut, other.cut),
                           (self.missing_left, other.missing_left), (self.value, other.value)):
            mine += more
        self.left += [k + offset for k in other.left]
        self.right += [k + offset for k in other.right]
        self.roots += [k + offset for k in other.roots]
        self.depth = max(self.depth, other.depth)

    def leaf_of(self, x: str, root: str) -> str:
        """SQL of the node that a row with features ``x`` (an array) ends in, from node ``root``."""
        feature, cut = _array(self.feature, "int"), _array([float(c) for c in self.cut], "double")
        left, right, miss = _array(self.left, "int"), _array(self.right, "int"), _array(self.missing_left, "boolean")
        goes = f"coalesce(get({x}, get({feature}, node)) <= get({cut}, node), get({miss}, node))"
        step = f"if(get({feature}, node) < 0, node, if({goes}, get({left}, node), get({right}, node)))"
        return f"aggregate(sequence(1, {max(1, self.depth)}), int({root}), (node, turn) -> {step})"

    def total(self, x: str, first: int = 0, last: int | None = None) -> str:
        """SQL of the sum of the leaf values over the trees from ``first`` to ``last``."""
        roots = self.roots[first:last]
        if not roots:
            return "0D"
        return (f"aggregate({_array(roots, 'int')}, 0D, "
                f"(done, root) -> done + get({_array(self.value, 'double')}, {self.leaf_of(x, 'root')}))")


@dataclass
class Boosted:
    """A fitted ensemble over raw columns."""

    cols: list[str]
    base: float
    logistic: bool
    trees: Trees

    def raw(self) -> Column:
        x = "array({})".format(", ".join(f"cast(`{c}` as double)" for c in self.cols))
        return F.lit(self.base) + F.expr(self.trees.total(x))

    def score(self, df: DataFrame, out: str) -> DataFrame:
        raw = self.raw()
        return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-raw)) if self.logistic else raw)

    def write(self, spark: SparkSession, path: str) -> None:
        row = [(json.dumps(asdict(self)),)]
        spark.createDataFrame(row, "model string").coalesce(1).write.mode("error").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Boosted":
        read = json.loads(spark.read.schema("model string").json(path).first()["model"])
        return Boosted(read["cols"], read["base"], read["logistic"], Trees(**read["trees"]))


def bin_edges(df: DataFrame, cols: Sequence[str], bins: int) -> list[list[float]]:
    """Upper ends of the bins of each column: its distinct exact quantiles, without the last."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    found = quantiles(long, ["column"], "value", [i / bins for i in range(1, bins)])
    edges = {r["column"]: sorted(set(r["edges"])) for r in found.collect()}      # bins numbers per column
    return [edges.get(c, []) for c in cols]


def bin_width(edges: list[list[float]]) -> int:
    """Bins of the widest column, with one for the missing."""
    return max([len(e) for e in edges], default=0) + 2


def bin_kind(width: int) -> np.dtype:
    """The narrowest type that holds ``width`` bins."""
    return np.min_scalar_type(max(0, width - 1))


def binned(rows: DataFrame, cols: Sequence[str], edges: list[list[float]], width: int) -> DataFrame:
    """``x``: the bin numbers (0 based) of ``cols`` packed into a binary value, in place of them.

    A missing value is in bin ``width - 1``. A value on an edge is in the bin below it.
    """
    names = [f"_x{i}" for i in range(len(cols))]
    others = [f for f in rows.schema if f.name not in cols]
    ends, kind = [np.asarray(e, dtype=np.float64) for e in edges], bin_kind(width)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.empty((batch.num_rows, len(names)), kind)
            for i, name in enumerate(names):
                value = batch.column(name)
                place = np.searchsorted(ends[i], value.to_numpy(zero_copy_only=False).astype(np.float64), "left")
                x[:, i] = np.where(value.is_null().to_numpy(zero_copy_only=False), width - 1, place)
            yield pa.RecordBatch.from_arrays([_packed(x), *[batch.column(f.name) for f in others]],
                                             ["x", *[f.name for f in others]])

    doubles = [F.col(c).cast("double").alias(n) for c, n in zip(cols, names)]
    return rows.select(*doubles, *[f.name for f in others]).mapInArrow(
        pack, ", ".join(["x binary", *[f"{f.name} {f.dataType.simpleString()}" for f in others]]))


def _packed(x: np.ndarray) -> pa.Array:
    """One binary value per row of the matrix."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])


def _unpacked(batch: pa.RecordBatch, features: int, kind: np.dtype) -> np.ndarray:
    """The matrix of a batch's ``x``, which is never NULL."""
    if not batch.num_rows:
        return np.empty((0, features), kind)
    x = batch.column("x").cast(pa.large_binary())
    at = np.frombuffer(x.buffers()[1], np.int64)[x.offset:x.offset + len(x) + 1]
    return np.frombuffer(x.buffers()[2], np.uint8)[at[0]:at[-1]].view(kind).reshape(len(x), features)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


class Walk:
    """Trees over bins as arrays, for the rows of a batch."""

    def __init__(self, trees: Trees, missing: int):
        self.feature, self.cut = np.array(trees.feature, np.int64), np.array(trees.cut, np.float64)
        self.left, self.right = np.array(trees.left, np.int64), np.array(trees.right, np.int64)
        self.missing_left, self.value = np.array(trees.missing_left, bool), np.array(trees.value, np.float64)
        self.missing = missing

    def leaf_of(self, x: np.ndarray, root: int) -> np.ndarray:
        """The node that each row ends in, from node ``root``."""
        at = np.full(len(x), root, np.int64)
        moving = np.arange(len(x)) if self.feature[root] >= 0 else np.empty(0, np.int64)
        while len(moving):
            node = at[moving]
            bins = x[moving, self.feature[node]]
            goes = np.where(bins == self.missing, self.missing_left[node], bins <= self.cut[node])
            node = np.where(goes, self.left[node], self.right[node])
            at[moving] = node
            moving = moving[self.feature[node] >= 0]
        return at

    def total(self, x: np.ndarray, roots: Sequence[int]) -> np.ndarray:
        """Sum of the leaf values over the trees of ``roots``."""
        done = np.zeros(len(x))
        for root in roots:
            done += self.value[self.leaf_of(x, root)]
        return done


def drawn(key: str, number: int, share: float) -> str:
    """SQL of whether the row of this key is drawn in round ``number``."""
    if share >= 1:
        return "true"
    return f"conv(substring(md5(concat({key}, ':{number}')), 1, 8), 16, 10) % 1000 < {round(1000 * share)}"


def drawn_columns(cols: Sequence[str], number: int, share: float) -> list[int]:
    count = max(1, round(len(cols) * share))
    order = sorted(range(len(cols)), key=lambda i: hashlib.md5(f"{cols[i]}:{number}".encode()).hexdigest())
    return sorted(order[:count])


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the lowest loss before ``patience`` rounds without a gain, and whether patience ran out."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        if i - best >= patience:
            return best + 1, True
    return best + 1, False


@dataclass
class Split:
    gain: float
    feature: int
    bin: int
    missing_left: bool
    sides: tuple[tuple[float, float, int], tuple[float, float, int]]    # gradient, weight, rows left and right


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, p: BoostParams) -> Split | None:
    """The split of one leaf from its sums per feature and bin (the last bin holds the missing)."""
    whole = np.array([x[0].sum() for x in (g, h, n)])
    best = None
    left = [np.cumsum(x[:, :-1], axis=1) for x in (g, h, n)]
    for missing_left in (False, True):
        l_g, l_h, l_n = (a + x[:, -1:] if missing_left else a for a, x in zip(left, (g, h, n)))
        r_g, r_h, r_n = whole[0] - l_g, whole[1] - l_h, whole[2] - l_n
        ok = (l_n >= p.min_rows) & (r_n >= p.min_rows) & (l_h >= p.min_weight) & (r_h >= p.min_weight)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = l_g ** 2 / (l_h + p.l2) + r_g ** 2 / (r_h + p.l2) - whole[0] ** 2 / (whole[1] + p.l2)
        gain = np.where(ok, np.round(gain, GAIN_DIGITS), -np.inf)
        f, b = np.unravel_index(np.argmax(gain), gain.shape)
        # of equal gains the first feature, then bin; missing right before missing left
        if gain[f, b] > p.min_gain and (best is None or (-gain[f, b], f, b) < (-best.gain, best.feature, best.bin)):
            best = Split(float(gain[f, b]), int(f), int(b), missing_left,
                         ((float(l_g[f, b]), float(l_h[f, b]), int(l_n[f, b])),
                          (float(r_g[f, b]), float(r_h[f, b]), int(r_n[f, b]))))
    return best


@dataclass
class Leaf:
    path: int                       # 1 for the root, then 2k and 2k + 1
    sums: tuple[float, float, int]
    split: Split | None = None
    known: bool = False


@dataclass
class Growth:
    """A tree on its way: its layout so far (path -> node), its leaves by path, and those whose sums are asked for."""

    tree: Trees
    node: dict[int, int]
    leaves: dict[int, Leaf]
    asked: list[int]
    chosen: list[int]


class Forest:
    """Grows trees from sums; where the rows are is left to its kinds."""

    def __init__(self, cols: Sequence[str], edges: list[list[float]], logistic: bool, p: BoostParams):
        self.cols, self.edges, self.logistic, self.p = list(cols), edges, logistic, p
        self.width = bin_width(edges)
        self.trees, self.written = Trees(), 0

    def _laid_out(self, leaves: dict[int, Leaf]) -> tuple[Trees, dict[int, int], list[int]]:
        """The tree that best-first growth gives on what is known: (tree, path -> node, leaf paths)."""
        open_, splits = {1}, set()
        while len(open_) < self.p.leaves:
            able = [leaves[k] for k in open_ if leaves[k].split]
            if not able:
                break
            best = min(able, key=lambda leaf: (-leaf.split.gain, leaf.path))
            splits.add(best.path)
            open_ = open_ - {best.path} | {2 * best.path, 2 * best.path + 1}
        tree, node = Trees(), {}
        for path in sorted(open_ | splits):
            node[path] = tree.node()
        for path in splits:
            split, k = leaves[path].split, node[path]
            tree.feature[k], tree.cut[k], tree.missing_left[k] = split.feature, split.bin, split.missing_left
            tree.left[k], tree.right[k] = node[2 * path], node[2 * path + 1]
        tree.depth = max(path.bit_length() - 1 for path in open_)
        return tree, node, sorted(open_)

    def sums(self, number: int, growth: "Growth") -> np.ndarray:
        """(leaf, feature, bin, 3): gradient, weight and rows of the leaves that ``growth`` asks for."""
        raise NotImplementedError

    def batch(self, number: int) -> tuple[int, bool]:
        """Grow from round ``number`` on until scores are due to be written: (the next round, whether rounds end)."""
        while number < self.p.rounds and len(self.trees.roots) - self.written < WRITE_EVERY:
            grown = self.grow(number)
            number += 1
            # without sampling a round that splits nothing is the last
            if not grown and self.p.col_share >= 1 and self.p.row_share >= 1:
                return number, True
        return number, number >= self.p.rounds

    def grow(self, number: int) -> bool:
        """Add the tree of round ``number``; False if nothing can be split."""
        chosen = drawn_columns(self.cols, number, self.p.col_share)
        leaves = {1: Leaf(1, (0.0, 0.0, 0))}
        while True:
            tree, node, ends = self._laid_out(leaves)
            # a leaf of fewer than twice the least rows can't be split
            asked = [k for k in ends if not leaves[k].known and (k == 1 or leaves[k].sums[2] >= 2 * self.p.min_rows)]
            if not asked:
                break
            sums = self.sums(number, Growth(tree, node, leaves, asked, chosen))
            for i, k in enumerate(asked):
                g, h, n = (sums[i, :, :, c] for c in range(3))
                leaf = leaves[k]
                leaf.known, leaf.split = True, best_split(g, h, n, self.p)
                if k == 1:
                    leaf.sums = (float(g[0].sum()), float(h[0].sum()), int(n[0].sum()))
                if leaf.split:
                    leaf.split.feature = chosen[leaf.split.feature]
                    for child, side in zip((2 * k, 2 * k + 1), leaf.split.sides):
                        leaves[child] = Leaf(child, side)
        if len(ends) == 1:
            return False
        for path in ends:
            g, h, _ = leaves[path].sums
            tree.value[node[path]] = -g / (h + self.p.l2) * self.p.step
        tree.roots.append(0)
        self.trees.add(tree)
        return True

    def on_values(self, rounds: int | None = None) -> Trees:
        """The trees with cuts on values instead of bins."""
        t = self.trees
        cuts = [float(self.edges[f][b]) if f >= 0 and b < len(self.edges[f]) else math.inf if f >= 0 else 0.0
                for f, b in zip(t.feature, (int(c) for c in t.cut))]
        # the last bin has no upper end: every value goes left, only the missing go right
        cuts = [1.7976931348623157e308 if c == math.inf else c for c in cuts]
        roots = t.roots if rounds is None else t.roots[:rounds]
        end = len(t.feature) if len(roots) == len(t.roots) else t.roots[len(roots)]
        return Trees(t.feature[:end], cuts[:end], t.left[:end], t.right[:end], t.missing_left[:end], t.value[:end],
                     list(roots), t.depth)


class InMemory(Forest):
    """Grows trees over one array of rows."""

    def __init__(self, cols: Sequence[str], edges: list[list[float]], logistic: bool, p: BoostParams,
                 x: np.ndarray, y: np.ndarray, w: np.ndarray, f: np.ndarray, drawn_in: np.ndarray, first: int):
        super().__init__(cols, edges, logistic, p)
        self.x, self.y, self.w, self.f, self.drawn_in, self.first = x, y, w, f, drawn_in, first
        self.total, self.added = np.zeros(len(y)), 0
        self.rows: dict[int, np.ndarray] = {}

    def _start(self, number: int) -> None:
        for root in self.trees.roots[self.added:]:
            walk = Walk(self.trees, self.width - 1)
            self.total += walk.value[walk.leaf_of(self.x, root)]
        self.added = len(self.trees.roots)
        with np.errstate(over="ignore"):
            f = self.f + self.total
            guess = 1 / (1 + np.exp(-f)) if self.logistic else f
        self.g = self.w * (guess - self.y)
        self.h = self.w * guess * (1 - guess) if self.logistic else self.w
        self.rows = {1: np.flatnonzero(self.drawn_in >> (number - self.first) & 1)}

    def _rows_of(self, path: int, leaves: dict[int, Leaf]) -> np.ndarray:
        if path not in self.rows:
            split, rows = leaves[path // 2].split, self.rows.pop(path // 2)
            bins = self.x[:, split.feature][rows]
            left = np.where(bins == self.width - 1, split.missing_left, bins <= split.bin)
            self.rows |= {path // 2 * 2: rows[left], path // 2 * 2 + 1: rows[~left]}
        return self.rows[path]

    def sums(self, number: int, growth: Growth) -> np.ndarray:
        if growth.asked == [1]:
            self._start(number)
        out = np.zeros((len(growth.asked), len(growth.chosen), self.width, 3))
        for i, path in enumerate(growth.asked):
            rows = self._rows_of(path, growth.leaves)
            g, h = self.g[rows], self.h[rows]
            for k, c in enumerate(growth.chosen):
                at = self.x[:, c][rows].astype(np.intp)
                for j, part in enumerate((g, h, None)):
                    out[i, k, :, j] = np.bincount(at, part, self.width)
        return out


class Grower(Forest):
    """Grows trees over a stored table (x packed bins, y, w, key, f: the score so far).

    A table that one task may hold (``small``) grows the trees of a batch there, in
    one job; otherwise each level of a tree is a job over all tasks.
    """

    def __init__(self, rows: DataFrame, cols: Sequence[str], edges: list[list[float]], logistic: bool, p: BoostParams,
                 small: bool = False):
        super().__init__(cols, edges, logistic, p)
        self.rows, self.small = rows, small

    def batch(self, number: int) -> tuple[int, bool]:
        if not self.small:
            return super().batch(number)
        rounds = range(number, min(number + WRITE_EVERY, self.p.rounds))
        bits = " | ".join(f"if({drawn('key', k, self.p.row_share)}, {1 << i}, 0)" for i, k in enumerate(rounds))
        rows = self.rows.select("x", "y", F.coalesce("w", F.lit(0.0)).alias("w"), "f", F.expr(bits).alias("d"))
        cols, edges, logistic, width = self.cols, self.edges, self.logistic, self.width
        p = replace(self.p, rounds=rounds.stop)

        def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            read = [(_unpacked(b, len(cols), bin_kind(width)), *[_column(b, c) for c in "ywfd"]) for b in batches]
            if not read:
                return
            x = np.asfortranarray(np.concatenate([r[0] for r in read]))     # read column by column
            y, w, f, d = (np.concatenate([r[i] for r in read]) for i in range(1, 5))
            read.clear()
            forest = InMemory(cols, edges, logistic, p, x, y, w, f, d, rounds.start)
            after, over = forest.batch(rounds.start)
            row = json.dumps({"trees": asdict(forest.trees), "number": after, "over": over and after < rounds.stop})
            yield pa.RecordBatch.from_arrays([pa.array([row])], ["grown"])

        found = json.loads(rows.coalesce(1).mapInArrow(grown, "grown string").first()["grown"])
        self.trees.add(Trees(**found["trees"]))
        return found["number"], found["over"] or found["number"] >= self.p.rounds

    def sums(self, number: int, growth: Growth) -> np.ndarray:
        tree, chosen, slots = growth.tree, growth.chosen, {growth.node[k]: i for i, k in enumerate(growth.asked)}
        slot_of = np.array([slots.get(k, -1) for k in range(len(tree.feature))], np.int64)
        mine, so_far, fresh = Walk(tree, self.width - 1), Walk(self.trees, self.width - 1), self.trees.roots[self.written:]
        width, features, logistic, shape = self.width, len(self.cols), self.logistic, (len(slots), len(chosen), self.width)

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros(shape) for _ in range(3)]
            for batch in batches:
                x = _unpacked(batch, features, bin_kind(width))
                slot = slot_of[mine.leaf_of(x, 0)]
                kept = slot >= 0
                x, slot = x[kept], slot[kept]
                y, w, f = (_column(batch, c)[kept] for c in ("y", "w", "f"))
                with np.errstate(over="ignore"):
                    f = f + so_far.total(x, fresh)
                    guess = 1 / (1 + np.exp(-f)) if logistic else f
                parts = [w * (guess - y), w * guess * (1 - guess) if logistic else w, None]
                for k, c in enumerate(chosen):
                    at = slot * width + x[:, c]
                    for out, part in zip(sums, parts):
                        out[:, k, :] += np.bincount(at, part, shape[0] * width).reshape(shape[0], width)
            where = np.nonzero(sums[2])
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)) for i in where]
                + [pa.array(out[where]) for out in sums[:2]] + [pa.array(sums[2][where].astype(np.int64))],
                ["slot", "feature", "bin", "g", "h", "n"])

        rows = self.rows.where(drawn("key", number, self.p.row_share)).select(
            "x", "y", F.coalesce("w", F.lit(0.0)).alias("w"), "f")      # counted, but adds nothing
        found = rows.mapInArrow(added, "slot int, feature int, bin int, g double, h double, n long") \
            .groupBy("slot", "feature", "bin").agg(*[F.sum(c).alias(c) for c in "ghn"]) \
            .toArrow()      # leaves x features x bins rows at most
        out = np.zeros((*shape, 3))
        where = tuple(found.column(c).to_numpy() for c in ("slot", "feature", "bin"))
        for k, c in enumerate("ghn"):
            out[(*where, k)] = found.column(c).to_numpy()
        return out

    def keep_scores(self) -> None:
        """Write the scores with all trees so far."""
        if self.written < len(self.trees.roots):
            self.rows = store(self.scored(self.rows), "boost-rows")
            self.written = len(self.trees.roots)

    def scored(self, rows: DataFrame) -> DataFrame:
        """Rows of the stored form with the trees since ``written`` added to their scores."""
        walk, fresh = Walk(self.trees, self.width - 1), self.trees.roots[self.written:]
        features, kind = len(self.cols), bin_kind(self.width)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                f = _column(batch, "f") + walk.total(_unpacked(batch, features, kind), fresh)
                yield batch.set_column(batch.schema.get_field_index("f"), "f", pa.array(f))

        return rows.mapInArrow(add, rows.schema)

    def losses(self, held: DataFrame) -> list[float]:
        """Mean loss on held-out rows after each tree since ``written``."""
        walk, fresh = Walk(self.trees, self.width - 1), self.trees.roots[self.written:]
        features, kind, logistic = len(self.cols), bin_kind(self.width), self.logistic

        def lost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, n = np.zeros(len(fresh)), 0
            for batch in batches:
                x, y, f = _unpacked(batch, features, kind), _column(batch, "y"), _column(batch, "f")
                n += len(x)
                for k, root in enumerate(fresh):
                    f = f + walk.value[walk.leaf_of(x, root)]
                    with np.errstate(over="ignore"):
                        sums[k] += (np.log(1 + np.exp(f)) - y * f if logistic else (f - y) ** 2).sum()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(fresh), dtype=np.int32)), pa.array(sums), pa.array(np.full(len(fresh), n))],
                ["k", "loss", "n"])

        found = held.mapInArrow(lost, "k int, loss double, n long").groupBy("k").agg(
            (F.sum("loss") / F.sum("n")).alias("loss")).orderBy("k").collect()     # one number per tree
        return [r["loss"] for r in found]


def fit_boosted(df: DataFrame, cols: Sequence[str], y: str, w: str, key: Sequence[str], p: BoostParams,
                logistic: bool = True, held: DataFrame | None = None) -> Boosted:
    """Boosted trees for ``y`` with weights ``w``; ``key`` names rows for sampling.

    With ``held`` rows and patience, rounds end when the loss on them has not
    fallen for that many, and the best round's trees are kept: one fit, cut back.
    """
    edges = bin_edges(df, cols, p.bins)
    names = [f"_{i}" for i in range(len(cols))]     # a feature may be called y

    def ready(rows: DataFrame, weight: Column, name: str) -> DataFrame:
        kept = rows.filter(F.col(y).isNotNull()).select(
            *[F.col(c).alias(n) for c, n in zip(cols, names)], F.col(y).cast("double").alias("y"),
            weight.cast("double").alias("w"), F.concat_ws(":", *[F.col(k).cast("string") for k in key]).alias("key"))
        return store(binned(kept, names, edges, bin_width(edges)), name)

    rows = ready(df, F.col(w), "boost-rows")
    mean, count = rows.agg(F.sum(F.col("w") * F.col("y")) / F.sum("w"), F.count(F.lit(1))).first()
    if mean is None:
        raise ValueError("no rows to fit")
    base = mean
    if logistic:
        mean = min(max(mean, 1e-15), 1 - 1e-15)
        base = math.log(mean / (1 - mean))
    small = count <= max_group_rows(df.sparkSession) \
        and count * len(cols) * bin_kind(bin_width(edges)).itemsize <= TASK_BYTES
    grower = Grower(rows.withColumn("f", F.lit(base)), cols, edges, logistic, p, small)
    tail = ready(held, F.lit(1.0), "boost-held").withColumn("f", F.lit(base)) if held is not None else None
    if tail is not None and (p.patience is None or tail.isEmpty()):
        tail = None
    losses: list[float] = []
    best, over, number = None, p.rounds <= 0, 0
    while not over:
        number, over = grower.batch(number)
        if len(grower.trees.roots) > grower.written:
            if tail is not None:
                losses += grower.losses(tail)
                tail = store(grower.scored(tail), "boost-held")
                best, impatient = best_round(losses, p.patience)
                over = over or impatient
            grower.keep_scores()
    return Boosted(list(cols), base, logistic, grower.on_values(best))
