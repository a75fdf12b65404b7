"""Exact quantiles, quantile bins and rank correlation per group.

Built-in ``percentile`` keeps every distinct value of a group in one
aggregation buffer, and a rank window sorts a group on one task. Here values
are counted per (group, value) and accumulated with ``ordered_windows``, which
splits groups of any size, so both stay exact at scale. Rows with a NULL group
key belong to no group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatecast.operators.ordered import Running, ordered_windows
from slatecast.session import max_group_rows, store


def _counted(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Distinct values with counts and the running count up to each."""
    counts = store(df.filter(F.col(value).isNotNull()).groupBy(*by, value)
                   .agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    return ordered_windows(counts, by, [value], {"_upto": Running("sum", F.col("_n"))},
                           include_current=True)


def quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles: one row per group, ``edges`` array in
    ``probs`` order, and ``n`` non-NULL values."""
    by = list(by)
    if not by:
        return quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, probs).drop("_all")
    upto = _counted(df, by, value)
    sizes = store(upto.groupBy(*by).agg(F.sum("_n").alias("_size")), "group-sizes")
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1
    lowest, highest = _near(probs, first, last, F.col("_size"))
    joined = upto.join(sizes, by).where(lowest <= highest)
    given = F.array(*[F.lit(float(p)) for p in probs])
    ranks = F.transform(F.when(lowest <= highest, F.sequence(lowest, highest)), lambda i: F.struct(
        i.alias("i"), (F.get(given, i) * (F.col("_size") - 1)).alias("at")))
    # keep only rows that cover a wanted rank: at most two per quantile
    hits = F.filter(ranks, lambda r: (F.floor(r["at"]).between(first, last))
                    | (F.ceil(r["at"]).between(first, last)))
    picked = (joined.withColumn("_hit", F.explode(hits))
              .select(*by, "_size", F.col("_hit.i").alias("_i"), F.col("_hit.at").alias("_at"),
                      F.when(F.floor("_hit.at").between(first, last), F.col(value)).alias("_lo"),
                      F.when(F.ceil("_hit.at").between(first, last), F.col(value)).alias("_hi")))
    ends = picked.groupBy(*by, "_size", "_i", "_at").agg(F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    lo, hi = F.col("_lo").cast("double"), F.col("_hi").cast("double")
    edge = lo + (hi - lo) * (F.col("_at") - F.floor("_at"))
    ordered = F.array_sort(F.collect_list(F.struct("_i", edge.alias("e"))))   # one entry per prob
    return ends.groupBy(*by, F.col("_size").alias("n")).agg(
        F.transform(ordered, lambda s: s["e"]).alias("edges"))


def _near(probs: Sequence[float], first: Column, last: Column, size: Column) -> tuple[Column, Column]:
    """Lowest and highest place in ``probs`` whose ranks can touch the ranks ``first`` to ``last`` of ``size``.

    Places on an even grid come from a division, so that most rows ask for none;
    the margin is far above its rounding, what is near is compared exactly later.
    """
    top, margin = F.lit(len(probs) - 1), 1e-6
    step = probs[1] - probs[0] if len(probs) > 1 else 1.0
    if step <= 0 or any(abs(probs[0] + i * step - p) > 1e-12 for i, p in enumerate(probs)):
        return F.lit(0), top
    steps = F.greatest(size - 1, F.lit(1)) * F.lit(float(step))
    start = F.lit(probs[0] / step)
    return (F.greatest(F.lit(0), F.ceil((first - 1) / steps - start - margin)).cast("int"),
            F.least(top, F.floor((last + 1) / steps - start + margin)).cast("int"))


def bin_of(value: Column, cuts: Column, bins: int) -> Column:
    """Right-closed bin number (1-based) among at most ``bins + 1`` distinct edges; the
    lowest edge belongs to the first bin. NULL for a value outside or with no bin.

    Counted by a sum of comparisons, which unlike a filter of the array is compiled."""
    below = reduce(lambda a, b: a + b, [F.when(F.get(cuts, F.lit(i)) < value, 1).otherwise(0) for i in range(bins + 1)])
    inside = (F.size(cuts) > 1) & (value >= F.get(cuts, F.lit(0))) & (value <= F.element_at(cuts, -1))
    return F.when(inside, F.greatest(below, F.lit(1)))


def quantile_bins(df: DataFrame, by: Sequence[str], value: str, bins: int, name: str,
                  edges: DataFrame | None = None) -> DataFrame:
    """Add the quantile bin of ``value`` inside its group; NULL value, NULL bin.

    One edge array per group: stored, so that its size decides the join.
    ``edges`` (by, edges) may come from elsewhere, such as sketches.
    """
    by = list(by)
    if not by:
        keyed = df.withColumn("_all", F.lit(0))
        return quantile_bins(keyed, ["_all"], value, bins, name).drop("_all")
    if edges is None:
        edges = quantiles(df, by, value, [i / bins for i in range(bins + 1)])
    edges = store(edges.select(*by, "edges", F.array_distinct("edges").alias("_cuts")), "edges")
    joined = df.join(edges, by, "left")
    return joined.withColumn(name, bin_of(F.col(value), F.col("_cuts"), bins)).drop("_cuts")


def spearman(df: DataFrame, by: Sequence[str], x: str, y: str, min_pairs: int = 30) -> DataFrame:
    """Spearman correlation per group over rows where both are present.

    Average ranks come from counts per distinct pair; Pearson on ranks is then
    one weighted sum per distinct pair, centred on the exact mean rank
    (n + 1) / 2. NULL under ``min_pairs`` pairs or for a constant column.
    The pairs of a usual group are moved once, for the ranks of both columns
    and the sum; larger groups are split.
    """
    by = list(by)
    if not by:
        return spearman(df.withColumn("_all", F.lit(0)), ["_all"], x, y, min_pairs).drop("_all")
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, x, y]])
    pairs = store(df.filter(whole).groupBy(*by, x, y).agg(F.count(F.lit(1)).alias("_pairs")), "pairs")
    groups = pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("_distinct"))
    hot = groups.filter(F.col("_distinct") > max_group_rows(df.sparkSession)).select(*by)
    if hot.isEmpty():
        ranks = _ranked_together(pairs, by, x, y)
    else:
        hot = store(hot, "hot-groups")
        usual = _ranked_together(pairs.join(hot, by, "left_anti"), by, x, y)
        ranks = usual.unionByName(_ranked_apart(store(pairs.join(hot, by, "left_semi"), "hot-pairs"), by, x, y))
    mean = (F.col("n_pairs") + 1) / 2
    dx, dy, w = F.col("_rx") - mean, F.col("_ry") - mean, F.col("_pairs")
    sums = ranks.groupBy(*by).agg(F.max("n_pairs").alias("n_pairs"), F.sum(w * dx * dy).alias("_xy"),
                                  F.sum(w * dx * dx).alias("_xx"), F.sum(w * dy * dy).alias("_yy"))
    rho = F.try_divide(F.col("_xy"), F.sqrt(F.col("_xx")) * F.sqrt(F.col("_yy")))
    return sums.select(*by, "n_pairs", F.when(F.col("n_pairs") >= min_pairs, rho).alias("ic"))


def _ranked_together(pairs: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """(by, n_pairs, _pairs, _rx, _ry): each group in one place, sorted by either column in turn."""
    def rank(c: str) -> Column:
        upto = W.partitionBy(*by).orderBy(c)
        equal = upto.rangeBetween(W.currentRow, W.currentRow)
        return F.sum("_pairs").over(upto) - (F.sum("_pairs").over(equal) - 1) / 2

    ranked = pairs.withColumn("_rx", rank(x)).withColumn("_ry", rank(y))
    return ranked.withColumn("n_pairs", F.sum("_pairs").over(W.partitionBy(*by))).select(
        *by, "n_pairs", "_pairs", "_rx", "_ry")


def _ranked_apart(pairs: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """The same for groups of any size: distinct values of a column are counted, accumulated and joined."""
    def ranked(c: str, name: str) -> DataFrame:
        counts = store(pairs.groupBy(*by, c).agg(F.sum("_pairs").alias("_n")), f"counts-{name}")
        upto = ordered_windows(counts, by, [c], {"_upto": Running("sum", F.col("_n"))},
                               include_current=True)
        return upto.select(*by, c, (F.col("_upto") - (F.col("_n") - 1) / 2).alias(name))

    sizes = store(pairs.groupBy(*by).agg(F.sum("_pairs").alias("n_pairs")), "pair-counts")
    both = pairs.join(ranked(x, "_rx"), [*by, x]).join(ranked(y, "_ry"), [*by, y]).join(sizes, by)
    return both.select(*by, "n_pairs", "_pairs", "_rx", "_ry")
