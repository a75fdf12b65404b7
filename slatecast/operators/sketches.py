"""Approximate quantiles from mergeable sketches.

A sketch is built per fine group (a factor in a month), merged upwards to any
coarser one without touching rows again, and read at the end. Its size depends
on ``k`` alone, so no group is ever held. An edge read from a sketch lies, with
99 % confidence, within ``rank_error(k)`` of its rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 800


def rank_error(k: int = K) -> float:
    """Published error of one quantile of a KLL sketch, as a share of the rows."""
    # fixed values: fitted constants of the sketch's authors
    return 2.296 / k ** 0.9021


def quantile_sketches(df: DataFrame, by: Sequence[str], value: str, k: int = K) -> DataFrame:
    """(by, sketch) over the known values of each group."""
    known = df.filter(F.col(value).isNotNull())
    return known.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def edges_of(sketches: DataFrame, by: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(by, n, edges): the quantiles of each sketch in ``probs`` order."""
    edges = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs])
    return sketches.select(*by, F.kll_sketch_get_n_double("sketch").alias("n"), edges.alias("edges"))


def edge_ranks(df: DataFrame, by: Sequence[str], value: str, edges: DataFrame) -> DataFrame:
    """(by, edge, below, upto, n): how many rows lie below, and up to, each edge of their group."""
    wide = df.filter(F.col(value).isNotNull()).join(edges.select(*by, "edges"), list(by))
    # each row counts once, in the bin it falls into; bins are then added up
    spot = F.struct(F.size(F.filter("edges", lambda e: e < F.col(value))).alias("over"),
                    F.size(F.filter("edges", lambda e: e <= F.col(value))).alias("from"))
    counts = wide.select(*by, F.size("edges").alias("_edges"), spot.alias("_s")).groupBy(*by, "_edges", "_s").agg(
        F.count(F.lit(1)).alias("_n"))
    each = counts.withColumn("edge", F.explode(F.sequence(F.lit(0), F.col("_edges") - 1)))
    below = F.sum(F.when(F.col("_s.from") <= F.col("edge"), F.col("_n")).otherwise(0))
    upto = F.sum(F.when(F.col("_s.over") <= F.col("edge"), F.col("_n")).otherwise(0))
    return each.groupBy(*by, "edge").agg(below.alias("below"), upto.alias("upto"), F.sum("_n").alias("n"))
