"""Scores, pickers and gates over predicted probabilities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slatecast.functions.rates import at_least_one, clip, safe_div
from slatecast.operators.dedup import top_k
from slatecast.operators.ordered import Running, ordered_windows
from slatecast.operators.ranks import quantile_bins
from slatecast.operators.runs import expanding_mean, longest_run
from slatecast.session import store

EPS = 1e-6
TOP_K = [5, 10]
#: Bands of the score in which ``auc`` ranks.
SCORE_BANDS = 16_384
# Report labels and band edges.
QUALITY_LABELS = ["Q1 weakest", "Q2", "Q3", "Q4 strongest"]
PA_BANDS = [(3.5, "<3.5"), (4.2, "3.5-4.2"), (10.0, ">4.2")]
CALIBRATION_GATE = 0.03
CALIBRATION_MIN_ROWS = 300
BENCH_MIN_PA = 50


def log_loss(y: Column, p: Column) -> Column:
    q = clip(p, EPS, 1 - EPS)
    return F.avg(-(y * F.log(q) + (1 - y) * F.log(1 - q)))


def squared_error(y: Column, p: Column) -> Column:
    return F.avg(F.pow(clip(p, EPS, 1 - EPS) - y, F.lit(2)))


def scores_long(df: DataFrame, models: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per frame row and model: (model, p, kept columns)."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("p"))
                      for m, c in models.items()])
    return df.select(*keep, F.explode(pairs).alias("_m")).select(*keep, "_m.model", "_m.p")


def auc(df: DataFrame, by: Sequence[str], y: str, p: str) -> DataFrame:
    """Exact area under the ROC curve per group from average ranks of distinct scores.

    Scores are ranked inside equal bands of (0, 1), so that no group has to be
    cut by position; the rows of lower bands are added to the ranks of a whole
    band. A band with very many scores is split like any group.
    """
    counts = store(df.withColumn(p, clip(p, EPS, 1 - EPS)).groupBy(*by, F.floor(F.col(p) * SCORE_BANDS).alias("_band"), p)
                   .agg(F.count(F.lit(1)).alias("_n"), F.sum(y).alias("_pos")), "score-counts")
    upto = ordered_windows(counts, [*by, "_band"], [p], {"_upto": Running("sum", F.col("_n"))}, include_current=True)
    rank = F.col("_upto") - (F.col("_n") - 1) / 2
    bands = upto.groupBy(*by, "_band").agg(F.sum(F.col("_pos") * rank).alias("_ranks"), F.sum("_pos").alias("_pos"),
                                           F.sum("_n").alias("_n"))
    # at most one row per band and group from here on
    lower = W.partitionBy(*by).orderBy(F.col("_band").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    bands = bands.withColumn("_lower", F.coalesce(F.sum("_n").over(lower), F.lit(0)))
    pos, neg = F.sum("_pos"), F.sum("_n") - F.sum("_pos")
    area = (F.sum(F.col("_ranks") + F.col("_pos") * F.col("_lower")) - pos * (pos + 1) / 2) \
        / F.nullif((pos * neg).cast("double"), F.lit(0.0))
    return bands.groupBy(*by).agg(area.alias("auc"))


def metric_rows(df: DataFrame, models: Mapping[str, str], y: str = "has_hit") -> DataFrame:
    """Log loss, Brier, AUC and row count per model in one long pass."""
    long = scores_long(df, models, [y])
    base = long.groupBy("model").agg(log_loss(F.col(y), F.col("p")).alias("log_loss"),
                                     squared_error(F.col(y), F.col("p")).alias("brier"),
                                     F.count(F.lit(1)).alias("n"))
    return base.join(auc(long, ["model"], y, "p"), "model").select("model", "log_loss", "brier", "auc", "n")


def _best_first(score: str) -> list[Column]:
    return [F.col(score).desc_nulls_last(), F.col("game_pk").asc(), F.col("batter_id").asc()]


def top_k_rates(df: DataFrame, models: Mapping[str, str], ks: Sequence[int] = TOP_K) -> DataFrame:
    """Hit rate of the k best rows of each date, per model."""
    long = scores_long(df, models, ["game_date", "game_pk", "batter_id", "has_hit"])
    picks = top_k(long, ["model", "game_date"], _best_first("p"), max(ks), "_rank")
    rates = [F.avg(F.when(F.col("_rank") <= k, F.col("has_hit"))).alias(f"top{k}_hit_rate") for k in ks]
    return picks.groupBy("model").agg(*rates)


def scoreboard(df: DataFrame, models: Mapping[str, str], ks: Sequence[int] = TOP_K) -> DataFrame:
    return metric_rows(df, models).join(top_k_rates(df, models, ks), "model", "left").orderBy("log_loss", "model")


def quality_tier(df: DataFrame, column: str = "eb_hit_per_pa_career", name: str = "quality") -> DataFrame:
    """Quartile label of the player-quality column."""
    labels = F.array(*[F.lit(x) for x in QUALITY_LABELS])
    binned = quantile_bins(df, [], column, 4, "_bin").drop("edges")
    return binned.withColumn(name, F.element_at(labels, F.col("_bin"))).drop("_bin")


def pa_band(column: str = "pa_roll10") -> Column:
    """Expected-PA band, right-closed from 0; NULL outside."""
    c, out = F.col(column), F.lit(None).cast("string")
    for bound, label in reversed(PA_BANDS):
        out = F.when(c <= bound, label).otherwise(out)
    return F.when(c > 0, out)


def by_dimension(df: DataFrame, dims: Mapping[str, Column], measures: Sequence[Column],
                 keep: Sequence[str]) -> DataFrame:
    """The same measures grouped by each of several dimensions, in one pass."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), c.cast("string").alias("level"))
                      for d, c in dims.items()])
    long = df.select(*keep, F.explode(pairs).alias("_d")).select(*keep, "_d.dimension", "_d.level")
    return long.filter(F.col("level").isNotNull()).groupBy("dimension", "level").agg(*measures)


def tier_table(df: DataFrame, models: Mapping[str, str]) -> DataFrame:
    """Log loss per model by quality quartile and expected-PA band."""
    losses = [log_loss(F.col("has_hit"), F.col(c)).alias(f"logloss_{m}") for m, c in models.items()]
    return by_dimension(quality_tier(df), {"quality": F.col("quality"), "pa_band": pa_band()},
                        [F.count(F.lit(1)).alias("n"), F.avg("has_hit").alias("base_rate"), *losses],
                        ["has_hit", *models.values()])


def slice_table(df: DataFrame, p: str) -> DataFrame:
    """Calibration gap and log loss by month, quality quartile and home side."""
    y, q = F.col("has_hit"), clip(p, EPS, 1 - EPS)
    return by_dimension(
        quality_tier(df).withColumn("_p", q),
        {"month": F.col("month"), "quality": F.col("quality"), "is_home": F.col("is_home")},
        [F.count(F.lit(1)).alias("n"), F.avg(y).alias("base_rate"), F.avg("_p").alias("mean_pred"),
         (F.avg(y) - F.avg("_p")).alias("cal_gap"), log_loss(y, F.col("_p")).alias("log_loss")],
        ["has_hit", "_p"])


def calibration_buckets(df: DataFrame, p: str, y: str = "has_hit") -> DataFrame:
    """Five-point buckets: rows, mean prediction, observed rate and their gap."""
    return df.groupBy((F.floor(F.col(p) * 20) / 20).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("pred"), F.avg(y).alias("obs"),
        (F.avg(y) - F.avg(p)).alias("gap"))


def baseline_scores(df: DataFrame, fill: Column | float) -> DataFrame:
    """Season-average score (-1 under 50 PA) and shrunk chance over expected PA."""
    expected = clip(F.coalesce(F.col("pa_roll10"), fill if isinstance(fill, Column) else F.lit(fill)), 1.0, 6.0)
    return df.withColumns({
        "ba_bench": F.when(F.col("season_pa_prior") >= BENCH_MIN_PA,
                           safe_div("season_hits_prior", "season_pa_prior")).otherwise(F.lit(-1.0)),
        "eb_bench": F.col("eb_hit_per_pa_career"),
        "eb_pa": at_least_one("eb_hit_per_pa_career", expected)})


PICKERS = {"model": "p_model", "season_ba": "ba_bench", "eb_shrunk": "eb_bench"}


def top_k_picks(df: DataFrame, k: int, pickers: Mapping[str, str] = PICKERS) -> DataFrame:
    """The k best rows per date for every picker, one window over (picker, date)."""
    long = scores_long(df, pickers, ["game_date", "game_pk", "batter_id", "has_hit"]) \
        .withColumnsRenamed({"model": "picker", "p": "score"})
    return top_k(long, ["picker", "game_date"], _best_first("score"), k, "pick")


def picker_table(df: DataFrame, ks: Sequence[int] = TOP_K, pickers: Mapping[str, str] = PICKERS) -> DataFrame:
    """Picks, hit rate and longest miss streak per k and picker.

    The k best are a prefix of the max(ks) best: one ranking, one explode.
    """
    picks = top_k_picks(df, max(ks), pickers)
    sized = picks.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).filter("pick <= k")
    sized = store(sized.select("k", "picker", "game_date", "pick", "has_hit"), "picks")
    rates = sized.groupBy("k", "picker").agg(F.count(F.lit(1)).alias("picks"), F.avg("has_hit").alias("hit_rate"))
    streaks = longest_run(sized, ["k", "picker"], ["game_date", "pick"], "has_hit", 0, "worst_miss_streak")
    return rates.join(streaks, ["k", "picker"])


def picker_curve(df: DataFrame, k: int = 5, pickers: Mapping[str, str] = PICKERS) -> DataFrame:
    """Running mean of the daily top-k hit rate: one row per picker and date."""
    daily = store(top_k_picks(df, k, pickers).groupBy("picker", "game_date")
                  .agg(F.avg("has_hit").alias("daily_rate")), "daily-rates")
    return expanding_mean(daily, ["picker"], ["game_date"], "daily_rate", "running_rate")


def backtest_gates(buckets: DataFrame, pickers: DataFrame) -> list[str]:
    """Reasons to fail: a large bucket out of band, or the season-average picker ahead."""
    failures = []
    out = buckets.filter((F.col("n") >= CALIBRATION_MIN_ROWS) & (F.abs("gap") > CALIBRATION_GATE))
    bad = [r["bucket"] for r in out.select("bucket").collect()]   # at most 21 buckets
    if bad:
        failures.append(f"calibration buckets out of band: {sorted(bad)}")
    top5 = pickers.filter("k = 5").agg(
        F.max(F.when(F.col("picker") == "model", F.col("hit_rate"))).alias("m"),
        F.max(F.when(F.col("picker") == "season_ba", F.col("hit_rate"))).alias("b")).first()
    if not (top5["m"] is not None and top5["b"] is not None and top5["m"] > top5["b"]):
        failures.append("model top-5 does not beat the season-average picker")
    return failures


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
