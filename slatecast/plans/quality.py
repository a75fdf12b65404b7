"""Data tests as jobs: each check returns one row (check, failures)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slatecast.operators.dedup import top_k
from slatecast.plans.history import overlapping
from slatecast.session import store


class CheckFailed(Exception):
    pass


def _row(df: DataFrame, name: str, failures: Column) -> DataFrame:
    return df.agg(F.coalesce(failures, F.lit(0)).cast("long").alias("failures")) \
             .select(F.lit(name).alias("check"), "failures")


def check_not_null(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """NULLs per column, all columns in one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "_column", "failures").select(
        F.concat(F.lit(f"not_null {table}."), "_column").alias("check"), "failures")


def check_unique(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Key values that occur more than once."""
    repeated = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return _row(repeated, f"unique {table}({', '.join(columns)})", F.count(F.lit(1)))


def check_accepted(df: DataFrame, column: str, values: Sequence, table: str) -> DataFrame:
    """Values outside the list; NULL passes."""
    return _row(df, f"accepted {table}.{column}", F.count_if(~F.col(column).isin(list(values))))


def check_expr(df: DataFrame, expression: str, table: str) -> DataFrame:
    """Rows for which the expression is false."""
    return _row(df, f"true {table}: {expression}", F.count_if(~F.expr(expression)))


def check_freshness(df: DataFrame, ts: str | Column, now: str, warn_hours: int, error_hours: int,
                    table: str) -> DataFrame:
    """Age of the newest row in hours and its state; an empty table is an error."""
    stamp = F.col(ts) if isinstance(ts, str) else ts
    newest = df.agg(F.max(stamp.cast("timestamp_ntz")).alias("_newest"))
    age = F.timestamp_diff("SECOND", F.col("_newest"), F.lit(now).cast("timestamp_ntz")) / 3600
    state = (F.when(age.isNull() | (age > error_hours), "error").when(age > warn_hours, "warn").otherwise("pass"))
    return newest.select(F.lit(table).alias("table"), age.alias("age_hours"), state.alias("state"))


def load_time(load_id: str = "load_id") -> Column:
    """Load stamps are unix seconds as text."""
    return F.timestamp_seconds(F.col(load_id).cast("double"))


_LEAK_KEYS = ["batter_id", "game_pk", "game_date"]
_NOTHING_YET = ["career_pa_prior", "career_games_prior", "season_pa_prior", "hit_streak_entering",
                "hitless_streak_entering"]
_NOT_KNOWN = ["has_hit_roll5", "hit_per_pa_roll40", "k_pct_roll10", "hit_per_pa_platoon_roll20"]
#: What the leakage check reads of the frame.
LEAK_COLUMNS = [*_LEAK_KEYS, "days_rest", *_NOTHING_YET, *_NOT_KNOWN]


def leaks(feat: DataFrame) -> DataFrame:
    """Rows that show knowledge of their own game: a first game with history,
    or a negative rest. Empty when the frame is clean."""
    feat = feat.select(*LEAK_COLUMNS)
    first = top_k(feat, ["batter_id"], [F.col("game_date").asc(), F.col("game_pk").asc()], 1, "_rank")
    tainted = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in _NOTHING_YET] + [F.col(c).isNotNull() for c in _NOT_KNOWN])
    keys = _LEAK_KEYS
    return first.filter(tainted).select(*keys).unionByName(feat.filter("days_rest < 0").select(*keys))


def check_leakage(feat: DataFrame) -> DataFrame:
    return _row(leaks(feat), "no leakage feat_batter_game", F.count(F.lit(1)))


def weekly_counts(df: DataFrame, date: str, key: Sequence[str], name: str) -> DataFrame:
    """Distinct keys per week: deduplicated first, so counting combines map-side."""
    week = F.date_trunc("week", F.col(date).cast("timestamp_ntz")).cast("date")
    unique = df.select(week.alias("wk"), *key).distinct()
    return unique.groupBy("wk").agg(F.count(F.lit(1)).alias(name))


def reconcile_counts(a: DataFrame, b: DataFrame, date: str, key: Sequence[str],
                     tolerance: float = 0.005) -> DataFrame:
    """Weekly key counts of two sources over the weeks both cover."""
    left, right = weekly_counts(a, date, key, "a_n"), weekly_counts(b, date, key, "b_n")
    both = left.join(right, "wk", "full")
    span = both.agg(F.greatest(F.min(F.when(F.col("a_n").isNotNull(), F.col("wk"))),
                               F.min(F.when(F.col("b_n").isNotNull(), F.col("wk")))).alias("lo"),
                    F.least(F.max(F.when(F.col("a_n").isNotNull(), F.col("wk"))),
                            F.max(F.when(F.col("b_n").isNotNull(), F.col("wk")))).alias("hi"))
    # one row with the common window
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    a_n, b_n = F.coalesce("a_n", F.lit(0)), F.coalesce("b_n", F.lit(0))
    diff = F.abs(a_n - b_n) / F.greatest(a_n, F.lit(1))
    return both.filter((F.col("wk") >= lo) & (F.col("wk") <= hi)).select(
        "wk", a_n.alias("a_n"), b_n.alias("b_n"), diff.alias("diff_pct"), (diff > tolerance).alias("mismatch"))


MISSING = -99.0


def parity(a: DataFrame, b: DataFrame, keys: Sequence[str], metrics: Mapping[str, str],
           strict: Sequence[str], tolerance: float = 1e-3, max_strict: float = 0.005,
           max_drift: float = 0.90) -> DataFrame:
    """Mismatch rate per metric of two versions of a table joined on ``keys``.

    NULL against a value is a mismatch. ``metrics`` maps a's names to b's.
    """
    pairs = a.select(*keys, *[F.col(m).cast("double").alias(f"a_{n}") for m, n in metrics.items()]).join(
        b.select(*keys, *[F.col(n).cast("double").alias(f"b_{n}") for n in metrics.values()]), keys)

    def off(n: str) -> Column:
        gap = F.coalesce(f"a_{n}", F.lit(MISSING)) - F.coalesce(f"b_{n}", F.lit(MISSING))
        return F.count_if(F.abs(gap) > tolerance).alias(n)

    names = list(metrics.values())
    counts = pairs.agg(F.count(F.lit(1)).alias("joined_rows"), *[off(n) for n in names])
    rows = counts.unpivot(["joined_rows"], names, "metric", "mismatches")
    rate = F.coalesce(F.try_divide("mismatches", "joined_rows"), F.lit(1.0))
    limit = F.when(F.col("metric").isin(list(strict)), max_strict).otherwise(max_drift)
    return rows.select("metric", "joined_rows", "mismatches", rate.alias("mismatch_rate"),
                       (rate < limit).alias("ok"))


def only_in_first(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti").agg(F.count(F.lit(1)).alias("n"))


# Declared keys and columns that may not be NULL.
UNIQUE = {
    "stg_pitches": ["game_pk", "at_bat_number", "pitch_number"], "stg_games": ["game_pk"],
    "stg_batting_lines": ["game_pk", "player_id"], "stg_standings": ["standings_date", "team_id"],
    "stg_lineups": ["game_pk", "player_id"], "stg_coaches": ["season", "team_id", "person_id", "job_id"],
    "stg_war_seasons": ["player_id", "season", "stint"],
    "stg_war_snapshots": ["player_id", "season", "stint", "snapshot_date"],
    "int_game_starters": ["game_pk", "pitching_side"], "int_batter_game": ["game_pk", "batter_id"],
    "int_batter_game_platoon": ["game_pk", "batter_id"], "dim_player": ["player_id"],
    "dim_team": ["team_id"], "dim_game": ["game_pk"], "dim_manager": ["season", "team_id"],
    "fct_standings_daily": ["standings_date", "team_id"], "fct_batter_game": ["game_pk", "batter_id"],
    "fct_pitcher_game": ["game_pk", "pitcher_id"], "fct_team_game": ["game_pk", "team_id"],
    "fct_batter_vs_pitcher": ["game_pk", "batter_id", "pitcher_id"],
    "fct_batter_pitchtype": ["batter_id", "pitch_type"], "feat_batter_game": ["game_pk", "batter_id"],
}
NOT_NULL = {
    "stg_pitches": ["game_pk", "game_date", "batter_id"], "stg_games": ["game_pk"],
    "stg_batting_lines": ["hits"], "stg_heartbeat": ["run_at"], "dim_player": ["player_id"],
    "dim_team": ["team_id", "team_code"], "dim_game": ["game_pk"],
    "fct_batter_game": ["game_pk", "batter_id", "game_date", "has_hit"],
    "feat_batter_game": ["game_pk", "batter_id", "game_date", "has_hit", "eb_hit_per_pa_career"],
}
TRUE = {"fct_batter_game": ["pa >= 1", "hits <= ab + walks"]}


#: What the suite reads of the feature frame beside its declared columns: no rolling column but those the leak check names.
EXTRA = {"feat_batter_game": LEAK_COLUMNS, "dim_team": ["team_code"]}


def checked(warehouse, name: str) -> DataFrame:
    """A model for its checks: written with the columns they read, unless the warehouse
    writes it whole or one check alone reads it."""
    columns = list(dict.fromkeys([*UNIQUE.get(name, []), *NOT_NULL.get(name, []), *EXTRA.get(name, [])]))
    df = getattr(warehouse, name)
    once = (name in UNIQUE) + (name in NOT_NULL) + (name in EXTRA) < 2
    return df if once or warehouse.writes(name) else store(df.select(*columns), f"checked-{name}")


def suite(warehouse, models: Sequence[str] | None = None) -> DataFrame:
    """Declared tests of the given models (default: all) as one table."""
    def wanted(name: str) -> bool:
        return models is None or name in models

    read = {m: checked(warehouse, m) for m in {**UNIQUE, **NOT_NULL, **TRUE} if wanted(m)}
    checks = [check_unique(read[m], keys, m) for m, keys in UNIQUE.items() if wanted(m)]
    if wanted("dim_team"):
        checks.append(check_unique(read["dim_team"], ["team_code"], "dim_team"))
    checks += [check_not_null(read[m], cols, m) for m, cols in NOT_NULL.items() if wanted(m)]
    checks += [check_expr(read[m], e, m) for m, es in TRUE.items() for e in es if wanted(m)]
    if wanted("fct_batter_game"):
        checks.append(check_accepted(read["fct_batter_game"], "has_hit", [0, 1], "fct_batter_game"))
    if wanted("feat_batter_game"):
        checks.append(check_leakage(read["feat_batter_game"]))
    if wanted("dim_venue"):
        checks.append(_row(overlapping(warehouse.dim_venue, "venue_id"), "no overlap dim_venue", F.count(F.lit(1))))
    return reduce(DataFrame.unionByName, checks)


def run_checks(checks: DataFrame) -> DataFrame:
    """Raise when any check has failures; one row per declared check is read."""
    red = checks.filter("failures > 0").collect()
    if red:
        raise CheckFailed("; ".join(f"{r['check']}: {r['failures']}" for r in red))
    return checks
