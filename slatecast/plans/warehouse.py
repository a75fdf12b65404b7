"""All models of one set of landed tables, each built once on first use.

Views stay lazy; models named in ``tables`` are written to the shared folder
when first needed and read back by everything above them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from slatecast import adapter
from slatecast.functions.pitch_flags import pitch_flags
from slatecast.plans import features, history, intermediate, marts, research, slate, staging
from slatecast.session import store, store_by
from slatecast.sources.readers import empty

# read by several models each, or small and joined to a fact: written once, so
# that the planner knows their size
TABLES = ("stg_pitches", "stg_games", "batter_game_by_hand", "fct_batter_game", "fct_pitcher_game", "fct_team_game",
          "int_league_daily", "dim_manager", "fct_standings_daily")

# met again by game, alone or within a longer key: written in buckets of it
BY_GAME = {"stg_pitches", "stg_games", "batter_game_by_hand", "fct_batter_game"}


class Warehouse:
    """``kept`` names, for a written table, the only columns that its readers need."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], tables: Iterable[str] = TABLES,
                 kept: Mapping[str, Sequence[str]] | None = None):
        self.spark = spark
        # sides that both lie by game meet there on (game, batter) as well
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        # longer generated methods are never compiled by the JVM: such a stage runs operator by operator
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
        # a task holds the rows of one bucket, which need no sort by bucket before they are written
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "2")
        self._raw = raw
        self._tables = set(tables)
        self._kept = dict(kept or {})
        self._built: dict[str, DataFrame] = {}

    def raw(self, name: str, by: str | None = None) -> DataFrame:
        """A landed table; an absent one is an empty typed table.

        Where the source derives it, ``by`` asks for the rows of a key together.
        """
        return self._raw.get(name) if name in self._raw else empty(self.spark, name)

    def __getattr__(self, name: str) -> DataFrame:
        builder = _BUILDERS.get(name)
        if builder is None:
            raise AttributeError(name)
        if name not in self._built:
            df = builder(self)
            if name in self._tables:
                df = df.select(*self._kept.get(name, df.columns))
                df = store_by(df, name, "game_pk") if name in BY_GAME else store(df, name)
            self._built[name] = df
        return self._built[name]

    def writes(self, name: str) -> bool:
        """Whether a model is written whole when first needed."""
        return name in self._tables

    def together(self, *names: str) -> list[DataFrame]:
        """Independent models, built at the same time on top of the staged pitches."""
        if any(n not in self._built for n in names):
            self.stg_pitches, self.stg_games, self.fct_standings_daily   # shared, or small
            with ThreadPoolExecutor(len(names)) as pool:
                list(pool.map(lambda n: getattr(self, n), names))
        return [getattr(self, n) for n in names]

    def features_with(self, columns: Sequence[str]) -> DataFrame:
        """These columns of the training frame (the fact's included), unwritten.

        Only models that hold one of them are built, and the fact is written with
        the columns that they are built from.
        """
        need = features.fact_columns(columns)

        def parent(name: str, model: str) -> DataFrame | None:
            return getattr(self, model) if set(need) & set(marts.BROUGHT[name]) else None

        def batter_games() -> DataFrame:
            games = marts.dim_game(self.stg_games, parent("starters", "int_game_starters"))
            fact = marts.fct_batter_game(
                self.stg_batting_lines, games, parent("batter_games", "int_batter_game"),
                parent("platoon", "int_batter_game_platoon"), parent("standings", "fct_standings_daily"),
                parent("managers", "dim_manager"))
            return store_by(fact.select(*need), "fct_batter_game", "game_pk")

        self.stg_pitches, self.stg_games    # shared by the facts, which are written at the same time
        others = [fact for name, fact in (("pitcher_rolling", "fct_pitcher_game"), ("team_rolling", "fct_team_game"))
                  if self.writes(fact) and set(columns) & set(features.READ_FROM[name])]
        with ThreadPoolExecutor(1 + len(others)) as pool:
            made = [pool.submit(batter_games), *[pool.submit(getattr, self, other) for other in others]]
        fact = [m.result() for m in made][0]

        def read(name: str, build: Callable[[], DataFrame]) -> DataFrame | None:
            return build() if set(columns) & set(features.READ_FROM[name]) else None

        return features.feat_batter_game(
            fact, read("league_daily", lambda: store(intermediate.int_league_daily(fact), "int_league_daily")),
            read("pitcher_rolling", lambda: self.int_pitcher_rolling), read("team_rolling", lambda: self.int_team_rolling),
            read("war", lambda: self.stg_war_seasons), columns=columns)

    def feat_slate(self, date: str) -> DataFrame:
        self.together("fct_batter_game", "fct_pitcher_game", "fct_team_game")
        return slate.feat_slate(self.dim_game, self.stg_lineups, self.fct_batter_game,
                                self.fct_pitcher_game, self.fct_team_game, self.fct_standings_daily,
                                self.stg_war_seasons, self.dim_player, date)


def _features(w: Warehouse, keep: Sequence[str] = ()) -> DataFrame:
    w.together("fct_batter_game", "fct_pitcher_game", "fct_team_game")
    return features.feat_batter_game(w.fct_batter_game, w.int_league_daily, w.int_pitcher_rolling, w.int_team_rolling,
                                     w.stg_war_seasons, keep)


_BUILDERS = {
    "stg_pitches": lambda w: staging.stg_pitches(w.raw("pitches", by="game_pk")),
    "stg_games": lambda w: staging.stg_games(w.raw("games", by="game_pk")),
    "stg_batting_lines": lambda w: staging.stg_batting_lines(w.raw("batting_lines")),
    "stg_lineups": lambda w: staging.stg_lineups(w.raw("lineups")),
    "stg_standings": lambda w: staging.stg_standings(w.raw("standings")),
    "stg_coaches": lambda w: staging.stg_coaches(w.raw("coaches")),
    "stg_war_seasons": lambda w: staging.stg_war_seasons(w.raw("war_seasons")),
    "stg_war_snapshots": lambda w: staging.stg_war_snapshots(w.raw("war_snapshots")),
    "stg_heartbeat": lambda w: staging.stg_heartbeat(w.raw("heartbeat")),
    "int_pitch_flags": lambda w: pitch_flags(w.stg_pitches),
    "batter_game_by_hand": lambda w: intermediate.batter_game_by_hand(w.int_pitch_flags),
    "int_batter_game": lambda w: intermediate.int_batter_game(w.batter_game_by_hand),
    "int_batter_game_platoon": lambda w: intermediate.int_batter_game_platoon(w.batter_game_by_hand),
    "int_game_starters": lambda w: intermediate.int_game_starters(w.stg_pitches),
    "int_league_daily": lambda w: intermediate.int_league_daily(w.fct_batter_game),
    "int_pitcher_rolling": lambda w: intermediate.int_pitcher_rolling(w.fct_pitcher_game),
    "int_team_rolling": lambda w: intermediate.int_team_rolling(w.fct_team_game),
    "dim_game": lambda w: marts.dim_game(w.stg_games, w.int_game_starters),
    "dim_venue": lambda w: history.dim_venue(w.stg_games),
    "dim_manager": lambda w: marts.dim_manager(w.stg_coaches),
    "dim_player": lambda w: marts.dim_player(w.stg_pitches, w.stg_batting_lines),
    "batter_sides": lambda w: marts.batter_sides(w.stg_pitches),
    "dim_team": lambda w: marts.dim_team(w.stg_games, w.stg_pitches),
    "fct_standings_daily": lambda w: marts.fct_standings_daily(w.stg_standings),
    "fct_batter_game": lambda w: marts.fct_batter_game(
        w.stg_batting_lines, w.dim_game, w.int_batter_game, w.int_batter_game_platoon,
        w.fct_standings_daily, w.dim_manager),
    "fct_pitcher_game": lambda w: marts.fct_pitcher_game(w.int_pitch_flags, w.int_game_starters),
    "fct_team_game": lambda w: marts.fct_team_game(w.stg_batting_lines, w.int_pitch_flags, w.dim_team),
    "fct_batter_vs_pitcher": lambda w: marts.fct_batter_vs_pitcher(w.int_pitch_flags),
    "fct_batter_pitchtype": lambda w: marts.fct_batter_pitchtype(w.int_pitch_flags),
    "feat_batter_game": lambda w: _features(w),
    # with the fact's columns that studies need: no join back to it
    "feat_research": lambda w: _features(w, research.FACT_COLUMNS),
}


class StarWarehouse(Warehouse):
    """Warehouse whose landed tables are derived from the star schema."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables: Iterable[str] = TABLES,
                 kept: Mapping[str, Sequence[str]] | None = None):
        super().__init__(spark, {}, tables, kept)
        self._star = adapter.star_tables(spark, sf_dir)

    def raw(self, name: str, by: str | None = None) -> DataFrame:
        key = name if name == "predictions" else f"raw_{name}"
        if key not in adapter.ADAPTER:
            return super().raw(name)
        text, inputs = adapter.ADAPTER[key], dict(self._star)
        for model in ("stg_pitches", "fct_batter_game"):
            if "{" + model + "}" in text:
                inputs[model] = getattr(self, model)
        for landed in ("war_seasons", "batting_lines"):
            if "{raw_" + landed + "}" in text:
                inputs[f"raw_{landed}"] = self.raw(landed)
        return adapter.derive(self.spark, key, inputs, by)
