"""DuckDB statement per registered query."""

from __future__ import annotations

from oracle import fitting, planes, studies
from oracle.models import compose
from slatecast.functions.pitch_flags import FLAGS
from slatecast.plans import features as f

DIGITS = 10


def rounded(source: str, columns, digits: int = DIGITS) -> str:
    swaps = ", ".join(f"round({c}, {digits}) as {c}" for c in columns)
    return f"select * replace ({swaps}) from {source}"


_FORM = [c for c in f.PITCHER_COLUMNS if c != "p_starts_prior"]
_DOUBLES = ["league_hit_per_pa_entering", "eb_hit_per_pa_career", "eb_hit_per_pa_season", *f.ROLLED,
            *f.PLATOON_ROLLED, *_FORM, *f.OFFENSE, *f.DEFENSE, "war_prev_season", "win_pct_entering"]

_PLAIN = ["stg_pitches", "stg_games", "stg_batting_lines", "stg_lineups", "stg_standings", "stg_coaches",
          "stg_war_seasons", "stg_war_snapshots", "int_batter_game", "int_batter_game_platoon",
          "int_game_starters", "dim_game", "dim_manager", "dim_player", "dim_team",
          "fct_standings_daily", "fct_batter_game", "fct_pitcher_game", "fct_team_game",
          "fct_batter_vs_pitcher", "fct_batter_pitchtype", "slate_sides", "projected_lineup"]

FINAL: dict[str, str] = {name: f"select * from {{{name}}}" for name in _PLAIN}
FINAL |= {
    "int_league_daily": rounded("{int_league_daily}", ["league_hit_per_pa"]),
    "int_pitcher_rolling": rounded("{int_pitcher_rolling}", _FORM),
    "int_team_rolling": rounded("{int_team_rolling}", [
        "team_hits_roll15", "team_runs_roll15", "team_pa_roll15", "team_hits_allowed_per_bf_roll15",
        "team_xwoba_against_roll15", "team_k_pct_against_roll15"]),
    "feat_batter_game": rounded("{feat_batter_game}", _DOUBLES),
    "pitch_flags": f"select game_pk, at_bat_number, pitch_number, {', '.join(FLAGS)} from {{flags}}",
    "rolling_hit_rate": """
        select h.game_pk, h.game_date, h.batter_id, h.has_hit, h.game_idx,
               round(h.has_hit_roll10, 10) as has_hit_roll10,
               round(x.eb_hit_per_pa_career, 10) as eb_hit_per_pa_career
        from {history} h join {feat_batter_game} x using (game_pk, batter_id)""",
    "slate_roster": "select * from {slate_roster}",
    "feat_slate": rounded("{feat_slate}", _DOUBLES),
    "current_form": f"""
        select batter_id, player_name, c_pa as career_pa_prior, c_hits as career_hits_prior,
               c_games as career_games_prior, run_hit as hit_streak_entering,
               run_miss as hitless_streak_entering, {', '.join(f'round({c}, 10) as {c}' for c in f.ROLLED)}
        from {{form_now}}""",
    "backtest_daily": """
        select p.*, row_number() over (partition by p.slate_date, p.game_pk, p.batter_id
                                       order by run_ts desc, model_version desc, p_hit desc) = 1 as is_latest,
               o.has_hit, o.hits, o.pa, o.has_hit is not null as graded
        from {predictions} p
        left join {fct_batter_game} o on o.game_pk = p.game_pk and o.batter_id = p.batter_id""",
    "slate_summary": """
        select count(*) as n_batters, count(distinct game_pk) as n_games,
               round(avg(if(lineup_confirmed, 1, 0)), 10) as share_confirmed
        from {predictions}""",
    "slate_top10": """
        select player_name, batting_order_slot, p_hit from {predictions}
        order by p_hit desc, game_pk, batter_id limit 10""",
}


def statements() -> dict[str, str]:
    own, small = studies.sized(studies.OWN), studies.sized(studies.SMALL_GROUPS)
    out = {name: compose(text, own) for name, text in {**FINAL, **studies.FINAL, **planes.FINAL, **fitting.FINAL}.items()}
    out |= {f"{name}_small_groups": compose(studies.FINAL[name], small) for name in studies.SIZED}
    return out
