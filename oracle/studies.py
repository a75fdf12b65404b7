"""DuckDB models of the studies, scores, checks and generic operators."""

from __future__ import annotations

from oracle.models import MODELS as BASE
from oracle.models import first_per, words
from slatecast.functions.pitch_flags import PITCH_TYPES
from slatecast.plans import research as rs
from slatecast.plans.quality import NOT_NULL, TRUE, UNIQUE
from slatecast.queries import DRIFTING, FRESHNESS, FRESHNESS_NOW, OWN, PARITY, SMALL_GROUPS

MODELS = dict(BASE)


def wilson(k: str, n: str) -> dict[str, str]:
    p, z2 = f"(cast({k} as double) / {n})", "3.8416"
    mid = f"({p} + {z2} / (2 * cast({n} as double)))"
    half = f"1.96 * sqrt(greatest({p} * (1 - {p}), 0) / {n} + {z2} / (4 * cast({n} as double) * {n}))"
    return {s: f"(({mid} {sign} {half}) / (1 + {z2} / cast({n} as double)))"
            for s, sign in (("lo", "-"), ("hi", "+"))}


def edge_list(values: str, bins: int) -> str:
    """Interpolated quantile edges of a sorted list, smallest first."""
    at = f"((len({values}) - 1) * (cast(i as double) / {bins}))"
    lo = f"{values}[cast(floor({at}) as bigint) + 1]"
    hi = f"{values}[cast(ceil({at}) as bigint) + 1]"
    return f"[{lo} + ({hi} - {lo}) * ({at} - floor({at})) for i in range({bins + 1})]"


def bin_number(value: str, cuts: str) -> str:
    return (f"case when len({cuts}) > 1 and {value} >= {cuts}[1] and {value} <= {cuts}[-1] "
            f"then greatest(len(list_filter({cuts}, lambda e: e < {value})), 1) end")


def average_rank(by: str, x: str) -> str:
    return (f"rank() over (partition by {by} order by {x}) "
            f"+ (count(*) over (partition by {by}, {x}) - 1) / 2")


def rank_ic(source: str, by: str, x: str, y: str) -> str:
    """Spearman as Pearson on average ranks; NULL for few pairs or a constant."""
    return f"""
        select {by}, count(*) as n_pairs,
               case when count(*) >= 30 and min(rx) < max(rx) and min(ry) < max(ry) then round(corr(rx, ry), 14) end as ic
        from (select *, {average_rank(by, x)} as rx, {average_rank(by, y)} as ry
              from (select * from {source} where {x} is not null and {y} is not null))
        group by {by}"""


_COLS = list(rs.FACTORS.values())
_DOUBLE = ", ".join(f"round(cast({c} as double), 10) as {c}" for c in _COLS)
MODELS["long_factors"] = f"""
    select season, month, has_hit, ctl as pa_roll10, factor, value
    from (unpivot (select season, month, has_hit, round(pa_roll10, 10) as ctl, {_DOUBLE} from {{feat_batter_game}})
          on {', '.join(_COLS)} into name factor value value)"""
# unpivot drops NULL values, so sizes come from the frame itself
MODELS["month_sizes"] = "select season, month, count(*) as n from {feat_batter_game} group by 1, 2"
MODELS["monthly_ic"] = f"""
    with ic as ({rank_ic('{long_factors}', 'factor, season, month', 'value', 'has_hit')})
    select ic.factor, ic.season, ic.month, ic.ic, m.n
    from ic join {{month_sizes}} m using (season, month)
    where ic.n_pairs >= @month_rows@ and ic.ic is not null"""


def binned(source: str, by: str, value: str, bins: int) -> str:
    cuts = f"list_sort(list_distinct({edge_list('vals', bins)}))"
    return f"""
        select s.*, e.cuts, {bin_number(f's.{value}', 'e.cuts')} as bin
        from {source} s
        join (select {by}, {cuts} as cuts
              from (select {by}, list({value} order by {value}) as vals from {source}
                    where {value} is not null group by {by})) e using ({by})"""


MODELS["decile_table"] = f"""
    with b as ({binned('{long_factors}', 'factor', 'value', 10)})
    select factor, row_number() over (partition by factor order by bin) as decile, mid, n, rate, lo, hi
    from (select factor, bin, any_value((cuts[bin] + cuts[bin + 1]) / 2) as mid, count(*) as n,
                 avg(has_hit) as rate, {wilson('sum(has_hit)', 'count(*)')['lo']} as lo,
                 {wilson('sum(has_hit)', 'count(*)')['hi']} as hi
          from b where bin is not null group by factor, bin)"""
MODELS["controlled_source"] = "select factor, value, has_hit, pa_roll10 from {long_factors} where pa_roll10 is not null"
MODELS["controlled_bands"] = binned("{controlled_source}", "factor", "pa_roll10", 3)
MODELS["controlled_ic"] = f"""
    with ic as ({rank_ic('(select * from {controlled_bands} where bin is not null)', 'factor, bin', 'value', 'has_hit')})
    select factor, if(sum(n_pairs) >= 1000, avg(ic), null) as pa_controlled_ic from ic group by factor"""

_KEYS = ", ".join(f"('{k}', '{c}')" for k, c in rs.FACTORS.items())


def verdicts(keys: str, ic: str, controlled: str) -> str:
    return f"""
        with keys(key, factor) as (values {keys}),
        mid as (select factor, median(ic) as m, count(*) as months, count(distinct season) as seasons
                from {ic} group by factor),
        stats as (select factor, any_value(m) as m, any_value(months) as months, any_value(seasons) as seasons,
                         avg(if(sign(ic) = if(m < 0, -1, 1), 1, 0)) as stable
                  from {ic} join mid using (factor) group by factor)
        select key, factor,
               case when months is null then 'NO-DATA'
                    when seasons >= 3 and stable >= 0.70 then if(abs(m) >= 0.01, 'PROMOTE', 'WEAK')
                    else 'REJECT' end as verdict,
               m as median_ic, stable as sign_stability, coalesce(months, 0) as n_months, c.pa_controlled_ic
        from keys left join stats using (factor) left join {controlled} c using (factor)"""


MODELS["study_continuous"] = verdicts(_KEYS, "{monthly_ic}", "{controlled_ic}")

MODELS["research_frame"] = f"""
    select {', '.join(f'f.{c}' for c in dict.fromkeys(rs._FRAME))}, b.venue_name, b.manager_name,
           v.bvp_pa_career, v.bvp_hits_per_pa, p.bats, t.team_code as opponent_code
    from {{feat_batter_game}} f
    join {{fct_batter_game}} b using (game_pk, batter_id)
    left join {{fct_batter_vs_pitcher}} v on v.game_pk = f.game_pk and v.batter_id = f.batter_id
                                        and v.pitcher_id = f.opp_starter_id
    left join {{dim_player}} p on p.player_id = f.batter_id
    left join {{dim_team}} t on t.team_id = f.opponent_team_id"""
MODELS["met_pairs"] = f"""
    select 'bvp_hits_per_pa' as factor, season, month, has_hit, round(pa_roll10, 10) as pa_roll10, bvp_hits_per_pa as value
    from {{research_frame}} where bvp_pa_career >= @bvp_pa@ and bvp_hits_per_pa is not null"""
MODELS["met_months"] = f"""
    select factor, season, month, ic from ({rank_ic('{met_pairs}', 'factor, season, month', 'value', 'has_hit')})
    where n_pairs >= @bvp_month_rows@ and ic is not null"""
MODELS["met_control"] = "select * from {met_pairs} where pa_roll10 is not null"
MODELS["met_bands"] = binned("{met_control}", "factor", "pa_roll10", 3)
MODELS["met_controlled"] = f"""
    with ic as ({rank_ic('(select * from {met_bands} where bin is not null)', 'factor, bin', 'value', 'has_hit')})
    select factor, if(sum(n_pairs) >= @bvp_controlled@, avg(ic), null) as pa_controlled_ic from ic group by factor"""
MODELS["bvp_study"] = verdicts("('24_bvp', 'bvp_hits_per_pa')", "{met_months}", "{met_controlled}")

MODELS["daily_tiers"] = """
    with teams as (
        select game_date, opponent_team_id, arg_min(opp_xwoba_against_roll15, game_pk) as x
        from {feat_batter_game} where opp_xwoba_against_roll15 is not null group by 1, 2)
    select game_date, opponent_team_id,
           case when row_number() over (partition by game_date order by x, opponent_team_id) <= 5 then 'top-5 pitching'
                when row_number() over (partition by game_date order by x desc, opponent_team_id desc) <= 5 then 'bottom-5 pitching'
                else 'middle' end as tier
    from teams"""
_STUDIES = {k: c for k, (c, _) in rs.CATEGORIES.items()}
_STUDIES |= {
    "07_platoon_adv": "if(bats is null or opp_starter_throws is null, null, if(bats = 'S', 'switch', "
                      "if(bats = opp_starter_throws, 'same hand', 'opposite hand')))",
    "05b_actual_pa": "least(pa, 6)", "23_pitching_tiers": "tier"}
_ONE = " union all ".join(
    f"select '{k}' as key, cast({c} as varchar) as level, has_hit, hits, pa from tiered" for k, c in _STUDIES.items())
_ORDERS = {k: v for k, (_, v) in rs.CATEGORIES.items() if v}
_ORDERS |= {"07_platoon_adv": rs.MATCHUPS, "05b_actual_pa": [1, 2, 3, 4, 5, 6], "23_pitching_tiers": rs.TIERS}
_PLACES = ", ".join(f"('{k}', '{v}', {i})" for k, vs in _ORDERS.items() for i, v in enumerate(vs))
_ENDS = " or ".join(
    f"(key = '{k}' and (levels <= {2 * n} or low <= {n} or high <= {n}))" for k, n in rs.TOP_BOTTOM.items())
MODELS["study_categorical"] = f"""
    with tiered as (select f.*, t.tier from {{research_frame}} f
                    left join {{daily_tiers}} t using (game_date, opponent_team_id)),
    places(key, level, place) as (values {_PLACES}),
    g as (select key, level, count(*) as n, cast(sum(has_hit) as bigint) as k,
                 avg(has_hit) as rate, cast(sum(hits) as double) / sum(pa) as hits_per_pa,
                 {wilson('sum(has_hit)', 'count(*)')['lo']} as lo, {wilson('sum(has_hit)', 'count(*)')['hi']} as hi
          from ({_ONE}) where level is not null group by key, level having count(*) >= @category_rows@),
    r as (select *, count(*) over (partition by key) as levels,
                 row_number() over (partition by key order by rate, level) as low,
                 row_number() over (partition by key order by rate desc, level desc) as high from g)
    select r.key, r.level, r.n, r.k, r.rate, r.hits_per_pa, r.lo, r.hi, cast(p.place as integer) as place
    from r left join places p on p.key = r.key and p.level = r.level
    where ((r.key not in ({words(_ORDERS)}) or p.place is not null) and r.key not in ({words(rs.TOP_BOTTOM)}))
       or {_ENDS.replace('key', 'r.key')}"""
MODELS["study_scoreboard"] = """
    select key, factor, verdict, median_ic, sign_stability, n_months, pa_controlled_ic, cast(null as double) as spread
    from {study_continuous}
    union all by name
    select * from {bvp_study}
    union all by name
    select key, 'CONTEXT' as verdict, max(rate) - min(rate) as spread from {study_categorical} group by key
    union all by name
    select '25_pitch_type' as key, 'pitch_type' as factor, 'CONTEXT' as verdict, max(ba) - min(ba) as spread
    from {pitchtype_league}
    union all by name
    select '26_streak_buckets' as key, 'hit_streak_entering' as factor, 'CONTEXT' as verdict,
           max(abs(residual)) as spread
    from {streak_buckets}"""
MODELS["streak_buckets"] = f"""
    select *, rate - expected as residual from (
        select case when hit_streak_entering >= 10 then '10+' when hit_streak_entering >= 5 then '5-9'
                    when hit_streak_entering >= 3 then '3-4' else cast(hit_streak_entering as varchar) end as bucket,
               count(*) as n, cast(sum(has_hit) as bigint) as k, avg(has_hit) as rate,
               avg(1 - pow(1 - eb_hit_per_pa_career, pa)) as expected,
               {wilson('sum(has_hit)', 'count(*)')['lo']} as lo, {wilson('sum(has_hit)', 'count(*)')['hi']} as hi
        from {{feat_batter_game}} where hit_streak_entering < 100 group by 1)"""
MODELS["pitchtype_league"] = f"""
    select pitch_type, cast(sum(hits) as double) / nullif(sum(ab_ended), 0) as ba, cast(sum(pitches_seen) as bigint) as n
    from {{fct_batter_pitchtype}} where pitch_type in ({words(PITCH_TYPES)}) group by 1"""
MODELS["pitchtype_matrix"] = f"""
    with busy as (select batter_id from {{fct_batter_pitchtype}} group by 1
                  order by sum(pitches_seen) desc, batter_id limit 25)
    select p.player_name, {', '.join(f"avg(t.ba) filter (where t.pitch_type = '{c}') as {c}" for c in PITCH_TYPES)}
    from {{fct_batter_pitchtype}} t join busy using (batter_id)
    join {{dim_player}} p on p.player_id = t.batter_id
    where t.ab_ended >= @matrix_ab@ and t.pitch_type in ({words(PITCH_TYPES)}) group by 1"""

# ---- evaluation ---------------------------------------------------------------

MODELS["starters"] = """
    select * replace (if(is_home, 1.0::double, 0.0::double) as is_home)
    from {feat_batter_game} where batting_order_slot is not null and not coalesce(is_substitute, false)"""
MODELS["scored"] = """
    with m as (select median(pa_roll10) as fill from {starters})
    select s.*, cast((game_pk * 31 + batter_id * 7) % 128 as double) / 128 as p_model,
           if(season_pa_prior >= 50, cast(season_hits_prior as double) / season_pa_prior, -1) as ba_bench,
           1 - pow(1 - eb_hit_per_pa_career, least(greatest(coalesce(pa_roll10, m.fill), 1), 6)) as eb_pa
    from {starters} s join m on true"""
_Q = "least(greatest(p, 1e-6::double), 1 - 1e-6::double)"
_LL = f"avg(-(has_hit * ln({_Q}) + (1 - has_hit) * ln(1 - {_Q})))"
MODELS["by_model"] = """
    select 'model' as model, p_model as p, game_date, game_pk, batter_id, has_hit from {scored}
    union all select 'eb_pa', eb_pa, game_date, game_pk, batter_id, has_hit from {scored}"""
MODELS["metric_rows"] = f"""
    select model, {_LL} as log_loss, avg(({_Q} - has_hit) * ({_Q} - has_hit)) as brier,
           cast(sum(if(has_hit = 1, r, 0)) - sum(has_hit) * (sum(has_hit) + 1) / 2 as double)
               / (sum(has_hit) * (count(*) - sum(has_hit))) as auc, count(*) as n
    from (select *, {average_rank('model', _Q)} as r from {{by_model}}) group by model"""
MODELS["top_k_rates"] = """
    select model, avg(has_hit) filter (where r <= 5) as top5_hit_rate, avg(has_hit) filter (where r <= 10) as top10_hit_rate
    from (select *, row_number() over (partition by model, game_date order by p desc, game_pk, batter_id) as r
          from {by_model}) group by model"""
MODELS["tiered"] = f"""
    select s.*, b.bin,
           case b.bin when 1 then 'Q1 weakest' when 2 then 'Q2' when 3 then 'Q3' when 4 then 'Q4 strongest' end as quality,
           case when pa_roll10 <= 0 then null when pa_roll10 <= 3.5 then '<3.5' when pa_roll10 <= 4.2 then '3.5-4.2'
                when pa_roll10 <= 10 then '>4.2' end as pa_band
    from {{scored}} s join (
        select game_pk, batter_id, bin
        from ({binned('{quality_source}', 'one', 'eb_hit_per_pa_career', 4)})) b using (game_pk, batter_id)"""
MODELS["quality_source"] = "select game_pk, batter_id, eb_hit_per_pa_career, 1 as one from {scored}"


def loss_of(p: str) -> str:
    return _LL.replace("least(greatest(p,", f"least(greatest({p},")


def stacked(dims: dict[str, str], measures: str) -> str:
    return " union all ".join(
        f"select '{d}' as dimension, cast({c} as varchar) as level, {measures} from {{tiered}} "
        f"where {c} is not null group by {c}" for d, c in dims.items())


MODELS["tier_table"] = stacked(
    {"quality": "quality", "pa_band": "pa_band"},
    f"count(*) as n, avg(has_hit) as base_rate, {loss_of('p_model')} as logloss_model, {loss_of('eb_pa')} as logloss_eb_pa")
_QM = _Q.replace("(p,", "(p_model,")
MODELS["slice_table"] = stacked(
    {"month": "month", "quality": "quality", "is_home": "is_home"},
    f"count(*) as n, avg(has_hit) as base_rate, avg({_QM}) as mean_pred, "
    f"avg(has_hit) - avg({_QM}) as cal_gap, {loss_of('p_model')} as log_loss")
MODELS["calibration_buckets"] = """
    select floor(p_model * 20) / 20 as bucket, count(*) as n, avg(p_model) as pred, avg(has_hit) as obs,
           avg(has_hit) - avg(p_model) as gap from {scored} group by 1"""
MODELS["picks"] = """
    select *, row_number() over (partition by picker, game_date order by score desc, game_pk, batter_id) as pick
    from (select 'model' as picker, p_model as score, game_date, game_pk, batter_id, has_hit from {scored}
          union all select 'season_ba', ba_bench, game_date, game_pk, batter_id, has_hit from {scored}
          union all select 'eb_shrunk', eb_hit_per_pa_career, game_date, game_pk, batter_id, has_hit from {scored})
    qualify pick <= 10"""
MODELS["picker_table"] = """
    with sized as (select *, unnest([5, 10]) as k from {picks}),
    islands as (
        select k, picker, has_hit, sum(has_hit) over (partition by k, picker order by game_date, pick) as island
        from sized where pick <= k),
    runs as (select k, picker, max(len) as worst from (
                 select k, picker, island, count(*) filter (where has_hit = 0) as len from islands group by 1, 2, 3)
             group by 1, 2)
    select i.k, i.picker, count(*) as picks, avg(i.has_hit) as hit_rate, any_value(r.worst) as worst_miss_streak
    from islands i join runs r using (k, picker) group by 1, 2"""
MODELS["picker_curve"] = """
    select picker, game_date, daily_rate, avg(daily_rate) over (partition by picker order by game_date) as running_rate
    from (select picker, game_date, avg(has_hit) as daily_rate from {picks} where pick <= 5 group by 1, 2)"""
MODELS["temporal_splits"] = """
    with t as (from {starters} where season between 2021 and 2024), c as (from {starters} where season = 2025),
    e as (select max(game_date) as top from t),
    ordinal as (select game_date, row_number() over (order by game_date) as r, count(*) over () as n from c),
    mid as (select max(game_date) as d from ordinal where r <= (n + 1) // 2),
    parts as (
        select 'train' as split, game_date, pow(0.5::double, cast(e.top - game_date as double) / 730) as w from t, e
        union all select 'train_fit', game_date, null from t, e where game_date <= e.top - 67
        union all select 'train_tail', game_date, null from t, e where game_date > e.top - 60
        union all select 'calib_fit', game_date, null from c, mid where game_date <= mid.d
        union all select 'calib_eval', game_date, null from c, mid where game_date > mid.d
        union all select 'test', game_date, null from {starters} where season = 2026)
    select n.split, count(game_date) as n, min(game_date) as first_date, max(game_date) as last_date, sum(w) as weight
    from (select unnest(['train', 'train_fit', 'train_tail', 'calib_fit', 'calib_eval', 'test']) as split) n
    left join parts using (split) group by n.split"""

# ---- quality ------------------------------------------------------------------


def _unique(model: str, keys: list[str]) -> str:
    cols = ", ".join(keys)
    return (f"select 'unique {model}({cols})' as check, count(*) as failures from "
            f"(select 1 from {{{model}}} group by {cols} having count(*) > 1)")


_CHECKS = [_unique(m, k) for m, k in UNIQUE.items()] + [_unique("dim_team", ["team_code"])]
_CHECKS += [f"select 'not_null {m}.{c}', count(*) from {{{m}}} where {c} is null"
            for m, cols in NOT_NULL.items() for c in cols]
_CHECKS += [f"select 'true {m}: {e}', count(*) from {{{m}}} where not ({e})" for m, es in TRUE.items() for e in es]
_CHECKS += ["select 'accepted fct_batter_game.has_hit', count(*) from {fct_batter_game} where has_hit not in (0, 1)",
            "select 'no leakage feat_batter_game', count(*) from {leakage}"]
MODELS["leakage"] = f"""
    select batter_id, game_pk, game_date from ({first_per('{feat_batter_game}', 'batter_id', 'game_date, game_pk')})
    where career_pa_prior + career_games_prior + season_pa_prior + hit_streak_entering + hitless_streak_entering <> 0
       or coalesce(has_hit_roll5, hit_per_pa_roll40, k_pct_roll10, hit_per_pa_platoon_roll20) is not null
    union all select batter_id, game_pk, game_date from {{feat_batter_game}} where days_rest < 0"""
MODELS["stg_heartbeat"] = "select cast(null as timestamp) as run_at where false"   # nothing landed yet
MODELS["check_suite"] = " union all ".join(_CHECKS)


def _fresh(table: str, newest: str, now: str, warn: int, error: int) -> str:
    age = f"(epoch(timestamp '{now}') - epoch({newest}))"
    return (f"select '{table}' as \"table\", floor({age}) / 3600 as age_hours, "
            f"case when {age} is null or floor({age}) / 3600 > {error} then 'error' "
            f"when floor({age}) / 3600 > {warn} then 'warn' else 'pass' end as state")


MODELS["freshness"] = " union all ".join([
    _fresh(name, {"heartbeat": "cast(null as timestamp)",
                  "pitches": "(select cast(max(game_date) as timestamp) from {raw_pitches})",
                  "war_snapshots": "(select max(cast(snapshot_date as timestamp)) from {raw_war_snapshots})"}.get(
        name, f"(select make_timestamp(max(cast(load_id as bigint)) * 1000000) from {{raw_{name}}})"),
        FRESHNESS_NOW, *hours) for name, hours in FRESHNESS.items() if hours])
_WEEK = "cast(date_trunc('week', cast(game_date as date)) as date)"
MODELS["reconcile"] = f"""
    with a as (select {_WEEK} as wk, count(distinct (game_pk, at_bat_number, pitch_number)) as n from {{raw_pitches}} group by 1),
    b as (select {_WEEK} as wk, count(distinct (game_pk, at_bat_number, pitch_number)) as n from {{raw_pitches}}
          where game_date >= '2021-05-01' and batter % 37 <> 0 group by 1),
    span as (select greatest((select min(wk) from a), (select min(wk) from b)) as lo,
                    least((select max(wk) from a), (select max(wk) from b)) as hi)
    select wk, coalesce(a.n, 0) as a_n, coalesce(b.n, 0) as b_n,
           abs(coalesce(a.n, 0) - coalesce(b.n, 0)) / greatest(coalesce(a.n, 0), 1) as diff_pct,
           abs(coalesce(a.n, 0) - coalesce(b.n, 0)) / greatest(coalesce(a.n, 0), 1) > 0.005::double as mismatch
    from a full join b using (wk) join span on wk between lo and hi"""
_OFF = {m: "0" for m in PARITY}
_OFF["xba_mean"] = "count(*) filter (where game_pk % 5 = 0 and xba_mean is not null)"
_OFF["contact_pct"] = "count(*) filter (where batter_id % 50 = 0 and contact_pct is not null)"
MODELS["parity"] = " union all ".join(
    f"select '{m}' as metric, count(*) as joined_rows, {e} as mismatches, {e} / count(*) as mismatch_rate, "
    f"{e} / count(*) < {'0.90' if m in DRIFTING else '0.005'} as ok from {{int_batter_game}}" for m, e in _OFF.items())
_COVER = {"pitches": "game_date", "games": "official_date", "batting_lines": "official_date",
          "standings": "standings_date", "war_seasons": "year_id", "coaches": "season"}
MODELS["coverage"] = " union all ".join(
    [f"select '{t}' as \"table\", 'ok' as state, count(*) as n, min(cast({c} as varchar)) as first_date, "
     f"max(cast({c} as varchar)) as last_date from {{raw_{t}}}" for t, c in _COVER.items()]
    + ["select 'heartbeat', 'MISSING', null, null, null"])

# ---- generic operators ----------------------------------------------------------

_PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
FINAL = {
    "asof_last_purchase": """
        select e.event_id, e.user_id, e.ts, p.value as last_purchase
        from {events} e asof left join (
            select user_id, ts, max(value) as value from {events} where event_type = 'purchase' group by all) p
          on p.user_id = e.user_id and e.ts > p.ts""",
    "asof_interval": """
        select e.event_id, e.user_id, e.ts, p.value as last_purchase
        from {events} e asof left join (
            select user_id, ts, max(value) as value from {events} where event_type = 'purchase' group by all) p
          on p.user_id = e.user_id and e.ts > p.ts""",
    "error_intervals": """
        select i.*, (select count(*) from {events} e where e.user_id = i.user_id and e.ts >= i.valid_from
                     and (i.valid_to is null or e.ts < i.valid_to)) as n_events
        from (select user_id, max(event_id) as error_id, ts as valid_from,
                     lead(ts) over (partition by user_id order by ts) as valid_to
              from {events} where event_type = 'error' group by user_id, ts) i""",
    "approximate_edges": """
        select factor, cast(edge as integer) as edge, n, true as within
        from (select factor, count(*) as n from {long_factors} where value is not null group by factor),
             (select unnest(range(11)) as edge)""",
    "asof_inclusive": """
        select e.event_id, e.user_id, e.ts, p.event_id as error_id
        from {events} e asof left join (
            select user_id, ts, max(event_id) as event_id from {events} where event_type = 'error' group by all) p
          on p.user_id = e.user_id and e.ts >= p.ts""",
    "asof_league": """
        select g.game_pk, g.official_date, round(l.league_hit_per_pa, 10) as league_hit_per_pa
        from {stg_games} g asof left join {int_league_daily} l on g.official_date > l.game_date""",
    "event_quantiles": "select event_type, count(*) as n, "
                       + ", ".join(f"round(quantile_cont(value, {p}), 8) as q{int(p * 100)}" for p in _PROBS)
                       + " from {events} group by event_type",
    "price_spearman": "select l_returnflag, l_linestatus, n_pairs, round(ic, 8) as ic from ("
                      + rank_ic("{lineitem}", "l_returnflag, l_linestatus", "l_quantity", "l_extendedprice") + ")",
    "longest_event_run": """
        select user_id, max(n) as longest_run from (
            select user_id, island, count(*) filter (where value < 20) as n from (
                select *, sum(if(value >= 20, 1, 0)) over (partition by user_id order by ts, event_id) as island from {events})
            group by 1, 2) group by 1""",
    "user_streaks": """
        select event_id, user_id, ts, row_number() over w as idx,
               sum(round(value)) over prior as v_before, count(*) over prior as n_before,
               sum(round(value)) over (partition by user_id, event_type order by ts, event_id
                                       rows between unbounded preceding and 1 preceding) as v_type_before,
               max(round(value)) over prior as max_before,
               round(avg(round(value)) over (partition by user_id order by ts, event_id
                                             rows between 5 preceding and 1 preceding), 10) as v_recent,
               lag(ts) over w as previous_ts
        from {events}
        window w as (partition by user_id order by ts, event_id),
               prior as (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding)""",
    "modal_return_flag": f"""
        select l_partkey, l_returnflag as flag from ({first_per(
            '(select l_partkey, l_returnflag, count(*) as n from {lineitem} group by all)',
            'l_partkey', 'n desc, l_returnflag')})""",
    "supplier_wilson": f"""
        select l_suppkey, n, k, round({wilson('k', 'n')['lo']}, 10) as lo, round({wilson('k', 'n')['hi']}, 10) as hi,
               round((k + 200 * 0.25::double) / (n + 200), 10) as shrunk
        from (select l_suppkey, count(*) as n, count(*) filter (where l_returnflag = 'R') as k from {{lineitem}} group by 1)""",
}


def rounded(name: str, columns: list[str], digits: int = 10) -> str:
    swaps = ", ".join(f"round({c}, {digits}) as {c}" for c in columns)
    return f"select * replace ({swaps}) from {{{name}}}"


_STATS = ["median_ic", "sign_stability", "pa_controlled_ic"]
_FRAME_DOUBLES = ["win_pct_entering", "eb_hit_per_pa_season", "hit_per_pa_roll40", "p_xwoba_against_roll10",
                  "opp_hits_allowed_per_bf_roll15",
                  *[c for c in _COLS if c not in ("league_rank_entering", "hit_streak_entering", "hitless_streak_entering")]]
FINAL |= {
    "research_frame": rounded("research_frame", [c for c in _FRAME_DOUBLES if c != "win_pct_entering"]),
    "decile_table": rounded("decile_table", ["mid", "rate", "lo", "hi"], 8).replace(
        "select *", "select * replace (cast(decile as integer) as decile) from (select *") + ")",
    "monthly_ic": rounded("monthly_ic", ["ic"], 8),
    "controlled_ic": rounded("controlled_ic", ["pa_controlled_ic"], 8),
    "study_continuous": rounded("study_continuous", _STATS, 8),
    "bvp_study": rounded("bvp_study", _STATS, 8),
    "study_categorical": rounded("study_categorical", ["rate", "hits_per_pa", "lo", "hi"]),
    "study_scoreboard": rounded("study_scoreboard", [*_STATS, "spread"], 8),
    "daily_tiers": "select * from {daily_tiers}",
    "streak_buckets": rounded("streak_buckets", ["rate", "expected", "lo", "hi", "residual"]),
    "pitchtype_league": rounded("pitchtype_league", ["ba"]),
    "pitchtype_matrix": rounded("pitchtype_matrix", PITCH_TYPES),
    "metric_rows": rounded("metric_rows", ["log_loss", "brier", "auc"], 8),
    "top_k_rates": rounded("top_k_rates", ["top5_hit_rate", "top10_hit_rate"]),
    "tier_table": rounded("tier_table", ["base_rate", "logloss_model", "logloss_eb_pa"], 8),
    "slice_table": rounded("slice_table", ["base_rate", "mean_pred", "cal_gap", "log_loss"], 8),
    "calibration_buckets": rounded("calibration_buckets", ["pred", "obs", "gap"]),
    "picker_table": rounded("picker_table", ["hit_rate"]),
    "picker_curve": rounded("picker_curve", ["daily_rate", "running_rate"]),
    "temporal_splits": rounded("temporal_splits", ["weight"], 6),
    "check_suite": "select * from {check_suite}",
    "leakage": "select * from {leakage}",
    "freshness": rounded("freshness", ["age_hours"]),
    "reconcile": rounded("reconcile", ["diff_pct"]),
    "parity": rounded("parity", ["mismatch_rate"]),
    "coverage": "select * from {coverage}",
    "stream_dedup": "select distinct game_pk, at_bat_number, pitch_number from {raw_pitches}",
    "stream_latest": first_per("{raw_games}", "game_pk", "load_id desc"),
    "stream_grade": """
        select p.game_pk, p.batter_id, p.slate_date, p.p_hit, p.model_version, f.has_hit, f.hits, f.pa
        from {predictions} p join {fct_batter_game} f using (game_pk, batter_id)""",
}

# group-size thresholds are written @so@ above
SIZED = ["monthly_ic", "study_continuous", "bvp_study", "study_categorical", "study_scoreboard", "pitchtype_matrix"]


def sized(sizes: dict[str, int]) -> dict[str, str]:
    out = MODELS
    for name, value in sizes.items():
        out = {n: t.replace(f"@{name}@", str(value)) for n, t in out.items()}
    return out
