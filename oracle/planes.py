"""DuckDB statements of the ingest and model planes, over the models of the studies."""

from __future__ import annotations

from oracle.studies import _LL, _Q, average_rank

_LINE = ["plate_appearances", "at_bats", "hits", "doubles", "triples", "home_runs", "walks", "strikeouts", "runs", "rbi"]


def metrics(models: dict[str, str]) -> str:
    """Loss, Brier, area and rows of score expressions over {scored}."""
    stacked = " union all ".join(f"select '{m}' as model, {p} as p, has_hit from {{scored}}" for m, p in models.items())
    return f"""
        select model, count(*) as n, round({_LL}, 8) as log_loss,
               round(avg(({_Q} - has_hit) * ({_Q} - has_hit)), 8) as brier,
               round(cast(sum(if(has_hit = 1, r, 0)) - sum(has_hit) * (sum(has_hit) + 1) / 2 as double)
                     / (sum(has_hit) * (count(*) - sum(has_hit))), 8) as auc
        from (select *, {average_rank('model', _Q)} as r from ({stacked})) group by model"""


_MIX = {"eb_pa": "eb_pa", "half_raw": "p_model", "half_cal": "(p_model + eb_pa) / 2",
        "most_raw": "(p_model + eb_pa) / 2", "most_cal": "p_model * 0.1::double + eb_pa * 0.9::double"}

FINAL = {
    "flatten_schedule": "select * exclude (load_id) from {raw_games}",
    "flatten_boxscore": f"""
        select l.game_pk, cast(g.official_date as varchar) as official_date, g.game_type, l.team_id, l.is_home,
               l.player_id, l.player_name, l.position, l.batting_order,
               coalesce(l.batting_order % 100 <> 0, false) as is_substitute, {', '.join(f'l.{c}' for c in _LINE)}
        from {{raw_batting_lines}} l join {{stg_games}} g using (game_pk)
        where g.status = 'Final' and coalesce({', '.join(f'l.{c}' for c in _LINE)}) is not null""",
    "flatten_standings": "select * exclude (load_id) from {raw_standings}",
    "flatten_coaches": "select * exclude (load_id) from {raw_coaches}",
    "incremental_slice": """
        select game_pk, official_date, load_id
        from {raw_games}, (select max(cast(official_date as date)) as day from {raw_games} where official_date < '2023-06-01')
        where cast(official_date as date) between coalesce(day, date '2021-03-01') and coalesce(day, date '2021-03-01') + 21""",
    "reload_window": """
        select game_pk, official_date, load_id from {raw_games}
        where cast(official_date as date) between date '2023-06-07' and date '2023-06-12'""",
    "conform_pitches": """
        select game_pk, at_bat_number, pitch_number, zone, launch_speed, balls, cast(null as varchar) as events
        from {raw_pitches}""",
    # a row is accepted if it is newer than the newest date landed before, less fourteen days; the first copy stays
    "stream_late": """
        select game_pk, official_date, min(slice) as slice from (
            select g.game_pk, g.official_date, s.slice, cast(g.official_date as date) as day,
                   (select max(cast(official_date as date)) from {raw_games} b
                    join (values (0, '2021-01-01', '2023-06-30'), (1, '2023-06-01', '2024-12-31'),
                                 (2, '2023-01-01', '2023-03-31')) t(slice, first, last)
                      on b.official_date between t.first and t.last
                    where t.slice < s.slice and (t.slice > 0 or b.game_pk % 5 <> 0)) as newest
            from {raw_games} g
            join (values (0, '2021-01-01', '2023-06-30'), (1, '2023-06-01', '2024-12-31'),
                         (2, '2023-01-01', '2023-03-31'), (3, '2024-12-20', '2026-12-31')) s(slice, first, last)
              on g.official_date between s.first and s.last and (s.slice > 0 or g.game_pk % 5 <> 0))
        where newest is null or day > newest - 14
        group by game_pk, official_date""",
    "flatten_lineups": """
        select l.game_pk, g.official_date, l.team_id, l.is_home, l.player_id, l.player_name,
               l.batting_order as batting_order_raw, cast(round_even(l.batting_order / 100, 0) as integer) as batting_order_slot,
               g.status as game_status
        from {raw_batting_lines} l join (
            select game_pk, any_value(cast(official_date as date)) as official_date, any_value(status) as status
            from {raw_games} where status <> 'Final' group by game_pk) g using (game_pk)
        where l.load_id = '1700000002' and l.batting_order is not null""",
    "war_files": """
        select mlb_id, year_id, stint_id, pa, g, war, cast(mlb_id as double) / 2 as salary,
               if(mlb_id % 20 = 0, 'n/a', cast(mlb_id as varchar)) as note
        from {raw_war_seasons} where year_id between 2021 and 2024""",
    "pitch_mix_xba": """
        select * from (with thrown as (
            select pitcher_id, game_date, pitch_type, count(*) as n from {flags} where pitch_type is not null group by all),
        struck as (
            select batter_id, game_date, pitch_type, sum(xba) as x, count(*) as n
            from {flags} where pitch_type is not null and is_bip and xba is not null group by all),
        games as (select game_pk, batter_id, opp_starter_id, game_date from {fct_batter_game} where opp_starter_id is not null),
        mix as (
            select g.game_pk, g.batter_id, t.pitch_type, sum(t.n) as n
            from games g join thrown t on t.pitcher_id = g.opp_starter_id and t.game_date < g.game_date group by all),
        skill as (
            select g.game_pk, g.batter_id, s.pitch_type, sum(s.x) / sum(s.n) as x
            from games g join struck s on s.batter_id = g.batter_id and s.game_date < g.game_date group by all)
        select game_pk, batter_id, round(sum(n * x) / sum(n) filter (x is not null) + 1e-12::double, 10) as mix_xba,
               round(cast(sum(n) filter (x is not null) as double) / sum(n) + 1e-12::double, 10) as mix_share
        from mix left join skill using (game_pk, batter_id, pitch_type)
        group by game_pk, batter_id having count(x) > 0)""",
    "streak_permutation": """
        select * from (with orders as (
            select r, batter_id, game_pk, has_hit, case when r = 0 then date_diff('day', date '1970-01-01', game_date) else
                   cast('0x' || substr(md5(game_pk || ':' || batter_id || ':1:' || r), 1, 15) as bigint) end as mark
            from {fct_batter_game}, range(31) x(r)),
        ran as (
            select *, row_number() over (partition by r, batter_id order by mark, game_pk) as i from orders),
        streaks as (
            select *, i - 1 - coalesce(max(case when has_hit = 0 then i end) over (
                partition by r, batter_id order by i rows between unbounded preceding and 1 preceding), 0) as streak
            from ran),
        rates as (
            select r, case when streak >= 10 then '10+' when streak >= 5 then '5-9' when streak >= 3 then '3-4'
                           else cast(streak as varchar) end as bucket,
                   count(*) as n, cast(sum(has_hit) as double) / count(*) as rate
            from streaks where streak < 100 group by all)
        select p.bucket, p.n, round(p.rate, 8) as rate, round(avg(s.rate), 8) as null_mean,
               round(stddev_samp(s.rate), 8) as null_sd,
               round(cast(count(*) filter (s.rate >= p.rate) + 1 as double) / (count(s.rate) + 1), 8) as p_high
        from rates p left join rates s on s.bucket = p.bucket and s.r > 0 where p.r = 0 group by p.bucket, p.n, p.rate)""",
    "predictions_as_shown": """
        select strftime(run_ts, '%Y-%m-%d %H:%M:%S') as scored_at, slate_date, game_pk, batter_id, p_hit, model_version from {predictions}
        where run_ts <= timestamp '2026-06-01 12:30:00'
        qualify row_number() over (partition by slate_date, game_pk, batter_id order by run_ts desc, model_version desc) = 1""",
    "lineup_slice": f"""
        select lineup_confirmed, count(*) as n, round(avg(has_hit), 8) as base_rate, round(avg(has_hit) - avg(q), 8) as cal_gap,
               round(-avg(if(has_hit = 1, ln(q), ln(1 - q))), 8) as log_loss, round(avg((q - has_hit) * (q - has_hit)), 8) as brier
        from (select *, least(greatest(p_hit, 1e-6::double), 1 - 1e-6::double) as q from {{predictions}}
              join (select game_pk, batter_id, has_hit from {{fct_batter_game}}) using (game_pk, batter_id)
              where run_ts <= timestamp '2026-06-01 12:30:00')
        group by lineup_confirmed""",
    "changed_lineups": """
        select game_pk, count(*) as n_changed
        from (select game_pk, player_id, arg_max(batting_order, load_id) as now,
                     arg_max(batting_order, load_id) filter (load_id <= '1700000001') as was
              from {raw_lineups} group by all)
        where was is distinct from now group by game_pk""",
    "dim_venue": """
        select venue_id, cast(row_number() over (partition by venue_id order by day) as integer) as version,
               v.venue_name, v.home_team_id, v.home_team_name, day as valid_from,
               lead(day) over (partition by venue_id order by day) as valid_to
        from (select *, lag(v) over (partition by venue_id order by day) as before
              from (select venue_id, official_date as day, max({'venue_name': venue_name, 'home_team_id': home_team_id,
                           'home_team_name': home_team_name}) as v
                    from {stg_games} where venue_id is not null group by all))
        where before is distinct from v""",
    "game_venues": """
        select g.game_pk, g.venue_id, g.official_date, cast(2 - cast(g.official_date < first_new as integer) as integer) as version,
               g.venue_name, if(g.official_date < first_new, old_name, new_name) as home_team_name
        from {stg_games} g join (
            select venue_id, min(official_date) filter (home_team_name not like '% (old)') as first_new,
                   max(home_team_name) filter (home_team_name like '% (old)') as old_name,
                   max(home_team_name) filter (home_team_name not like '% (old)') as new_name
            from {stg_games} group by venue_id) using (venue_id)""",
    "kelly_curve": """
        select * from (with b as (
            select slate_date, has_hit, 1 + cast((game_pk * 13 + batter_id * 5) % 64 as double) / 64 as odds, p_hit
            from {predictions} join (select game_pk, batter_id, has_hit from {fct_batter_game}) using (game_pk, batter_id)
            where run_ts <= timestamp '2026-06-01 12:30:00'),
        s as (
            select slate_date, odds, has_hit,
                   0.25::double * greatest(0, (p_hit * (odds - 1) - (1 - p_hit)) / (odds - 1)) as stake
            from b where odds > 1 and p_hit - 1 / odds >= 0.02::double and has_hit is not null),
        d as (
            select slate_date, count(*) as n_bets, sum(stake) as stake,
                   sum(if(has_hit = 1, stake * (odds - 1), -stake)) as gain, sum(if(has_hit = 1, odds - 1, -1)) as flat
            from s group by slate_date),
        r as (
            select slate_date, n_bets, stake * least(1, 0.5::double / stake) as staked,
                   gain * least(1, 0.5::double / stake) as day_return, flat from d),
        w as (
            select *, exp(sum(ln(1 + day_return)) over (order by slate_date)) as bankroll,
                   sum(flat) over (order by slate_date) as flat_profit from r)
        select slate_date, n_bets, round(staked, 7) as staked, round(day_return, 7) as day_return, round(bankroll, 7) as bankroll,
               round(flat_profit, 7) as flat_profit,
               round(1 - bankroll / greatest(max(bankroll) over (order by slate_date), 1), 7) as drawdown from w)""",
    # the recursion itself, week by week
    "drift_watch": """
        select * from (with recursive g as (
            select cast(date_trunc('week', game_date) as date) as week, game_date, p_hit - has_hit as e
            from {predictions} join (select game_pk, batter_id, game_date, has_hit from {fct_batter_game}) using (game_pk, batter_id)
            where run_ts <= timestamp '2026-06-01 12:30:00' and has_hit is not null),
        w as (
            select week, n, brier, row_number() over (order by week) as i
            from (select week, count(*) as n, avg(e * e) as brier from g group by week)
            where week + 7 <= (select max(game_date) from g) - 7),
        c as (
            select i, greatest(0, brier - 0.34::double) as cusum from w where i = 1
            union all
            select w.i, greatest(0, c.cusum + w.brier - 0.34::double) from c join w on w.i = c.i + 1)
        select week, n, round(brier + 1e-12::double, 9) as brier, round(cusum + 1e-12::double, 9) as cusum,
               cusum > 0.05::double as alarm
        from w join c using (i))""",
    "only_in_first_copy": "select count(*) as n from {int_batter_game} where batter_id % 37 = 0",
    # pooled scores; the map at i is the highest of the lowest running means that span i
    "isotonic_map": """
        select * from (with pools as (
            select p_model as p, cast(count(*) as double) as n, cast(sum(has_hit) as double) as k,
                   row_number() over (order by p_model) as i from {scored} group by 1),
        upto as (select *, sum(n) over (order by i) as ns, sum(k) over (order by i) as ks from pools),
        spans as (
            select a.i as j, b.i as l, (b.ks - a.ks + a.k) / (b.ns - a.ns + a.n) as mean
            from upto a join upto b on a.i <= b.i),
        low as (select j, l as i, min(mean) over (partition by j order by l desc) as least from spans)
        select p as p_model, round(least(greatest(max(least), 1e-6::double), 1 - 1e-6::double), 8) as rate
        from low join pools using (i) group by p)""",
    "binomial_expansion": """
        select * from (with t as (
            select 1.0::double as y, hits * (1.0::double / batting_order_slot) as w from {scored}
            union all
            select 0.0::double, greatest(pa - hits, 0) * (1.0::double / batting_order_slot) from {scored})
        select y, count(*) as n, round(sum(w), 6) as weight from t where w > 0 group by y)""",
    "structural_probability": """
        select game_pk, batter_id, round(1 - pow(1 - least(greatest(eb_hit_per_pa_career, 0.02::double), 0.55::double),
               least(greatest(coalesce(pa_roll10, 0), 1.0::double), 6.5::double)), 8) as p_hit
        from {scored}""",
    "baseline_scoreboard": metrics({"league": "(select avg(has_hit) from {scored})", "eb_pa": "eb_pa"}),
    "winner_gates": f"""
        select * from (with b as ({metrics(_MIX)}),
        best as (select * from b where model in ('half_cal', 'most_cal') order by log_loss, model limit 1)
        select best.model as winner,
               cast(if(best.log_loss < base.log_loss and best.brier < base.brier, 0, 1)
                    + if(best.brier > unfit.brier, 1, 0) as integer) as failures
        from best join b base on base.model = 'eb_pa'
        join b unfit on unfit.model = replace(best.model, '_cal', '_raw'))""",
    "backtest_gates": """
        select cast(
            if(exists (select 1 from {calibration_buckets} where n >= 300 and abs(gap) > 0.03), 1, 0)
            + if(coalesce((select max(hit_rate) from {picker_table} where k = 5 and picker = 'model')
                          > (select max(hit_rate) from {picker_table} where k = 5 and picker = 'season_ba'), false), 0, 1)
            as integer) as failures""",
    "evaluation_ledger": f"""
        select 'backtest-' || day as run_name, n, 0.5::double as top5_hit_rate, day as evaluations_to_date,
               log_loss, brier, auc
        from ({metrics({'eb_pa': 'eb_pa'})}), (select unnest([1::bigint, 2::bigint]) as day)""",
}
