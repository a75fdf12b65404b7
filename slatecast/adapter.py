"""Landed-feed tables derived from a star schema of orders and line items.

Each entry is plain SQL over the given tables (or over earlier entries) that
Spark runs with ``spark.sql``; names in braces are inputs, and ``each(a, b)``
fans a row out over fixed values. Measures are multiples of 1/256, so their
sums are exact in any order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SLATE_DATE = "2024-06-15"

ADAPTER: dict[str, str] = {
    "raw_pitches": """
        select
            game_pk,
            cast(date '2021-03-01' + cast(game_pk % 1900 as int) as string) as game_date,
            case when game_pk % 20 = 0 then 'S' else 'R' end as game_type,
            concat('T', cast(game_pk % 25 as string)) as home_team,
            concat('T', cast((game_pk % 25 + 1 + cast(floor(game_pk / 25) as bigint) % 24) % 25 as string)) as away_team,
            batter,
            pitcher,
            concat('Pitcher ', cast(pitcher as string)) as player_name,
            case when batter % 5 = 0 then case when line % 2 = 0 then 'L' else 'R' end
                 when batter % 2 = 0 then 'L' else 'R' end as stand,
            case when pitcher % 3 = 0 then 'L' else 'R' end as p_throws,
            cast(line as int) as inning,
            case when batter % 2 = 0 then 'Top' else 'Bot' end as inning_topbot,
            (orderkey % 4) * 10 + line as at_bat_number,
            cast(1 as bigint) as pitch_number,
            cast(part % 3 as int) as outs_when_up,
            cast(part % 4 as int) as balls,
            cast(supp % 3 as int) as strikes,
            case when part % 17 = 0 then null
                 else case part % 9 when 0 then 'FF' when 1 then 'SI' when 2 then 'FC'
                      when 3 then 'SL' when 4 then 'ST' when 5 then 'CU' when 6 then 'KC'
                      when 7 then 'CH' else 'FS' end end as pitch_type,
            cast(80 + part % 20 as double) as release_speed,
            case when part % 29 = 0 then null else cast(part % 14 + 1 as int) end as zone,
            case when dcode in (4, 5, 6, 7) then 'X' when dcode in (8, 10) then 'B' else 'S' end as type,
            case dcode when 0 then 'swinging_strike' when 1 then 'swinging_strike_blocked'
                 when 2 then 'foul' when 3 then 'foul_tip' when 4 then 'hit_into_play_score'
                 when 6 then 'hit_into_play_no_out' when 8 then 'ball' when 9 then 'called_strike'
                 when 10 then 'hit_by_pitch' else 'hit_into_play' end as description,
            case when dcode in (4, 5, 6, 7)
                 then case (part + supp) % 8 when 0 then 'single' when 1 then 'double'
                      when 2 then 'triple' when 3 then 'home_run' else 'field_out' end
                 when dcode = 0 then 'strikeout' when dcode = 8 then 'walk'
                 when dcode = 10 then 'hit_by_pitch' end as events,
            case when dcode in (4, 5, 6, 7)
                 then case part % 4 when 0 then 'line_drive' when 1 then 'ground_ball'
                      when 2 then 'fly_ball' else 'popup' end end as bb_type,
            case when dcode in (0, 4, 5, 6, 7, 8, 10) then cast(part % 5 as double) / 2 end as woba_value,
            cast(null as int) as babip_value,
            case when dcode in (4, 5, 6, 7) and part % 23 <> 0
                 then cast(60 + part % 60 as double) end as launch_speed,
            case when dcode in (4, 5, 6, 7) then cast((supp * 7) % 91 - 20 as double) end as launch_angle,
            cast(null as int) as launch_speed_angle,
            case when dcode in (4, 5, 6, 7) then cast(part % 100 as double) / 128 end as estimated_ba_using_speedangle,
            case when dcode in (0, 4, 5, 6, 7, 8, 10)
                 then cast(part % 200 as double) / 256 end as estimated_woba_using_speedangle,
            case when dcode in (4, 5, 6, 7) then cast(part % 100 as double) / 64 end as estimated_slg_using_speedangle
        from (
            select cast(floor(l.l_orderkey / 4) as bigint) as game_pk,
                   l.l_orderkey as orderkey,
                   cast(floor(o.o_custkey / 5) as bigint) as batter,
                   l.l_suppkey as pitcher, l.l_suppkey as supp, l.l_partkey as part,
                   cast(l.l_linenumber as bigint) as line,
                   cast(l.l_quantity as int) % 11 as dcode
            from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
        ) src""",
    "raw_games": """
        select
            game_pk, cast(day as string) as official_date,
            cast(extract(year from day) as string) as season,
            case when game_pk % 20 = 0 then 'S' else 'R' end as game_type,
            case when orderkey % 4 = 3 then 'Final' else 'Scheduled' end as status,
            case when game_pk % 3 = 0 then 'day' else 'night' end as day_night,
            case when game_pk % 10 = 0 then 'Y' else 'N' end as doubleheader,
            cast(1 as int) as game_number,
            home as venue_id, concat('Park ', cast(home as string)) as venue_name,
            100 + home as home_team_id,
            concat('Team ', cast(home as string), case when day < date '2023-01-01' then ' (old)' else '' end) as home_team_name,
            game_pk % suppliers as home_probable_pitcher_id,
            concat('Pitcher ', cast(game_pk % suppliers as string)) as home_probable_pitcher_name,
            100 + away as away_team_id,
            concat('Team ', cast(away as string), case when day < date '2023-01-01' then ' (old)' else '' end) as away_team_name,
            case when game_pk % 8 = 0 then null else (game_pk * 7 + 1) % suppliers end as away_probable_pitcher_id,
            case when game_pk % 8 = 0 then null
                 else concat('Pitcher ', cast((game_pk * 7 + 1) % suppliers as string)) end as away_probable_pitcher_name,
            cast(1700000000 + orderkey as string) as load_id
        from (
            select g.*, date '2021-03-01' + cast(g.game_pk % 1900 as int) as day,
                   g.game_pk % 25 as home,
                   (g.game_pk % 25 + 1 + cast(floor(g.game_pk / 25) as bigint) % 24) % 25 as away,
                   (select count(*) from {supplier}) as suppliers
            from (select o_orderkey as orderkey, cast(floor(o_orderkey / 4) as bigint) as game_pk from {orders}) g
        ) src""",
    "raw_batting_lines": """
        select
            game_pk, cast(game_date as string) as official_date, game_type,
            case when batter_id % 2 = 1 then 100 + home else 100 + away end as team_id,
            batter_id % 2 = 1 as is_home,
            batter_id as player_id,
            concat('Batter ', cast(batter_id as string), case when game_date < date '2022-01-01' then ' Jr' else '' end) as player_name,
            case when batter_id % 9 = 0 then 'DH' else 'OF' end as position,
            batting_order,
            coalesce(batting_order % 100 <> 0, false) as is_substitute,
            plate_appearances, at_bats,
            case when load_no = 2 then hits else 0 end as hits,
            doubles, triples, home_runs, walks, strikeouts,
            home_runs as runs, cast(hits + home_runs as int) as rbi,
            cast(1700000000 + load_no as string) as load_id
        from (
            select each(1, 2) as load_no,
                   game_pk, game_date, game_type, batter_id,
                   game_pk % 25 as home,
                   (game_pk % 25 + 1 + cast(floor(game_pk / 25) as bigint) % 24) % 25 as away,
                   case when batter_id % 17 = 0 then null
                        else cast((batter_id % 9 + 1) * 100 + case when batter_id % 13 = 0 then 1 else 0 end as int)
                        end as batting_order,
                   cast(count(events) as int) as plate_appearances,
                   cast(sum(case when events in ('walk', 'hit_by_pitch') or events is null then 0 else 1 end) as int) as at_bats,
                   cast(sum(case when events in ('single', 'double', 'triple', 'home_run') then 1 else 0 end) as int) as hits,
                   cast(sum(case when events = 'double' then 1 else 0 end) as int) as doubles,
                   cast(sum(case when events = 'triple' then 1 else 0 end) as int) as triples,
                   cast(sum(case when events = 'home_run' then 1 else 0 end) as int) as home_runs,
                   cast(sum(case when events = 'walk' then 1 else 0 end) as int) as walks,
                   cast(sum(case when events = 'strikeout' then 1 else 0 end) as int) as strikeouts
            from {stg_pitches} group by game_pk, game_date, game_type, batter_id
        ) box
        where load_no = 2 or game_pk % 5 = 0""",
    "raw_standings": """
        select
            cast(d.day as string) as standings_date,
            cast(100 + n.n_nationkey as bigint) as team_id, n.n_name as team_name,
            cast(n.n_regionkey as bigint) as division_id, cast(n.n_regionkey % 2 as bigint) as league_id,
            cast((n.n_nationkey * 7 + d.dayno) % 5 + 1 as string) as division_rank,
            case when d.load_no = 1 then '99' else cast((n.n_nationkey * 7 + d.dayno) % 15 + 1 as string) end as league_rank,
            cast((n.n_nationkey + d.dayno) % 90 as int) as wins,
            cast((n.n_nationkey * 3 + d.dayno) % 80 as int) as losses,
            concat('.', cast(400 + (n.n_nationkey * 11 + d.dayno) % 200 as string)) as win_pct,
            cast(1700000000 + d.load_no as string) as load_id
        from (
            select team.*, each(1, 2) as load_no
            from (
                select dates.*, each(0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24) as team_no
                from (select distinct date '2021-03-01' + cast(cast(floor(o_orderkey / 4) as bigint) % 1900 as int) as day,
                             cast(floor(o_orderkey / 4) as bigint) % 1900 as dayno
                      from {orders}) dates
            ) team
        ) d
        join {nation} n on n.n_nationkey = d.team_no
        where d.dayno % 11 <> 0 and (d.load_no = 2 or d.dayno % 6 = 0)""",
    "raw_coaches": """
        select
            cast(n.season as int) as season, cast(100 + n.n_nationkey as bigint) as team_id,
            n.n_name as team_name,
            cast(9000 + (n.n_nationkey * 6 + n.person * 5 + n.season) % 97 as bigint) as person_id,
            concat('Coach ', cast((n.n_nationkey * 6 + n.person * 5 + n.season) % 97 as string)) as person_name,
            case when n.person = 3 then 'Hitting Coach' when n.n_nationkey % 2 = 0 then 'Manager' else 'MANAGER' end as job,
            case when n.person = 3 then 'COAT' when n.n_nationkey % 3 = 0 then 'MNGR' else 'OTHR' end as job_id,
            cast(1700000000 + n.person as string) as load_id
        from (select y.*, each(1, 2, 3) as person
              from (select nation.*, each(2021, 2022, 2023, 2024, 2025, 2026) as season from {nation} nation) y) n""",
    "raw_war_seasons": """
        select
            b.batter as mlb_id, concat('Batter ', cast(b.batter as string)) as name_common,
            cast(b.season as int) as year_id, cast(floor(b.code / 10) as int) as stint_id,
            concat('W', cast(b.batter % 25 as string)) as team_id,
            case when b.batter % 2 = 0 then 'AL' else 'NL' end as lg_id,
            case when (b.batter + b.season) % 11 = 0 then null
                 else cast(50 + (b.batter * 13 + b.season * 7 + b.code % 10 * 40) % 500 as double) end as pa,
            cast((b.batter + b.season) % 160 as double) as g,
            case when b.batter % 19 = 0 then null
                 else cast((b.batter * 3 + b.season + b.code % 10) % 60 as double) / 8 - 1 end as war
        from (select y.*, each(11, 12, 21) as code
              from (select people.*, each(2020, 2021, 2022, 2023, 2024, 2025) as season
                    from (select distinct cast(floor(o_custkey / 5) as bigint) as batter from {orders}) people) y) b
        where b.code < 20 or b.batter % 7 = 0""",
    "raw_war_snapshots": """
        select w.mlb_id, w.name_common, w.year_id, w.stint_id, w.team_id, w.lg_id, w.pa, w.g, w.war,
               cast(date '2025-06-01' + w.day as string) as snapshot_date
        from (select s.*, each(0, 1) as day from {raw_war_seasons} s where s.year_id = 2025) w""",
    "raw_lineups": """
        select
            game_pk, official_date, team_id, is_home, player_id, player_name,
            cast(case when load_id = '1700000001' then 900 else batting_order end as int) as batting_order,
            'Scheduled' as game_status, load_id
        from {raw_batting_lines}
        where game_pk % 2 = 0 and batting_order is not null""",
    "predictions": """
        select
            timestamp '2026-06-01 12:00:00' + f.n * interval '1' hour as run_ts,
            f.game_date as slate_date, f.game_pk, f.batter_id, f.player_name, f.team_id,
            f.opponent_team_id, cast(f.batting_order_slot as int) as batting_order_slot,
            f.game_pk % 2 = 0 as lineup_confirmed, f.opp_starter_id,
            cast((f.game_pk * 31 + f.batter_id * 7 + f.n) % 128 as double) / 128 as p_hit,
            concat('hit_model:v', cast(f.n + 1 as string)) as model_version
        from (select fct.*, each(0, 1) as n from {fct_batter_game} fct) f
        where f.n = 0 or f.game_pk % 3 = 0""",
}

STAR = ["lineitem", "orders", "nation", "supplier"]


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in STAR}


def derive(spark: SparkSession, name: str, inputs: dict[str, DataFrame], by: str | None = None) -> DataFrame:
    """Run one adapter statement; only the named inputs it mentions are passed.

    ``by`` brings the rows of a key together: the inner query ``src``, which has
    that column, is moved by it, before the outer one makes the rows wide.
    """
    text = re.sub(r"each\(([^)]*)\)", r"explode(array(\1))", ADAPTER[name])

    def run(statement: str, tables: dict[str, DataFrame]) -> DataFrame:
        return spark.sql(statement, **{k: v for k, v in tables.items() if "{" + k + "}" in statement})

    if by is None:
        return run(text, inputs)
    outer, inner = re.fullmatch(r"(.*?\bfrom )\((.*)\) src", text.strip(), re.S).groups()
    # a set number: partitions merged by their narrow size would be too large when wide
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return run(outer + "{src} src", {"src": run(inner, inputs).repartition(parts, by)})
