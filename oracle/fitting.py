"""DuckDB statements that fit models: boosting rounds and a logistic regression by Newton steps."""

from __future__ import annotations

_FEATURES = ["batting_order_slot", "contact_pct"]
_BINS, _ROUNDS, _LEAVES = 8, 3, 4

_GAMES = """
    select game_pk, batter_id, cast(has_hit as double) as y, cast(batting_order_slot as double) as a,
           cast(contact_pct as double) as b, 1 + cast(game_pk % 3 as double) / 2 as w
    from {fct_batter_game}"""


def _edges(c: str) -> str:
    """Distinct quantiles at 1/8 .. 7/8 of a column, in order."""
    at = f"((len(v) - 1) * (i / {_BINS}::double))"
    lo, hi = f"v[cast(floor({at}) as bigint) + 1]", f"v[cast(ceil({at}) as bigint) + 1]"
    return (f"(select list_sort(list_distinct([{lo} + ({hi} - {lo}) * ({at} - floor({at})) for i in range(1, {_BINS})])) "
            f"from (select list({c} order by {c}) as v from games where {c} is not null))")


def boosted() -> str:
    """Rows of score table s<t> carry f; r<t>_<k> their node after k splits of round t."""
    parts = [f"games as materialized ({_GAMES})", f"""
        s0 as materialized (
            select game_pk, batter_id, y, w, (select ln(m / (1 - m)) from (select sum(w * y) / sum(w) as m from games)) as f,
                   if(a is null, null, len(list_filter({_edges('a')}, lambda e: e < a))) as x0,
                   if(b is null, null, len(list_filter({_edges('b')}, lambda e: e < b))) as x1
            from games)"""]
    for t in range(_ROUNDS):
        parts.append(f"""
        r{t}_0 as materialized (
            select *, 1 as node, w * (p - y) as g, w * p * (1 - p) as h,
                   cast('0x' || substr(md5(game_pk || ':' || batter_id || ':{t}'), 1, 8) as bigint) % 1000 < 800 as bag
            from (select *, 1 / (1 + exp(-f)) as p from s{t}))""")
        for k in range(_LEAVES - 1):
            # sums per leaf, feature and bin; every bin is a border, missing rows (bin -1) go to either side
            parts.append(f"""
        t{t}_{k} as materialized (
            select node, 0 as feature, coalesce(x0, -1) as bin, g, h from r{t}_{k} where bag
            union all select node, 1, coalesce(x1, -1), g, h from r{t}_{k} where bag),
        c{t}_{k} as materialized (
            select t.node, t.feature, border, miss, sum(g) as tg, sum(h) as th, count(*) as tn,
                   coalesce(sum(g) filter (goes), 0) as lg, coalesce(sum(h) filter (goes), 0) as lh, count(*) filter (goes) as ln
            from (select t.*, border, miss, if(bin < 0, miss = 1, bin <= border) as goes
                  from t{t}_{k} t, range({_BINS}) b(border), (values (0), (1)) m(miss)) t
            group by t.node, t.feature, border, miss),
        b{t}_{k} as materialized (
            select * from (
                select *, round(lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1) - tg * tg / (th + 1), 9) as gain
                from c{t}_{k} where ln >= 20 and tn - ln >= 20 and lh >= 1e-3::double and th - lh >= 1e-3::double)
            where gain > 1e-8::double order by gain desc, node, feature, border, miss limit 1),
        r{t}_{k + 1} as materialized (
            select r.* exclude (node), case when r.node is distinct from b.node then r.node
                when coalesce(if(feature = 0, x0, x1) <= border, miss = 1) then 2 * r.node else 2 * r.node + 1 end as node
            from r{t}_{k} r left join b{t}_{k} b on true)""")
        parts.append(f"""
        s{t + 1} as materialized (
            select r.game_pk, r.batter_id, r.y, r.w, r.f + v.value as f, r.x0, r.x1
            from r{t}_{_LEAVES - 1} r join (
                select node, -sum(g) / (sum(h) + 1) * 0.3::double as value from r{t}_{_LEAVES - 1} where bag group by node) v
              using (node))""")
    return (f"select * from (with {','.join(parts)}"
            f" select game_pk, batter_id, round(1 / (1 + exp(-f)), 6) as p from s{_ROUNDS})")


def _det(m: list[list[str]]) -> str:
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


def logistic(strength: str = "0.01", steps: int = 8) -> str:
    """Newton steps over summed gradients and second derivatives, solved by determinants."""
    parts = [f"games as materialized ({_GAMES})", """
        filled as (select y, w, coalesce(a, (select median(a) from games)) as a, coalesce(b, (select median(b) from games)) as b
                   from games),
        z as materialized (
            select y, w, (a - avg(a) over ()) / stddev_samp(a) over () as u, (b - avg(b) over ()) / stddev_samp(b) over () as v
            from filled),
        n0 as (select 0::double as c0, 0::double as c1, 0::double as c2)"""]
    second = [["h00", "h01", "h02"], ["h01", "h11", "h12"], ["h02", "h12", "h22"]]
    for k in range(steps):
        solved = []
        for j in range(3):
            swapped = [[f"g{r}" if c == j else second[r][c] for c in range(3)] for r in range(3)]
            solved.append(f"c{j} - {_det(swapped)} / {_det(second)} as c{j}")
        parts.append(f"""
        q{k} as (select z.*, n.*, 1 / (1 + exp(-(c0 + c1 * u + c2 * v))) as p from z, n{k} n),
        d{k} as (select c0, c1, c2, sum(w * (p - y)) as g0, sum(w * (p - y) * u) + c1 / {strength}::double as g1,
                        sum(w * (p - y) * v) + c2 / {strength}::double as g2, sum(w * p * (1 - p)) as h00,
                        sum(w * p * (1 - p) * u) as h01, sum(w * p * (1 - p) * v) as h02,
                        sum(w * p * (1 - p) * u * u) + 1 / {strength}::double as h11, sum(w * p * (1 - p) * u * v) as h12,
                        sum(w * p * (1 - p) * v * v) + 1 / {strength}::double as h22
                 from q{k} group by c0, c1, c2),
        n{k + 1} as materialized (select {', '.join(solved)} from d{k})""")
    return f"""select * from (with {','.join(parts)}
        select 'intercept' as term, round(c0, 4) as value from n{steps}
        union all select '{_FEATURES[0]}', round(c1, 4) from n{steps}
        union all select '{_FEATURES[1]}', round(c2, 4) from n{steps})"""


FINAL = {"boosted_rounds": boosted(), "logistic_fit": logistic()}
