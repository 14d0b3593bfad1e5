"""Queries over the event operators, and their twins. Sessions use other ids for ages, units and buildings than matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from laddermill.operators import events as e
from laddermill.operators.ingest import compose_players
from laddermill.plans.ingest import split_top
from laddermill.sources.roles import Tables, twin

QUERIES, ORACLE = {}, {}
#: The twins without their roles.
ORACLE_SELECT: dict[str, str] = {}
AGES = {"feudal": 20, "castle": 40, "imperial": 60}
LINES = (("Scouts", "scouts", (1, 2, 3)), ("Archers", "archers", (4, 5, 6)), ("M@A", "man_at_arms", (74, 75, 76, 77)), ("Spears", "spears", (93, 94, 95)))
MILITIA = (74, 75, 76, 77, 78, 79, 80)
ECO = f"({', '.join(map(str, e.ECO_UNITS))})"
S, P = "f_sessions", "f_session_players"
KEY = "match_id, profile_id"
CLICKS = {"clicks": f"select {KEY}, " + ", ".join(f"min(case when target_id = {i} then t_ms end) as {a}_ms" for a, i in AGES.items()) + f" from {S} where kind = 'research' and target_id in (20, 40, 60) group by all"}
BASES = {"bases": f"""select {KEY}, cast(list_sort(list(x))[count(*) // 2 + 1] as double) as base_x, cast(list_sort(list(y))[count(*) // 2 + 1] as double) as base_y
    from {S} where kind = 'build' and t_ms <= 360000 group by all"""}
AMOUNT = "least(greatest(coalesce(amount, 1), 1), 60)"
PRICES = {k: v for k, v in (("train", 50), ("build", 100), ("research", 75))}


def add(name: str, query, sql: str | None, **ctes: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: query(Tables(spark, sf_dir))
    if sql:
        ORACLE[name], ORACLE_SELECT[name] = twin(sql, **ctes), sql


def clicks(t: Tables):
    return e.age_clicks(t.sessions, AGES)


def costs(t: Tables):
    """A price list: 5 for a unit, 10 for a building, 7.5 for a technology, whatever its id."""
    kinds = F.expr("inline(array(named_struct('kind', 'train', 'cost', 5.0D), named_struct('kind', 'build', 'cost', 10.0D), named_struct('kind', 'research', 'cost', 7.5D)))")
    return t.spark.range(100).select(F.col("id").cast("int").alias("target_id"), kinds)


add("first_research", lambda t: e.first_event(t.events, "research", [22]), f"select {KEY}, min(t_ms) as t_ms from f_events where kind = 'research' and target_id = 22 group by all")
add("age_clicks", clicks, "select * from clicks", **CLICKS)
COMPLETE = ", ".join(f"round({a}_ms / 1000 + (case when civ_id = 3 then {e.FAST_AGES!r} else 1.0::double end) * {s}::double, 3) as {a}_t" for a, s in e.AGE_SECONDS.items())
add("age_completion", lambda t: e.completion(clicks(t).join(t.session_players, e.PLAYER), 3), f"select {KEY}, {COMPLETE} from clicks join {P} using ({KEY})", **CLICKS)
add(
    "openings_derived",
    lambda t: e.classify_opening(t.sessions, clicks(t), LINES, MILITIA),
    f"""select {KEY}, case when dark >= 3 then 'Drush + ' || body else body end as opening,
    case when dark >= 3 then 'drush' when len(o) = 0 then 'fast_castle' else o[1].kind end as opening_kind
    from (select *, case when len(o) > 0 then array_to_string(list_transform(o, lambda x: x.tag), ' into ') when castle_ms is not null then 'Fast Castle' end as body from opened) where body is not null""",
    **CLICKS,
    line="select * from (values " + ", ".join(f"({i}, '{tag}', '{kind}', {u})" for i, (tag, kind, ids) in enumerate(LINES) for u in ids) + ") v(nth, tag, line_kind, unit)",
    firsts=f"""select {KEY}, nth, tag, line_kind, min(t_ms) as t from {S} join clicks using ({KEY}) join line on unit = target_id
        where kind = 'train' and t_ms >= feudal_ms and t_ms < coalesce(castle_ms, feudal_ms + 720000) group by all""",
    dark=f"select {KEY}, count(*) as dark from {S} join clicks using ({KEY}) where kind = 'train' and t_ms < feudal_ms and target_id in {MILITIA} group by all",
    opened=f"""select c.match_id, c.profile_id, castle_ms, coalesce(dark, 0) as dark,
        coalesce((select list({{'tag': tag, 'kind': line_kind}} order by t, nth) from firsts f where f.match_id = c.match_id and f.profile_id = c.profile_id), [])[1:2] as o
        from clicks c left join dark using ({KEY}) where feudal_ms is not null""",
)
add("player_units", lambda t: e.player_units(t.events), "select * from f_units")
add("player_techs", lambda t: e.player_techs(t.events), f"select {KEY}, target_id as tech_id, min(t_ms) as t_ms from f_events where kind = 'research' and target_id in {tuple(e.WATCHED)} group by all")
add("apm", lambda t: e.apm(t.sessions, t.session_players), f"select {KEY}, round(coalesce(n, 0) / greatest(duration_ms / 60000.0::double, 1/60.0::double), 6) as apm from {P} left join (select {KEY}, count(*) n from {S} group by all) using ({KEY})")
SNAP = "cast(coalesce(sum(case when t_ms <= at_ms and {} end), 0) as bigint) as {}"
add(
    "age_snapshots",
    lambda t: e.age_snapshots(t.sessions, clicks(t)).withColumnRenamed("at", "at_ms"),
    f"""select {KEY}, age, at_ms, {SNAP.format("kind = 'train' and target_id = 83 then greatest(coalesce(amount, 1), 1)", "villagers")},
    {SNAP.format(f"kind = 'train' and target_id not in {ECO} then greatest(coalesce(amount, 1), 1)", "military")}, {SNAP.format("kind = 'build' then 1", "n_buildings")}, {SNAP.format("kind = 'research' then 1", "n_research")}
    from {S} right join ages using ({KEY}) group by all""",
    **CLICKS,
    ages=" union all ".join(f"select {KEY}, '{a}' as age, {a}_ms as at_ms from clicks where {a}_ms is not null" for a in AGES),
)
OUT = {"gone": f"select distinct {KEY} from {S} where kind = 'resign'"}
add(
    "winner_individual",
    lambda t: e.winner_individual(t.sessions, t.session_players),
    f"""select {KEY}, case when n_out >= 1 and n_out < n then not gone end as won from (select {KEY}, g.profile_id is not null as gone,
    count(g.profile_id) over (partition by p.match_id) as n_out, count(*) over (partition by p.match_id) as n from {P} p left join gone g using ({KEY}))""",
    **OUT,
)
add(
    "winner_team",
    lambda t: e.winner_team(t.sessions, t.session_players),
    f"""select {KEY}, team, case when teams >= 2 and somebody and clean = 1 then team = winner end as won from {P} join
    (select match_id, count(*) as teams, sum(resigned) as resigned, count(*) filter (where resigned = 0) as clean, max(case when resigned = 0 then team end) as winner
     from (select p.match_id, team, count(g.profile_id) as resigned from {P} p left join gone g using ({KEY}) where civ_id <> 0 group by all) group by 1) using (match_id)
    left join (select distinct match_id, true as somebody from gone) using (match_id) where civ_id <> 0""",
    **OUT,
)
BLOCKS = "match_id, 3 + profile_id % 2 as ladder, profile_id - 1 as slot, elo"
add("postgame_elo", lambda t: e.postgame_elo(t.players.selectExpr("match_id", "3 + profile_id % 2 ladder", "profile_id - 1 slot", "elo")), f"select match_id, slot + 1 as player_number, coalesce(max(case when ladder = 3 then elo end), max(case when ladder = 4 then elo end)) as elo from (select {BLOCKS} from f_players) group by all")
add("vils_at", lambda t: e.units_by(t.sessions, 83, 900_000), f"select {KEY}, cast(coalesce(sum(case when kind = 'train' and target_id = 83 and t_ms <= 900000 then {AMOUNT} end), 0) as bigint) as n from {S} group by all")
BUSY = " ".join(f"when {i} then {ms}" for i, ms in ((22, 25_000), (20, 130_000), (55, 75_000)))
add(
    "idle_tc",
    lambda t: e.idle_time(t.sessions, t.session_players.selectExpr(*e.PLAYER, "cast(0 as bigint) since_ms", "cast(600000 as bigint) until_ms"), {22: 25_000, 20: 130_000, 55: 75_000}),
    f"""select {KEY}, cast(greatest(greatest(600000 - 25000 * coalesce(vils, 0), 0) - coalesce(busy, 0), 0) as bigint) as idle_ms from {P} left join
    (select {KEY}, sum(case when kind = 'train' and target_id = 83 and t_ms <= 600000 then {AMOUNT} end) as vils,
            sum(case when kind = 'research' and t_ms < 600000 and target_id in (22, 20, 55) then least(case target_id {BUSY} end, 600000 - t_ms) end) as busy from {S} group by all) using ({KEY})""",
)
add("first_tc", lambda t: e.first_event(t.sessions, "build", [9, 21]), f"select {KEY}, min(t_ms) as t_ms from {S} where kind = 'build' and target_id in (9, 21) group by all")
add("first_military", lambda t: e.first_military(t.events), f"select {KEY}, min(t_ms) as t_ms from f_events where kind = 'train' and target_id not in {ECO} group by all")
add(
    "production_series",
    lambda t: e.production_series(t.sessions, t.session_players),
    f"""select {KEY}, minute, cast(sum(coalesce(e, 0)) over w as bigint) as eco, cast(sum(coalesce(m, 0)) over w as bigint) as military
    from (select {KEY}, cast(unnest(range(0, duration_ms // 60000 + 1)) as int) as minute from {P}) left join per using ({KEY}, minute)
    window w as (partition by {KEY} order by minute rows between unbounded preceding and current row)""",
    per=f"""select {KEY}, cast(t_ms // 60000 as int) as minute, sum(case when target_id in {ECO} then {AMOUNT} else 0 end) as e, sum(case when target_id not in {ECO} then {AMOUNT} else 0 end) as m
        from {S} join {P} using ({KEY}) where kind = 'train' and t_ms // 60000 <= duration_ms // 60000 group by all""",
)
add(
    "apm_series",
    lambda t: e.apm_series(t.sessions),
    f"""select {KEY}, minute, count(t_ms) as commands from (select {KEY}, cast(unnest(range(0, max(t_ms // 60000) + 1)) as int) as minute from {S} group by {KEY}) m
    left join (select {KEY}, t_ms, cast(t_ms // 60000 as int) as minute from {S}) using ({KEY}, minute) group by all""",
)
SPLIT_ECO = f"(kind = 'train' and target_id in {ECO} or kind = 'build' and target_id in (50, 51, 52) or kind = 'research' and target_id in (20, 40, 60, 22, 14))"
SPLIT_ARMY = f"(kind = 'train' and target_id not in {ECO} or kind = 'build' and target_id in (12, 45, 49))"
add(
    "command_split",
    lambda t: e.command_split(t.sessions, t.session_players, (50, 51, 52), (12, 45, 49), (20, 40, 60, 22, 14)),
    f"""select {KEY}, coalesce(a, 0) as eco, coalesce(b, 0) as military, round(coalesce(a, 0) / (duration_ms / 60000.0::double), 6) as eco_pm, round(coalesce(b, 0) / (duration_ms / 60000.0::double), 6) as military_pm
    from {P} left join (select {KEY}, count(*) filter (where {SPLIT_ECO}) as a, count(*) filter (where {SPLIT_ARMY}) as b from {S} group by all) using ({KEY})""",
)
add("market_counts", lambda t: e.market_counts(t.sessions, "build", "move"), f"select {KEY}, count(*) filter (where kind = 'build') as buys, count(*) filter (where kind = 'move') as sells from {S} group by all")
add("base_centroid", lambda t: e.base_centroid(t.sessions), "select * from bases", **BASES)
add(
    "roles",
    lambda t: e.roles(t.session_players.selectExpr("*", "profile_id % 7 slot")),
    f"""select {KEY}, role from (select {KEY}, case when n = 1 then null when n = 2 then case when nth = 1 then 'flank' else 'pocket' end when nth in (1, n) then 'flank' else 'pocket' end as role
    from (select {KEY}, row_number() over (partition by match_id, team order by profile_id % 7, profile_id) as nth, count(*) over (partition by match_id, team) as n,
    count(distinct team) over (partition by match_id) as teams from {P} where team <> 1 and family in ('open', 'closed')) where teams >= 2) where role is not null""",
)
NEAR = f"select a.match_id, a.profile_id, a.base_x, a.base_y, b.base_x as ex, b.base_y as ey from bases a join {P} p using ({KEY}) join (select bases.*, team as t2 from bases join {P} using ({KEY})) b on a.match_id = b.match_id and p.team <> b.t2"
add("nearest_enemy", lambda t: e.nearest_enemy(e.base_centroid(t.sessions), t.session_players), f"select {KEY}, round(min(sqrt((base_x - ex) * (base_x - ex) + (base_y - ey) * (base_y - ey))), 6) as distance from ({NEAR}) group by all", **BASES)
add(
    "find_enemy",
    lambda t: e.find_enemy(t.sessions, e.base_centroid(t.sessions), t.session_players),
    f"""select s.match_id, s.profile_id, min(t_ms) as t_ms from {S} s join {P} p using ({KEY}) join (select bases.match_id as m2, base_x, base_y, team as t2 from bases join {P} using ({KEY})) b
    on s.match_id = m2 and p.team <> t2 where kind = 'move' and sqrt((x - base_x) * (x - base_x) + (y - base_y) * (y - base_y)) < 15 and exists (select 1 from bases o where o.match_id = s.match_id and o.profile_id = s.profile_id) group by all""",
    **BASES,
)
FLOATS = {
    "grid0": f"select {KEY}, duration_ms, cast(unnest(range(0, duration_ms // 30000 + 1)) as bigint) as step from {P}",
    "per_step": f"""select {KEY}, cast(ceil(t_ms / 30000) as bigint) as step, sum(case when kind = 'train' and target_id = 83 then {AMOUNT} else 0 end) as v,
        sum(case kind when 'train' then 5.0::double * {AMOUNT} when 'build' then 10.0::double when 'research' then 7.5::double else 0 end) as c from {S} group by all""",
    "grid1": f"select {KEY}, duration_ms, step, sum(coalesce(v, 0)) over w as v, sum(coalesce(c, 0)) over w as spent from grid0 left join per_step using ({KEY}, step) window w as (partition by {KEY} order by step)",
    "grid2": f"select *, case when step = 0 then 0 else greatest(coalesce(sum(v) over (partition by {KEY} order by step rows between unbounded preceding and 1 preceding), 0) * 90.0::double - spent, 0) end as surplus from grid1",
    "grid3": f"select *, lag(surplus) over (partition by {KEY} order by step) as before from grid2",
    "grid4": "select *, (surplus - before) / 0.5::double >= 150 as fast from grid3 where step > 0",
    "grid5": f"select *, coalesce(sum(case when not fast then 1 else 0 end) over (partition by {KEY} order by step rows between unbounded preceding and 1 preceding), 0) as run from grid4",
    "runs": f"""select {KEY}, duration_ms, run, min(case when fast then step end) as first_step, max(case when not fast then step end) as slow, arg_min(before, case when fast then step end) as s0, arg_max(surplus, step) as s1
        from grid5 group by all having min(case when fast then step end) is not null""",
    "floats": f"""select {KEY}, (first_step - 1) * 30000 as start_ms, coalesce(slow * 30000, duration_ms) as end_ms, round(greatest(s1 - s0, 0), 6) as banked,
        round(greatest(s1 - s0, 0) / greatest((coalesce(slow * 30000, duration_ms) - (first_step - 1) * 30000) / 60000.0::double, 0.5::double), 6) as rate from runs""",
}
add("float_windows", lambda t: e.float_windows(t.sessions, costs(t), t.session_players, per_second=3.0), "select * from floats", **FLOATS)
add("float_peak", lambda t: e.float_peak(e.float_windows(t.sessions, costs(t), t.session_players, per_second=3.0)), f"select {KEY}, rate, start_ms, end_ms, banked from floats qualify row_number() over (partition by {KEY} order by rate desc, start_ms desc) = 1", **FLOATS)
BUSY_ALL = " ".join(f"when {i} then {ms}" for i, ms in e.CENTRE_MS.items())


def until(age: str) -> str:
    return f"""coalesce(sum(case when kind = 'train' and target_id = 83 and t_ms <= {age}_ms then {AMOUNT} end), 0) as vils_{age},
        coalesce(sum(case when kind = 'research' and t_ms < {age}_ms and target_id in {tuple(e.CENTRE_MS)} then least(case target_id {BUSY_ALL} end, {age}_ms - t_ms) end), 0) as busy_{age}"""


def idle(age: str) -> str:
    return f"cast(greatest(greatest(greatest({age}_ms - case when family = 'nomad' then coalesce(first_centre_ms, 0) else 0 end, 0) - 25000 * vils_{age}, 0) - busy_{age}, 0) as bigint)"


CENTRES = (9, 21)
TECH_COLUMNS = [f"tech_{x}_ms" for x in e.WATCHED]
RATE = "round(coalesce({}, 0) / greatest(duration_ms / 60000.0::double, 1/60.0::double), 6) as {}"
MEASURED = CLICKS | BASES | FLOATS | {
    "opened": f"""select c.match_id, c.profile_id, castle_ms, (select sum({AMOUNT}) from {S} s where s.match_id = c.match_id and s.profile_id = c.profile_id and kind = 'train' and t_ms < feudal_ms and target_id in {MILITIA}) as dark,
        coalesce((select list(tag order by t, nth) from (select nth, tag, min(t_ms) as t from {S} s join (values {", ".join(f"({i}, '{tag}', {u})" for i, (tag, _, ids) in enumerate(LINES) for u in ids)}) v(nth, tag, unit) on unit = target_id
            where s.match_id = c.match_id and s.profile_id = c.profile_id and kind = 'train' and t_ms >= feudal_ms and t_ms < coalesce(castle_ms, feudal_ms + 720000) group by nth, tag)), [])[1:2] as o from clicks c where feudal_ms is not null""",
    "named": f"select {KEY}, case when coalesce(dark, 0) >= 3 then 'Drush + ' || body else body end as opening from (select *, case when len(o) > 0 then array_to_string(o, ' into ') when castle_ms is not null then 'Fast Castle' end as body from opened)",
    "counted": f"""select {KEY}, min(case when kind = 'train' and target_id not in {ECO} then t_ms end) as first_military_ms, min(case when kind = 'build' and target_id in {CENTRES} then t_ms end) as first_centre_ms,
        count(*) filter (where kind = 'market_buy') as market_buys, count(*) filter (where kind = 'market_sell') as market_sells, count(*) as commands, {until("feudal")}, {until("castle")}, {until("duration")},
        count(*) filter (where kind = 'train' and target_id in {ECO} or kind = 'build' and target_id in {e.ECO_BUILDINGS} or kind = 'research' and target_id in {(*AGES.values(), *e.WATCHED)}) as eco, count(*) filter (where kind = 'train' and target_id not in {ECO} or kind = 'build' and target_id in {e.MILITARY_BUILDINGS}) as army,
        {", ".join(f"min(case when kind = 'research' and target_id = {x} then t_ms end) as tech_{x}_ms" for x in e.WATCHED)} from {S} join {P} using ({KEY}) left join clicks using ({KEY}) group by all""".replace("group by all", f"group by {KEY}"),
    "measured": f"""select p.*, feudal_ms, castle_ms, imperial_ms, first_military_ms, first_centre_ms, cast(case when castle_ms is null then vils_duration else vils_castle end as bigint) as vils_castle, market_buys, market_sells, {", ".join(TECH_COLUMNS)},
        opening, coalesce(rate, 0) as float_rate, coalesce(banked, 0) as float_banked, start_ms as float_start_ms, end_ms as float_end_ms, base_x, base_y, distance as nearest_enemy, found.t_ms as find_enemy_ms,
        {RATE.format("commands", "apm")}, {RATE.format("eco", "eco_apm")}, {RATE.format("army", "army_apm")}, coalesce({idle("feudal")}, 0) as idle_dark_ms,
        case when feudal_ms is not null and castle_ms is not null then greatest({idle("castle")} - {idle("feudal")}, 0) else 0 end as idle_feudal_ms
        from {P} p left join clicks using ({KEY}) left join counted using ({KEY}) left join named using ({KEY}) left join bases using ({KEY}) left join ({ORACLE["nearest_enemy"]}) near using ({KEY}) left join ({ORACLE["find_enemy"]}) found using ({KEY})
        left join (select {KEY}, rate, start_ms, end_ms, banked from floats qualify row_number() over (partition by {KEY} order by rate desc, start_ms desc) = 1) peak using ({KEY})""",
}


def measured(t: Tables):
    return e.player_metrics(t.sessions, t.session_players, costs(t), AGES, per_second=3.0, centres=CENTRES, lines=LINES, militia=MILITIA)


add("player_metrics", measured, "select * from measured", **MEASURED)
POSTED = "match_id, profile_id, civ_id, profile_id % 2 = 0 as won, case when profile_id % 3 > 0 then cast(1000 + profile_id as int) end as {}"
add(
    "compose_players",
    lambda t: compose_players(t.session_players.select("match_id", "duration_ms").distinct(), t.session_players.selectExpr(*(x.strip() for x in split_top(POSTED.format("post_elo")))), t.sessions, 3, ages=AGES, lines=LINES, militia=MILITIA)["players"],
    f"""select p.*, opening, opening_kind, feudal_t, castle_t, imperial_t, apm from (select {POSTED.format("elo")} from {P}) p
    left join ({ORACLE["openings_derived"]}) o using ({KEY}) left join ({ORACLE["age_completion"]}) a using ({KEY}) left join ({ORACLE["apm"]}) m using ({KEY})""",
)
add("game_mode", lambda t: e.game_mode(t.players), "select match_id, case when count(*) > 2 then 'team' else '1v1' end as mode from f_players group by 1")
add("resolve_recorder", lambda t: e.resolve_focus(t.players.selectExpr("match_id", "profile_id", "profile_id player_number", "1 + match_id % 5 recorder")), f"select {KEY}, profile_id as player_number, 1 + match_id % 5 as recorder from f_players where profile_id = 1 + match_id % 5")
add("resolve_focus", lambda t: e.resolve_focus(t.players.selectExpr("match_id", "profile_id", "concat('Player', match_id % 97) name"), "player7"), "select match_id, profile_id, 'Player7' as name from f_players where match_id % 97 = 7")
