"""Queries over the marts, and their twins."""

from __future__ import annotations

from laddermill.operators import marts as m
from laddermill.sources.roles import SMALL, Tables, twin

N, WN, SH, G = SMALL["min_n"], SMALL["min_winners"], SMALL["min_share"], SMALL["min_games"]

RATE = "case when games > 0 then ((20000 * wins + games) // (2 * games)) / 100.0 end as winrate"
BASE = "f_rated p join f_matches m using (match_id) where won is not null and civ_id <> 0"
COUNTS = "count(*) as games, cast(count(*) filter (where won) as bigint) as wins"
SUMS = "cast(sum(games) as bigint) as games, cast(sum(wins) as bigint) as wins"


def med(c: str, name: str, q: float = 0.5) -> str:
    return f"quantile_cont(cast({c} as double), {q}) as {name}"


MEDIANS = ", ".join(med(f"{a}_t", f"{a}_median") for a in ("feudal", "castle", "imperial"))
EVERY_WINNER = "select p.*, map_id, source from f_rated p join f_matches using (match_id) where won and elo is not null and ladder = '1v1'"
WINNERS = f"select * from ({EVERY_WINNER}) where civ_id <> 0 and source = 'replay'"
OUT = f"({', '.join(map(str, m.MILITARY_OUT))})"


def pair_cte(ladder: str) -> str:
    met = "a.profile_id <> b.profile_id" if ladder == "1v1" else "a.won <> b.won"
    other = f"f_rated where civ_id <> 0{'' if ladder == '1v1' else ' and won is not null'}"
    return f"""select a.*, b.civ_id as opp_civ_id from (select p.*, map_id from {BASE} and ladder = '{ladder}') a
        join (select * from {other}) b on a.match_id = b.match_id and {met} and a.civ_id <> b.civ_id"""


def rolled(keys: str, base: str, over: str = "elo_bucket") -> dict[str, str]:
    return {
        "fine": f"select {keys}, {over}, {COUNTS} from {base} group by all",
        "rolled_up": f"select * from fine where {over} is not null union all by name select {keys}, 'all' as {over}, {SUMS} from fine group by all",
    }


def label(c: str) -> str:
    return f"case when grouping({c}) = 1 then 'all' else cast({c} as varchar) end as {c}"


def shared(part: str, whole: str) -> str:
    return f"((20000 * {part} + {whole}) // (2 * {whole})) / 10000.0 as share"


QUERIES, ORACLE = {}, {}


def add(name: str, query, sql: str, **ctes: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: query(Tables(spark, sf_dir))
    ORACLE[name] = twin(sql, **ctes)


add("civ_meta", lambda t: m.civ_meta(m.results(t.matches, t.players)), f"select *, {RATE}, cast(sum(case when elo_bucket = 'all' then games end) over (partition by ladder) as bigint) as ladder_total_games from rolled_up", **rolled("civ_id, ladder", BASE))
add("civ_meta_by_map", lambda t: m.civ_meta_by_map(m.results(t.matches, t.players)), f"select *, {RATE} from (select civ_id, ladder, map_id, {COUNTS} from {BASE} group by all)")
add("civ_meta_by_patch", lambda t: m.civ_meta_by_patch(m.results(t.matches, t.players)), f"select *, {RATE} from (select civ_id, ladder, build, {COUNTS} from {BASE} and build is not null group by all)")
add("civ_meta_openings", lambda t: m.civ_meta_openings(m.results(t.matches, t.players)), f"select *, cast(row_number() over (partition by civ_id, ladder order by games desc, opening_kind) as int) as rank from (select civ_id, ladder, opening_kind, {COUNTS} from {BASE} and opening_kind is not null group by all)")
add("civ_meta_ageup", lambda t: m.civ_meta_ageup(t.matches, t.players), f"select civ_id, ladder, {MEDIANS} from f_players join f_matches using (match_id) where feudal_t is not null and civ_id <> 0 group by all")
add("patch_axis", lambda t: m.patch_axis(t.matches), "select build, count(*) as matches from f_matches where ladder = '1v1' and build is not null group by all")
add("matchups_1v1", lambda t: m.matchups(t.matches, t.players), f"select *, {RATE} from (select civ_id, opp_civ_id, {COUNTS} from pairs group by all)", pairs=pair_cte("1v1"))
add("matchups_1v1_by_map", lambda t: m.matchups(t.matches, t.players, by="map_id"), f"select *, {RATE} from (select civ_id, opp_civ_id, map_id, {COUNTS} from pairs group by all)", pairs=pair_cte("1v1"))
add("matchups_team", lambda t: m.matchups(t.matches, t.players, "team"), f"select *, {RATE} from (select civ_id, opp_civ_id, {COUNTS} from pairs group by all)", pairs=pair_cte("team"))
add("matchups_1v1_by_elo", lambda t: m.matchups_by_elo(t.matches, t.players), f"select *, {RATE} from rolled_up", pairs=pair_cte("1v1"), **rolled("civ_id, opp_civ_id", "(select * from pairs where elo_bucket is not null)"))
add(
    "benchmark_ageup",
    lambda t: m.benchmark_ageup(t.matches, t.players, N),
    f"""select civ_id, {label("map_id")}, {label("elo_bucket")}, {label("ladder")}, count(*) as n, {MEDIANS}
    from f_rated join f_matches using (match_id) where feudal_t is not null and civ_id <> 0 and elo is not null
    group by grouping sets ((civ_id, map_id, elo_bucket, ladder), (civ_id, map_id, ladder), (civ_id, map_id), (civ_id)) having count(*) >= {N}""",
)
add(
    "benchmark_vils",
    lambda t: m.benchmark_vils(t.matches, t.players, t.ages, N),
    f"""select civ_id, cast(map_id as varchar) as map_id, {label("elo_bucket")}, {label("ladder")}, count(*) as n, {med("vils", "vils_median")}
    from per join (select match_id, profile_id, elo_bucket from f_rated where elo is not null) using (match_id, profile_id) join f_matches using (match_id)
    where won and castle and windows = 2 and vils is not null and civ_id <> 0
    group by grouping sets ((civ_id, map_id, elo_bucket, ladder), (civ_id, map_id, ladder), (civ_id, map_id)) having count(*) >= {N}""",
    per="""select match_id, profile_id, civ_id, bool_or(won) as won, sum(case when age in ('dark', 'feudal') then villagers end) as vils, count(*) filter (where age in ('dark', 'feudal')) as windows,
        bool_or(age = 'castle') as castle from f_ages where uptime_ms >= 0 group by all""",
)
add(
    "benchmark_ecotech",
    lambda t: m.benchmark_ecotech(t.matches, t.players, t.techs, N),
    f"""select tech_id, {label("map_id")}, {label("elo_bucket")}, ladder, count(*) as n, {med("t_ms", "p25_ms", 0.25)}, {med("t_ms", "p50_ms")}, {med("t_ms", "p75_ms", 0.75)}
    from f_techs join f_rated using (match_id, profile_id) join f_matches using (match_id) where won and elo is not null
    group by grouping sets ((tech_id, map_id, elo_bucket, ladder), (tech_id, map_id, ladder), (tech_id, elo_bucket, ladder), (tech_id, ladder)) having count(*) >= {N}""",
)
CUBE = f"select civ_id, elo_bucket, map_id, build, {COUNTS} from {BASE} and ladder = '1v1' and elo_bucket is not null and build is not null group by all having count(*) >= {G}"
add("civ_cube", lambda t: m.civ_cube(t.matches, t.players, G), CUBE)
add(
    "winner_comps",
    lambda t: m.winner_comps(m.winners(t.matches, t.players), t.units, t.unit_names, WN, SH),
    f"""select *, cast(row_number() over (partition by civ_id, elo_bucket order by producers desc, unit) as int) as rank
    from (select *, ((2000 * producers + winners) // (2 * winners)) / 10.0 as share from made join totals using (civ_id, elo_bucket) where producers >= winners * {SH})""",
    won=WINNERS,
    totals=f"select civ_id, elo_bucket, count(*) as winners from won group by all having count(*) >= {WN}",
    made=f"select civ_id, elo_bucket, lower(name) as unit, count(*) as producers, {med('trained', 'trained_median')} from f_units join won using (match_id, profile_id) join f_unit_names using (unit_id) where unit_id not in {OUT} group by all",
)
add(
    "winner_refs_openings",
    lambda t: m.winner_refs_openings(m.winners(t.matches, t.players, None), WN, SH),
    f"""select *, cast(row_number() over (partition by civ_id, elo_bucket order by share desc, opening_kind) as int) as rank
    from (select *, {shared("n", "winners")} from by_opening join totals using (civ_id, elo_bucket) where n >= winners * {SH})""",
    won=f"select * from ({EVERY_WINNER}) where opening_kind is not null and civ_id <> 0",
    totals=f"select civ_id, elo_bucket, count(*) as winners from won group by all having count(*) >= {WN}",
    by_opening="select civ_id, elo_bucket, opening_kind, count(*) as n from won group by all",
)
add(
    "winner_refs_ecotech",
    lambda t: m.winner_refs_ecotech(m.winners(t.matches, t.players, random_civ=True), t.techs, N),
    f"select elo_bucket, n, tech_id, clicked, {shared('clicked', 'n')} from cells",
    won=f"select * from ({EVERY_WINNER}) where castle_t is not null and source = 'replay'",
    cells=f"""select elo_bucket, count(distinct (match_id, profile_id)) as n, x.tech_id, count(distinct case when t.tech_id = x.tech_id and t.t_ms < castle_t * 1000 then (match_id, profile_id) end) as clicked
        from won left join f_techs t using (match_id, profile_id), (select unnest({list(m.REF_TECHS)}) as tech_id) x group by elo_bucket, x.tech_id having n >= {N}""",
)
add(
    "winner_refs_meds",
    lambda t: m.winner_refs_meds(m.winners(t.matches, t.players, None, random_civ=True), t.events, N),
    f"""select {label("map_id")}, elo_bucket, count(*) as n, {med("military", "military_median")}, {", ".join(med(f"t{x}", f"t{x}_median") for x in m.REF_TECHS[:4])}
    from won join firsts using (match_id, profile_id) group by grouping sets ((map_id, elo_bucket), (elo_bucket)) having count(*) >= {N}""",
    won=EVERY_WINNER,
    firsts=f"""select match_id, profile_id, min(case when kind = 'train' then t_ms end) as military,
        {", ".join(f"min(case when kind = 'research' and target_id = {x} then t_ms end) as t{x}" for x in m.REF_TECHS[:4])}
        from f_events where kind = 'train' and target_id not in {OUT} or kind = 'research' and target_id in {m.REF_TECHS[:4]} group by all""",
)
add("map_meta", lambda t: m.map_meta(t.matches, t.players), f"select *, {RATE}, cast(sum(case when elo_bucket = 'all' then games end) over (partition by map_id, ladder) as bigint) as map_total_games from rolled_up", **rolled("map_id, ladder, civ_id", BASE))
