"""Queries over the cube, the pages and the documents, and their twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from laddermill.functions.scalars import BANDS
from laddermill.operators import cube as q
from laddermill.operators import documents as d
from laddermill.operators import marts as m
from laddermill.plans.marts import CUBE, ORACLE as MART_SQL, RATE, SUMS, WN, SH, N, G
from laddermill.sources.archives import saved
from laddermill.sources.roles import ROLE_CTES, Tables, twin

QUERIES, ORACLE = {}, {}


def add(name: str, query, sql: str | None, **ctes: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: query(Tables(spark, sf_dir))
    if sql:
        ORACLE[name] = twin(sql, **ctes)


def mart(name: str) -> str:
    """A mart's twin as a subquery."""
    return f"({MART_SQL[name]})"


def cube(t: Tables):
    return m.civ_cube(t.matches, t.players, G)


def meta(t: Tables):
    return m.civ_meta(m.results(t.matches, t.players))


EDGE = "try_cast(regexp_extract(elo_bucket, '^(\\d+)', 1) as int)"
PLACE = "case elo_bucket " + " ".join(f"when '{b}' then {i}" for i, b in enumerate(BANDS)) + " end"
CUBES = {"cube": CUBE}
SUMMED = "cast(coalesce(sum(games), 0) as bigint) as games, cast(coalesce(sum(wins), 0) as bigint) as wins"
BY_ELO, BY_MAP = {"by_elo": mart("matchups_1v1_by_elo")[1:-1]}, {"by_map": mart("matchups_1v1_by_map")[1:-1]}

add("elo_cumulative", lambda t: q.selected(cube(t), elo="cum:1650"), f"select * from cube where {EDGE} >= 1650", **CUBES)
add("slice_win_rate", lambda t: q.slice_win_rate(cube(t), 1, map=2, elo="cum:1200"), f"select *, {RATE} from (select {SUMMED} from cube where civ_id = 1 and map_id = 2 and {EDGE} >= 1200)", **CUBES)
add("breakdown_elo", lambda t: q.breakdown(cube(t), "elo", 1, elo="1200-1399", map=1), f"select *, {RATE} from (select elo_bucket, {SUMMED} from cube where civ_id = 1 and map_id = 1 group by 1)", **CUBES)
add("breakdown_map", lambda t: q.breakdown(cube(t), "map", 2, elo="cum:1000"), f"select *, {RATE} from (select map_id, {SUMMED} from cube where civ_id = 2 and {EDGE} >= 1000 group by 1)", **CUBES)
add("breakdown_patch", lambda t: q.breakdown(cube(t), "patch", 3), f"select *, {RATE} from (select build, {SUMMED} from cube where civ_id = 3 group by 1)", **CUBES)
TIER = "case when winrate >= 53 then 'S' when winrate >= 51 then 'A' when winrate >= 49 then 'B' when winrate >= 47 then 'C' when winrate is not null then 'D' end"
add("tier_list", lambda t: q.tier_list(cube(t), 30, map=1), f"select *, case when games >= 30 then {TIER} else 'NR' end as tier from (select *, {RATE} from (select civ_id, {SUMMED} from cube where map_id = 1 group by 1))", **CUBES)
add("map_ranking", lambda t: q.map_ranking(cube(t), 3), f"select *, {RATE} from (select civ_id, {SUMMED} from cube where map_id = 3 group by 1 having sum(games) >= 20)", **CUBES)
add("pooled_rate", lambda t: q.pooled_rate(meta(t).filter("ladder = '1v1' and elo_bucket <> 'all'"), 1200), f"select civ_id, cast(sum(games) as bigint) as games, round(sum(games * winrate) / sum(games), 4) as winrate from {mart('civ_meta')} where ladder = '1v1' and elo_bucket <> 'all' and {EDGE} >= 1200 group by 1 having sum(games) >= 20")
add("patches_with_rows", lambda t: q.patches_with_rows(cube(t), 4), "select distinct build from cube where map_id = 4", **CUBES)
add(
    "strong_weak",
    lambda t: q.strong_weak(m.matchups(t.matches, t.players), 2),
    f"""select civ_id, side, cast(case side when 'strong' then nth else n - nth + 1 end as int) as place, opp_civ_id, winrate, games from
    (select *, case when nth <= f then 'strong' when nth > greatest(f, n - 2) then 'weak' end as side from
     (select *, least(2, ceil(n / 2)) as f from (select *, row_number() over (partition by civ_id order by winrate desc, opp_civ_id) as nth, count(*) over (partition by civ_id) as n from {mart("matchups_1v1")} where winrate <> 50)))
    where side is not null""",
)
add("matchup_map_views", lambda t: q.map_views(m.matchups(t.matches, t.players, by="map_id"), 4, 3), "select * from (select civ_id, map_id, count(*) as opponents, cast(sum(games) as bigint) as games from by_map group by all having count(*) >= 4) qualify row_number() over (partition by civ_id order by games desc, map_id) <= 3", **BY_MAP)
add(
    "h2h",
    lambda t: q.h2h(m.matchups_by_elo(t.matches, t.players), "cum:2500"),
    f"""select *, case when winrate >= 52 then 'first' when winrate <= 48 then 'second' else 'even' end as favourite from
    (select a.civ_id, a.opp_civ_id, coalesce(f.games, a.games) as games, coalesce(f.winrate, a.winrate) as winrate, f.games is null as fallback from (select * from by_elo where elo_bucket = 'all') a
     left join (select *, {RATE} from (select civ_id, opp_civ_id, {SUMS} from by_elo where {EDGE} >= 2500 group by all)) f using (civ_id, opp_civ_id))""",
    **BY_ELO,
)
add("h2h_curve", lambda t: q.h2h_curve(m.matchups_by_elo(t.matches, t.players), 1, 2), "select elo_bucket, games, winrate from by_elo where civ_id = 1 and opp_civ_id = 2 and elo_bucket <> 'all'", **BY_ELO)
add("h2h_maps", lambda t: q.h2h_maps(m.matchups(t.matches, t.players, by="map_id"), 3), "select civ_id, opp_civ_id, map_id, games, winrate from by_map where map_id in (select map_id from by_map group by 1 order by sum(games) desc, map_id limit 3)", **BY_MAP)
COMPS = {"comps": mart("winner_comps")[1:-1]}


def comps(t: Tables):
    return m.winner_comps(m.winners(t.matches, t.players), t.units, t.unit_names, WN, SH)


add(
    "comp_bucket",
    lambda t: q.comp_bucket(comps(t), "1000-1199"),
    f"select civ_id, case when list_contains(b, '1000-1199') then '1000-1199' else b[len(b) // 2 + 1] end as elo_bucket from (select civ_id, list(elo_bucket order by i) as b from (select distinct civ_id, elo_bucket, {PLACE} as i from comps) group by 1)",
    **COMPS,
)
VARIANTS = "select c_mktsegment as canonical, c_nationkey % 5 as v, count(*) as games, count(distinct c_nationkey) as civs from customer group by all"
add(
    "map_variants",
    lambda t: q.best_variant(t.raw("customer").groupBy(F.col("c_mktsegment").alias("canonical"), (F.col("c_nationkey") % 5).alias("v")).agg(F.count(F.lit(1)).alias("games"), F.count_distinct("c_nationkey").alias("civs")).withColumn("slug", F.concat_ws("-", "canonical", "v")), 3),
    f"select canonical, arg_max(slug, (games, slug)) as slug, max(games) as games from (select *, canonical || '-' || v as slug from ({VARIANTS})) where civs >= 3 group by 1",
)
add("top_civs", lambda t: q.top_n(meta(t).filter("ladder = '1v1' and elo_bucket = 'all'").select("civ_id", "winrate", "games"), [F.desc("winrate"), F.asc("civ_id")], 4), f"select civ_id, winrate, games from {mart('civ_meta')} where ladder = '1v1' and elo_bucket = 'all' order by winrate desc, civ_id limit 4")
SHOWN = "civ_id, winrate, games"
add("top_civs_by_map", lambda t: q.top_n(m.civ_meta_by_map(m.results(t.matches, t.players)).filter("ladder = '1v1'").select("civ_id", "map_id", "winrate", "games"), [F.desc("winrate"), F.asc("map_id")], 10, ["civ_id"]), f"select civ_id, map_id, winrate, games from {mart('civ_meta_by_map')} where ladder = '1v1' qualify row_number() over (partition by civ_id order by winrate desc, map_id) <= 10")
add("civ_trend_by_elo", lambda t: q.trend(meta(t).filter("ladder = '1v1' and elo_bucket <> 'all'"), q.band_order(F.col("elo_bucket")), "elo_bucket"), f"select {SHOWN}, elo_bucket, cast(row_number() over (partition by civ_id order by {PLACE}) as int) as nth from {mart('civ_meta')} where ladder = '1v1' and elo_bucket <> 'all'")
add("civ_trend_by_patch", lambda t: q.trend(m.civ_meta_by_patch(m.results(t.matches, t.players)).filter("ladder = '1v1'"), F.col("build"), "build"), f"select {SHOWN}, build, cast(row_number() over (partition by civ_id order by build) as int) as nth from {mart('civ_meta_by_patch')} where ladder = '1v1'")
add(
    "peer_average",
    lambda t: q.peer_average(t.raw("part").selectExpr("p_partkey", "p_brand", "cast(p_size as bigint) p_size"), "p_brand", "p_partkey", "p_size"),
    "select p_partkey, p_brand, p_size, peers, peer_mean, p_size - peer_mean as difference from (select p_partkey, p_brand, cast(p_size as bigint) as p_size, count(*) over w as peers, cast(round(avg(p_size) over w) as bigint) as peer_mean from part window w as (partition by p_brand)) where peers >= 3",
)
add("tier_counts", lambda t: q.tier_counts(m.civ_meta_by_map(m.results(t.matches, t.players))), f"select tier, n, cast(sum(n) over () as bigint) as total from (select {TIER} as tier, count(*) as n from {mart('civ_meta_by_map')} group by 1)")
add("match_total", lambda t: q.match_total(meta(t).filter("elo_bucket = 'all'")), f"select cast(floor(sum(games) / 2 / 10000) * 10000 as bigint) as matches from {mart('civ_meta')} where elo_bucket = 'all'")
KEPT = "select build, 'Update ' || build as label, matches from (select build, count(*) as matches from f_matches where ladder = '1v1' and build is not null group by 1) where matches >= 20 order by build desc limit 5"


def kept(t: Tables):
    return d.kept_patches(m.patch_axis(t.matches), 20, 5)


add("kept_patches", kept, KEPT)


def civ_documents(t: Tables):
    """All win rates of the document are summed from one finest aggregate."""
    rows = saved(m.finest(t.matches, t.players), "finest")
    return d.doc_civ_meta(t.civs, m.civ_meta(rows), m.civ_meta_by_map(rows), m.civ_meta_by_patch(rows), m.civ_meta_openings(rows), m.civ_meta_ageup(t.matches, t.players), kept(t), 50, 10, 20, 10)


add("doc_civ_meta", lambda t: civ_documents(t).select("civ_id", "slug", F.explode_outer("ladders").alias("ladder", "v")).select("civ_id", "slug", "ladder", "v.games", "v.winrate", "v.play_rate", "v.tier", *(F.coalesce(F.size(f"v.{x}"), F.lit(0)).alias(x) for x in ("by_elo", "by_map", "by_patch", "openings")), F.element_at("v.by_elo", "1400-1649")["games"].alias("games_1400"), F.get("v.openings", F.lit(0))["opening"].alias("opening"), "v.age_up.feudal_median", F.expr("array_join(transform(v.openings, o -> concat(o.opening, ':', cast(round(o.share * 100) as bigint))), ',')").alias("shares"), F.expr("array_join(transform(array_sort(map_keys(v.by_elo)), k -> concat(k, ':', v.by_elo[k].games)), ',')").alias("elo_games")), f"""select c.civ_id, slug, ladder, games, winrate, play_rate, case when ladder is not null then {TIER} end as tier, coalesce(by_elo, 0) as by_elo, coalesce(by_map, 0) as by_map, coalesce(by_patch, 0) as by_patch, coalesce(openings, 0) as openings, games_1400, opening, case when castle_median is not null and imperial_median is not null then round(feudal_median) end as feudal_median, (select string_agg(w.opening_kind || ':' || cast(round(w.games / a.games * 10000) as bigint), ',' order by w.rank) from {mart("civ_meta_openings")} w where w.civ_id = a.civ_id and w.ladder = a.ladder and w.rank <= 3) as shares, elo_games
    from (select * from f_civs where civ_id <> 0) c left join (select *, round(games / greatest(ladder_total_games, 1) * 10000) / 100 as play_rate from {mart("civ_meta")} where elo_bucket = 'all' and games >= 50) a on a.civ_id = c.civ_id
    left join (select civ_id as c1, ladder as l1, cast(count(*) as int) as by_elo, string_agg(elo_bucket || ':' || games, ',' order by elo_bucket) as elo_games, max(case when elo_bucket = '1400-1649' then games end) as games_1400 from {mart("civ_meta")} where elo_bucket <> 'all' and games >= 10 group by all) e on c1 = a.civ_id and l1 = a.ladder
    left join (select civ_id as c2, ladder as l2, cast(count(*) as int) as by_map from {mart("civ_meta_by_map")} where games >= 20 group by all) b on c2 = a.civ_id and l2 = a.ladder
    left join (select civ_id as c3, ladder as l3, cast(count(*) as int) as by_patch from {mart("civ_meta_by_patch")} where games >= 10 and build in (select build from kept) group by all) p on c3 = a.civ_id and l3 = a.ladder
    left join (select civ_id as c4, ladder as l4, cast(least(count(*), 3) as int) as openings, max(case when rank = 1 then opening_kind end) as opening from {mart("civ_meta_openings")} group by all) o on c4 = a.civ_id and l4 = a.ladder
    left join (select civ_id as c5, ladder as l5, feudal_median, castle_median, imperial_median from {mart("civ_meta_ageup")}) g on c5 = a.civ_id and l5 = a.ladder""", kept=KEPT)
LADDERS = f"select civ_id, ladder, games as overall from {mart('civ_meta')} where elo_bucket = 'all' and games >= 50 and civ_id in (select civ_id from f_civs where civ_id <> 0)"
add(
    "doc_civ_openings",
    lambda t: civ_documents(t).select("civ_id", F.explode("ladders").alias("ladder", "v")).select("civ_id", "ladder", F.posexplode("v.openings").alias("nth", "o")).select("civ_id", "ladder", "nth", "o.*"),
    f"select civ_id, ladder, cast(rank - 1 as int) as nth, opening_kind as opening, round(games / overall * 10000) / 100 as share from {mart('civ_meta_openings')} join ladders using (civ_id, ladder) where rank <= 3",
    ladders=LADDERS,
)
PARTS = {"elo": ("elo_bucket", "civ_meta", "elo_bucket <> 'all' and games >= 10"), "map": ("map_id", "civ_meta_by_map", "games >= 20"), "patch": ("build", "civ_meta_by_patch", "games >= 10 and build in (select build from kept)")}


def civ_cells(t: Tables):
    """Every entry of the documents' maps by band, map and patch."""
    v = civ_documents(t).select("civ_id", F.explode("ladders").alias("ladder", "v"))
    parts = [v.select("civ_id", "ladder", F.lit(p).alias("part"), F.explode(f"v.by_{p}").alias("key", "x")).select("civ_id", "ladder", "part", F.col("key").cast("string").alias("key"), "x.games", "x.winrate") for p in PARTS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


add("doc_civ_cells", civ_cells, " union all ".join(f"select civ_id, ladder, '{p}' as part, cast({key} as varchar) as key, games, winrate from {mart(of)} semi join ladders using (civ_id, ladder) where {where}" for p, (key, of, where) in PARTS.items()), ladders=LADDERS, kept=KEPT)
ENTRY = "o.opponent opponent, o.winrate winrate, o.games games"


def listed(docs, *keys: str):
    """The entries of nested documents as rows, numbered in their order."""
    return docs.select(*keys, F.posexplode("opponents").alias("nth", "o")).selectExpr(*keys, "nth", *(x.strip() for x in ENTRY.split(",")))


def entries(name: str, keys: str, games: int) -> str:
    return f"select {keys}, cast(row_number() over (partition by {keys} order by winrate desc, opp_civ_id) - 1 as int) as nth, opp_civ_id as opponent, winrate, games from {mart(name)} where games >= {games}"


add("doc_matchups", lambda t: listed(d.doc_matchups(m.matchups(t.matches, t.players), 10), "civ_id"), entries("matchups_1v1", "civ_id", 10))
add("doc_matchups_team", lambda t: listed(d.doc_matchups(m.matchups(t.matches, t.players, "team"), 20), "civ_id"), entries("matchups_team", "civ_id", 20))
add("doc_matchups_by_map", lambda t: listed(d.doc_matchups_by_map(m.matchups(t.matches, t.players, by="map_id"), 2).select("civ_id", F.explode("maps").alias("map_id", "opponents")), "civ_id", "map_id"), f"select * replace (cast(map_id as varchar) as map_id) from ({entries('matchups_1v1_by_map', 'civ_id, map_id', 2)})")
add("doc_matchups_by_elo", lambda t: d.doc_matchups_by_elo(m.matchups_by_elo(t.matches, t.players), 5).select("civ_id", "opp_civ_id", F.explode("cells").alias("elo_bucket", "cell")).selectExpr("civ_id", "opp_civ_id", "elo_bucket", "cell[0] winrate", "cast(cell[1] as bigint) games"), f"select civ_id, opp_civ_id, elo_bucket, winrate, games from {mart('matchups_1v1_by_elo')} where games >= 5")
add(
    "doc_civ_cube",
    lambda t: d.doc_cube(cube(t), t.maps, kept(t), list(BANDS)),
    f"""select cast(dense_rank() over (order by civ_id) - 1 as int) as civ, {PLACE} as elo, cast(dense_rank() over (order by g desc, slug) - 1 as int) as map, month, games, wins
    from (select r.*, sum(games) over (partition by map_id) as g, month from cube r join (select build, cast(row_number() over (order by build desc) - 1 as int) as month from kept) using (build)) join f_maps using (map_id)""",
    kept=KEPT,
    **CUBES,
)
CELLS = {"ageup": mart("benchmark_ageup")[1:-1], "vils": mart("benchmark_vils")[1:-1]}


def bench(t: Tables):
    return m.benchmark_ageup(t.matches, t.players, N), m.benchmark_vils(t.matches, t.players, t.ages, N)


add("doc_benchmark", lambda t: d.doc_benchmark(*bench(t)), "select civ_id, map_id, elo_bucket, ladder, feudal_median as feudal_s, castle_median as castle_s, imperial_median as imperial_s, vils_median as vils_castle from ageup left join vils using (civ_id, map_id, elo_bucket, ladder)", **CELLS)
add("doc_benchmark_skipped", lambda t: d.skipped(*bench(t)), "select count(*) as skipped from vils anti join ageup using (civ_id, map_id, elo_bucket, ladder)", **CELLS)
add("doc_eco", lambda t: d.doc_eco(m.benchmark_ecotech(t.matches, t.players, t.techs, N)), f"select tech_id, map_id, elo_bucket, ladder, round(p25_ms / 1000 * 10) / 10 as p25, round(p50_ms / 1000 * 10) / 10 as p50, round(p75_ms / 1000 * 10) / 10 as p75, n from {mart('benchmark_ecotech')}")


def eco_cells(t: Tables):
    """The nested document, taken apart again."""
    docs = d.nested_eco(d.doc_eco(m.benchmark_ecotech(t.matches, t.players, t.techs, N)))
    for key, name in (("map_id", "cells"), ("elo_bucket", "v"), ("ladder", "v")):
        docs = docs.select(*(c for c in docs.columns if c != name), F.explode(name).alias(key, "v"))
    return docs.select("tech_id", "map_id", "elo_bucket", "ladder", "v.*")


add("doc_eco_nested", eco_cells, f"select * from ({ORACLE['doc_eco']})")
add("doc_winner_comps", lambda t: d.doc_winner_comps(comps(t)).select("civ_id", F.explode("bands").alias("elo_bucket", "items")).select("civ_id", "elo_bucket", F.posexplode("items").alias("nth", "v")).select("civ_id", "elo_bucket", "nth", "v.*"), f"select civ_id, elo_bucket, rank - 1 as nth, unit, share, trained_median from {mart('winner_comps')} where rank <= 6")


def refs(t: Tables):
    every = m.winners(t.matches, t.players, None, random_civ=True)
    return m.winner_refs_openings(every.filter("civ_id <> 0"), WN, SH), m.winner_refs_ecotech(m.winners(t.matches, t.players, random_civ=True), t.techs, N), m.winner_refs_meds(every, t.events, N)


def refs_parts(t: Tables):
    """The document's JSON values, taken apart: section, key, nth, name, value."""
    docs = d.doc_winner_refs(*refs(t))
    of = lambda section, name: docs.filter(f"section = '{section}'").select("section", "key", F.posexplode(F.from_json("value", f"array<struct<{name}:string,share:double>>")).alias("nth", "v")).select("section", "key", "nth", F.col(f"v.{name}").alias("name"), F.col("v.share").alias("value"))
    meds = docs.filter("section like 'meds%'").select("section", "key", F.lit(0).alias("nth"), F.explode(F.from_json("value", "map<string,double>")).alias("name", "value"))
    return of("openings", "opening_kind").union(of("ecotech", "tech_id")).union(meds)


MED_NAMES = ["n", "military_median", *(f"t{x}_median" for x in m.REF_TECHS[:4])]
add(
    "doc_winner_refs",
    refs_parts,
    f"""select 'openings' as section, civ_id || '/' || elo_bucket as key, rank - 1 as nth, opening_kind as name, share as value from {mart("winner_refs_openings")} where rank <= 5
    union all select 'ecotech', elo_bucket, cast(row_number() over (partition by elo_bucket order by tech_id) - 1 as int), cast(tech_id as varchar), share from {mart("winner_refs_ecotech")}
    union all select case when map_id = 'all' then 'meds' else 'meds_by_map' end, case when map_id = 'all' then elo_bucket else map_id || '/' || elo_bucket end, 0, name, value
    from (unpivot (select map_id, elo_bucket, {", ".join(f"cast({c} as double) as {c}" for c in MED_NAMES)} from {mart("winner_refs_meds")}) on {", ".join(MED_NAMES)} into name name value value)""",
)
add("source_date", lambda t: d.source_date(t.matches), "select strftime(max(played_at), '%Y-%m') as source_date from f_matches")
add("all_slugs", lambda t: d.all_slugs(t.civs), "select slug from f_civs where civ_id <> 0")
