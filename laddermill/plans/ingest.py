"""Queries over scalars, conforming and upserts, and their twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from laddermill.functions import scalars as s
from laddermill.operators import ingest as g
from laddermill.sources.archives import MAP_ALIASES, scratch
from laddermill.sources.roles import Tables, twin
from laddermill.sources.targets import Target

QUERIES, ORACLE = {}, {}


def add(name: str, query, sql: str | None, **ctes: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: query(Tables(spark, sf_dir))
    if sql:
        ORACLE[name] = twin(sql, **ctes)


BAND = "select distinct elo, elo_bucket from f_rated"
NAMES = "select p_partkey, p_name from part"
add("slug", lambda t: t.raw("customer").select("c_custkey", s.slug(F.col("c_name")).alias("slug")), "select c_custkey, lower(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')) as slug from customer")
add("slug_alias", lambda t: t.maps.select("map_id", s.alias(F.when(F.col("map_id") == 1, "scandanavia").when(F.col("map_id") == 2, "passage").otherwise(F.col("slug")), MAP_ALIASES).alias("slug")), "select map_id, case map_id when 1 then 'scandinavia' when 2 then 'thepassage' else slug end as slug from f_maps")
LB = "case match_id % 5 when 0 then 'random_map' when 1 then 'co_random_map' when 2 then 'team_random_map' when 3 then 'co_team_random_map' end"
add(
    "ladder_case",
    lambda t: t.matches.select("match_id", s.to_ladder(F.expr(LB), F.col("n_players")).alias("ladder")),
    f"select match_id, case when lb like '%team%' then 'team' when lb is not null then '1v1' when n_players = 2 then '1v1' else 'team' end as ladder from (select *, {LB} as lb from f_matches)",
)
add(
    "duration_guard",
    lambda t: t.matches.select("match_id", s.guard_int(F.col("match_id") * 400000).alias("duration_ms")),
    "select match_id, try_cast(match_id * 400000 as int) as duration_ms from f_matches",
)
add("elo_bucket", lambda t: t.players.select("elo", s.elo_bucket(F.col("elo")).alias("elo_bucket")).distinct(), BAND)
KINDS = ", ".join(f"'{x}'" for x in s.OPENINGS)
LABEL = "case p_partkey % 5 when 0 then 'scouts' when 1 then 'unknown' when 2 then 'towers' when 3 then 'other' end"
add("opening_kind", lambda t: t.raw("part").select("p_partkey", s.opening_kind(F.expr(LABEL)).alias("opening_kind")), f"select p_partkey, case when l in ({KINDS}) then l end as opening_kind from (select *, {LABEL} as l from part)")
NATION = "lower(n_name) as map_slug"
add(
    "resolve_dims",
    lambda t: g.resolve_dims(t.raw("part").select("p_partkey", F.lower("p_type").alias("civ_slug")), civ_slug=t.civs.filter("civ_id <> 2")),
    "select lower(p_type) as civ_slug, p_partkey, civ_id from part join f_civs on slug = lower(p_type) where civ_id <> 2",
)
add(
    "unknown_slugs",
    lambda t: g.unknown_values(t.raw("part").select(F.lower("p_type").alias("slug")), t.civs.filter("civ_id > 2"), "slug"),
    "select lower(p_type) as slug, count(*) as n from part where lower(p_type) not in (select slug from f_civs where civ_id > 2) group by 1",
)
add("missing_identity", lambda t: g.missing_identity(t.players, ["match_id", "elo", "castle_t"]), "select count(*) filter (where match_id is null) as missing_match_id, count(*) filter (where elo is null) as missing_elo, count(*) filter (where castle_t is null) as missing_castle_t, count(*) as n from f_players")
LINES = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def insert_lines(t: Tables):
    rows = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    there = t.lines.filter("l_orderkey % 2 = 0").select(*rows.columns)
    return g.insert_new(there, rows, ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


add("insert_new", insert_lines, f"select {LINES} from l1")
add("gate_children", lambda t: g.gate(t.players, t.matches.filter("source = 'replay'")).select("match_id", "profile_id", "civ_id"), "select match_id, profile_id, civ_id from f_players where match_id in (select match_id from f_matches where source = 'replay')")
add("gate_parent", lambda t: g.gate(t.players, t.matches).select("match_id", "profile_id"), "select match_id, profile_id from f_players where match_id in (select match_id from f_matches)")


def upgraded(t: Tables):
    m, p = t.matches.select("match_id", "source", "build"), t.players.select("match_id", "profile_id", "civ_id")
    target = {"matches": m.filter("match_id % 3 <> 0"), "players": p.filter("match_id % 3 <> 0")}
    batch = {"matches": m.filter("match_id % 2 = 0").withColumn("source", F.lit("replay")).withColumn("build", F.col("build") + 100), "players": p.filter("match_id % 2 = 0").withColumn("civ_id", F.col("civ_id") + 10)}
    out = g.upsert(target, batch)
    return out["players"].join(out["matches"], "match_id")


add(
    "upsert_upgrade",
    upgraded,
    """select match_id, profile_id, case when taken then civ_id + 10 else civ_id end as civ_id, case when taken then 'replay' else source end as source, case when taken then build + 100 else build end as build
    from (select p.match_id, profile_id, civ_id, source, build, match_id % 2 = 0 and (match_id % 3 = 0 or source = 'archive') as taken from f_players p join f_matches using (match_id)
          where match_id % 3 <> 0 or match_id % 2 = 0)""",
)
CHILD_TABLES = {"players": "f_players", "events": "f_events", "ages": "f_ages", "units": "f_units", "techs": "f_techs"}


def versioned(t: Tables):
    """upsert_upgrade over a bucketed target with all children, of which the batch brings those of the first three players."""
    t = t.dealt_lines()
    m = t.matches.select("match_id", "source", "build")
    own = {name: getattr(t, name).withColumn("match_id", F.col("match_id").cast("long")) for name in CHILD_TABLES}
    own["age_windows"] = own["ages"].withColumn("uptime_ms", F.lit(-1))
    every = {"matches": m} | own
    held = Target(t.spark, scratch(t.spark, "target"), {name: df.schema for name, df in every.items()}, buckets=max(8, t.parts))
    held.upsert({name: df.filter("match_id % 3 <> 0") for name, df in every.items()}, number=0)
    again = {name: df.filter("match_id % 2 = 0 and profile_id <= 3") for name, df in own.items()}
    again["matches"] = m.filter("match_id % 2 = 0").selectExpr("match_id", "'replay' source", "build + 100 build")
    for _ in range(2):  # a batch that runs again changes nothing
        held.upsert(again, "upgrade", better="source = 'replay'", number=1)
    out = held.read()
    counts = [out[name].groupBy("match_id").agg(F.count(F.lit(1)).alias(f"n_{name}")) for name in own]
    rows = out["matches"]
    for c in counts:
        rows = rows.join(c, "match_id", "left")
    return rows.na.fill(0)


add(
    "upsert_versioned",
    versioned,
    f"""select match_id, case when taken then 'replay' else source end as source, case when taken then build + 100 else build end as build,
    {", ".join(f"coalesce(case when taken then {n}.few else {n}.n end, 0) as n_{n}" for n in [*CHILD_TABLES, "age_windows"])}
    from (select *, match_id % 2 = 0 and (match_id % 3 = 0 or source = 'archive') as taken from f_matches where match_id % 3 <> 0 or match_id % 2 = 0)
    {" ".join(f"left join (select match_id, count(*) as n, count(*) filter (where profile_id <= 3) as few from {sql} group by 1) {n} using (match_id)" for n, sql in (CHILD_TABLES | {"age_windows": "f_ages"}).items())}""",
)
add("replace_scope", lambda t: g.replace_scope(t.ages.select("match_id", "age", "villagers"), t.ages.filter("match_id % 4 = 0 and age = 'dark'").selectExpr("match_id", "age", "villagers + 1 villagers")), "select match_id, age, villagers from f_ages where match_id % 4 <> 0 union all select match_id, age, villagers + 1 from f_ages where match_id % 4 = 0 and age = 'dark'")
add("upsert_dim", lambda t: g.upsert_dim(t.maps, t.maps.filter("map_id < 2").withColumn("name", F.lower("name")), "map_id"), "select map_id, case when map_id < 2 then lower(name) else name end as name, slug, family from f_maps")
KNOWN = "unit_id in (83, 4, 7, 448)"
add("filter_known", lambda t: g.filter_known(t.units, t.units.filter(KNOWN).select("unit_id").distinct(), "unit_id")[1], f"select unit_id, count(*) as dropped from f_units where not {KNOWN} group by 1")


def seeds(t: Tables):
    return t.players.join(t.matches.select("match_id", "played_at", "ladder"), "match_id").selectExpr("match_id", "profile_id", "elo", "ladder", "case when profile_id % 3 = 1 then 'n/a' else concat(date_format(played_at, 'yyyy-MM-dd'), ' 00:00:00') end played_at", "profile_id nth")


add(
    "attach_seed",
    lambda t: g.attach_seed(t.matches, t.players.select("match_id", "profile_id"), seeds(t)),
    """select p.match_id, profile_id, elo, case when good > 0 then ladder end as ladder, case when good > 0 then strftime(played_at, '%Y-%m-%d 00:00:00') end as played_at, bad as bad_times
    from f_players p join f_matches using (match_id) join (select match_id, count(*) filter (where profile_id % 3 <> 1) as good, count(*) filter (where profile_id % 3 = 1) as bad from f_players group by 1) using (match_id)""",
)
add(
    "skip_reasons",
    lambda t: g.classify_skips(t.matches.selectExpr("match_id", "case when match_id % 7 = 0 then 'x' else '12' end duration_text"), t.players.filter("match_id % 11 <> 0"), t.matches.filter("match_id % 5 <> 0"), ["1v1"], t.ages.withColumn("age", F.when(F.expr("match_id % 13 = 0"), "stone").otherwise(F.col("age"))), ["dark", "feudal", "castle"]),
    """select case when match_id % 11 = 0 then 'no_players' when match_id % 5 = 0 then 'no_seed' when ladder <> '1v1' then 'unknown_ladder' when match_id % 7 = 0 then 'bad_numeric' when match_id % 13 = 0 then 'bad_age' else 'ok' end as reason,
    count(*) as n from f_matches group by 1""",
)
add("compose", lambda t: g.compose(t.matches.select("match_id", "map_id", "duration_ms"), t.matches.selectExpr("match_id", "match_id seed_match_id", "case when ladder = '1v1' then 6 else 7 end match_type"), {6: "1v1", 7: "team", 8: "team", 9: "team"}), "select match_id, ladder, map_id, duration_ms from f_matches")
add(
    "backfill_candidates",
    lambda t: g.discover(t.matches, t.players, t.matches.filter("match_id % 10 = 0").select("match_id"), "1995-01-01", 50),
    """select match_id, played_at, array_to_string(list_sort(list(profile_id)), ',') as profile_ids from
    (select match_id, played_at from f_matches where source = 'archive' and played_at >= date '1995-01-01' and match_id % 10 <> 0 order by played_at desc, match_id desc limit 50) join f_players using (match_id) group by all""",
)
MISS = "match_id, case when match_id % 2 = 0 then 'not_found' else 'corrupt' end reason, {} attempted_at"
add("record_misses", lambda t: g.record_misses(t.matches.filter("match_id % 3 = 0").selectExpr("match_id", "'expired' reason", "1 attempted_at"), t.matches.filter("match_id % 2 = 0").selectExpr("match_id", "'not_found' reason", "2 attempted_at")), "select match_id, case when match_id % 3 = 0 then 'expired' else 'not_found' end as reason, case when match_id % 3 = 0 then 1 else 2 end as attempted_at from f_matches where match_id % 3 = 0 or match_id % 2 = 0")
MANIFEST = "match_id, played_at, case match_id % 4 when 0 then 'pending' when 1 then 'error' when 2 then 'expired' else 'done' end status, cast(match_id % 10 as int) attempts, 1000000 - match_id * 7 % 5000 updated_at, case when match_id % 3 = 0 then null else cast(match_id as {0}) end profile_ids, match_id % 100 best_size"
MANIFEST_CTE = {"manifest": f"select {MANIFEST.format('varchar')} from f_matches"}


def manifest(t: Tables):
    return t.matches.selectExpr(*(x.strip() for x in split_top(MANIFEST.format("string"))))


def split_top(text: str) -> list[str]:
    """Items of a select list, cut at the commas outside parentheses."""
    out, depth = [""], 0
    for c in text:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


add("take_ready", lambda t: g.take_ready(manifest(t), 1_000_000, 40), "select match_id, status, attempts, played_at from manifest where status = 'pending' or status = 'error' and attempts < 8 and 1000000 - updated_at >= 60 * (1 << least(attempts, 6)) order by played_at desc, match_id desc limit 40", **MANIFEST_CTE)
add(
    "seed_manifest",
    lambda t: g.seed_manifest(manifest(t).filter("match_id % 5 <> 0").select("match_id", "played_at", "profile_ids", "status", "attempts"), t.matches.filter("match_id % 2 = 0").selectExpr("match_id", "played_at", "explode(array('1,2', null)) profile_ids")),
    """select match_id, played_at, case when known and (profile_ids is not null or not seeded) then profile_ids else '1,2' end as profile_ids,
    case when not known or (seeded and profile_ids is null and status = 'expired') then 'pending' else status end as status, case when known then attempts else 0 end as attempts
    from (select *, match_id % 5 <> 0 as known, match_id % 2 = 0 as seeded from manifest) where known or seeded""",
    **MANIFEST_CTE,
)
add(
    "record_status",
    lambda t: g.record_status(
        manifest(t).selectExpr("match_id", "status", "best_size", "cast(null as string) error", "attempts", "updated_at"),
        t.matches.filter("match_id % 6 = 0").selectExpr("match_id", "explode(array(0, 1)) nth").selectExpr("match_id", "nth", "if(nth = 0, 'error', 'done') status", "case when match_id % 12 = 0 and nth = 0 then 5L end best_size", "if(nth = 0, 'timeout', null) error", "nth = 0 attempts_inc"),
        2_000_000,
    ),
    "select match_id, case when u then 'done' else status end as status, case when match_id % 12 = 0 then 5 else best_size end as best_size, case when u then 'timeout' end as error, attempts + cast(u as int) as attempts, case when u then 2000000 else updated_at end as updated_at from (select *, match_id % 6 = 0 as u from manifest)",
    **MANIFEST_CTE,
)
add("status_counts", lambda t: g.status_counts(manifest(t)), "select status, count(*) as n from manifest group by 1", **MANIFEST_CTE)
add(
    "id_ranges",
    lambda t: g.id_ranges(t.matches, 200, 330, width=1000),
    "select (nth - 330) // 200 as chunk, min(match_id) as low, max(match_id) as high, count(*) as n, max(nth) + 1 as cursor from ranked where nth >= 330 group by 1",
    ranked="select match_id, row_number() over (order by match_id) - 1 as nth from (select distinct match_id from f_matches)",
)
PLACE = "case when profile_id <> 3 then profile_id * 5 % 7 end"
add(
    "merge_seeds",
    lambda t: g.merge_seeds(t.players.select("match_id", "profile_id", "elo", F.expr(PLACE).alias("place"))).select("match_id", "profile_id", "elo"),
    f"select match_id, profile_id, elo from f_players qualify row_number() over (partition by match_id order by {PLACE} nulls last, profile_id) = 1",
)
add("dim_default", lambda t: g.lookup_default(t.players.select("match_id", "profile_id", F.col("civ_id").alias("map_id")), t.maps, "map_id", "family", "other").select("match_id", "profile_id", "map_id", "family"), "select match_id, profile_id, civ_id as map_id, coalesce(family, 'other') as family from f_players left join f_maps on civ_id = map_id")
WL = "wilson(wins, games)"
CENTRE, HALF = "(wins / games + 1.96*1.96 / (2 * games::double))", "(1.96::double * sqrt((wins / games) * (1 - wins / games) / games + 1.96::double*1.96::double / (4 * games::double * games)))"
COUNTED = "select civ_id, count(*) filter (where won) as wins, count(*) as games from f_players where won is not null group by 1"
add(
    "wilson",
    lambda t: t.players.filter("won is not null").groupBy("civ_id").agg(F.count_if("won").alias("wins"), F.count(F.lit(1)).alias("games")).withColumn("w", s.wilson(F.col("wins"), F.col("games"))).select("civ_id", "wins", "games", F.round("w.lo", 9).alias("lo"), F.round("w.hi", 9).alias("hi")),
    f"select civ_id, wins, games, round(({CENTRE} - {HALF}) / (1 + 1.96::double*1.96::double / games), 9) as lo, round(({CENTRE} + {HALF}) / (1 + 1.96::double*1.96::double / games), 9) as hi from ({COUNTED})",
)
add(
    "rounding",
    lambda t: t.raw("supplier").select("s_suppkey", s.pct(F.col("s_suppkey") / 64).alias("pct"), s.round1(F.col("s_suppkey") / 16).alias("round1"), s.round_ms(F.col("s_suppkey") / 2).alias("round_ms")),
    "select s_suppkey, round(s_suppkey / 64 * 10000) / 100 as pct, round(s_suppkey / 16 * 10) / 10 as round1, cast(round(s_suppkey / 2) as bigint) as round_ms from supplier",
)
add("tier", lambda t: t.raw("supplier").select("s_suppkey", s.tier_of(F.col("s_suppkey") % 100 / 2 + 20).alias("tier")), "select s_suppkey, case when x >= 53 then 'S' when x >= 51 then 'A' when x >= 49 then 'B' when x >= 47 then 'C' else 'D' end as tier from (select s_suppkey, s_suppkey % 100 / 2 + 20 as x from supplier)")
add("prettify", lambda t: t.raw("part").select("p_partkey", s.prettify(F.translate(F.lower("p_name"), " ", "-")).alias("title")), "select p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') as title from part")
add("mmss", lambda t: t.raw("supplier").select("s_suppkey", s.mmss(F.col("s_suppkey") * 7.5).alias("t")), "select s_suppkey, printf('%d:%02d', cast(floor(s_suppkey * 7.5) as bigint) // 60, cast(floor(s_suppkey * 7.5) as bigint) % 60) as t from supplier")
add("kebab", lambda t: t.raw("documents").select("doc_id", s.kebab(F.col("text")).alias("words"), s.kebab(F.col("text"), "runs").alias("runs")), """select doc_id, regexp_replace(regexp_replace(regexp_replace(lower(text), '[^a-z0-9_ \\t\\n\\r\\f\\v-]', '', 'g'), '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g'), '[ \\t\\n\\r\\f\\v]+', '-', 'g') as words,
    regexp_replace(regexp_replace(replace(lower(text), '''', ''), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') as runs from documents""")
