"""Queries over data-quality checks and text operators, and their twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from laddermill.functions.scalars import BANDS, tier_of
from laddermill.operators import marts as m
from laddermill.operators import quality as v
from laddermill.operators import text as x
from laddermill.plans.cube import CUBES, TIER, cube, mart
from laddermill.sources.roles import Tables, twin

QUERIES, ORACLE = {}, {}


def add(name: str, query, sql: str | None, **ctes: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: query(Tables(spark, sf_dir))
    if sql:
        ORACLE[name] = twin(sql, **ctes)


def row(check: str, key: str, detail: str, source: str) -> str:
    return f"select '{check}' as check, cast({key} as varchar) as key, cast({detail} as varchar) as detail from {source}"


def union(*rows: str) -> str:
    return " union all ".join(rows).replace(" as check,", ' as "check",')


add("dq_not_null", lambda t: v.not_null(t.players, ["elo", "won", "castle_t"], "match_id"), union(*(row("not_null", "match_id", f"'{c}'", f"f_players where {c} is null") for c in ("elo", "won", "castle_t"))))
add("dq_unique", lambda t: v.unique(t.raw("lineitem").select(F.concat_ws("/", "l_orderkey", "l_linenumber").alias("k")), "k"), union(row("unique", "k", "n", "(select l_orderkey || '/' || l_linenumber as k, count(*) as n from lineitem group by 1 having count(*) > 1)")))
add(
    "dq_vocabulary",
    lambda t: v.vocabulary(m.rated(t.players).join(t.matches, "match_id"), {"ladder": ["1v1"], "elo_bucket": list(BANDS)[:4], "opening_kind": ["scouts", "archers"]}),
    union(*(row("vocabulary", f"'{c}=' || {c}", "count(*)", f"f_rated join f_matches using (match_id) where {c} not in ({vs}) group by {c}") for c, vs in (("ladder", "'1v1'"), ("elo_bucket", ", ".join(f"'{b}'" for b in list(BANDS)[:4])), ("opening_kind", "'scouts', 'archers'")))),
)
add("dq_elo_coverage", lambda t: v.coverage(t.players.join(t.matches, "match_id"), "elo", 0.99, "map_id"), "select n, have, nulls, round(have / n, 6) as share, have >= n * 0.99 and nulls = 0 as passed from (select count(*) as n, count(elo) as have, count(*) filter (where map_id is null) as nulls from f_players join f_matches using (match_id))")
add(
    "dq_rates",
    lambda t: v.rates(m.civ_meta_by_map(m.results(t.matches, t.players)).withColumn("winrate", F.col("winrate") * 2.05).withColumn("tier", F.when(F.expr("civ_id = 3"), "X").when(F.expr("civ_id <> 4"), tier_of(F.col("winrate")))), "winrate", "tier", F.concat_ws("/", "civ_id", "ladder", "map_id")),
    union(row("rate_range", "civ_id || '/' || ladder || '/' || map_id", "winrate", "bad where winrate > 100"), row("tier", "civ_id || '/' || ladder || '/' || map_id", "'X'", "bad where civ_id = 3")),
    bad=f"select civ_id, ladder, map_id, winrate * 2.05::double as winrate from {mart('civ_meta_by_map')}",
)
add(
    "dq_cube",
    lambda t: v.cube(cube(t).withColumn("wins", F.expr("case when civ_id = 2 then games + 1 else wins end")), {"map_id": t.maps.filter("map_id <> 4"), "civ_id": t.civs}, F.concat_ws("/", "civ_id", "elo_bucket", "map_id", "build")),
    union(row("cube_counts", "civ_id || '/' || elo_bucket || '/' || map_id || '/' || build", "(games + 1) || '/' || games", "cube where civ_id = 2"), row("cube_map_id", "civ_id || '/' || elo_bucket || '/' || map_id || '/' || build", "map_id", "cube where map_id = 4")),
    **CUBES,
)
PART = "select p_partkey, replace(lower(p_name), ' ', case when p_partkey % 10 = 0 then '_' else '-' end) as slug, p_brand, case when p_partkey % 7 = 0 then p_name else replace(array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' '), ' ', case when p_partkey % 5 = 0 then ' and ' when p_partkey % 11 = 0 then ' 2' else ' ' end) end as label, p_partkey % 9 as b from part"


def labelled(t: Tables):
    return t.raw("part").selectExpr("p_partkey", "replace(lower(p_name), ' ', case when p_partkey % 10 = 0 then '_' else '-' end) slug", "p_brand", "case when p_partkey % 7 = 0 then p_name else replace(initcap(p_name), ' ', case when p_partkey % 5 = 0 then ' and ' when p_partkey % 11 = 0 then ' 2' else ' ' end) end label", "case when p_partkey % 9 = 0 then cast(array() as array<string>) when p_partkey % 13 = 0 then array('x', 'all-Azure.') else array('x') end bonuses")


add(
    "dq_text_rules",
    lambda t: v.text_rules(labelled(t), "p_partkey", "slug", "p_brand", "label", "bonuses", ["Brand#11", "Brand#12", "Brand#13"], ["blue", "azure"]),
    union(
        row("slug", "p_partkey", "label", "named where not regexp_full_match(slug, '[a-z0-9-]+')"),
        row("region", "p_partkey", "label", "named where p_brand not in ('Brand#11', 'Brand#12', 'Brand#13')"),
        row("title", "p_partkey", "label", "named where regexp_matches(replace(label, ' and ', ' '), '(^| )[^A-Z]')"),
        row("typo", "p_partkey", "label", "named where list_has_any(string_split(lower(label), ' '), ['blue', 'azure']) or b <> 0 and p_partkey % 13 = 0"),
        row("bonus", "p_partkey", "label", "named where b = 0"),
    ),
    named=PART,
)
STEPS = "l_orderkey as build_id, l_linenumber as nth, case when l_suppkey % 6 > 0 then cast(l_quantity as int) end as counter, case when l_suppkey % 7 > 0 then l_linenumber * 60 + l_suppkey % 90 end as at_s, l_partkey % 3 as phase, case l_partkey % 4 when 0 then '+' || (l_partkey % 6) || ' -> wood' when 1 then 'then +3 →' when 2 then '+1→a, +2→b' end as text"
ENDS = "select build_id, arg_max(at_s, nth) filter (where at_s is not null) as last_s, max(phase) as top from steps group by 1"
add(
    "dq_sequence",
    lambda t: v.sequence(t.lines.selectExpr("l_orderkey build_id", "l_linenumber nth", "case when l_suppkey % 6 > 0 then cast(l_quantity as int) end counter", "case when l_suppkey % 7 > 0 then l_linenumber * 60 + l_suppkey % 90 end at_s", "l_partkey % 3 phase", "case l_partkey % 4 when 0 then concat('+', l_partkey % 6, ' -> wood') when 1 then 'then +3 →' when 2 then '+1→a, +2→b' end text", "l_suppkey % 25 unit"), t.raw("orders").selectExpr("o_orderkey build_id", "o_orderkey % 300 duration_s", "1 target_phase"), facts=t.raw("nation").selectExpr("n_nationkey unit", "n_regionkey phase")),
    union(
        row("counter", "build_id || '/' || nth", "counter", "seq where counter < c0"),
        row("delta", "build_id || '/' || nth", "counter", "seq where l4 and stated and said <> counter - c0"),
        row("time", "build_id || '/' || nth", "counter", "(select * from seq where at_s <= t0 qualify row_number() over (partition by build_id order by nth) = 1)"),
        row("phase", "build_id || '/' || nth", "counter", "(select * from seq where phase < p0 qualify row_number() over (partition by build_id order by nth) = 1)"),
        row("length", "build_id", "last_s", "ends where last_s > build_id % 300 + 90"),
        row("target", "build_id", "top", "ends where top > 1"),
        row("unit", "build_id || '/' || unit", "n_regionkey", "(select distinct l_orderkey as build_id, l_suppkey % 25 as unit from l1) join nation on unit = n_nationkey where n_regionkey > 1"),
    ),
    steps=f"select {STEPS} from l1",
    ends=ENDS,
    seq="select *, text like '%wood' as l4, try_cast(regexp_extract(text, '[0-9]+') as int) as said, lag(counter is not null) over (partition by build_id order by nth) as stated, last_value(counter ignore nulls) over w as c0, last_value(at_s ignore nulls) over w as t0, max(phase) over w as p0 from steps window w as (partition by build_id order by nth rows between unbounded preceding and 1 preceding)",
)
FLAT = r"trim(regexp_replace(d.text, '\s+', ' ', 'g'))"
add(
    "dq_pairs",
    lambda t: v.pairs(t.raw("documents").select("doc_id", "text", "lang", "source"), t.raw("documents").filter("doc_id % 3 <> 0").selectExpr("doc_id", "case when doc_id % 5 = 0 then concat('  ', text) else reverse(text) end text", "case when doc_id % 2 = 0 then 'xx' else lang end lang", "source"), "doc_id", "text", ["lang", "source"], ["src0", "en"]),
    union(
        row("missing", "doc_id", "''", "documents where doc_id % 3 = 0"),
        row("same_body", "doc_id", "''", f"documents d where doc_id % 3 <> 0 and {FLAT} = trim(regexp_replace(case when doc_id % 5 = 0 then '  ' || d.text else reverse(d.text) end, '\\s+', ' ', 'g'))"),
        row("same_field", "doc_id", "'lang'", "documents where doc_id % 3 <> 0 and doc_id % 2 <> 0 and lang <> 'en'"),
        row("same_field", "doc_id", "'source'", "documents where doc_id % 3 <> 0 and source <> 'src0'"),
    ),
)
add("dq_fk", lambda t: v.foreign_keys(t.units, t.units.select("unit_id").distinct().filter("unit_id < 100"), "unit_id"), union(row("fk_unit_id", "unit_id", "count(*)", "f_units where unit_id >= 100 group by unit_id")))
add("dq_id_spaces", lambda t: v.id_spaces(t.civs.selectExpr("civ_id id", "slug"), t.civs.selectExpr("7 - civ_id id", "slug"), t.civs.selectExpr("civ_id id", "case when civ_id = 3 then 'other' else slug end slug")), union(row("mirror", "civ_id", "slug || '/other'", "f_civs where civ_id = 3")))
SUMMARY = ("elo", "won", "castle_t")
add(
    "dq_summary",
    lambda t: v.summarize(v.not_null(t.players, list(SUMMARY), "match_id").unionByName(v.unique(t.raw("orders"), "o_orderkey")), t.players.agg(F.count(F.lit(1)).alias("checked")).withColumn("check", F.lit("not_null")).unionByName(t.raw("orders").agg(F.count(F.lit(1)).alias("checked")).withColumn("check", F.lit("unique")))),
    """select "check", violations, checked, violations = 0 as passed from (select 'not_null' as "check", (select count(*) filter (where elo is null) + count(*) filter (where won is null) + count(*) filter (where castle_t is null) from f_players) as violations, (select count(*) from f_players) as checked
    union all select 'unique', (select count(*) from (select o_orderkey from orders group by 1 having count(*) > 1)), (select count(*) from orders))""",
)

add(
    "mode_per_key",
    lambda t: x.mode_per_key(t.raw("lineitem"), "l_suppkey", F.struct(F.col("l_returnflag").alias("building"), F.least(F.floor(F.col("l_linenumber") / 2), F.lit(3)).cast("int").alias("band")), F.col("l_partkey") % 5).select("l_suppkey", "value.*", "n"),
    """select l_suppkey, building, band, n from (select l_suppkey, l_returnflag as building, cast(least(l_linenumber // 2, 3) as int) as band, cast(sum(l_partkey % 5) as bigint) as n from lineitem group by all)
    qualify row_number() over (partition by l_suppkey order by n desc, building, band) = 1""",
)
add("conflict_dedupe", lambda t: x.consensus(t.raw("lineitem").withColumn("k", F.concat_ws("/", "l_orderkey", "l_linenumber")), "k", ["l_partkey", "l_suppkey"])[1], "select l_orderkey || '/' || l_linenumber as k, count(distinct (l_partkey, l_suppkey)) as variants from lineitem group by 1 having count(distinct (l_partkey, l_suppkey)) > 1")
add(
    "first_wins",
    lambda t: x.first_wins(t.raw("orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", ["o_orderdate", "o_orderkey"], t.raw("customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), {-1: 7, -2: 7, 8: 7, 10: 8}),
    """select * from first union all select alias, o_orderkey, o_orderdate from first join (values (-1, 7), (-2, 7), (8, 7), (10, 8)) v(alias, source) on o_custkey = source where alias not in (select o_custkey from first)""",
    first="select o_custkey, o_orderkey, o_orderdate from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0) qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1",
)
add("resolve_names", lambda t: x.resolve_names(t.raw("supplier").select("s_suppkey", F.col("s_nationkey").alias("k")), t.raw("nation").filter("n_nationkey < 20").select(F.col("n_nationkey").alias("k"), "n_name"), "k"), "select s_suppkey, s_nationkey as k, n_name from supplier join nation on s_nationkey = n_nationkey where n_nationkey < 20")
BONUS = "array(named_struct('class', cast(n_nationkey % 3 + 5 as int), 'amount', cast(n_nationkey % 2 as int)), named_struct('class', cast(n_nationkey % 5 as int), 'amount', cast(n_nationkey % 4 as int)))"
add(
    "bonus_string",
    lambda t: x.bonus_string(t.raw("nation").selectExpr("n_nationkey", f"{BONUS} bonuses"), t.raw("nation").selectExpr("cast(n_nationkey as int) class", "lower(n_name) label"), "n_nationkey", [0]),
    """select n.n_nationkey, nullif(concat_ws(';', case when n.n_nationkey % 2 > 0 then '+' || (n.n_nationkey % 2) || ' ' || lower(b.n_name) end, case when n.n_nationkey % 4 > 0 and n.n_nationkey % 5 <> 0 then '+' || (n.n_nationkey % 4) || ' ' || lower(a.n_name) end), '') as bonus
    from nation n join nation a on a.n_nationkey = n.n_nationkey % 5 join nation b on b.n_nationkey = n.n_nationkey % 3 + 5""",
)
add("sparse_map", lambda t: t.raw("supplier").selectExpr("s_suppkey", "s_suppkey % 2 food", "s_suppkey % 3 wood", "s_suppkey % 5 gold").select("s_suppkey", F.to_json(x.sparse_map(["food", "wood", "gold"])).alias("costs")), "select s_suppkey, '{' || concat_ws(',', case when s_suppkey % 2 <> 0 then '\"food\":' || (s_suppkey % 2) end, case when s_suppkey % 3 <> 0 then '\"wood\":' || (s_suppkey % 3) end, case when s_suppkey % 5 <> 0 then '\"gold\":' || (s_suppkey % 5) end) || '}' as costs from supplier")
HTML = "trim(regexp_replace(regexp_replace(regexp_replace({}, '(?i)<br\\s*/?>', ' ', 'g'), '<[^>]*>', '', 'g'), '[ \\t\\r\\n]+', ' ', 'g'))"
add("html_text", lambda t: t.raw("pages").select("page_id", F.sha2(x.html_text(F.col("html")), 256).alias("text_sha256"), x.span(F.col("html"), "b").alias("bold")), f"select page_id, sha256({HTML.format('html')}) as text_sha256, nullif({HTML.format(chr(39).join(['regexp_extract(html, ', '(?s)<b>(.*?)</b>', ', 1)']))}, '') as bold from pages")
HELP = "concat('• early, ', n_name, '\\nno bullet\\nUnique units (all):\\nfirst (', n_regionkey, ' gold), second\\nTECHS\\n• one, two (a, b)\\nleft out\\n•third\\nTeam bonus\\ncheap, ', n_regionkey, '\\nfast')"
SECTIONS = {"bonus": ((), "bullets"), "units": (("unique unit",), "list"), "techs": (("techs",), "effects"), "team": (("team",), "text")}
add(
    "sectioned_text",
    lambda t: x.sectioned_text(t.raw("nation").selectExpr("n_nationkey", f"{HELP} help", "n_name"), "n_nationkey", "help", SECTIONS, "bonus", {"techs": 2}),
    """select n_nationkey, section, nth, part, replace(replace(name, '$n', n_name), '$r', cast(n_regionkey as varchar)) as name, effect from nation, (values ('bonus', 0, 0, 'early, $n', null), ('units', 3, 0, 'first', null), ('units', 3, 1, 'second', null),
    ('techs', 5, 0, 'one, two', 'a, b'), ('techs', 7, 0, 'third', null), ('team', 9, 0, 'cheap, $r fast', null)) v(section, nth, part, name, effect)""",
)
add("canonical_join", lambda t: x.canonical_join(t.raw("supplier").select("s_suppkey", F.col("s_nationkey").alias("k")), t.raw("nation").select(F.col("n_nationkey").alias("k"), "n_name"), "k", ["n_name", "s_suppkey"]), "select s_nationkey as k, s_suppkey, n_name from supplier join nation on s_nationkey = n_nationkey")
add("facet_search", lambda t: x.facet_search(t.raw("documents").withColumn("facets", F.concat_ws(" ", "lang", "source")), "text", "The ", {"facets": "src1"}).select("doc_id", "source"), "select doc_id, source from documents where contains(lower(text), 'the ') and source = 'src1'")
add(
    "locale_fallback",
    lambda t: x.localize(t.raw("documents").selectExpr("cast(doc_id div 2 as bigint) k", "case when doc_id % 2 = 0 then 'base' else 'own' end locale", "text", "lang").filter("locale = 'base' or k % 3 = 0"), "own", "base", "k", ["lang"]),
    "select b.doc_id // 2 as k, case when o.doc_id is not null then o.lang else b.lang end as lang, o.doc_id is null as fallback from documents b left join documents o on o.doc_id = b.doc_id + 1 and (o.doc_id // 2) % 3 = 0 where b.doc_id % 2 = 0",
)
