"""Queries over sources, sinks and streams. The files that they read are first written from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laddermill.operators import documents as d
from laddermill.operators import marts as m
from laddermill.sources import archives as a
from laddermill.sources.roles import Tables, twin
from laddermill.streaming import streams

QUERIES, ORACLE = {}, {}


def add(name: str, query, sql: str | None = None, **ctes: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: query(Tables(spark, sf_dir))
    if sql:
        ORACLE[name] = twin(sql, **ctes)


def written(df: DataFrame, name: str) -> str:
    """df as files of as many tasks as it takes to read it."""
    path = a.scratch(df.sparkSession, name)
    df.write.parquet(path)
    return path


def landed(df: DataFrame, name: str, times: int = 4) -> tuple[str, int]:
    """df as files that land one after the other, each with part of the rows; and how many files land at once.

    df is written once before, so that it is not made anew for each landing. A stream that takes as many files at a time
    has as many batches as there are landings, whatever the size of the tables.
    """
    path = a.scratch(df.sparkSession, name)
    parted = a.saved(df.withColumn("_part", F.pmod(F.xxhash64(*df.columns), F.lit(times))), f"{name}-whole")
    for i in range(times):
        parted.filter(F.col("_part") == i).drop("_part").write.mode("append").parquet(path)
    return path, max(2, -(-a.listed(df.sparkSession, [path]).count() // times))


def match_files(t: Tables) -> list[str]:
    """Matches as two archive folders, of which the second stores ids as text and times as nanoseconds."""
    rows = t.matches.selectExpr("match_id game_id", "concat('Map ', map_id) map", "cast(played_at as timestamp) started_timestamp", "duration_ms * 1000000L duration", "n_players num_players", "ladder leaderboard", "cast(build as bigint) patch", "'unused' raw")
    return [written(rows.filter("game_id % 2 = 0"), "m"), written(rows.filter("game_id % 2 = 1").withColumn("game_id", F.col("game_id").cast("string")).withColumn("started_timestamp", F.unix_micros("started_timestamp") * 1000), "m")]


def player_files(t: Tables) -> list[str]:
    rows = t.players.selectExpr("match_id game_id", "cast(profile_id as bigint) profile_id", "concat('c', civ_id) civ", "won winner", "opening_kind opening", "cast(feudal_t as double) feudal_age_uptime", "cast(castle_t as double) castle_age_uptime", "cast(imperial_t as double) imperial_age_uptime", "cast(elo as bigint) new_rating")
    third = rows.filter("game_id % 3 = 2").withColumn("profile_id", F.col("profile_id").cast("double")).withColumn("opening", F.lit(None).cast("int"))
    return [written(rows.filter("game_id % 3 = 0"), "p"), written(rows.filter("game_id % 3 = 1").withColumn("profile_id", F.col("profile_id").cast("int")), "p"), written(third, "p")]


add("scan_matches", lambda t: a.read_match_archive(t.spark, match_files(t)).select("game_id", "map", F.to_date("started_timestamp").alias("started_on"), "duration_ms", "num_players", "leaderboard", "patch"), "select match_id as game_id, 'map' || map_id as map, cast(played_at as date) as started_on, cast(duration_ms as bigint) as duration_ms, n_players as num_players, ladder as leaderboard, cast(build as bigint) as patch from f_matches")
SCAN = "select match_id as game_id, cast(profile_id as bigint) as profile_id, 'c' || civ_id as civ, won as winner, {} as opening, cast(feudal_t as double) as feudal_age_uptime, cast(castle_t as double) as castle_age_uptime, cast(imperial_t as double) as imperial_age_uptime, cast(elo as bigint) as new_rating from f_players"
add("scan_players", lambda t: a.read_player_archive(t.spark, player_files(t)), SCAN.format("case when match_id % 3 < 2 then opening_kind end"))
add("schema_drift_union", lambda t: a.read_player_archive(t.spark, player_files(t)), SCAN.format("case when match_id % 3 < 2 then opening_kind end"))
add("pair_files", lambda t: a.pair_files(t.raw("orders").selectExpr("concat('x/', case when o_orderkey % 2 = 0 then 'm_' else 'p_' end, date_format(o_orderdate, 'yyyy-MM-dd'), '.parquet') path").distinct()), """select date, max(case when side = 'm' then 'x/m_' || date || '.parquet' end) as matches, max(case when side = 'p' then 'x/p_' || date || '.parquet' end) as players
    from (select distinct case when o_orderkey % 2 = 0 then 'm' else 'p' end as side, strftime(o_orderdate, '%Y-%m-%d') as date from orders) group by 1""")
BLOB = """concat('{''age_stats'': {''dark'': {''unit_counts'': {''villager'': ', l_linenumber + 18, ', ''militia'': ', l_suppkey % 5, ', ''sheep'': 4}, ''building_counts'': {''house'': 2}, ''research'': [''loom'']}',
    case when l_partkey % 3 = 0 then concat(', ''feudal'': {''uptime'': ', l_partkey % 900, '.5, ''unit_counts'': {''archer'': 3}}') else '' end, case when l_suppkey = 7 then '' else '}}' end)"""
OWN = "l_orderkey as game_id, cast(l_linenumber as bigint) as profile_id, 'c' || l_partkey % 9 as civ, l_linestatus = 'F' as won"
add(
    "age_summaries",
    lambda t: a.explode_age_summaries(t.raw("lineitem").selectExpr("l_orderkey game_id", "cast(l_linenumber as bigint) profile_id", "concat('c', l_partkey % 9) civ", "l_linestatus = 'F' won", f"{BLOB} summary")),
    f"""select {OWN}, 'bad' as age, cast(null as int) as villagers, cast(null as int) as military, cast(null as int) as n_buildings, cast(null as int) as n_research, cast(null as int) as uptime_ms from lineitem where l_suppkey = 7
    union all select {OWN}, 'dark', l_linenumber + 18, cast(l_suppkey % 5 as int), 2, 1, -1 from lineitem where l_suppkey <> 7
    union all select {OWN}, 'feudal', 0, 3, 0, 0, cast((l_partkey % 900) * 1000 + 500 as int) from lineitem where l_suppkey <> 7 and l_partkey % 3 = 0""",
)


def shards(t: Tables) -> DataFrame:
    path = a.scratch(t.spark, "shards")
    t.events.selectExpr("match_id", "profile_id", "profile_id player_number", "t_ms", "kind", "target_id", "amount").withColumn("line", F.when(F.col("match_id") % 50 == 0, "{broken").otherwise(F.to_json(F.struct("match_id", "profile_id", "player_number", "t_ms", "kind", "target_id", "amount")))).select("line").write.option("compression", "gzip").text(path)
    return a.read_event_shards(t.spark, path)


add("scan_shards", lambda t: shards(t).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("t_ms").alias("t_ms")), "select kind, count(*) as n, cast(sum(t_ms) as bigint) as t_ms from f_events where match_id % 50 <> 0 group by 1")


def histories(t: Tables) -> DataFrame:
    """Payloads of two hundred match ids for each profile, so that their number, not their size, grows with the matches."""
    rows = t.players.join(t.matches, "match_id").selectExpr("profile_id", "match_id", "struct(match_id id, case when match_id % 9 = 0 then 'LOBBY' else 'AUTOMATCH' end description, cast(match_id % 12 as int) matchtype_id, case when match_id % 8 > 0 then 1600000000 + match_id when match_id % 16 = 0 then 0 end completiontime, array(struct(cast(profile_id as bigint) profile_id, elo oldrating, case when match_id % 2 = 0 then elo + 9 end newrating)) members) m")
    return rows.groupBy("profile_id", F.floor(F.col("match_id") / 200).alias("page")).agg(F.to_json(F.struct(F.collect_list("m").alias("matches"))).alias("payload"))


HIST = "f_players where match_id in (select match_id from f_matches) and match_id % 9 <> 0 and match_id % 8 > 0 and match_id % 12 between 6 and 9"
add(
    "history_seeds",
    lambda t: a.normalize_history(histories(t))[0].select("match_id", "ladder", F.unix_seconds("played_at").alias("played_s"), "profile_id", "elo"),
    f"select match_id, case when match_id % 12 = 6 then '1v1' else 'team' end as ladder, 1600000000 + match_id as played_s, profile_id, case when match_id % 2 = 0 then elo + 9 else elo end as elo from {HIST}",
)
add(
    "history_census",
    lambda t: a.normalize_history(histories(t))[1],
    """select case when match_id % 9 = 0 then 'not_automatch' when match_id % 8 = 0 then 'running' when match_id % 12 = 2 then 'known_other' when match_id % 12 between 6 and 9 then 'ok' else 'unknown_type' end as reason, count(*) as n
    from f_players where match_id in (select match_id from f_matches) group by 1""",
)
PAGES = "select o_orderkey // 100 as page, o_orderkey, o_custkey from orders"
add(
    "ladder_profiles",
    lambda t: a.ladder_profiles(t.raw("orders").groupBy(F.floor(F.col("o_orderkey") / 100).alias("page")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_custkey"))).alias("l")).select("page", F.to_json(F.struct(F.transform("l", lambda x: F.struct(F.array(F.struct(x["o_custkey"].alias("profile_id"))).alias("members"))).alias("statGroups"))).alias("payload")), 30),
    "select o_custkey as profile_id from orders group by 1 order by min(o_orderkey) limit 30",
)
add(
    "best_file",
    lambda t: a.best_file(t.raw("lineitem").selectExpr("l_orderkey match_id", "l_linenumber profile_id", "l_partkey % 50 size", "case when l_suppkey % 4 > 0 then concat('u', l_suppkey) end url")),
    "select l_orderkey as match_id, l_linenumber as profile_id, l_partkey % 50 as size, 'u' || l_suppkey as url from lineitem where l_partkey % 50 > 0 and l_suppkey % 4 > 0 qualify row_number() over (partition by l_orderkey order by size desc, l_linenumber desc, url desc) = 1",
)


def dim_file(t: Tables) -> str:
    path = a.scratch(t.spark, "dims")
    t.maps.select(F.concat(F.when(F.col("map_id") == 3, "# gone\n\nx\tbad\n").otherwise(""), F.concat_ws("\t", F.col("map_id").cast("string"), "name", "slug")).alias("line")).coalesce(1).write.text(path)
    return path


add("dim_maps", lambda t: a.read_dimension(t.spark, dim_file(t), ("map_id", "name", "slug", "family"), "map_id"), "select cast(map_id as int) as map_id, name, slug, cast(null as varchar) as family from f_maps")


def unit_file(t: Tables) -> str:
    path = a.scratch(t.spark, "dims")
    t.raw("part").select(F.concat_ws("\t", F.when(F.col("p_partkey") % 17 == 0, "none").otherwise(F.col("p_partkey").cast("string")), "p_name").alias("line")).write.text(path)
    return path


def json_file(t: Tables, rows: DataFrame, body) -> str:
    path = a.scratch(t.spark, "dims")
    rows.agg(F.to_json(F.struct(body)).alias("value")).coalesce(1).write.text(path)
    return path


def civ_file(t: Tables) -> str:
    """The civs as a map from id to slug; one id is no number."""
    entries = F.map_from_entries(F.collect_list(F.struct(F.when(F.col("civ_id") == 9, "x").otherwise(F.col("civ_id").cast("string")), "slug")))
    return json_file(t, t.civs, entries.alias("map"))


def patch_file(t: Tables) -> str:
    builds = t.matches.groupBy("build").agg(F.date_format(F.min("played_at"), "yyyy-MM-dd").alias("released")).select("build", F.concat(F.lit("Update "), "build").alias("label"), "released")
    return json_file(t, builds, F.collect_list(F.struct("build", "label", "released")).alias("builds"))


add("dim_units", lambda t: a.read_dimension(t.spark, unit_file(t), ("unit_id", "name"), "unit_id"), "select cast(p_partkey as int) as unit_id, p_name as name from part where p_partkey % 17 <> 0")
add("dim_civs", lambda t: a.read_id_map(t.spark, civ_file(t)), "select civ_id as id, slug from f_civs where civ_id <> 9")
add("dim_patches", lambda t: a.read_patches(t.spark, patch_file(t)), "select build, 'Update ' || build as label, cast(cast(min(played_at) as date) as varchar) as released from f_matches group by 1")


def audited(t: Tables) -> DataFrame:
    """Orders as 210 raw files in 20 shards: some lie in a wrong shard, some are not listed, some have another hash."""
    path = a.scratch(t.spark, "raw")
    lines = t.raw("orders").select((F.col("o_orderkey") % 210).alias("match_id"), F.concat("o_orderkey", F.lit(","), "o_custkey").alias("line"))
    shard = F.when(F.col("match_id") % 7 == 3, (F.col("match_id") + 1) % 20).otherwise(F.col("match_id") % 20)
    lines.withColumn("shard", shard).repartition("match_id").sortWithinPartitions("shard", "match_id", "line").write.partitionBy("shard", "match_id").text(path)
    whole = F.concat(F.array_join(F.array_sort(F.collect_list("line")), "\n"), F.lit("\n"))
    listed = lines.groupBy("match_id").agg(F.sha2(whole, 256).alias("sha256")).filter("match_id % 5 <> 0")
    listed = listed.withColumn("sha256", F.when(F.col("match_id") % 5 == 1, "0").otherwise(F.col("sha256")))
    gone = t.raw("nation").select((F.col("n_nationkey") + 1000).alias("match_id"), F.lit("0").alias("sha256"))
    return a.audit_archive(t.spark, path, listed.union(gone), 20)


add(
    "archive_audit",
    audited,
    """select case when m < 1000 and m % 7 = 3 then 'misplaced' when m >= 1000 then 'missing' when m % 5 = 0 then 'unlisted' when m % 5 = 1 then 'mismatch' else 'ok' end as state, count(*) as n
    from (select distinct o_orderkey % 210 as m from orders union all select n_nationkey + 1000 from nation) group by 1""",
)


def documents_written(t: Tables) -> DataFrame:
    path = a.scratch(t.spark, "docs")
    a.write_docs(d.doc_matchups(m.matchups(t.matches, t.players), 10), path)
    return t.spark.read.json(path).select("civ_id", F.size("opponents").alias("opponents"))


add("write_docs", documents_written, "select civ_id, cast(count(*) as int) as opponents from pairs_n where games >= 10 group by 1", pairs_n="select a.civ_id, b.civ_id as o, count(*) as games from (select * from f_players join f_matches using (match_id) where ladder = '1v1' and won is not null and civ_id <> 0) a join (select * from f_players where civ_id <> 0) b on a.match_id = b.match_id and a.profile_id <> b.profile_id and a.civ_id <> b.civ_id group by all")


def table_written(t: Tables) -> DataFrame:
    path = a.scratch(t.spark, "table")
    rows = t.matches.select("match_id", "build", "ladder")
    a.write_table(rows, path, "append", ["build"])
    a.write_table(rows.filter("build = 1995").withColumn("ladder", F.upper("ladder")), path, "replace", ["build"])
    return t.spark.read.parquet(path).groupBy("build", "ladder").agg(F.count(F.lit(1)).alias("n"))


add("write_table", table_written, "select build, case when build = 1995 then upper(ladder) else ladder end as ladder, count(*) as n from f_matches group by all")


def twice(rows: DataFrame, which: str, *again: str) -> DataFrame:
    """rows, and those of `which` a second time (again: their columns then), made in one pass."""
    copies = F.explode(F.when(F.expr(which), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    both = rows.select("*", copies)
    return both.selectExpr(*(f"if(_copy = 1, {new}, {c}) as {c}" for c, new in zip(rows.columns, again or rows.columns, strict=True)))


def stream_ingest(t: Tables) -> DataFrame:
    rows = t.matches.select("match_id", "played_at", "build")
    (path, files), out = landed(twice(rows, "match_id % 3 = 0"), "stream"), a.scratch(t.spark, "ingest")
    return streams.ingest(t.spark, path, out, f"{out}-checkpoint", buckets=max(8, t.parts), files_per_trigger=files)


add("stream_ingest", stream_ingest, "select match_id, played_at, build from f_matches")


def stream_upgrade(t: Tables) -> DataFrame:
    """A third of the archive matches come again as replays with another build, before or after themselves."""
    rows = t.matches.selectExpr("match_id", "'archive' source", "played_at", "build")
    (path, files), out = landed(twice(rows, "match_id % 3 = 0", "match_id", "'replay'", "played_at", "build + 100"), "stream"), a.scratch(t.spark, "upgrade")
    return streams.ingest(t.spark, path, out, f"{out}-checkpoint", "upgrade", max(8, t.parts), files)


add("stream_upgrade", stream_upgrade, "select match_id, case when match_id % 3 = 0 then 'replay' else 'archive' end as source, played_at, case when match_id % 3 = 0 then build + 100 else build end as build from f_matches")


def stream_dedup(t: Tables) -> DataFrame:
    rows = t.raw("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    (path, files), out = landed(twice(rows, "event_id % 4 = 0"), "stream"), a.scratch(t.spark, "dedup")
    return streams.run(streams.dedup(streams.source(t.spark, path, files), "event_id", "ts"), out, f"{out}-checkpoint").select("event_id", "user_id")


add("stream_dedup", stream_dedup, "select event_id, user_id from events")


def stream_apm(t: Tables) -> DataFrame:
    rows = t.raw("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    closing = rows.agg(F.lit(None).cast("bigint").alias("event_id"), (F.max("ts") + F.expr("interval 1 hour")).alias("ts"), F.lit(None).cast("bigint").alias("user_id"))
    path, out = written(rows.union(closing), "stream"), a.scratch(t.spark, "apm")
    counted = streams.commands_per_minute(streams.source(t.spark, path, None), "ts")
    return streams.run(counted, out, f"{out}-checkpoint").select(F.floor(F.unix_seconds("minute") / 60).alias("minute"), "user_id", "commands")


add("stream_apm", stream_apm, "select cast(floor(epoch(ts) / 60) as bigint) as minute, user_id, count(*) as commands from events group by 1, 2")


def stream_retry(t: Tables) -> DataFrame:
    (path, files), out = landed(t.raw("events").filter("event_type = 'error'").select(F.col("user_id").alias("match_id"), F.col("event_id").alias("failed_at")), "stream"), a.scratch(t.spark, "retry")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    streams.retries(streams.source(t.spark, path, files)).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(out).groupBy("match_id").agg(F.max("attempts").alias("attempts"), F.max_by("next_at", "batch").alias("next_at"))


add("stream_retry", stream_retry, "select user_id as match_id, cast(count(*) as int) as attempts, case when count(*) < 8 then max(event_id) + 60 * (1 << least(count(*), 6)) end as next_at from events where event_type = 'error' group by 1")


#: Failures that a part of the state of retries takes at most, and at least if there are cores for more parts.
MOST_FAILURES, LEAST_FAILURES = 250_000, 5_000


def stream_ready(t: Tables) -> DataFrame:
    """Each user's errors of a day as failed attempts at one match; a closing row, days later, lets all waits end."""
    rows = t.raw("events").filter("event_type = 'error'").select((F.col("user_id") * 1000 + F.dayofyear("ts")).cast("bigint").alias("match_id"), F.col("ts").cast("timestamp").alias("failed_at"))
    closing = rows.agg(F.lit(-1).cast("bigint").alias("match_id"), (F.max("failed_at") + F.expr("interval 2 days")).alias("failed_at"))
    path, out = written(rows.union(closing), "stream"), a.scratch(t.spark, "ready")
    # each part of the state starts a worker and a store for each batch: their number follows the failures, not the session's shuffles
    n = t.spark.read.parquet(path).count()
    parts = max(-(-n // MOST_FAILURES), min(t.spark.sparkContext.defaultParallelism, -(-n // LEAST_FAILURES)), 1)
    settings = {"spark.sql.streaming.stateStore.providerClass": streams.ROCKSDB, "spark.sql.shuffle.partitions": str(parts)}
    kept = {name: t.spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            t.spark.conf.set(name, value)
        found = streams.run(streams.ready_by_timer(streams.source(t.spark, path, None), buckets=max(parts, n // 500)), out, f"{out}-checkpoint")
    finally:
        for name, value in kept.items():
            t.spark.conf.set(name, value)
    return found.select("match_id", "attempts", F.unix_millis("ready_at").alias("ready_ms"))


add("stream_ready", stream_ready, "select user_id * 1000 + dayofyear(ts) as match_id, cast(count(*) as int) as attempts, max(epoch_us(ts) // 1000) + 60000 * (1 << least(count(*), 6)) as ready_ms from events where event_type = 'error' group by 1 having count(*) < 8")
