"""Reading archives whose files drift, event shards, landed payloads and dimensions; writing tables and documents."""

from __future__ import annotations

import ast
import json
import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MATCH_COLUMNS = {"game_id": "bigint", "map": "string", "started_timestamp": "timestamp", "duration": "bigint", "num_players": "bigint", "leaderboard": "string", "patch": "bigint"}
PLAYER_COLUMNS = {"game_id": "bigint", "profile_id": "bigint", "civ": "string", "winner": "boolean", "opening": "string", "feudal_age_uptime": "double", "castle_age_uptime": "double", "imperial_age_uptime": "double", "new_rating": "bigint"}
#: Types in which a column may be stored; any other fails. Fixed values, as the archive's files have them.
ACCEPTED = {
    "game_id": {"string", "bigint", "int"}, "map": {"string"}, "started_timestamp": {"timestamp", "timestamp_ntz", "bigint"}, "duration": {"bigint"}, "num_players": {"bigint", "int"},
    "leaderboard": {"string"}, "patch": {"bigint", "int"}, "profile_id": {"double", "int", "bigint"}, "civ": {"string"}, "winner": {"boolean"}, "opening": {"string", "int", "void"},
    "feudal_age_uptime": {"double", "int", "void"}, "castle_age_uptime": {"double", "int", "void"}, "imperial_age_uptime": {"double", "int", "void"}, "new_rating": {"bigint", "int"},
}
#: Columns of which an int stands for no value at all: a file that has one must have nulls only.
ALL_NULL_AS_INT = {"opening", "feudal_age_uptime", "castle_age_uptime", "imperial_age_uptime"}
#: Map slugs of the archive that are spelled otherwise in the dimension.
MAP_ALIASES = {"scandanavia": "scandinavia", "passage": "thepassage"}
#: Kinds of unit in a summary that are no soldiers.
NOT_MILITARY = ("villager", "fishing ship", "trade cart", "trade cog", "sheep", "llama", "cow", "goat", "turkey", "water buffalo", "fish trap")
SUMMARY_AGES = ("dark", "feudal", "castle", "imperial")
SHARD = "match_id bigint, profile_id bigint, player_number smallint, t_ms int, kind string, target_id bigint, amount bigint, detail string"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the one that driver and executors share; a temporary one only on a single machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written once, for what reads it several times; its size then decides whether joins broadcast it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
    """df written once as a table of `parts` buckets by the key: what groups by the key or joins on it shuffles no more."""
    return bucketed(df.repartition(parts, key), name, key, parts)


def bucketed(df: DataFrame, name: str, key: str, parts: int) -> DataFrame:
    """`dealt` of what is in `parts` parts by the key already."""
    path = scratch(df.sparkSession, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.bucketBy(parts, key).option("path", path).saveAsTable(table, format="parquet")
    return df.sparkSession.table(table)


def listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path of every data file under the paths (files or folders), as a table; nothing is read but folders."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("path")


def footers(files: DataFrame, columns: Sequence[str], per_task: int = 64) -> DataFrame:
    """path, types of each Parquet file of `files` (path): the stored types of the columns, by name; null: not there.

    The executors read the footers, some `per_task` files a task. Types have Spark's names; times in nanoseconds, which
    Spark reads as their number, are 'nanoseconds', and types without a name in Spark are named as in the file."""

    def name(kind) -> str:
        import pyarrow as pa
        from pyspark.sql.pandas.types import from_arrow_type

        if pa.types.is_timestamp(kind):
            return "nanoseconds" if kind.unit == "ns" else "timestamp" if kind.tz else "timestamp_ntz"
        try:
            return "void" if pa.types.is_null(kind) else from_arrow_type(kind).simpleString()
        except Exception as unknown:  # pyspark raises classes of its own
            if type(unknown).__module__.startswith("pyspark."):
                return str(kind)
            raise

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from urllib.parse import quote

        import pyarrow.fs as pf
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for path in batch.path:
                local = path.removeprefix("file:") if path.startswith("file:") else path if "://" not in path else None
                fs, where = (pf.LocalFileSystem(), "/" + local.lstrip("/")) if local else pf.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe=":/"))
                with pq.ParquetFile(where, filesystem=fs) as file:
                    stored, leaves = file.schema_arrow, [file.schema.column(i) for i in range(len(file.schema))]
                # Spark reads the old times of 96 bits as times
                old = {leaf.path for leaf in leaves if leaf.physical_type == "INT96"}
                found.append(["timestamp" if c in old else name(stored.field(c).type) if c in stored.names else None for c in columns])
            yield pd.DataFrame({"path": batch.path, "types": found})

    tasks = max(1, files.count() // per_task)
    return files.repartition(tasks).mapInPandas(read, "path string, types array<string>")


def read_drifting(spark: SparkSession, paths: Sequence[str], columns: Mapping[str, str], accepted: Mapping[str, set[str]] = ACCEPTED) -> DataFrame:
    """Files whose columns differ in type, read once for each kind of schema, cast to `columns` and put together.

    Executors look at the footers; the driver gets the files of each kind. A stored type that is not accepted fails, and
    so does a column that is missing altogether, or an int that is to stand for nulls (ALL_NULL_AS_INT) and has a value.
    Times stored in nanoseconds are read as their number and become microseconds; that needs a setting, which a session
    of its own has, and this one has not.
    """
    names = list(columns)
    kinds = {tuple(r.types): r.files for r in footers(listed(spark, paths), names).groupBy("types").agg(F.sort_array(F.collect_list("path")).alias("files")).collect()}
    for types, files in kinds.items():
        for c, stored in zip(names, types, strict=True):
            if stored is None:
                raise ValueError(f"{files[0]}: no column {c}")
            if c in accepted and stored.replace("nanoseconds", "bigint") not in accepted[c]:
                raise ValueError(f"{files[0]}: column {c} is stored as {stored}")

    def conformed(c: str, stored: str):
        if c in ALL_NULL_AS_INT and stored == "int":
            return F.when(F.col(c).isNotNull(), F.raise_error(F.lit(f"column {c} is stored as int and has values")).cast(columns[c])).cast(columns[c])
        if columns[c] == "timestamp" and stored in ("bigint", "nanoseconds"):
            return F.timestamp_micros(F.floor(F.col(c) / 1000).cast("bigint"))
        return F.col(c).cast(columns[c])

    with_nanoseconds = spark.newSession()
    with_nanoseconds.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    with_nanoseconds.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    # an empty table of this session comes first, as the first one's session is that of the result
    out = spark.createDataFrame([], ", ".join(f"`{c}` {kind}" for c, kind in columns.items()))
    for types, files in sorted(kinds.items()):
        session = with_nanoseconds if "nanoseconds" in types else spark
        out = out.unionByName(session.read.parquet(*files).select(*(conformed(c, stored).alias(c) for c, stored in zip(names, types, strict=True))))
    return out


def read_match_archive(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Seven columns of the match files; the map as a slug, nanoseconds of duration as milliseconds."""
    from laddermill.functions.scalars import alias, slug

    rows = read_drifting(spark, paths, MATCH_COLUMNS)
    return rows.withColumn("map", alias(slug(F.col("map")), MAP_ALIASES)).withColumn("duration_ms", (F.col("duration") / 1_000_000).cast("bigint")).drop("duration")


def read_player_archive(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Nine columns of the player files; the civilisation as a slug."""
    from laddermill.functions.scalars import slug

    return read_drifting(spark, paths, PLAYER_COLUMNS).withColumn("civ", slug(F.col("civ")))


def pair_files(files: DataFrame) -> DataFrame:
    """date, matches, players of files (path) named m_<date> and p_<date>; one of a pair can be missing."""
    named = files.select("path", F.regexp_extract("path", r"(?:^|/)([mp])_[^/]*\.parquet$", 1).alias("side"), F.regexp_extract("path", r"(?:^|/)[mp]_([^/]*)\.parquet$", 1).alias("date")).filter("side <> ''")
    of = lambda side, name: named.filter(F.col("side") == side).select("date", F.col("path").alias(name))
    return of("m", "matches").join(of("p", "players"), "date", "full")


#: What a text must not have to mean the same as JSON, its quotes doubled, and as a Python literal.
NOT_JSON = re.compile(r'["\\\\]|true|false|null|NaN|Infinity')


def literal_reader():
    """What gives the value of a Python literal. Most are JSON but for their quotes, and read as such, which is several
    times as fast. (A function inside, as such ones reach executors that lack this package.)"""

    def literal(text: str):
        if text[:1] == "{" and text[-1:] == "}" and not NOT_JSON.search(text) and text.count("{") + text.count("[") <= 50:
            try:
                return json.loads(text.replace("'", '"'))
            except ValueError:
                pass
        return ast.literal_eval(text)

    return literal


def explode_age_summaries(df: DataFrame, text: str = "summary", keys: Sequence[str] = ("game_id", "profile_id", "civ", "won")) -> DataFrame:
    """Up to four rows per player's summary (a Python dictionary as text, over 50 characters): the keys, age, villagers,
    military, buildings, research and uptime in ms (-1: not reached). The civilisation (civ) becomes a slug. An age
    that is absent, null or empty gives no row, and so does a text without ages; one that can't be read gives one with age
    'bad'."""
    from laddermill.functions.scalars import slug

    df = df.withColumn("civ", slug(F.col("civ"))) if "civ" in keys else df
    counts = ("villagers", "military", "n_buildings", "n_research", "uptime_ms")
    schema = ", ".join([*(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys), "nth int", "age string", *(f"{c} int" for c in counts)])

    literal = literal_reader()

    def ages(blob: str) -> Iterator[tuple]:
        try:
            stats, out = (literal(blob) or {}).get("age_stats") or {}, []
            for age in SUMMARY_AGES:
                if stats.get(age):
                    units, built = stats[age].get("unit_counts") or {}, stats[age].get("building_counts") or {}
                    up = stats[age].get("uptime")
                    army = sum(int(n or 0) for u, n in units.items() if u not in NOT_MILITARY)
                    out.append((age, int(units.get("villager") or 0), army, sum(int(n or 0) for n in built.values()), len(stats[age].get("research") or ()), -1 if up is None else int(up * 1000)))
            yield from out
        except (ValueError, SyntaxError, KeyError, TypeError, AttributeError):
            yield ("bad", None, None, None, None, None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(i, *row) for i, blob in enumerate(b[text]) for row in ages(blob)]
            rows = pd.DataFrame(found, columns=["nth", "age", *counts]).astype({c: "Int32" for c in counts} | {"nth": "int32"})
            whose = b[list(keys)].iloc[rows["nth"]].reset_index(drop=True)
            yield pd.concat([whose, rows], axis=1)

    return df.filter(F.length(text) > 50).select(*keys, text).mapInPandas(run, schema).drop("nth")


def read_event_shards(spark: SparkSession, path: str, schema: str = SHARD) -> DataFrame:
    """Gzipped JSON lines with a fixed schema. Lines that can't be read, or that name no match, and the torn end of a file
    are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").option("ignoreCorruptFiles", True).json(path).filter("match_id is not null")


def normalize_history(df: DataFrame, payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Seeds (match_id, ladder, played_at, profile_id, elo) of landed match histories, newest first, and a census of
    what was skipped. df: profile_id, payload (JSON). Only finished automatic matches (their time is above 0); types 6 and
    7 to 9; of the queried profile's ratings the new one, else the old."""
    kind = T.StructType.fromDDL("matches array<struct<id:bigint,description:string,matchtype_id:int,completiontime:bigint,members:array<struct<profile_id:bigint,oldrating:int,newrating:int>>>>")
    m = df.select("profile_id", F.explode(F.from_json(payload, kind)["matches"]).alias("m")).select("profile_id", "m.*")
    ladder = F.when(F.col("matchtype_id") == 6, "1v1").when(F.col("matchtype_id").between(7, 9), "team")
    reason = F.when(F.coalesce(F.col("description") != "AUTOMATCH", F.lit(True)), "not_automatch").when(F.coalesce(F.col("completiontime") <= 0, F.lit(True)), "running").when(F.col("matchtype_id").isin(2, 18), "known_other").when(ladder.isNull(), "unknown_type").otherwise("ok")
    m = m.withColumn("reason", reason).withColumn("ladder", ladder)
    own = F.get(F.filter("members", lambda x: x["profile_id"] == F.col("profile_id")), F.lit(0))
    seeds = m.filter("reason = 'ok'").select(F.col("id").alias("match_id"), "ladder", F.timestamp_seconds("completiontime").alias("played_at"), "profile_id", F.coalesce(own["newrating"], own["oldrating"]).alias("elo"))
    return seeds.orderBy(F.desc("played_at"), "match_id"), m.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def ladder_profiles(df: DataFrame, n: int) -> DataFrame:
    """The first n different profiles of leaderboard pages (page, payload), in the ladder's order."""
    kind = T.StructType.fromDDL("statGroups array<struct<members:array<struct<profile_id:bigint>>>>")
    groups = df.select("page", F.posexplode(F.from_json("payload", kind)["statGroups"]).alias("i", "g")).select("page", "i", F.posexplode("g.members").alias("j", "x"))
    first = groups.groupBy(F.col("x.profile_id").alias("profile_id")).agg(F.min(F.struct("page", "i", "j")).alias("at"))
    return first.orderBy("at").limit(n).select("profile_id")


def best_file(df: DataFrame) -> DataFrame:
    """The largest file of each match that has a size and a url; files: match_id, profile_id, size, url."""
    return df.filter("size > 0 and url is not null").groupBy("match_id").agg(F.max(F.struct("size", "profile_id", "url")).alias("b")).select("match_id", "b.profile_id", "b.size", "b.url")


def read_dimension(spark: SparkSession, path: str, names: Sequence[str], id_column: str) -> DataFrame:
    """Tab-separated lines; comments, blank lines and lines without a numeric id are left out, missing fields are null."""
    lines = spark.read.text(path).filter("trim(value) <> '' and value not like '#%'")
    parts = F.split("value", "\t")
    rows = lines.select(*(F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(names)))
    return rows.withColumn(id_column, F.col(id_column).try_cast("int")).filter(F.col(id_column).isNotNull())


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """The map {id: slug} of {"map": {...}} as rows; an id that is no number is left out."""
    whole = spark.read.text(path, wholetext=True)
    pairs = whole.select(F.explode(F.from_json("value", T.StructType.fromDDL("map map<string,string>"))["map"]).alias("id", "slug"))
    return pairs.select(F.col("id").try_cast("int").alias("id"), "slug").filter("id is not null")


def read_patches(spark: SparkSession, path: str) -> DataFrame:
    """build, label, released of an index {"builds": [...]}."""
    kind = T.StructType.fromDDL("builds array<struct<build:int,label:string,released:string>>")
    builds = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)["builds"]).alias("b"))
    return builds.select("b.build", "b.label", "b.released")


def audit_archive(spark: SparkSession, path: str, sidecar: DataFrame, shards: int = 1000) -> DataFrame:
    """How many files are ok, missing, a mismatch, unlisted or misplaced, beside recorded hashes (match_id, sha256).

    A match's file lies in the folder of its shard, match_id % shards: <shard>/<match_id>.<type>, or as a table writes it
    shard=<shard>/match_id=<match_id>/<file>. One that lies elsewhere is misplaced, whatever it holds.
    """
    place = r"/(?:shard=)?([0-9]+)/(?:match_id=)?([0-9]+)[./]"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = files.select(F.regexp_extract("path", place, 1).try_cast("bigint").alias("shard"), F.regexp_extract("path", place, 2).try_cast("bigint").alias("match_id"), F.sha2("content", 256).alias("found"))
    both = files.filter("match_id is not null").join(sidecar, "match_id", "full")
    misplaced = F.col("shard") != F.pmod("match_id", F.lit(shards))
    state = F.when(misplaced, "misplaced").when(F.col("sha256").isNull(), "unlisted").when(F.col("found").isNull(), "missing").when(F.col("found") == F.col("sha256"), "ok").otherwise("mismatch")
    return both.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def write_docs(docs: DataFrame, path: str, name: str | None = None) -> None:
    """One JSON line per document or, with a column `name`, a readable file for each in a folder name=<its value>."""
    if name is None:
        docs.write.mode("overwrite").json(path)
    else:
        body = F.to_json(F.struct(*(c for c in docs.columns if c != name)), {"pretty": "true"})
        docs.select(name, body.alias("value")).repartition(name).write.mode("overwrite").partitionBy(name).text(path)


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """append, overwrite, or replace: only the partitions that df has."""
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    if mode == "replace":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).parquet(path)
