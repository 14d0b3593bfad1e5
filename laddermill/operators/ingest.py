"""Conforming, deduplicating and upserting batches, and the work queues around them.

Targets and batches are DataFrames; an upsert returns the new target, to be written as a new version (see sinks).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHILDREN = ("players", "events", "ages", "age_windows", "units", "techs")
MISS_REASONS = ("not_found", "expired", "corrupt", "unsupported")
MAX_ATTEMPTS, BACKOFF_S, MAX_DOUBLINGS = 8, 60, 6


def resolve_dims(df: DataFrame, **dims: DataFrame) -> DataFrame:
    """df with each dimension's id joined by its slug: dims maps a slug column of df to (slug, id) tables."""
    for column, dim in dims.items():
        df = df.join(dim.withColumnRenamed("slug", column), column)
    return df


def unknown_values(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    return df.join(dim.select(key).distinct(), key, "left_anti").filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def missing_identity(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.agg(*(F.count_if(F.col(k).isNull()).alias(f"missing_{k}") for k in keys), F.count(F.lit(1)).alias("n"))


def first_of(batch: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the order, whatever the partitioning."""
    return batch.withColumn("_nth", F.row_number().over(W.partitionBy(*key).orderBy(*order))).filter("_nth = 1").drop("_nth")


def insert_new(target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """target and the batch's rows with new keys; of equal keys in the batch the first."""
    return target.unionByName(first_of(batch, key, order).join(target.select(*key), list(key), "left_anti").select(*target.columns))


def gate(child: DataFrame, parents: DataFrame, key: str = "match_id") -> DataFrame:
    """Children whose parent is among `parents`."""
    return child.join(parents.select(key), key, "left_semi")


def upsert(target: dict[str, DataFrame], batch: dict[str, DataFrame], policy: str = "upgrade") -> dict[str, DataFrame]:
    """Tables by name, matches first. skip: matches there stay. upgrade: archive matches in the batch as replays are
    replaced with all their children; replay matches stay. New matches come in either way, with their children."""
    there = target["matches"]
    new = batch["matches"].join(there.select("match_id"), "match_id", "left_anti")
    better = batch["matches"].filter("source = 'replay'").join(there.filter("source = 'archive'").select("match_id"), "match_id", "left_semi") if policy == "upgrade" else new.limit(0)
    taken = new.unionByName(better).select("match_id")
    out = {}
    for name, rows in target.items():
        kept = rows.join(better.select("match_id"), "match_id", "left_anti")
        out[name] = kept.select(*rows.columns).unionByName(gate(batch[name], taken).select(*rows.columns)) if name in batch else kept.select(*rows.columns)
    return out


def replace_scope(target: DataFrame, batch: DataFrame, key: str = "match_id") -> DataFrame:
    """target with all rows of the batch's keys replaced by the batch."""
    return target.join(batch.select(key).distinct(), key, "left_anti").select(*target.columns).unionByName(batch.select(*target.columns))


def upsert_dim(target: DataFrame, source: DataFrame, pk: str) -> DataFrame:
    return replace_scope(target, source, pk)


def filter_known(df: DataFrame, dim: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows whose id the dimension has, and a census: each id that it lacks, with the number of rows dropped."""
    # counted first: the ids, not the rows, meet the dimension
    dropped = df.groupBy(key).agg(F.count(F.lit(1)).alias("dropped")).join(dim.select(key), key, "left_anti")
    return df.join(dim.select(key), key, "left_semi"), dropped


def attach_seed(meta: DataFrame, players: DataFrame, seed: DataFrame) -> DataFrame:
    """Players with their own seed rating and the match's ladder and time: those of the first seed row (by nth) whose
    time can be read. Seeds: match_id, profile_id, elo, ladder, played_at text, nth."""
    timed = seed.withColumn("at", F.try_to_timestamp("played_at", F.lit("yyyy-MM-dd HH:mm:ss")))
    head = timed.filter("at is not null").groupBy("match_id").agg(F.min_by(F.struct("ladder", "at"), "nth").alias("s"), F.count(F.lit(1)).alias("readable"))
    bad = timed.groupBy("match_id").agg(F.count_if(F.col("at").isNull()).alias("bad_times"))
    own = first_of(seed.select("match_id", "profile_id", "elo", "nth"), ["match_id", "profile_id"], ["nth"]).drop("nth")
    rows = players.join(meta.select("match_id"), "match_id").join(own, ["match_id", "profile_id"], "left").join(head, "match_id", "left").join(bad, "match_id", "left")
    return rows.select("match_id", "profile_id", "elo", F.col("s.ladder").alias("ladder"), F.date_format("s.at", "yyyy-MM-dd HH:mm:ss").alias("played_at"), F.coalesce("bad_times", F.lit(0)).alias("bad_times"))


def classify_skips(meta: DataFrame, players: DataFrame, seed: DataFrame, ladders: Sequence[str], ages: DataFrame | None = None, known_ages: Sequence[str] = ()) -> DataFrame:
    """Matches by the first reason to skip them, 'ok' without one."""
    has = lambda df, name: df.select("match_id").distinct().withColumn(name, F.lit(True))
    rows = meta.join(has(players, "has_players"), "match_id", "left").join(seed.groupBy("match_id").agg(F.min("ladder").alias("seed_ladder")), "match_id", "left")
    bad = has(ages.filter(~F.col("age").isin(*known_ages)), "bad_age") if ages is not None else has(meta.limit(0), "bad_age")
    reason = (
        F.when(F.col("has_players").isNull(), "no_players").when(F.col("seed_ladder").isNull(), "no_seed").when(~F.col("seed_ladder").isin(*ladders), "unknown_ladder")
        .when(F.col("duration_text").try_cast("int").isNull(), "bad_numeric").when(F.col("bad_age"), "bad_age").otherwise("ok")
    )
    return rows.join(bad, "match_id", "left").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def compose(parsed: DataFrame, seed: DataFrame, kinds: dict[int, str]) -> DataFrame:
    """Parsed matches with the ladder of their seed's match type. A missing map, an unknown type or a seed of another
    match is an error; a player's rating is only that of their own post-game block."""
    rows = parsed.join(seed, "match_id")
    ladder = F.element_at(F.create_map(*(F.lit(x) for kv in kinds.items() for x in kv)), F.col("match_type"))
    checked = F.coalesce(ladder, F.raise_error(F.lit("unknown match type")).cast("string"))
    map_id = F.coalesce("map_id", F.raise_error(F.lit("a match without a map")).cast("int"))
    same = F.when(F.col("seed_match_id") == F.col("match_id"), F.col("match_id")).otherwise(F.raise_error(F.lit("seed of another match")).cast("long"))
    more = [c for c in ("build", "played_at", "n_players") if c in rows.columns]
    return rows.select(same.alias("match_id"), checked.alias("ladder"), map_id.alias("map_id"), "duration_ms", *more)


def compose_players(parsed: DataFrame, players: DataFrame, events: DataFrame, fast_civ: int, **of_opening) -> dict[str, DataFrame]:
    """The tables below composed matches (match_id, duration_ms): players, units, techs.

    players: match_id, profile_id, civ_id, won, post_elo (of the player's own post-game block, null without one). A player
    gets opening, opening_kind, completed ages in seconds and commands a minute from the events; what these don't show is
    null. Rows of other matches are left out. of_opening: `ages`, and the options of `classify_opening`.
    """
    from laddermill.operators import events as e

    own = players.join(parsed.select("match_id", "duration_ms"), "match_id")
    moves = gate(events, parsed)
    clicks = e.age_clicks(moves, of_opening.pop("ages", e.AGES))
    ages = e.completion(own.select(*e.PLAYER, "civ_id").join(clicks, e.PLAYER), fast_civ)
    rows = own.select("match_id", "profile_id", "civ_id", F.col("post_elo").alias("elo"), "won")
    for part in (e.classify_opening(moves, clicks, **of_opening), ages, e.apm(moves, own)):
        rows = rows.join(part, e.PLAYER, "left")
    return {"players": rows, "units": e.player_units(moves), "techs": e.player_techs(moves)}


def discover(matches: DataFrame, players: DataFrame, misses: DataFrame, floor: str, n: int) -> DataFrame:
    """The newest n archive matches from a date on that are not known misses; cut first, then joined with players."""
    fresh = matches.filter((F.col("source") == "archive") & (F.col("played_at") >= F.lit(floor).cast("date"))).join(misses.select("match_id"), "match_id", "left_anti")
    newest = fresh.orderBy(F.desc("played_at"), F.desc("match_id")).limit(n)
    ids = players.join(newest.select("match_id"), "match_id").groupBy("match_id").agg(F.array_join(F.sort_array(F.collect_list("profile_id")), ",").alias("profile_ids"))
    return newest.select("match_id", "played_at").join(ids, "match_id")


def record_misses(misses: DataFrame, batch: DataFrame) -> DataFrame:
    """Terminal misses; the first record of a match stays. An unknown reason is an error."""
    reason = F.when(F.col("reason").isin(*MISS_REASONS), F.col("reason")).otherwise(F.raise_error(F.lit("unknown reason")).cast("string"))
    return insert_new(misses, batch.withColumn("reason", reason), ["match_id"], ["attempted_at", "reason"])


def take_ready(manifest: DataFrame, now: int, n: int) -> DataFrame:
    """Matches to try: pending, or failed less than MAX_ATTEMPTS times and long enough ago; newest first."""
    wait = F.lit(BACKOFF_S) * F.call_function("shiftleft", F.lit(1), F.least("attempts", F.lit(MAX_DOUBLINGS)).cast("int"))
    retry = (F.col("status") == "error") & (F.col("attempts") < MAX_ATTEMPTS) & (now - F.coalesce("updated_at", F.lit(0)) >= wait)
    return manifest.filter((F.col("status") == "pending") | retry).orderBy(F.desc("played_at"), F.desc("match_id")).limit(n).select("match_id", "status", "attempts", "played_at")


def seed_manifest(manifest: DataFrame, rows: DataFrame) -> DataFrame:
    """New matches are pending; known ones get profile ids if they had none, and then an expired one is pending again.

    A match that is seeded several times counts once, with its least time and the least profile ids that are given."""
    new = rows.groupBy("match_id").agg(F.min("played_at").alias("new_at"), F.min("profile_ids").alias("new_ids"))
    both = manifest.join(new, "match_id", "full")
    known, filled = F.col("status").isNotNull(), F.col("profile_ids").isNull() & F.col("new_ids").isNotNull()
    status = F.when(~known, "pending").when(filled & (F.col("status") == "expired"), "pending").otherwise(F.col("status"))
    return both.select("match_id", F.coalesce("played_at", "new_at").alias("played_at"), F.coalesce("profile_ids", "new_ids").alias("profile_ids"), status.alias("status"), F.coalesce("attempts", F.lit(0)).alias("attempts"))


METADATA = ("n_files", "best_size", "best_pid", "events", "error")


def record_status(manifest: DataFrame, updates: DataFrame, now: int, metadata: Sequence[str] = METADATA) -> DataFrame:
    """Manifest after updates: match_id, nth (their order), status, attempts_inc, and of the metadata what they state.

    Each update sets the status and the time, overwrites the metadata that it states (not null), and counts an attempt if
    attempts_inc. Of several for a match the last ones stated count, and all attempts. Unknown matches change nothing.
    """
    stated = [c for c in metadata if c in updates.columns]
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("nth"))).alias(f"_{c}")
    per = updates.groupBy("match_id").agg(*(last(c) for c in ("status", *stated)), F.count_if("attempts_inc").alias("_inc"))
    rows = manifest.join(per, "match_id", "left")
    new = {c: F.coalesce(f"_{c}", c) for c in ("status", *stated)} | {"attempts": F.col("attempts") + F.coalesce("_inc", F.lit(0)), "updated_at": F.when(F.col("_status").isNotNull(), F.lit(now)).otherwise(F.col("updated_at"))}
    return rows.select(*(new[c].cast(manifest.schema[c].dataType).alias(c) if c in new else F.col(c) for c in manifest.columns))


def status_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def ranked_ids(ids: DataFrame, key: str = "match_id", width: int = 1_000_000) -> DataFrame:
    """The distinct ids and nth, their place in ascending order, from 0; nulls have none.

    Ids are cut into blocks of `width` values, which are counted; a block's ids are ranked by themselves and begin where
    the blocks before it end. One row for each block, but no id, is ordered in one task. A lost task is repeated with the
    same result, as nothing is sampled.
    """
    block = F.col(key) - F.pmod(F.col(key), F.lit(width))
    ids = ids.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_block", block)
    blocks = ids.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_block").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")
    inside = F.row_number().over(W.partitionBy("_block").orderBy(key)) - 1
    return ids.join(blocks.select("_block", before.alias("_before")), "_block").select(key, (F.col("_before") + inside).alias("nth"))


def id_ranges(df: DataFrame, size: int, processed: int = 0, limit: int | None = None, key: str = "match_id", width: int = 1_000_000) -> DataFrame:
    """Chunks of `size` distinct ids in ascending order, the last one of what is left: chunk, low, high, n, cursor.

    cursor is how many ids have been processed once the chunk is done; a run that was stopped goes on with that number as
    `processed`, and its chunks begin after those ids. limit: only the first so many ids, those processed included. A
    chunk's bounds hold its ids and no others.
    """
    ranked = ranked_ids(df, key, width).filter(F.col("nth") >= processed)
    ranked = ranked if limit is None else ranked.filter(F.col("nth") < limit)
    chunk = ((F.col("nth") - processed - F.pmod(F.col("nth") - processed, F.lit(size))) / size).cast("long").alias("chunk")
    return ranked.groupBy(chunk).agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n"), (F.max("nth") + 1).alias("cursor"))


def merge_seeds(seeds: DataFrame, order: Sequence[str | Column] = ("place", "profile_id")) -> DataFrame:
    """One seed for each match: that of the profile with the first place on the ladder (place, null last)."""
    return first_of(seeds, ["match_id"], [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order])


def lookup_default(df: DataFrame, dim: DataFrame, key: str, value: str, default: str) -> DataFrame:
    return df.join(dim.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))
