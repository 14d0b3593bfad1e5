"""Nested result documents, one row per top-level key, made of the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laddermill.functions.scalars import pct, round1, tier_of, wilson


def kept_patches(axis: DataFrame, min_matches: int = 3000, newest: int = 16) -> DataFrame:
    number = F.col("build").cast("string").try_cast("int")
    return axis.filter(F.col("matches") >= min_matches).orderBy(number.desc_nulls_last(), "build").limit(newest).select("build", F.concat(F.lit("Update "), F.col("build").cast("string")).alias("label"), "matches")


def keyed(rows: DataFrame, keys: list[str], key: str, *values: str, name: str) -> DataFrame:
    """Per keys, a map from key to a struct of values."""
    return rows.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key).cast("string"), F.struct(*values))))).alias(name))


def with_share(rows: DataFrame) -> DataFrame:
    w = wilson(F.col("wins"), F.col("games"))
    return rows.withColumn("ci_low", pct(w["lo"])).withColumn("ci_high", pct(w["hi"])).withColumn("tier", tier_of(F.col("winrate")))


def doc_civ_meta(civs: DataFrame, meta: DataFrame, by_map: DataFrame, by_patch: DataFrame, openings: DataFrame, ageup: DataFrame, kept: DataFrame, min_all: int = 500, min_elo: int = 100, min_map: int = 200, min_patch: int = 100) -> DataFrame:
    """One row per civ, also without data, with a map from ladder to its figures; a ladder with too few games is left out."""
    keys = ["civ_id", "ladder"]
    every = with_share(meta.filter((F.col("elo_bucket") == "all") & (F.col("games") >= min_all))).withColumn("play_rate", pct(F.col("games") / F.greatest("ladder_total_games", F.lit(1))))
    figures = ["games", "winrate"]
    elo = keyed(meta.filter((F.col("elo_bucket") != "all") & (F.col("games") >= min_elo)), keys, "elo_bucket", *figures, name="by_elo")
    maps = keyed(by_map.filter(F.col("games") >= min_map), keys, "map_id", *figures, name="by_map")
    patches = keyed(by_patch.filter(F.col("games") >= min_patch).join(kept.select("build"), "build", "left_semi"), keys, "build", *figures, name="by_patch")
    # of all of the ladder's games, also those whose opening is not known
    top = openings.filter("rank <= 3").join(every.select(*keys, F.col("games").alias("overall")), keys).withColumn("share", pct(F.col("games") / F.col("overall")))
    opened = top.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "opening_kind", "share"))), lambda x: F.struct(x["opening_kind"].alias("opening"), x["share"].alias("share"))).alias("openings"))
    ages = ageup.dropna(subset=["feudal_median", "castle_median", "imperial_median"]).select(*keys, F.struct(*(F.round(c).alias(c) for c in ("feudal_median", "castle_median", "imperial_median"))).alias("age_up"))
    rows = every
    for part in (elo, maps, patches, opened, ages):
        rows = rows.join(part, keys, "left")
    body = F.struct("games", "winrate", "ci_low", "ci_high", "tier", "play_rate", "by_elo", "by_map", "by_patch", "openings", "age_up")
    ladders = rows.groupBy("civ_id").agg(F.map_from_entries(F.collect_list(F.struct("ladder", body))).alias("ladders"))
    return civs.filter("civ_id <> 0").select("civ_id", "slug").join(ladders, "civ_id", "left")


def doc_matchups(matchups: DataFrame, min_games: int = 50) -> DataFrame:
    """Per civ its opponents with enough games, by rate, then opponent. For the team ladder the gate is 100 games."""
    return opponents(matchups, ["civ_id"], min_games)


def opponents(matchups: DataFrame, keys: list[str], min_games: int) -> DataFrame:
    entry = F.struct((-F.col("winrate")).alias("order"), F.col("opp_civ_id").alias("opponent"), "winrate", "games")
    return matchups.filter(F.col("games") >= min_games).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: F.struct(x["opponent"].alias("opponent"), x["winrate"].alias("winrate"), x["games"].alias("games"))).alias("opponents"))


def doc_matchups_by_map(by_map: DataFrame, min_games: int = 50) -> DataFrame:
    """Per civ a map from map to its opponents there with enough games."""
    per = opponents(by_map, ["civ_id", "map_id"], min_games)
    return per.groupBy("civ_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("map_id").cast("string"), "opponents")))).alias("maps"))


def doc_matchups_by_elo(by_elo: DataFrame, min_games: int = 30) -> DataFrame:
    """Per civ and opponent a map from band to [rate, games]."""
    return by_elo.filter(F.col("games") >= min_games).groupBy("civ_id", "opp_civ_id").agg(F.map_from_entries(F.collect_list(F.struct("elo_bucket", F.array("winrate", F.col("games").cast("double"))))).alias("cells"))


def numbered(values: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """values with a dictionary index from 0 in the given order; dictionaries are dimensions, small by nature."""
    return values.withColumn(name, F.row_number().over(W.orderBy(*order)) - 1)


def doc_cube(cube: DataFrame, maps: DataFrame, kept: DataFrame, bands: list[str]) -> DataFrame:
    """Rows of kept patches, dictionary-encoded: civ, elo, map, month, games, wins. Maps by games, then slug."""
    rows = cube.join(kept.select("build"), "build", "left_semi").join(maps.select("map_id", "slug"), "map_id")
    civ = numbered(rows.select("civ_id").distinct(), "civ", "civ_id")
    by_games = numbered(rows.groupBy("map_id", "slug").agg(F.sum("games").alias("g")), "map", F.desc("g"), "slug").select("map_id", "map")
    month = numbered(kept.select("build"), "month", F.desc("build"))
    band = F.create_map(*(F.lit(x) for i, b in enumerate(bands) for x in (b, i)))
    out = rows.join(civ, "civ_id").join(by_games, "map_id").join(month, "build")
    return out.select("civ", F.element_at(band, F.col("elo_bucket")).alias("elo"), "map", "month", "games", "wins")


def doc_benchmark(ageup: DataFrame, vils: DataFrame) -> DataFrame:
    """Age-up cells with the villagers' medians laid over; villagers without such a cell are left out (see skipped)."""
    keys = ["civ_id", "map_id", "elo_bucket", "ladder"]
    return ageup.join(vils.select(*keys, F.col("vils_median").alias("vils_castle")), keys, "left").select(*keys, F.col("feudal_median").alias("feudal_s"), F.col("castle_median").alias("castle_s"), F.col("imperial_median").alias("imperial_s"), "vils_castle")


def skipped(ageup: DataFrame, vils: DataFrame) -> DataFrame:
    return vils.join(ageup, ["civ_id", "map_id", "elo_bucket", "ladder"], "left_anti").agg(F.count(F.lit(1)).alias("skipped"))


def doc_eco(ecotech: DataFrame) -> DataFrame:
    seconds = lambda c: round1(F.col(f"{c}_ms") / 1000).alias(c)
    return ecotech.select("tech_id", "map_id", "elo_bucket", "ladder", seconds("p25"), seconds("p50"), seconds("p75"), "n")


def nested_eco(eco: DataFrame) -> DataFrame:
    """One row per tech: map of map, of band, of ladder."""
    cell = F.struct("p25", "p50", "p75", "n")
    level = eco.groupBy("tech_id", "map_id", "elo_bucket").agg(F.map_from_entries(F.collect_list(F.struct("ladder", cell))).alias("v"))
    for keys, key in ((["tech_id", "map_id"], "elo_bucket"), (["tech_id"], "map_id")):
        level = level.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(key, "v"))).alias("v"))
    return level.withColumnRenamed("v", "cells")


def ranked_list(rows: DataFrame, keys: list[str], top: int, *values: str) -> DataFrame:
    picked = rows.filter(F.col("rank") <= top).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rank", F.struct(*values).alias("v")))).alias("l"))
    return picked.select(*keys, F.transform("l", lambda x: x["v"]).alias("items"))


def doc_winner_comps(comps: DataFrame, top: int = 6) -> DataFrame:
    cells = ranked_list(comps, ["civ_id", "elo_bucket"], top, "unit", "share", "trained_median")
    return cells.groupBy("civ_id").agg(F.map_from_entries(F.collect_list(F.struct("elo_bucket", "items"))).alias("bands"))


def doc_winner_refs(openings: DataFrame, ecotech: DataFrame, meds: DataFrame, top: int = 5) -> DataFrame:
    """Sections openings, ecotech, meds and meds_by_map, a JSON value per key."""
    opened = ranked_list(openings, ["civ_id", "elo_bucket"], top, "opening_kind", "share").select(F.lit("openings").alias("section"), F.concat_ws("/", "civ_id", "elo_bucket").alias("key"), F.to_json("items").alias("value"))
    eco = ecotech.groupBy("elo_bucket").agg(F.array_sort(F.collect_list(F.struct("tech_id", "share"))).alias("items")).select(F.lit("ecotech").alias("section"), F.col("elo_bucket").alias("key"), F.to_json("items").alias("value"))
    body = F.to_json(F.struct(*(c for c in meds.columns if c not in ("map_id", "elo_bucket"))))
    both = meds.select(F.when(F.col("map_id") == "all", "meds").otherwise("meds_by_map").alias("section"), F.when(F.col("map_id") == "all", F.col("elo_bucket")).otherwise(F.concat_ws("/", "map_id", "elo_bucket")).alias("key"), body.alias("value"))
    return opened.unionByName(eco).unionByName(both)


def source_date(matches: DataFrame) -> DataFrame:
    return matches.agg(F.date_format(F.max("played_at"), "yyyy-MM").alias("source_date"))


def all_slugs(civs: DataFrame) -> DataFrame:
    return civs.filter("civ_id <> 0").select("slug").orderBy("slug")
