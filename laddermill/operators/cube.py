"""Slices of the win-rate cube and the pages' questions. cube: civ_id, elo_bucket, map_id, build, games, wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laddermill.functions.scalars import BANDS, band_edge, rate, tier_of

ORDER = {b: i for i, b in enumerate(BANDS)}


def band_order(c: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in ORDER.items() for x in kv)), c)


def elo_predicate(c: Column, selection: str | None) -> Column:
    """None: any band; cum:N: bands from N on, by their lower edge (the lowest band has none); else the band itself."""
    if selection is None:
        return F.lit(True)
    if selection.startswith("cum:"):
        return F.coalesce(band_edge(c) >= int(selection[4:]), F.lit(False))
    return c == selection


def selected(cube: DataFrame, civ=None, map=None, elo=None, patch=None) -> DataFrame:
    """Rows of a selection; a value that the cube lacks selects nothing."""
    for column, value in (("civ_id", civ), ("map_id", map), ("build", patch)):
        if value is not None:
            cube = cube.filter(F.col(column) == value)
    return cube.filter(elo_predicate(F.col("elo_bucket"), elo))


def summed(rows: DataFrame, *keys: str) -> DataFrame:
    out = rows.groupBy(*keys).agg(F.coalesce(F.sum("games"), F.lit(0)).alias("games"), F.coalesce(F.sum("wins"), F.lit(0)).alias("wins"))
    return out.withColumn("winrate", rate(F.col("wins"), F.col("games")))


def slice_win_rate(cube: DataFrame, civ: int, **selection) -> DataFrame:
    return summed(selected(cube, civ, **selection))


def breakdown(cube: DataFrame, dim: str, civ: int, **selection) -> DataFrame:
    """By elo, map or patch; the dimension's own filter is ignored. Bands and patches in order, maps by rate."""
    column = {"elo": "elo_bucket", "map": "map_id", "patch": "build"}[dim]
    out = summed(selected(cube, civ, **{k: v for k, v in selection.items() if k != dim}), column)
    return out.orderBy(F.desc("winrate"), column) if dim == "map" else out.orderBy(band_order(F.col(column)) if dim == "elo" else column)


def tier_list(cube: DataFrame, min_games: int = 30, **selection) -> DataFrame:
    out = summed(selected(cube, **selection), "civ_id")
    return out.withColumn("tier", F.when(F.col("games") >= min_games, tier_of(F.col("winrate"))).otherwise("NR")).orderBy(F.desc("winrate"), "civ_id")


def map_ranking(cube: DataFrame, map: int, min_games: int = 20, **selection) -> DataFrame:
    return summed(selected(cube, map=map, **selection), "civ_id").filter(F.col("games") >= min_games).orderBy(F.desc("winrate"), "civ_id")


def pooled_rate(rows: DataFrame, cut: int, min_games: int = 20) -> DataFrame:
    """Mean of band rates from a rating on, weighted by games. rows: civ_id, elo_bucket, games, winrate."""
    above = rows.filter(band_edge(F.col("elo_bucket")) >= cut)
    out = above.groupBy("civ_id").agg(F.sum("games").alias("games"), F.sum(F.col("games") * F.col("winrate")).alias("s"))
    return out.filter(F.col("games") >= min_games).select("civ_id", "games", F.round(F.col("s") / F.col("games"), 4).alias("winrate"))


def patches_with_rows(cube: DataFrame, map: int) -> DataFrame:
    return cube.filter(F.col("map_id") == map).select("build").distinct().orderBy("build")


def strong_weak(matchups: DataFrame, k: int = 6) -> DataFrame:
    """The best k and the worst k opponents of each civ, without overlap; exactly even ones are dropped."""
    side = W.partitionBy("civ_id")
    ranked = matchups.filter("winrate <> 50").withColumn("nth", F.row_number().over(side.orderBy(F.desc("winrate"), "opp_civ_id"))).withColumn("n", F.count(F.lit(1)).over(side))
    first = F.least(F.lit(k), F.ceil(F.col("n") / 2))
    group = F.when(F.col("nth") <= first, "strong").when(F.col("nth") > F.greatest(first, F.col("n") - k), "weak")
    place = F.when(group == "strong", F.col("nth")).otherwise(F.col("n") - F.col("nth") + 1)
    return ranked.withColumn("side", group).withColumn("place", place.cast("int")).filter("side is not null").select("civ_id", "side", "place", "opp_civ_id", "winrate", "games")


def map_views(matchups_by_map: DataFrame, min_opponents: int = 14, k: int = 10) -> DataFrame:
    per = matchups_by_map.groupBy("civ_id", "map_id").agg(F.count(F.lit(1)).alias("opponents"), F.sum("games").alias("games")).filter(F.col("opponents") >= min_opponents)
    return top_n(per, [F.desc("games"), F.asc("map_id")], k, ["civ_id"])


def top_n(df: DataFrame, by: list[Column], n: int, per: list[str] | None = None) -> DataFrame:
    if not per:
        return df.orderBy(*by).limit(n)
    return df.withColumn("_nth", F.row_number().over(W.partitionBy(*per).orderBy(*by))).filter(F.col("_nth") <= n).drop("_nth")


def trend(rows: DataFrame, order: Column, label: str) -> DataFrame:
    """A civ's rates in the order of bands or patches, numbered."""
    nth = F.row_number().over(W.partitionBy("civ_id").orderBy(order))
    return rows.select("civ_id", label, "winrate", "games", nth.alias("nth"))


def h2h(by_elo: DataFrame, selection: str) -> DataFrame:
    """Each pair's rate in a band, or pooled over bands from a rating on; without games there, the 'all' cell, flagged."""
    fine = summed(by_elo.filter((F.col("elo_bucket") != "all") & elo_predicate(F.col("elo_bucket"), selection)), "civ_id", "opp_civ_id")
    every = by_elo.filter("elo_bucket = 'all'").select("civ_id", "opp_civ_id", F.col("games").alias("all_games"), F.col("winrate").alias("all_rate"))
    both = every.join(fine, ["civ_id", "opp_civ_id"], "left")
    out = both.select("civ_id", "opp_civ_id", F.coalesce("games", "all_games").alias("games"), F.coalesce("winrate", "all_rate").alias("winrate"), F.col("games").isNull().alias("fallback"))
    favourite = F.when(F.col("winrate") >= 52, "first").when(F.col("winrate") <= 48, "second").otherwise("even")
    return out.withColumn("favourite", favourite)


def h2h_curve(by_elo: DataFrame, a: int, b: int) -> DataFrame:
    rows = by_elo.filter((F.col("civ_id") == a) & (F.col("opp_civ_id") == b) & (F.col("elo_bucket") != "all"))
    return rows.select("elo_bucket", "games", "winrate").orderBy(band_order(F.col("elo_bucket")))


def h2h_maps(by_map: DataFrame, k: int = 15) -> DataFrame:
    """Pairs on the k maps with most games."""
    top = by_map.groupBy("map_id").agg(F.sum("games").alias("g")).orderBy(F.desc("g"), "map_id").limit(k)
    return by_map.join(top.select("map_id"), "map_id", "left_semi").select("civ_id", "opp_civ_id", "map_id", "games", "winrate").orderBy("civ_id", "opp_civ_id", F.desc("games"), "map_id")


def comp_bucket(comps: DataFrame, selection: str) -> DataFrame:
    """The band to show for each civ: 'all' and the highest stand for 1200-1399; a band without rows for the middle one."""
    wanted = "1200-1399" if selection in ("all", "2500+") else selection
    bands = comps.groupBy("civ_id").agg(F.array_sort(F.collect_set(F.struct(band_order(F.col("elo_bucket")).alias("i"), F.col("elo_bucket").alias("b")))).alias("s"))
    names = F.transform("s", lambda x: x["b"])
    return bands.select("civ_id", F.when(F.array_contains(names, wanted), wanted).otherwise(F.get(names, F.floor(F.size("s") / 2).cast("int"))).alias("elo_bucket"))


def best_variant(maps: DataFrame, min_civs: int = 10) -> DataFrame:
    """Of the variants of a canonical name with enough ranked civs the one with most games."""
    return maps.filter(F.col("civs") >= min_civs).groupBy("canonical").agg(F.max_by("slug", F.struct("games", "slug")).alias("slug"), F.max("games").alias("games"))


def peer_average(df: DataFrame, group: str, item: str, value: str, min_n: int = 3, excluded: str | None = None) -> DataFrame:
    """Items beside the rounded mean of their group, for groups of min_n or more."""
    own = W.partitionBy(group)
    rows = df.filter(F.col(group) != excluded) if excluded else df
    return rows.withColumn("peers", F.count(F.lit(1)).over(own)).withColumn("peer_mean", F.round(F.avg(value).over(own)).cast("long")).filter(F.col("peers") >= min_n).select(item, group, value, "peers", "peer_mean", (F.col(value) - F.col("peer_mean")).alias("difference"))


def tier_counts(rates: DataFrame) -> DataFrame:
    counted = rates.groupBy(tier_of(F.col("winrate")).alias("tier")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("total", F.sum("n").over(W.partitionBy())).orderBy(F.expr("array_position(array('S', 'A', 'B', 'C', 'D'), tier)"))


def match_total(appearances: DataFrame, step: int = 10_000) -> DataFrame:
    return appearances.agg((F.floor(F.sum("games") / 2 / step) * step).cast("long").alias("matches"))
