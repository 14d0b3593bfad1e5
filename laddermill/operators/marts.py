"""Aggregates of matches: win rates, match-ups, benchmarks and compositions.

Groups are formed on ids first and named afterwards through broadcast dimensions, so what is shuffled are partial
aggregates. A player without a result counts nowhere; civ 0 (random) is left out; thresholds are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laddermill.functions.scalars import elo_bucket, rate
from laddermill.operators.quantiles import quantiles

MILITARY_OUT = (83, 13, 128, 354, 17)
REF_TECHS = (22, 213, 202, 14, 55)
#: Width of the bins in which seconds and units, and milliseconds, are counted for quantiles.
S_BIN, MS_BIN = 64, 16_384


def rated(players: DataFrame) -> DataFrame:
    return players.withColumn("elo_bucket", elo_bucket(F.col("elo")))


def results(matches: DataFrame, players: DataFrame) -> DataFrame:
    """One row per player with a known result and civ, with the match's columns; games (1) and wins are summed later."""
    rows = rated(players).filter("won is not null and civ_id <> 0").join(matches, "match_id")
    return rows.withColumns({"games": F.lit(1).cast("long"), "wins": F.col("won").cast("long")})


#: The finest keys by which the win-rate marts count.
FINEST = ["civ_id", "ladder", "elo_bucket", "map_id", "build", "opening_kind"]


def finest(matches: DataFrame, players: DataFrame) -> DataFrame:
    """games and wins by all of FINEST: what civ_meta and its kin can be summed from in place of `results`."""
    return summed(results(matches, players), *FINEST)


def summed(rows: DataFrame, *keys) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("games").alias("games"), F.sum("wins").alias("wins"))


def wins_by(rows: DataFrame, *keys) -> DataFrame:
    return summed(rows, *keys).withColumn("winrate", rate(F.col("wins"), F.col("games")))


def rolled(rows: DataFrame, keys: list[str], over: str) -> DataFrame:
    """wins_by(keys + over) and, as 'all', wins_by(keys): the finest counts are summed again."""
    fine = summed(rows, *keys, over)
    coarse = summed(fine, *keys).withColumn(over, F.lit("all"))
    both = fine.filter(F.col(over).isNotNull()).unionByName(coarse)
    return both.withColumn("winrate", rate(F.col("wins"), F.col("games")))


def civ_meta(rows: DataFrame) -> DataFrame:
    """civ, ladder, band or 'all' (which includes unrated players), with the ladder's total of appearances.

    rows here and in the next three: `results`, or `finest`."""
    out = rolled(rows, ["civ_id", "ladder"], "elo_bucket")
    total = F.sum(F.when(F.col("elo_bucket") == "all", F.col("games"))).over(W.partitionBy("ladder"))
    return out.withColumn("ladder_total_games", total)


def civ_meta_by_map(rows: DataFrame) -> DataFrame:
    return wins_by(rows, "civ_id", "ladder", "map_id")


def civ_meta_by_patch(rows: DataFrame) -> DataFrame:
    return wins_by(rows.filter("build is not null"), "civ_id", "ladder", "build")


def civ_meta_openings(rows: DataFrame) -> DataFrame:
    counted = summed(rows.filter("opening_kind is not null"), "civ_id", "ladder", "opening_kind")
    order = W.partitionBy("civ_id", "ladder").orderBy(F.desc("games"), "opening_kind")
    return counted.withColumn("rank", F.row_number().over(order))


AGE_TIMES = {f"{a}_median": f"{a}_t" for a in ("feudal", "castle", "imperial")}


def civ_meta_ageup(matches: DataFrame, players: DataFrame) -> DataFrame:
    rows = players.filter("feudal_t is not null and civ_id <> 0").join(matches.select("match_id", "ladder"), "match_id")
    return quantiles(rows, [["civ_id", "ladder"]], AGE_TIMES, width=S_BIN).select("civ_id", "ladder", *(F.col(c)[0].alias(c) for c in AGE_TIMES))


def patch_axis(matches: DataFrame) -> DataFrame:
    return matches.filter("ladder = '1v1' and build is not null").groupBy("build").agg(F.count(F.lit(1)).alias("matches"))


def pairs(matches: DataFrame, players: DataFrame, ladder: str) -> DataFrame:
    """Ordered pairs of opponents. 1v1: the two players; team: players with opposite results. Mirrors are left out.

    Only the first of a pair needs a result; on the team ladder opposite results need both.
    """
    every = rated(players).filter("civ_id <> 0").join(matches.filter(F.col("ladder") == ladder).select("match_id", "map_id"), "match_id")
    # a match has eight players at most; pairs are made within it, without another join
    side = F.struct("profile_id", "civ_id", "elo_bucket", "won")
    per = every.groupBy("match_id", "map_id").agg(F.collect_list(side).alias("sides")).withColumn("a", F.explode("sides")).withColumn("b", F.explode("sides"))
    met = "a.profile_id <> b.profile_id" if ladder == "1v1" else "a.won <> b.won"
    met = per.filter(f"{met} and a.won is not null and a.civ_id <> b.civ_id").select("map_id", "a.civ_id", F.col("b.civ_id").alias("opp_civ_id"), "a.elo_bucket", "a.won")
    return met.withColumns({"games": F.lit(1).cast("long"), "wins": F.col("won").cast("long")})


def matchups(matches: DataFrame, players: DataFrame, ladder: str = "1v1", by: str | None = None) -> DataFrame:
    return wins_by(pairs(matches, players, ladder), "civ_id", "opp_civ_id", *([by] if by else []))


def matchups_by_elo(matches: DataFrame, players: DataFrame) -> DataFrame:
    """By the first player's band, and 'all' over players with a known rating only."""
    return rolled(pairs(matches, players, "1v1").filter("elo_bucket is not null"), ["civ_id", "opp_civ_id"], "elo_bucket")


def rollup_label(c: str) -> Column:
    """The key c of `quantiles` as text, 'all' where it is rolled up."""
    return F.when(F.array_contains("rolled", c), "all").otherwise(F.col(c).cast("string")).alias(c)


def benchmark_ageup(matches: DataFrame, players: DataFrame, min_n: int = 50) -> DataFrame:
    """Median age times by (civ, map, band, ladder), (civ, map, ladder), (civ, map) and (civ); cells of min_n or more."""
    return ageup_cells(players.join(matches.select("match_id", "map_id", "ladder"), "match_id"), min_n)


def ageup_cells(played: DataFrame, min_n: int = 50) -> DataFrame:
    """benchmark_ageup of players that have map_id and ladder."""
    rows = rated(played).filter("feudal_t is not null and civ_id <> 0 and elo is not null")
    sets = [["civ_id", "map_id", "elo_bucket", "ladder"], ["civ_id", "map_id", "ladder"], ["civ_id", "map_id"], ["civ_id"]]
    cells = quantiles(rows, sets, AGE_TIMES, width=S_BIN, least=min_n)
    return cells.select("civ_id", *map(rollup_label, ("map_id", "elo_bucket", "ladder")), "n", *(F.col(c)[0].alias(c) for c in AGE_TIMES))


def benchmark_vils(matches: DataFrame, players: DataFrame, ages: DataFrame, min_n: int = 50) -> DataFrame:
    """Median villagers up to Castle Age of winners that have dark and feudal windows and reached Castle Age.

    A window with a negative uptime was not reached and counts nowhere.
    """
    per = villagers_by_castle(ages)
    rows = per.join(players.select("match_id", "profile_id", "elo"), ["match_id", "profile_id"])
    return vils_cells(rows.join(matches.select("match_id", "map_id", "ladder"), "match_id"), min_n)


def villagers_by_castle(ages: DataFrame, *more: str) -> DataFrame:
    """won, vils, windows and castle of each player, kept with more of the player's columns."""
    early = F.col("age").isin("dark", "feudal")
    return ages.filter("age in ('dark', 'feudal', 'castle') and uptime_ms >= 0").groupBy("match_id", "profile_id", "civ_id", *more).agg(
        F.bool_or("won").alias("won"), F.sum(F.when(early, F.col("villagers"))).alias("vils"), F.count_if(early).alias("windows"), F.bool_or(F.col("age") == "castle").alias("castle")
    )


def vils_cells(played: DataFrame, min_n: int = 50) -> DataFrame:
    """benchmark_vils of what villagers_by_castle gives, with elo, map_id and ladder."""
    rows = rated(played).filter("won and castle and windows = 2 and vils is not null and civ_id <> 0 and elo is not null")
    sets = [["civ_id", "map_id", "elo_bucket", "ladder"], ["civ_id", "map_id", "ladder"], ["civ_id", "map_id"]]
    cells = quantiles(rows, sets, {"vils_median": "vils"}, width=S_BIN, least=min_n)
    return cells.select("civ_id", *map(rollup_label, ("map_id", "elo_bucket", "ladder")), "n", F.col("vils_median")[0].alias("vils_median"))


def benchmark_ecotech(matches: DataFrame, players: DataFrame, techs: DataFrame, min_n: int = 50) -> DataFrame:
    """Quartiles of winners' click seconds by (tech, map, band, ladder) and three rollups."""
    return ecotech_cells(players.join(matches.select("match_id", "map_id", "ladder"), "match_id"), techs, min_n)


def ecotech_cells(played: DataFrame, techs: DataFrame, min_n: int = 50) -> DataFrame:
    """benchmark_ecotech of players that have map_id and ladder."""
    won = rated(played).filter("won and elo is not null").select("match_id", "profile_id", "map_id", "elo_bucket", "ladder")
    rows = techs.join(won, ["match_id", "profile_id"])
    sets = [["tech_id", "map_id", "elo_bucket", "ladder"], ["tech_id", "map_id", "ladder"], ["tech_id", "elo_bucket", "ladder"], ["tech_id", "ladder"]]
    cells = quantiles(rows, sets, {"q": "t_ms"}, (0.25, 0.5, 0.75), MS_BIN, min_n)
    return cells.select("tech_id", *map(rollup_label, ("map_id", "elo_bucket")), "ladder", "n", *(F.col("q")[i].alias(p) for i, p in enumerate(("p25_ms", "p50_ms", "p75_ms"))))


def civ_cube(matches: DataFrame, players: DataFrame, min_games: int = 20, ladder: str = "1v1") -> DataFrame:
    rows = results(matches.filter(F.col("ladder") == ladder), players).filter("elo_bucket is not null and build is not null")
    return summed(rows, "civ_id", "elo_bucket", "map_id", "build").filter(F.col("games") >= min_games)


def winners(matches: DataFrame, players: DataFrame, source: str | None = "replay", random_civ: bool = False) -> DataFrame:
    """Rated winners of 1v1 matches, of one source or (None) of all, with or without those of civ 0."""
    return winners_of(players.join(matches.select("match_id", "map_id", "source", "ladder"), "match_id"), source, random_civ).drop("source", "ladder")


def winners_of(played: DataFrame, source: str | None = "replay", random_civ: bool = False) -> DataFrame:
    """`winners` of players that have map_id, source and ladder."""
    won = rated(played).filter("won and elo is not null and ladder = '1v1'")
    won = won.filter(F.col("source") == source) if source else won
    return won if random_civ else won.filter("civ_id <> 0")


def share(part: str, whole: str) -> Column:
    return F.floor((F.col(part) * 20000 + F.col(whole)) / (F.col(whole) * 2)) / 10000.0


def winner_comps(won: DataFrame, units: DataFrame, names: DataFrame, min_winners: int = 100, min_share: float = 0.15) -> DataFrame:
    """Units, by their names in small letters (names: unit_id, name), that at least min_share of a cell's winners trained;
    share is that percentage, to one decimal. The denominator counts all winners of the source; units without a name are
    left out, and a player who trained two units of one name counts twice."""
    cell = ["civ_id", "elo_bucket"]
    totals = won.groupBy(*cell).agg(F.count(F.lit(1)).alias("winners")).filter(F.col("winners") >= min_winners)
    made = units.filter(~F.col("unit_id").isin(*MILITARY_OUT)).join(names.select("unit_id", F.lower("name").alias("unit")), "unit_id").join(won.select("match_id", "profile_id", *cell), ["match_id", "profile_id"])
    by_unit = quantiles(made, [[*cell, "unit"]], {"trained_median": "trained"}, width=S_BIN).select(*cell, "unit", F.col("n").alias("producers"), F.col("trained_median")[0].alias("trained_median"))
    percent = F.floor((F.col("producers") * 2000 + F.col("winners")) / (F.col("winners") * 2)) / 10.0
    out = by_unit.join(totals, cell).withColumn("share", percent).filter(F.col("producers") >= F.col("winners") * min_share)
    return out.withColumn("rank", F.row_number().over(W.partitionBy(*cell).orderBy(F.desc("producers"), "unit")))


def winner_refs_openings(won: DataFrame, min_winners: int = 100, min_share: float = 0.08) -> DataFrame:
    cell = ["civ_id", "elo_bucket"]
    totals = won.filter("opening_kind is not null").groupBy(*cell).agg(F.count(F.lit(1)).alias("winners")).filter(F.col("winners") >= min_winners)
    by = won.filter("opening_kind is not null").groupBy(*cell, "opening_kind").agg(F.count(F.lit(1)).alias("n"))
    out = by.join(totals, cell).withColumn("share", share("n", "winners")).filter(F.col("n") >= F.col("winners") * min_share)
    return out.withColumn("rank", F.row_number().over(W.partitionBy(*cell).orderBy(F.desc("share"), "opening_kind")))


def winner_refs_ecotech(won: DataFrame, techs: DataFrame, min_n: int = 50) -> DataFrame:
    """Share of a band's winners that clicked each tech before their own Castle Age was complete (seconds against ms)."""
    rows = won.filter("castle_t is not null").select("match_id", "profile_id", "elo_bucket", "castle_t")
    clicked = rows.join(techs.filter(F.col("tech_id").isin(*REF_TECHS)), ["match_id", "profile_id"], "left")
    in_time = lambda t: F.bool_or((F.col("tech_id") == t) & (F.col("t_ms") < F.col("castle_t") * 1000))
    per = clicked.groupBy("match_id", "profile_id", "elo_bucket").agg(*(F.coalesce(in_time(t), F.lit(False)).alias(f"t{t}") for t in REF_TECHS))
    wide = per.groupBy("elo_bucket").agg(F.count(F.lit(1)).alias("n"), *(F.count_if(f"t{t}").alias(f"t{t}") for t in REF_TECHS)).filter(F.col("n") >= min_n)
    long = wide.select("elo_bucket", "n", F.explode(F.array(*(F.struct(F.lit(t).alias("tech_id"), F.col(f"t{t}").alias("clicked")) for t in REF_TECHS))).alias("x"))
    return long.select("elo_bucket", "n", "x.tech_id", "x.clicked", share("x.clicked", "n").alias("share")).orderBy("elo_bucket", "tech_id")


def winner_refs_meds(won: DataFrame, events: DataFrame, min_n: int = 50) -> DataFrame:
    """Medians of winners' first military unit and four techs, by (map, band) and (band).

    Winners without any of these events count nowhere; a winner without one of them only in the other medians.
    """
    first = lambda cond: F.min(F.when(cond, F.col("t_ms")))
    kind, target = F.col("kind"), F.col("target_id")
    asked = ((kind == "train") & ~target.isin(*MILITARY_OUT)) | ((kind == "research") & target.isin(*REF_TECHS[:4]))
    firsts = events.filter(asked).groupBy("match_id", "profile_id").agg(
        first(kind == "train").alias("military"), *(first((kind == "research") & (target == t)).alias(f"t{t}") for t in REF_TECHS[:4])
    )
    rows = won.select("match_id", "profile_id", "map_id", "elo_bucket").join(firsts, ["match_id", "profile_id"])
    names = ["military", *(f"t{t}" for t in REF_TECHS[:4])]
    medians = {f"{c}_median": c for c in names}
    cells = quantiles(rows, [["map_id", "elo_bucket"], ["elo_bucket"]], medians, width=MS_BIN, least=min_n)
    return cells.select(rollup_label("map_id"), "elo_bucket", "n", *(F.col(c)[0].alias(c) for c in medians)).orderBy("map_id", "elo_bucket")


def map_meta(matches: DataFrame, players: DataFrame) -> DataFrame:
    """As civ_meta, by map; with each map's appearances in its ladder."""
    out = rolled(results(matches, players), ["map_id", "ladder", "civ_id"], "elo_bucket")
    total = F.sum(F.when(F.col("elo_bucket") == "all", F.col("games"))).over(W.partitionBy("map_id", "ladder"))
    return out.withColumn("map_total_games", total)
