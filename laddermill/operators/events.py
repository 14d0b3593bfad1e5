"""Per-player features from event tables, for all matches at once.

Events have match_id, profile_id, t_ms, kind, target_id, amount, and where a feature needs places, x and y. Players have
match_id, profile_id, and where needed team, civ_id and duration_ms. Everything that one pass can count shares one
groupBy on (match_id, profile_id); joins on ranges always keep equality on the match.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laddermill.sources.archives import saved

# Ids of technologies, units and buildings, and their research times in seconds.
AGES = {"feudal": 101, "castle": 102, "imperial": 103}
AGE_SECONDS = {"feudal": 130.0, "castle": 160.0, "imperial": 190.0}
FAST_AGES = 1 / 1.66
VILLAGER, VILLAGER_MS = 83, 25_000
ECO_UNITS = (83, 13, 128, 354, 17)
WATCHED = {22: "Loom", 213: "Wheelbarrow", 249: "Hand Cart", 202: "Double-Bit Axe", 203: "Bow Saw", 14: "Horse Collar", 13: "Heavy Plow", 55: "Gold Mining", 182: "Gold Shaft Mining", 278: "Stone Mining"}
CENTRE_MS = {101: 130_000, 102: 160_000, 103: 190_000, 22: 25_000, 213: 75_000, 249: 55_000}
CENTRES = (109, 621)
MILITIA = (74, 75)
ECO_BUILDINGS = (70, 68, 50, 562, 584, 45, 84, 199, 109, 621)
MILITARY_BUILDINGS = (12, 87, 101, 49, 82, 79)
LINES = (("Scouts", "scouts", (448,)), ("Archers", "archers", (4,)), ("Skirms", "skirms", (7,)), ("Eagles", "eagles", (751,)), ("M@A", "man_at_arms", (74, 75)), ("Spears", "spears", (93,)))
PLAYER = ["match_id", "profile_id"]
MINUTE = 60_000


def first_at(cond: Column) -> Column:
    return F.min(F.when(cond, F.col("t_ms")))


def is_kind(kind: str, ids: Sequence[int] | None = None) -> Column:
    cond = F.col("kind") == kind
    return cond & F.col("target_id").isin(*ids) if ids is not None else cond


def first_event(events: DataFrame, kind: str, ids: Sequence[int]) -> DataFrame:
    return events.filter(is_kind(kind, ids)).groupBy(*PLAYER).agg(F.min("t_ms").alias("t_ms"))


def age_clicks(events: DataFrame, ages: Mapping[str, int] = AGES) -> DataFrame:
    """feudal_ms, castle_ms, imperial_ms: each player's first click; only players with any."""
    clicks = events.filter(is_kind("research", list(ages.values())))
    return clicks.groupBy(*PLAYER).agg(*(first_at(F.col("target_id") == i).alias(f"{age}_ms") for age, i in ages.items()))


def completion(clicks: DataFrame, fast_civ: int) -> DataFrame:
    """Completion seconds from clicks (with civ_id): one civ researches ages faster."""
    factor = F.when(F.col("civ_id") == fast_civ, FAST_AGES).otherwise(1.0)
    return clicks.select(*PLAYER, *(F.round(F.col(f"{age}_ms") / 1000 + factor * s, 3).alias(f"{age}_t") for age, s in AGE_SECONDS.items()))


def classify_opening(events: DataFrame, clicks: DataFrame, lines=LINES, militia: Sequence[int] = MILITIA, expand: bool = False) -> DataFrame:
    """Opening tag and kind of each player with a feudal click that has one.

    Three trains or more of the militia line before the click make a drush; `expand` counts queued units instead of
    commands. The body is the first two lines trained from then to the castle click (or 12 minutes), by time, ties in
    the lines' order; without any, Fast Castle if there is a castle click, else nothing.
    """
    rows = events.filter(F.col("kind") == "train").join(clicks.filter("feudal_ms is not null").select(*PLAYER, "feudal_ms", "castle_ms"), PLAYER, "right")
    size = F.least(F.greatest(F.coalesce("amount", F.lit(1)), F.lit(1)), F.lit(60)) if expand else F.lit(1)
    until = F.coalesce(F.col("castle_ms"), F.col("feudal_ms") + 12 * MINUTE)
    inside = (F.col("t_ms") >= F.col("feudal_ms")) & (F.col("t_ms") < until)
    dark = F.sum(F.when((F.col("t_ms") < F.col("feudal_ms")) & F.col("target_id").isin(*militia), size).otherwise(0))
    firsts = [F.min(F.when(inside & F.col("target_id").isin(*ids), F.struct("t_ms", F.lit(i).alias("nth"), F.lit(tag).alias("tag"), F.lit(kind).alias("kind")))).alias(f"l{i}") for i, (tag, kind, ids) in enumerate(lines)]
    per = rows.groupBy(*PLAYER, "castle_ms").agg(dark.alias("dark"), *firsts)
    opened = F.slice(F.array_sort(F.array_compact(F.array(*(f"l{i}" for i in range(len(lines)))))), 1, 2)
    per = per.withColumn("o", opened)
    none = F.size("o") == 0
    body = F.when(~none, F.array_join(F.transform("o", lambda x: x["tag"]), " into ")).when(F.col("castle_ms").isNotNull(), "Fast Castle")
    kind = F.when(F.col("dark") >= 3, "drush").when(none, "fast_castle").otherwise(F.get("o", F.lit(0))["kind"])
    return per.withColumn("body", body).filter("body is not null").select(*PLAYER, F.when(F.col("dark") >= 3, F.concat(F.lit("Drush + "), "body")).otherwise(F.col("body")).alias("opening"), kind.alias("opening_kind"))


def player_units(events: DataFrame) -> DataFrame:
    """Units queued by each player: the sum of max(amount, 1)."""
    trained = events.filter("kind = 'train'")
    return trained.groupBy("match_id", "profile_id", F.col("target_id").alias("unit_id")).agg(F.sum(F.greatest(F.coalesce("amount", F.lit(1)), F.lit(1))).cast("long").alias("trained"))


def player_techs(events: DataFrame, watched: Sequence[int] = tuple(WATCHED)) -> DataFrame:
    return events.filter(is_kind("research", watched)).groupBy(*PLAYER, F.col("target_id").alias("tech_id")).agg(F.min("t_ms").alias("t_ms"))


def apm(events: DataFrame, players: DataFrame) -> DataFrame:
    """Commands a minute over the match's length, a second at least; players without events have 0.0."""
    n = events.groupBy(*PLAYER).agg(F.count(F.lit(1)).alias("commands"))
    minutes = F.greatest(F.col("duration_ms") / float(MINUTE), F.lit(1 / 60))
    return players.join(n, PLAYER, "left").select(*PLAYER, F.round(F.coalesce("commands", F.lit(0)) / minutes, 6).alias("apm"))


def age_snapshots(events: DataFrame, clicks: DataFrame) -> DataFrame:
    """What a player had queued, built and researched up to each age click, the click included."""
    events = events.select(*PLAYER, "t_ms", "kind", "target_id", "amount")
    upto = events.join(clicks.select(*PLAYER, *(f"{a}_ms" for a in AGES)), PLAYER, "right")
    amount = F.greatest(F.coalesce("amount", F.lit(1)), F.lit(1))
    train = F.col("kind") == "train"
    counts = {
        "villagers": (train & (F.col("target_id") == VILLAGER), amount),
        "military": (train & ~F.col("target_id").isin(*ECO_UNITS), amount),
        "n_buildings": (F.col("kind") == "build", F.lit(1)),
        "n_research": (F.col("kind") == "research", F.lit(1)),
    }
    # one pass with sums for each age, so that events are neither copied nor shuffled again
    total = lambda a, cond, what: F.coalesce(F.sum(F.when((F.col("t_ms") <= F.col(f"{a}_ms")) & cond, what)), F.lit(0)).cast("long")
    per = upto.groupBy(*PLAYER).agg(*(F.struct(F.lit(a).alias("age"), F.max(f"{a}_ms").alias("at"), *(total(a, *c).alias(n) for n, c in counts.items())).alias(a) for a in AGES))
    return per.select(*PLAYER, F.explode(F.array(*AGES)).alias("c")).filter("c.at is not null").select(*PLAYER, "c.*")


def winner_individual(events: DataFrame, players: DataFrame) -> DataFrame:
    """won = not resigned, where at least one and not all of the match's players resigned; else null."""
    out = events.filter("kind = 'resign'").select(*PLAYER).distinct().withColumn("out", F.lit(True))
    rows = players.join(out, PLAYER, "left").withColumn("out", F.coalesce("out", F.lit(False)))
    match = W.partitionBy("match_id")
    n_out, n = F.count_if("out").over(match), F.count(F.lit(1)).over(match)
    return rows.select(*PLAYER, F.when((n_out >= 1) & (n_out < n), ~F.col("out")).alias("won"))


def winner_team(events: DataFrame, players: DataFrame) -> DataFrame:
    """The one team without a resignation won, if there are two teams or more and somebody resigned; else null.

    A civ_id of 0 marks no player; such rows count in no team and are left out.
    """
    players = players.filter("civ_id <> 0")
    out = events.filter("kind = 'resign'").select(*PLAYER).distinct().withColumn("out", F.lit(1))
    teams = players.join(out, PLAYER, "left").groupBy("match_id", "team").agg(F.sum(F.coalesce("out", F.lit(0))).alias("resigned"))
    gone = events.filter("kind = 'resign'").select("match_id").distinct().withColumn("somebody", F.lit(True))
    per = teams.groupBy("match_id").agg(F.count(F.lit(1)).alias("teams"), F.count_if(F.col("resigned") == 0).alias("clean"), F.max(F.when(F.col("resigned") == 0, F.col("team"))).alias("winner"))
    known = F.col("somebody") & (F.col("teams") >= 2) & (F.col("clean") == 1)
    return players.join(per.join(gone, "match_id", "left"), "match_id").select(*PLAYER, "team", F.when(known, F.col("team") == F.col("winner")).alias("won"))


def postgame_elo(blocks: DataFrame) -> DataFrame:
    """Rating of each player from post-game blocks (match_id, ladder, slot from 0, elo): ladder 3, else ladder 4."""
    of = lambda ladder: F.max(F.when(F.col("ladder") == ladder, F.col("elo")))
    return blocks.groupBy("match_id", (F.col("slot") + 1).alias("player_number")).agg(F.coalesce(of(3), of(4)).alias("elo"))


def expanded() -> Column:
    return F.least(F.greatest(F.coalesce("amount", F.lit(1)), F.lit(1)), F.lit(60))


def units_by(events: DataFrame, unit: int, until: Column | int) -> DataFrame:
    """Units of one kind queued up to a time; a command counts for 1 to 60."""
    until = until if isinstance(until, Column) else F.lit(until)
    return events.groupBy(*PLAYER).agg(F.coalesce(F.sum(F.when(is_kind("train", [unit]) & (F.col("t_ms") <= until), expanded())), F.lit(0)).cast("long").alias("n"))


def idle_time(events: DataFrame, bounds: DataFrame, busy_ms: Mapping[int, int] = CENTRE_MS, unit: int = VILLAGER) -> DataFrame:
    """Estimated idle milliseconds of a town centre between since_ms and until_ms (in bounds), floored at 0 each time."""
    rows = events.join(bounds, PLAYER, "right")
    until = F.col("until_ms")
    vils = F.coalesce(F.sum(F.when(is_kind("train", [unit]) & (F.col("t_ms") <= until), expanded())), F.lit(0))
    lasts = F.element_at(F.create_map(*(F.lit(x) for kv in busy_ms.items() for x in kv)), F.col("target_id").cast("int"))
    research = F.coalesce(F.sum(F.when((F.col("kind") == "research") & lasts.isNotNull() & (F.col("t_ms") < until), F.least(lasts, until - F.col("t_ms")))), F.lit(0))
    per = rows.groupBy(*PLAYER, "since_ms", "until_ms").agg(vils.alias("vils"), research.alias("busy"))
    floor = lambda x: F.greatest(x, F.lit(0))
    return per.select(*PLAYER, floor(floor(floor(until - F.col("since_ms")) - F.col("vils") * VILLAGER_MS) - F.col("busy")).cast("long").alias("idle_ms"))


def first_military(events: DataFrame) -> DataFrame:
    return events.filter((F.col("kind") == "train") & ~F.col("target_id").isin(*ECO_UNITS)).groupBy(*PLAYER).agg(F.min("t_ms").alias("t_ms"))


def minutes_of(players: DataFrame) -> DataFrame:
    return players.select(*PLAYER, "duration_ms", F.explode(F.sequence(F.lit(0), F.floor(F.col("duration_ms") / MINUTE).cast("int"))).alias("minute"))


def production_series(events: DataFrame, players: DataFrame) -> DataFrame:
    """Units queued up to each minute, workers and soldiers apart; every minute of the match has a row.

    The minute in which a match ends counts as a whole; what is logged in later ones does not.
    """
    minute = F.floor(F.col("t_ms") / MINUTE)
    rows = events.filter("kind = 'train'").join(players.select(*PLAYER, "duration_ms"), PLAYER).filter(minute <= F.floor(F.col("duration_ms") / MINUTE))
    eco = F.col("target_id").isin(*ECO_UNITS)
    per = rows.groupBy(*PLAYER, minute.cast("int").alias("minute")).agg(F.sum(F.when(eco, expanded()).otherwise(0)).alias("e"), F.sum(F.when(~eco, expanded()).otherwise(0)).alias("m"))
    upto = W.partitionBy(*PLAYER).orderBy("minute").rowsBetween(W.unboundedPreceding, 0)
    out = minutes_of(players).join(per, [*PLAYER, "minute"], "left")
    run = lambda c: F.sum(F.coalesce(c, F.lit(0))).over(upto).cast("long")
    return out.select(*PLAYER, "minute", run("e").alias("eco"), run("m").alias("military"))


def apm_series(events: DataFrame) -> DataFrame:
    """Commands in each minute from 0 to the player's last one; minutes without any have 0."""
    per = events.groupBy(*PLAYER, F.floor(F.col("t_ms") / MINUTE).cast("int").alias("minute")).agg(F.count(F.lit(1)).alias("commands"))
    lists = per.groupBy(*PLAYER).agg(F.map_from_entries(F.collect_list(F.struct("minute", "commands"))).alias("n"), F.max("minute").alias("last"))
    return lists.select(*PLAYER, "n", F.explode(F.sequence(F.lit(0), "last")).alias("minute")).select(*PLAYER, "minute", F.coalesce(F.element_at("n", F.col("minute")), F.lit(0)).alias("commands"))


def command_split(events: DataFrame, players: DataFrame, eco_buildings: Sequence[int], military_buildings: Sequence[int], techs: Sequence[int] = (*AGES.values(), *WATCHED)) -> DataFrame:
    """Commands for economy and army, and their rates a minute."""
    eco = is_kind("train", ECO_UNITS) | is_kind("build", eco_buildings) | is_kind("research", techs)
    army = ((F.col("kind") == "train") & ~F.col("target_id").isin(*ECO_UNITS)) | is_kind("build", military_buildings)
    per = events.groupBy(*PLAYER).agg(F.count_if(eco).alias("eco"), F.count_if(army).alias("military"))
    minutes = F.greatest(F.col("duration_ms") / float(MINUTE), F.lit(1 / 60))
    n = lambda c: F.coalesce(c, F.lit(0))
    return players.join(per, PLAYER, "left").select(*PLAYER, n("eco").alias("eco"), n("military").alias("military"), F.round(n("eco") / minutes, 6).alias("eco_pm"), F.round(n("military") / minutes, 6).alias("military_pm"))


def market_counts(events: DataFrame, buy: str = "market_buy", sell: str = "market_sell") -> DataFrame:
    return events.groupBy(*PLAYER).agg(F.count_if(F.col("kind") == buy).alias("buys"), F.count_if(F.col("kind") == sell).alias("sells"))


def base_centroid(events: DataFrame, until_ms: int = 6 * MINUTE) -> DataFrame:
    """The upper middle of the x and of the y of a player's early buildings; a player has hundreds at most."""
    built = events.filter((F.col("kind") == "build") & (F.col("t_ms") <= until_ms) & F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan(F.col("x").cast("double")) & ~F.isnan(F.col("y").cast("double")))
    mid = lambda c: F.get(F.sort_array(F.collect_list(c)), F.floor(F.count(F.lit(1)) / 2).cast("int")).cast("double")
    return built.groupBy(*PLAYER).agg(mid("x").alias("base_x"), mid("y").alias("base_y"))


def roles(players: DataFrame) -> DataFrame:
    """flank or pocket by the place in the team; only open and closed maps (family) with two real teams or more.

    players also have slot and family. Team 1 is no team. The first and last slot are flanks, those between pockets; a
    team of two has one of each, a team of one has none.
    """
    real = players.filter("team <> 1")
    teams = real.groupBy("match_id").agg(F.count_distinct("team").alias("teams"))
    side = W.partitionBy("match_id", "team")
    nth, n = F.row_number().over(side.orderBy("slot", "profile_id")), F.count(F.lit(1)).over(side)
    ranked = real.join(teams, "match_id").filter("teams >= 2 and family in ('open', 'closed')").select(*PLAYER, "team", nth.alias("nth"), n.alias("n"))
    role = F.when(F.col("n") == 1, None).when(F.col("n") == 2, F.when(F.col("nth") == 1, "flank").otherwise("pocket")).when((F.col("nth") == 1) | (F.col("nth") == F.col("n")), "flank").otherwise("pocket")
    return ranked.select(*PLAYER, role.alias("role")).filter("role is not null")



#: Sides of the cells in which the nearest base is looked for, in tiles; beyond the last the whole match is one cell.
RINGS = (15.0, 60.0, 240.0)


def _cell(x: str, y: str, side: float) -> Column:
    return F.struct(F.floor(F.col(x) / side).alias("cx"), F.floor(F.col(y) / side).alias("cy"))


def _around(x: str, y: str, side: float) -> Column:
    """The cell of a place and the eight next to it."""
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return F.array(*(F.struct((F.floor(F.col(x) / side) + i).alias("cx"), (F.floor(F.col(y) / side) + j).alias("cy")) for i, j in steps))


def placed_bases(bases: DataFrame, players: DataFrame) -> DataFrame:
    return players.select(*PLAYER, "team").join(bases.select(*PLAYER, "base_x", "base_y"), PLAYER)


def nearest_enemy(bases: DataFrame, players: DataFrame, rings: Sequence[float] = RINGS) -> DataFrame:
    """Distance to the nearest base of another team; players without a base, or without an enemy that has one, have no row.

    Grids of growing cells: a base meets another team first on the ring whose cells, its own and the eight next to it,
    hold one. That enemy is less than three sides away, hence so is the nearest, which the cells of the next grid around
    the base therefore hold if they are three times as wide or more. Only bases in those cells are measured.
    """
    if any(b < 3 * a for a, b in zip(rings, rings[1:], strict=False)):
        raise ValueError("cells of each ring must be three times as wide as those before, or wider")
    own = placed_bases(bases, players)
    whole = F.struct(F.lit(0).cast("long").alias("cx"), F.lit(0).cast("long").alias("cy"))
    grids = [_cell("base_x", "base_y", side) for side in rings]
    def tag(ring: int, cell: Column) -> Column:
        return F.struct(F.lit(ring).alias("ring"), cell["cx"].alias("cx"), cell["cy"].alias("cy"))

    every = own.select(*PLAYER, "team", "base_x", "base_y", F.inline(F.array(*(tag(i, c) for i, c in enumerate([*grids, whole])))))
    held = every.groupBy("match_id", "ring", "cx", "cy").agg(F.min("team").alias("low"), F.max("team").alias("high"))
    seen = [F.transform(_around("base_x", "base_y", side), partial(tag, i)) for i, side in enumerate(rings)]
    asked = own.select(*PLAYER, "team", "base_x", "base_y", F.inline(F.concat(*seen, F.array(tag(len(rings), whole)))))
    meets = asked.join(held, ["match_id", "ring", "cx", "cy"]).filter("low <> team or high <> team")
    first = meets.groupBy(*PLAYER, "team", "base_x", "base_y").agg(F.least(F.min("ring") + 1, F.lit(len(rings))).alias("ring"))
    cells = F.when(F.col("ring") == len(rings), F.array(whole))
    for i, side in enumerate(rings[1:], 1):
        cells = cells.when(F.col("ring") == i, _around("base_x", "base_y", side))
    enemies = every.select("match_id", "ring", "cx", "cy", F.col("team").alias("enemy_team"), F.col("base_x").alias("enemy_x"), F.col("base_y").alias("enemy_y"))
    met = first.select(*PLAYER, "team", "base_x", "base_y", "ring", F.inline(cells)).join(enemies, ["match_id", "ring", "cx", "cy"]).filter("team <> enemy_team")
    return met.groupBy(*PLAYER).agg(F.round(F.min(F.hypot(F.col("base_x") - F.col("enemy_x"), F.col("base_y") - F.col("enemy_y"))), 6).alias("distance"))


def find_enemy(events: DataFrame, bases: DataFrame, players: DataFrame, within: float = 15.0) -> DataFrame:
    """When a player with a base first moved to less than `within` tiles from a base of another team.

    Bases stand in the cells, `within` wide, from which they can be near; a move is joined with those of its cell only.
    """
    own = placed_bases(bases, players)
    reach = own.select("match_id", F.col("team").alias("enemy_team"), F.col("base_x").alias("enemy_x"), F.col("base_y").alias("enemy_y"), F.inline(_around("base_x", "base_y", within)))
    moves = events.filter("kind in ('move', 'interact') and x is not null and y is not null").select(*PLAYER, "t_ms", "x", "y", _cell("x", "y", within).alias("c")).select(*PLAYER, "t_ms", "x", "y", "c.*")
    near = moves.join(own.select(*PLAYER, "team"), PLAYER).join(reach, ["match_id", "cx", "cy"])
    near = near.filter((F.col("team") != F.col("enemy_team")) & (F.hypot(F.col("x") - F.col("enemy_x"), F.col("y") - F.col("enemy_y")) < within))
    return near.groupBy(*PLAYER).agg(F.min("t_ms").alias("t_ms"))


def priced(events: DataFrame, costs: DataFrame) -> DataFrame:
    """events with `spent`: the cost (costs: kind, target_id, cost) of each, for a train times the units it queues."""
    times = F.when(F.col("kind") == "train", expanded()).otherwise(1)
    return events.join(costs.select("kind", "target_id", "cost"), ["kind", "target_id"], "left").withColumn("spent", F.coalesce("cost", F.lit(0.0)).cast("double") * times)


def flow_entry(unit: int = VILLAGER, step_ms: int = 30_000) -> Column:
    """What a priced event adds to its player's flow, from the first step at or after it; null if nothing."""
    queued = F.when(is_kind("train", [unit]), expanded()).otherwise(0)
    entry = F.struct(F.ceil(F.col("t_ms") / step_ms).cast("int").alias("step"), F.lit(0).alias("tick"), queued.cast("long").alias("queued"), F.col("spent").alias("spent"))
    return F.when((queued > 0) | (F.col("spent") > 0), entry)


def float_fold(flow: str = "flow", duration: str = "duration_ms", step_ms: int = 30_000, per_second: float = 0.30, least: float = 150.0) -> Column:
    """The windows (rate, start_ms, end_ms, banked) of one player as an array, by one pass over their flow and the steps.

    flow: a column of flow_entry arrays; null: empty. Each step of the match is an entry too (tick), behind the events that
    count from it. units: queued so far; working: those of the step before; start, low: where a window opened.
    """
    steps, gain = f"cast(greatest(floor({duration} / {step_ms}), 0) as int)", f"{per_second * step_ms / 1000!r}D"
    surplus = f"greatest(a.income + a.working * {gain} - a.spent, 0D)"
    same = "'income', a.income, 'spent', a.spent, 'surplus', a.surplus, 'start', a.start, 'low', a.low, 'closed', a.closed"
    window = "named_struct('start', a.start, 'low', a.low, 'end', cast({} as bigint), 'high', {})"
    ticked = f"""element_at(transform(array({surplus}), s -> named_struct('units', a.units, 'working', a.units, 'income', a.income + a.working * {gain}, 'spent', a.spent, 'surplus', s,
        'start', case when s - a.surplus >= {least * step_ms / MINUTE!r}D then coalesce(a.start, x.step - 1) end, 'low', if(a.start is null, a.surplus, a.low),
        'closed', if(a.start is null or s - a.surplus >= {least * step_ms / MINUTE!r}D, a.closed, concat(a.closed, array({window.format(f"x.step * {step_ms}L", "s")}))))), 1)"""
    shown = f"named_struct('rate', round(greatest(w.high - w.low, 0D) / greatest((w.end - w.start * {step_ms}L) / {float(MINUTE)}D, {step_ms / MINUTE!r}D), 6), 'start_ms', w.start * {step_ms}L, 'end_ms', w.end, 'banked', round(greatest(w.high - w.low, 0D), 6))"
    return F.expr(f"""transform(aggregate(
        array_sort(concat(filter(coalesce({flow}, array()), x -> x.step <= {steps}), transform(sequence(0, {steps}), k -> named_struct('step', k, 'tick', 1, 'queued', 0L, 'spent', 0D)))),
        named_struct('units', 0L, 'working', 0L, 'income', 0D, 'spent', 0D, 'surplus', 0D, 'start', cast(null as int), 'low', 0D, 'closed', cast(array() as array<struct<start: int, low: double, end: bigint, high: double>>)),
        (a, x) -> case when x.tick = 0 then named_struct('units', a.units + x.queued, 'working', a.working, {same.replace("'spent', a.spent", "'spent', a.spent + x.spent")})
                       when x.step = 0 then named_struct('units', a.units, 'working', a.units, {same}) else {ticked} end,
        a -> if(a.start is null, a.closed, concat(a.closed, array({window.format(duration, "a.surplus")})))), w -> {shown})""")


def float_windows(events: DataFrame, costs: DataFrame, players: DataFrame, unit: int = VILLAGER, step_ms: int = 30_000, per_second: float = 0.30, least: float = 150.0) -> DataFrame:
    """Windows in which resources pile up: start_ms, end_ms, banked, rate a minute.

    On a grid of steps up to the match's length, the surplus is what workers gathered (those queued by each earlier
    step, the first at 0) less what was spent (costs: kind, target_id, cost; a train costs that for each unit queued), 0
    at least. A window is a run of steps in which it grew by `least` a minute or more; it ends at the next slower step, or
    with the match. One shuffle of the events; a player's flow, thousands of entries at most, is folded in one row.
    """
    rows = priced(events, costs).join(players.select(*PLAYER, "duration_ms"), PLAYER)
    flows = rows.groupBy(*PLAYER, "duration_ms").agg(F.collect_list(flow_entry(unit, step_ms)).alias("flow"))
    return flows.select(*PLAYER, F.inline(float_fold("flow", "duration_ms", step_ms, per_second, least))).select(*PLAYER, "start_ms", "end_ms", "banked", "rate")


def float_peak(windows: DataFrame) -> DataFrame:
    """The window with the highest rate, of equal ones the last."""
    best = F.max(F.struct("rate", "start_ms", "end_ms", "banked")).alias("w")
    return windows.groupBy(*PLAYER).agg(best).select(*PLAYER, "w.rate", "w.start_ms", "w.end_ms", "w.banked")


def game_mode(players: DataFrame) -> DataFrame:
    return players.groupBy("match_id").agg(F.when(F.count(F.lit(1)) > 2, "team").otherwise("1v1").alias("mode"))


def resolve_focus(players: DataFrame, selector: str | int | None = None) -> DataFrame:
    """The players that a selector means: a name in any ASCII case (text), a profile id (number), or the recorder (None).

    For the recorder players have player_number and recorder, the number of who recorded the match. A selector that means
    nobody in the whole table is an error.
    """
    if selector is None:
        return players.filter("player_number = recorder")
    found = players.filter(F.col("profile_id") == selector if isinstance(selector, int) else F.lower("name") == selector.lower())
    n = found.agg(F.count(F.lit(1)).alias("n"))
    checked = n.select(F.assert_true(F.col("n") > 0, f"no player matches {selector}").alias("ok"))
    return found.join(F.broadcast(checked)).filter("ok is null").drop("ok")


def player_metrics(events: DataFrame, players: DataFrame, costs: DataFrame, ages: Mapping[str, int] = AGES, per_second: float = 0.30, busy_ms: Mapping[int, int] = CENTRE_MS, centres: Sequence[int] = CENTRES, lines=LINES, militia: Sequence[int] = MILITIA, eco_buildings: Sequence[int] = ECO_BUILDINGS, military_buildings: Sequence[int] = MILITARY_BUILDINGS) -> DataFrame:
    """One wide row per player: age clicks, first events, opening, queues, idle time, places, floats and rates.

    players have team, civ_id, duration_ms and family. All that needs no other player is gathered in one grouping of the
    events, a player's own lists (thousands of entries at most) included, so that what depends on the age clicks needs no
    second pass. On nomad maps idle time begins with the first town centre. Villagers are those queued by the Castle
    click, or by the end of the match. A player without events has zeros, and nulls for what did not happen.
    """
    train, research = F.col("kind") == "train", F.col("kind") == "research"
    eco = is_kind("train", ECO_UNITS) | is_kind("build", eco_buildings) | is_kind("research", (*ages.values(), *WATCHED))
    army = (train & ~F.col("target_id").isin(*ECO_UNITS)) | is_kind("build", military_buildings)
    units = {VILLAGER, *militia, *(u for _, _, ids in lines for u in ids)}
    early = (F.col("kind") == "build") & (F.col("t_ms") <= 6 * MINUTE) & F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan(F.col("x").cast("double")) & ~F.isnan(F.col("y").cast("double"))
    what = F.when(is_kind("train", sorted(units)), "train").when(is_kind("research", sorted(busy_ms)), "busy").when(early, "built")
    told = F.when(what.isNotNull() | (F.col("spent") > 0), F.struct("t_ms", what.alias("what"), F.col("target_id").cast("int").alias("id"), expanded().alias("n"), "x", "y", flow_entry().alias("flow")))
    gathered = priced(events, costs).groupBy(*PLAYER).agg(
        *(first_at(is_kind("research", [i])).alias(f"{age}_ms") for age, i in ages.items()),
        first_at(train & ~F.col("target_id").isin(*ECO_UNITS)).alias("first_military_ms"),
        first_at(is_kind("build", centres)).alias("first_centre_ms"),
        F.count_if(F.col("kind") == "market_buy").alias("market_buys"),
        F.count_if(F.col("kind") == "market_sell").alias("market_sells"),
        *(first_at(is_kind("research", [t])).alias(f"tech_{t}_ms") for t in WATCHED),
        F.count(F.lit(1)).alias("_commands"), F.count_if(eco).alias("_eco"), F.count_if(army).alias("_army"),
        F.collect_list(told).alias("_events"),
    )
    out = players.join(gathered, PLAYER, "left")
    ids = lambda these: f"({', '.join(map(str, these))})"
    lists = {"_workers": f"x.what = 'train' and x.id = {VILLAGER}", "_busy": "x.what = 'busy'", "_opened": "x.what = 'train'", "_militia": f"x.what = 'train' and x.id in {ids(militia)}", "_built": "x.what = 'built'"}
    out = out.withColumns({name: F.expr(f"filter(_events, x -> {cond})") for name, cond in lists.items()} | {"_flow": F.expr("array_compact(transform(_events, x -> x.flow))")} | {c: F.coalesce(c, F.lit(0)) for c in ("market_buys", "market_sells", "_commands", "_eco", "_army")})

    def total(items: str, cond: str, what: str) -> str:
        return f"coalesce(aggregate(filter({items}, x -> {cond}), 0L, (a, x) -> a + {what}), 0L)"

    def idle(age: str) -> str:
        lasts = " ".join(f"when {i} then {ms}L" for i, ms in busy_ms.items())
        since = "if(family = 'nomad', coalesce(first_centre_ms, 0), 0)"
        busy = total("_busy", f"x.t_ms < {age}_ms", f"least(case x.id {lasts} end, {age}_ms - x.t_ms)")
        return f"cast(greatest(greatest(greatest({age}_ms - {since}, 0) - {total('_workers', f'x.t_ms <= {age}_ms', 'x.n')} * {VILLAGER_MS}, 0) - {busy}, 0) as bigint)"

    until = f"coalesce(castle_ms, feudal_ms + {12 * MINUTE})"
    nth = " ".join(f"when x.id in {ids(units)} then {i}" for i, (_, _, units) in enumerate(lines))
    inside = f"filter(_opened, x -> x.t_ms >= feudal_ms and x.t_ms < {until} and case {nth} end is not null)"
    # by time, equal ones in the order of the lines; the first train of each line stands for it
    firsts = f"array_distinct(transform(array_sort(transform({inside}, x -> named_struct('t', x.t_ms, 'nth', case {nth} end))), x -> x.nth))"
    tags = ", ".join(f"'{tag}'" for tag, _, _ in lines)
    mid = "cast(get(array_sort(transform(_built, x -> x.{0})), cast(floor(size(_built) / 2) as int)) as double)"
    rate = f"round(_{{}} / greatest(duration_ms / {float(MINUTE)}D, 1D / 60), 6)"
    out = out.withColumns({
        "vils_castle": F.expr(total("_workers", "x.t_ms <= coalesce(castle_ms, duration_ms)", "x.n")),
        "_firsts": F.expr(firsts),
        "_drush": F.expr(f"{total('_militia', 'x.t_ms < feudal_ms', 'x.n')} >= 3"),
        "base_x": F.expr(mid.format("x")), "base_y": F.expr(mid.format("y")),
        "apm": F.expr(rate.format("commands")), "eco_apm": F.expr(rate.format("eco")), "army_apm": F.expr(rate.format("army")),
        "idle_dark_ms": F.expr(f"coalesce({idle('feudal')}, 0L)"), "_idle_castle_ms": F.expr(f"coalesce({idle('castle')}, 0L)"),
        "_peak": F.array_max(float_fold("_flow", per_second=per_second)),
    })
    body = f"case when feudal_ms is null then null when size(_firsts) > 0 then array_join(transform(slice(_firsts, 1, 2), i -> get(array({tags}), i)), ' into ') when castle_ms is not null then 'Fast Castle' end"
    out = out.withColumns({
        "opening": F.expr(f"if(_drush, concat('Drush + ', {body}), {body})"),
        "idle_feudal_ms": F.expr("if(feudal_ms is null or castle_ms is null, 0L, greatest(_idle_castle_ms - idle_dark_ms, 0L))"),
        "float_rate": F.expr("coalesce(_peak.rate, 0D)"), "float_banked": F.expr("coalesce(_peak.banked, 0D)"), "float_start_ms": F.col("_peak.start_ms"), "float_end_ms": F.col("_peak.end_ms"),
    })
    out = saved(out.drop("_events", "_flow", "_peak", "_firsts", "_drush", "_idle_castle_ms", "_commands", "_eco", "_army", *lists), "measured")  # written once: places are looked up in it
    bases = out.select(*PLAYER, "base_x", "base_y").filter("base_x is not null")
    for part in (nearest_enemy(bases, players).withColumnRenamed("distance", "nearest_enemy"), find_enemy(events, bases, players).withColumnRenamed("t_ms", "find_enemy_ms")):
        out = out.join(part, PLAYER, "left")
    return out
