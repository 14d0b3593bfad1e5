"""Column functions: slugs, bands, labels, rates and formats. All are built-in expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rating bands by their lower edge.
BANDS = {"<1000": None, "1000-1199": 1000, "1200-1399": 1200, "1400-1649": 1400, "1650-1799": 1650, "1800-1999": 1800, "2000-2199": 2000, "2200-2499": 2200, "2500+": 2500}
#: Tiers by their least percentage.
TIERS = (("S", 53), ("A", 51), ("B", 49), ("C", 47))
#: Opening labels that stand for themselves; any other becomes null.
OPENINGS = ("scouts", "archers", "man_at_arms", "fast_castle", "drush", "trash", "fires", "galleys", "towers")
#: Leaderboards of each ladder.
LADDERS = {"1v1": ("random_map", "co_random_map"), "team": ("team_random_map", "co_team_random_map")}


def slug(c: Column) -> Column:
    """ASCII letters and digits, lower case; others go first, since lower() can turn them into ASCII."""
    return F.lower(F.regexp_replace(c, "[^A-Za-z0-9]", ""))


def alias(c: Column, names: Mapping[str, str]) -> Column:
    """The name that stands for c, if there is one, else c."""
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), c), c)


def to_ladder(leaderboard: Column, n_players: Column) -> Column:
    """The ladder of a leaderboard; without one, by the number of players. An unknown leaderboard fails."""
    known = [F.when(leaderboard.isin(*names), ladder) for ladder, names in LADDERS.items()]
    by_size = F.when(leaderboard.isNull(), F.when(n_players == 2, "1v1").otherwise("team"))
    return F.coalesce(*known, by_size, F.raise_error(F.concat(F.lit("unknown leaderboard: "), leaderboard)).cast("string"))


def guard_int(c: Column) -> Column:
    """c as an int, null where it does not fit."""
    return c.try_cast("int")


def elo_bucket(elo: Column) -> Column:
    out = F.when(elo < 1000, "<1000")
    names = list(BANDS)
    for name, above in zip(names[1:], names[2:], strict=False):
        out = out.when(elo < BANDS[above], name)
    return out.when(elo.isNotNull(), names[-1])


def band_edge(band: Column) -> Column:
    """The number that a band starts with, null for the lowest."""
    return F.regexp_extract(band, r"^(\d+)", 1).try_cast("int")


def opening_kind(label: Column) -> Column:
    return F.when(label.isin(*OPENINGS), label)


def rate(wins: Column, games: Column) -> Column:
    """100 * wins / games, two decimals, half up, in integers so that engines agree; null for no games."""
    return F.when(games > 0, F.floor((wins * 20000 + games) / (games * 2)) / 100.0)


def wilson(wins: Column, games: Column, z: float = 1.96) -> Column:
    """The 95 % interval (lo, hi) of a share, (0, 0) without games."""
    p, n = wins / games, games.cast("double")
    centre, half = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    bound = lambda x: F.when(games > 0, x / (1 + z * z / n)).otherwise(0.0)
    return F.struct(bound(centre - half).alias("lo"), bound(centre + half).alias("hi"))


def pct(x: Column) -> Column:
    """A share as a percentage with two decimals, half away from zero."""
    return F.round(x * 10000) / 100


def round1(x: Column) -> Column:
    return F.round(x * 10) / 10


def round_ms(x: Column) -> Column:
    return F.round(x).cast("long")


def tier_of(percent: Column) -> Column:
    out = F.when(percent >= TIERS[0][1], TIERS[0][0])
    for name, least in TIERS[1:]:
        out = out.when(percent >= least, name)
    return out.when(percent.isNotNull(), "D")


def prettify(c: Column) -> Column:
    """A slug as a title."""
    return F.initcap(F.translate(c, "-_", "  "))


def mmss(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("int")
    rest = (whole % 60).cast("string")
    return F.concat(F.floor(whole / 60).cast("int").cast("string"), F.when((whole % 60).between(0, 9), F.concat(F.lit(":0"), rest)).otherwise(F.concat(F.lit(":"), rest)))


def kebab(c: Column, style: str = "words") -> Column:
    """words: signs other than white space, _ and - dropped, then trimmed, white space to single hyphens.
    runs: ' dropped, each run of other signs one hyphen, none at the ends."""
    low = F.lower(c)
    if style == "words":
        kept = F.regexp_replace(low, r"[^a-z0-9_\s-]", "")
        return F.regexp_replace(F.regexp_replace(kept, r"^\s+|\s+$", ""), r"\s+", "-")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(low, "'", ""), "[^a-z0-9]+", "-"), "^-|-$", "")
