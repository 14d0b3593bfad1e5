"""Data-quality checks. Each gives violation rows (check, key, detail); summarize() counts them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

TIERS = ("S", "A", "B", "C", "D")


def violation(rows: DataFrame, check: str | Column, key: Column, detail: Column) -> DataFrame:
    return rows.select((F.lit(check) if isinstance(check, str) else check).alias("check"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def summarize(violations: DataFrame, checked: DataFrame) -> DataFrame:
    """check, violations, checked, passed; checked: check, checked."""
    n = violations.groupBy("check").agg(F.count(F.lit(1)).alias("violations"))
    out = checked.join(n, "check", "left").withColumn("violations", F.coalesce("violations", F.lit(0)))
    return out.select("check", "violations", "checked", (F.col("violations") == 0).alias("passed"))


def not_null(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """One row for each null, all columns in one pass."""
    hits = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in columns)))
    return violation(df.withColumn("_hit", F.explode(hits)), "not_null", F.col(key), F.col("_hit"))


def unique(df: DataFrame, key: str) -> DataFrame:
    return violation(df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "unique", F.col(key), F.col("n"))


def vocabulary(df: DataFrame, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside a column's closed vocabulary, once each with their number of rows."""
    pairs = F.array_compact(F.array(*(F.when(~F.col(c).isin(*vs), F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))) for c, vs in rules.items())))
    rows = df.select(F.explode(pairs).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    return violation(rows, "vocabulary", F.concat_ws("=", "x.c", "x.v"), F.col("n"))


def coverage(df: DataFrame, column: str, least: float, never_null: str) -> DataFrame:
    """Share of rows with a value, with a floor; and a column that must have one everywhere."""
    out = df.agg(F.count(F.lit(1)).alias("n"), F.count(column).alias("have"), F.count_if(F.col(never_null).isNull()).alias("nulls"))
    return out.select("n", "have", "nulls", F.round(F.col("have") / F.col("n"), 6).alias("share"), ((F.col("have") >= F.col("n") * least) & (F.col("nulls") == 0)).alias("passed"))


def rates(df: DataFrame, rate: str, tier: str, key: Column) -> DataFrame:
    """Rates outside 0 to 100 or not finite, tiers outside the set, and rates that are all fractions; nulls pass."""
    r = F.col(rate)
    bad = F.isnan(r) | (r < 0) | (r > 100)
    rows = violation(df.filter(bad), "rate_range", key, r).unionByName(violation(df.filter(~F.col(tier).isin(*TIERS)), "tier", key, F.col(tier)))
    scale = df.agg(F.max(rate).alias("m")).filter("m <= 1")
    return rows.unionByName(violation(scale, "rate_scale", F.lit("all"), F.col("m")))


def cube(rows: DataFrame, dims: Mapping[str, DataFrame], key: Column) -> DataFrame:
    """Indices that their dimension lacks, and counts that cannot be; an empty dimension fails as such."""
    out = violation(rows.filter("wins < 0 or wins > games or games < 0"), "cube_counts", key, F.concat_ws("/", "wins", "games"))
    for name, dim in dims.items():
        out = out.unionByName(violation(rows.join(dim.select(name).distinct(), name, "left_anti"), f"cube_{name}", key, F.col(name)))
        out = out.unionByName(violation(dim.agg(F.count(F.lit(1)).alias("n")).filter("n = 0"), "cube_empty", F.lit(name), F.col("n")))
    return out


def text_rules(df: DataFrame, key: str, slug: str, region: str, label: str, bonuses: str, regions: Sequence[str], typos: Sequence[str], texts: Sequence[str] = ()) -> DataFrame:
    """Slugs of small letters, digits and hyphens; known regions; labels whose words begin with capitals, but for "and"
    between them; none of the typos, as words in any case, in the label, the bonuses or other texts; a bonus at least."""
    words = F.flatten(F.transform(F.split(label, r"(?i)\s+and\s+"), lambda part: F.split(part, r"\s+")))
    typo = rf"(?i)\b({'|'.join(typos)})\b"
    checks = {
        "slug": ~F.col(slug).rlike("^[a-z0-9-]+$"),
        "region": ~F.col(region).isin(*regions),
        "title": ~F.forall(words, lambda w: w.rlike("^[A-Z]")),
        "typo": F.concat_ws("\n", label, bonuses, *texts).rlike(typo),
        "bonus": F.size(bonuses) < 1,
    }
    hits = F.array_compact(F.array(*(F.when(cond, F.lit(name)) for name, cond in checks.items())))
    return violation(df.withColumn("_hit", F.explode(hits)), F.col("_hit"), F.col(key), F.col(label))


def sequence(steps: DataFrame, builds: DataFrame, slack_s: int = 90, facts: DataFrame | None = None) -> DataFrame:
    """Ordered steps of builds: the counter never falls, times rise, a text "+N →" says by how much the counter grew, the
    last time is within the length, the phase never goes back, and no unit is of a later phase than the target.

    steps: build_id, nth, counter, at_s, phase, text (each may be null), and unit where there are facts (unit, phase);
    builds: build_id, duration_s, target_phase. A counter is compared with the last one stated, however long ago; what a
    text says counts only if it leads the text, stands alone there and the step before states a counter. Of times and of
    phases the first fault of a build is reported.
    """
    own = W.partitionBy("build_id").orderBy("nth")
    before = own.rowsBetween(W.unboundedPreceding, -1)
    clause = r"\+\d+\s*(?:→|->)"
    said = F.regexp_extract(F.coalesce("text", F.lit("")), r"^\s*\+(\d+)\s*(?:→|->)", 1).try_cast("int")
    alone = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(clause), F.lit(0))) == 1
    last = lambda c: F.last(c, ignorenulls=True).over(before)
    rows = steps.select("*", last("counter").alias("c0"), F.lag(F.col("counter").isNotNull(), 1, False).over(own).alias("stated"), last("at_s").alias("t0"), F.coalesce(F.max("phase").over(before), F.lit(0)).alias("p0"))
    first = lambda cond: F.min(F.when(cond, F.col("nth"))).over(W.partitionBy("build_id")) == F.col("nth")
    late_time, back = F.col("at_s") <= F.col("t0"), F.col("phase") < F.col("p0")
    rows = rows.withColumns({"_time": late_time & first(late_time), "_phase": back & first(back)})
    checks = {"counter": F.col("counter") < F.col("c0"), "delta": alone & F.col("stated") & (said != F.col("counter") - F.col("c0")), "time": F.col("_time"), "phase": F.col("_phase")}
    hits = F.array_compact(F.array(*(F.when(cond, F.lit(name)) for name, cond in checks.items())))
    inner = violation(rows.withColumn("_hit", F.explode(hits)), F.col("_hit"), F.concat_ws("/", "build_id", "nth"), F.col("counter"))
    ends = steps.groupBy("build_id").agg(F.max_by("at_s", F.when(F.col("at_s").isNotNull(), F.col("nth"))).alias("last_s"), F.max("phase").alias("top")).join(builds, "build_id")
    late = violation(ends.filter(F.col("last_s") > F.col("duration_s") + slack_s), "length", F.col("build_id"), F.col("last_s"))
    out = inner.unionByName(late).unionByName(violation(ends.filter("top > target_phase"), "target", F.col("build_id"), F.col("top")))
    if facts is None:
        return out
    units = steps.select("build_id", "unit").distinct().join(facts.select("unit", F.col("phase").alias("unit_phase")), "unit").join(builds, "build_id")
    return out.unionByName(violation(units.filter("unit_phase > target_phase"), "unit", F.concat_ws("/", "build_id", "unit"), F.col("unit_phase")))


def pairs(base: DataFrame, twin: DataFrame, key: str, body: str, fields: Sequence[str], allowed: Sequence[str] = ()) -> DataFrame:
    """Translations: a missing twin, a body equal but for white space, equal fields outside the allowed values."""
    flat = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    missing = violation(base.join(twin, key, "left_anti"), "missing", F.col(key), F.lit(""))
    both = base.join(twin.select(F.col(key), *(F.col(c).alias(f"_{c}") for c in (body, *fields))), key)
    same = violation(both.filter(flat(F.col(body)) == flat(F.col(f"_{body}"))), "same_body", F.col(key), F.lit(""))
    hits = F.array_compact(F.array(*(F.when((F.col(c) == F.col(f"_{c}")) & ~F.col(c).isin(*allowed) if allowed else F.col(c) == F.col(f"_{c}"), F.lit(c)) for c in fields)))
    return missing.unionByName(same).unionByName(violation(both.withColumn("_hit", F.explode(hits)), "same_field", F.col(key), F.col("_hit")))


def foreign_keys(child: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    # counted first: the ids, not the rows, meet the dimension
    orphans = child.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(dim.select(key), key, "left_anti")
    return violation(orphans, f"fk_{key}", F.col(key), F.col("n"))


def id_spaces(one: DataFrame, other: DataFrame, mirror: DataFrame) -> DataFrame:
    """Two id spaces of the same names must differ somewhere, and the first must equal its mirror. Tables: id, slug."""
    equal = one.join(other.withColumnRenamed("id", "other_id"), "slug").agg(F.count_if(F.col("id") != F.col("other_id")).alias("n")).filter("n = 0")
    both = one.join(mirror.withColumnRenamed("slug", "mirror"), "id", "full").filter(~F.col("slug").eqNullSafe(F.col("mirror")))
    return violation(equal, "same_space", F.lit("all"), F.col("n")).unionByName(violation(both, "mirror", F.col("id"), F.concat_ws("/", "slug", "mirror")))
