"""URL filters: a temporal join of captures with dated list entries.

Entries of a list become validity intervals: an entry holds until the next one for the same pattern. A pattern is a
host, a domain above it, or a host with the first parts of a path. An as-of join finds, for each capture, the entries
active when it was fetched. Intervals are cut at the borders of slots of time. Only the last entry of each slot is
carried forward, to the slots in which captures ask for the pattern; so what meets in one place is a pattern's slots,
whose number is bounded by the calendar, or the entries and captures of one slot, but never a pattern's whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laddermill.llm.common import table

DAY, SLOT = 86_400, 3_600


def intervals(entries: DataFrame, asked: DataFrame, slot: int = SLOT) -> DataFrame:
    """pattern, slot, action, since, start, stop: what holds in a slot from start until stop (null: to its end).

    entries: pattern, at (seconds), action; asked: the (pattern, slot) that are wanted. Of entries with one pattern and
    second the last action in the alphabet holds. Entries with nulls are ignored; repeated entries change nothing.
    """
    one = entries.filter("pattern is not null and at is not null and action is not null").groupBy("pattern", "at").agg(F.max("action").alias("action"))
    one = one.select("pattern", F.floor(F.col("at") / slot).alias("slot"), F.struct(F.col("at").alias("since"), "action").alias("entry"))
    last = one.groupBy("pattern", "slot").agg(F.max("entry").alias("entry"))
    marks = last.withColumn("wanted", F.lit(False)).unionByName(asked.select("pattern", "slot", F.lit(True).alias("wanted")), allowMissingColumns=True)
    before = W.partitionBy("pattern").orderBy("slot", F.desc("wanted")).rowsBetween(W.unboundedPreceding, -1)
    carried = marks.withColumn("entry", F.when(F.col("wanted"), F.last("entry", ignorenulls=True).over(before))).filter("entry is not null")
    held = carried.select("pattern", "slot", "entry", (F.col("slot") * slot).alias("start")).union(one.select("pattern", "slot", "entry", F.col("entry.since")))
    stop = F.lead("start").over(W.partitionBy("pattern", "slot").orderBy("start", "entry"))
    return held.select("pattern", "slot", "entry.action", "entry.since", "start", stop.alias("stop"))


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(url), "^[a-z]+://([^/:?#]+)", 1)


def patterns_of(url: Column) -> Column:
    """The host and all domains above it of at least two labels, and the host with 1 and 2 parts of the path."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    one, two = (F.regexp_extract(url, f"^[A-Za-z]+://[^/?#]+((?:/[^/?#]+){{{n}}})", 1) for n in (1, 2))
    paths = F.filter(F.array(*(F.when(p != "", F.concat(host, p)) for p in (one, two))), lambda x: x.isNotNull())
    return F.when(host != "", F.array_distinct(F.concat(domains, paths)))


def filter_captures(captures: DataFrame, entries: DataFrame, slot: int = SLOT) -> DataFrame:
    """One row per row of captures (page_id, url, fetched: seconds): page_id, url, fetched, blocked, pattern, since.

    pattern and since are those of the active entry with the longest pattern (in a tie the last in the alphabet);
    blocked is whether its action is "block". Without an active entry, a url or a time they are null, false and null.
    Rows that repeat are one capture. Other columns are ignored.
    """
    keyed = captures.select("page_id", "url", "fetched").distinct()
    names = keyed.filter("fetched is not null").select("page_id", "url", "fetched", F.explode(patterns_of(F.col("url"))).alias("pattern"), F.floor(F.col("fetched") / slot).alias("slot"))
    held = intervals(entries, names.select("pattern", "slot").distinct(), slot)
    hits = names.join(held, ["pattern", "slot"]).filter("start <= fetched and (stop is null or fetched < stop)")
    best = hits.groupBy("page_id", "url", "fetched").agg(F.max(F.struct(F.length("pattern").alias("n"), "pattern", "action", "since")).alias("b"))
    found = best.select(F.col("page_id").alias("p"), F.col("url").alias("u"), F.col("fetched").alias("f"), "b.pattern", "b.action", "b.since")
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("url") == F.col("u")) & (F.col("fetched") == F.col("f"))
    return keyed.join(found, same, "left").select("page_id", "url", "fetched", F.coalesce(F.col("action") == "block", F.lit(False)).alias("blocked"), "pattern", "since")


def captures_of(pages: DataFrame, start: int) -> DataFrame:
    """The pages as captures: page p was fetched 37 * p seconds, modulo 30 days, after the start."""
    return pages.select("page_id", "url", (F.lit(start) + F.pmod(F.col("page_id") * 37, F.lit(30 * DAY))).alias("fetched"))


def entries_of(events: DataFrame, pages: DataFrame) -> DataFrame:
    """The events as list entries about the hosts of the pages: a user's events concern the host, or its domain, of the
    page with the user's number; errors block it, purchases and signups allow it again."""
    host = host_of(F.col("url"))
    hosts = pages.select(F.col("page_id").alias("user_id"), host.alias("host"))
    action = F.when(F.col("event_type") == "error", "block").when(F.col("event_type").isin("purchase", "signup"), "allow")
    # in parts, so that the session's time zone plays no part
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date"))
    seconds = day * F.lit(DAY).cast("long") + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.expr("extract(second from ts)")).cast("long")
    dated = events.select("user_id", seconds.alias("at"), action.alias("action"), (F.col("event_id") % 3).alias("kind")).filter("action is not null")
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    return dated.join(hosts, "user_id").select(F.when((F.col("kind") == 0) & (domain != ""), domain).otherwise(F.col("host")).alias("pattern"), "at", "action")


START = 1_704_067_200  # 2024-01-01, when the events begin


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_captures(captures_of(pages, START), entries_of(table(spark, sf_dir, "events"), pages))


OP6_SQL = r"""
with h as (select page_id, url, regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1) as host,
                  1704067200 + page_id * 37 % 2592000 as fetched,
                  regexp_extract(url, '^[A-Za-z]+://[^/?#]+((?:/[^/?#]+){1})', 1) as one, regexp_extract(url, '^[A-Za-z]+://[^/?#]+((?:/[^/?#]+){2})', 1) as two from pages),
e as (select case when event_id % 3 = 0 and regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) <> '' then regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) else host end as pattern,
             cast(floor(epoch(ts)) as bigint) as at_s, case when event_type = 'error' then 'block' else 'allow' end as action
      from events join h on user_id = page_id where event_type in ('error', 'purchase', 'signup')),
o as (select pattern, at_s, max(action) as action from e group by 1, 2),
i as (select pattern, action, at_s as since, lead(at_s) over (partition by pattern order by at_s) as until_s from o),
k as (select distinct page_id, url, fetched, unnest(list_concat(
        list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1), lambda x: array_to_string(string_split(host, '.')[x:], '.')),
        case when one <> '' then [host || one] else [] end, case when two <> '' then [host || two] else [] end)) as pattern from h where host <> ''),
b as (select k.page_id, k.url, k.fetched, i.pattern, i.action, i.since, row_number() over (partition by k.page_id, k.url order by length(i.pattern) desc, i.pattern desc) as rn
      from k join i on k.pattern = i.pattern and i.since <= k.fetched and (i.until_s is null or k.fetched < i.until_s))
select h.page_id, h.url, cast(h.fetched as bigint) as fetched, coalesce(b.action = 'block', false) as blocked, b.pattern, b.since from h left join b on b.page_id = h.page_id and b.rn = 1
"""

QUERIES = {"op6_url_filter": op6_url_filter}
ORACLE = {"op6_url_filter": OP6_SQL}
