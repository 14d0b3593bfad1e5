"""Deriving dimensions from observations and reference text, and searching content tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def mode_per_key(df: DataFrame, key: str, value: Column, weight: Column | None = None) -> DataFrame:
    """key, value, n: the most frequent value of each key, of equally frequent ones the smallest.

    A value can be anything that has an order, a struct of several columns too. weight: how often a row counts.
    """
    counted = df.groupBy(key, value.alias("value")).agg(F.sum(weight if weight is not None else F.lit(1)).cast("long").alias("n"))
    best = counted.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("less"), "value")).alias("b"))
    return best.select(key, "b.value", (-F.col("b.less")).alias("n"))


def consensus(df: DataFrame, key: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Keys whose rows agree, with their values, and keys with several, with how many."""
    per = df.groupBy(key).agg(F.count_distinct(F.struct(*columns)).alias("variants"), *(F.min(c).alias(c) for c in columns))
    return per.filter("variants = 1").drop("variants"), per.filter("variants > 1").select(key, "variants")


def first_wins(df: DataFrame, key: str, order: Sequence[str | Column], present: DataFrame | None = None, aliases: Mapping | None = None) -> DataFrame:
    """Of the rows of each key the first in order, of keys that are present. aliases: a key without a row, and the key
    whose row stands in for it."""
    rows = df.join(present.select(key).distinct(), key, "left_semi") if present is not None else df
    first = rows.withColumn("_nth", F.row_number().over(W.partitionBy(key).orderBy(*order))).filter("_nth = 1").drop("_nth")
    if not aliases:
        return first
    pairs = F.array(*(F.struct(F.lit(alias).alias("alias"), F.lit(source).alias("source")) for alias, source in aliases.items()))
    more = first.withColumn("_alias", F.explode(F.filter(pairs, lambda x: x["source"] == F.col(key)))).withColumn(key, F.col("_alias.alias")).drop("_alias")
    return first.unionByName(more.join(first.select(key), key, "left_anti").select(*first.columns))


def resolve_names(ids: DataFrame, names: DataFrame, key: str) -> DataFrame:
    return ids.join(names, key)


def bonus_string(df: DataFrame, labels: DataFrame, key: str, base: Sequence[int]) -> DataFrame:
    """'+N label' of positive amounts in other than base classes, in their order, joined by ';'. df: key, bonuses
    array<class, amount>; labels: class, label, small by nature. An unknown class is an error; keys without a bonus have null."""
    rows = df.select(key, F.posexplode_outer("bonuses").alias("nth", "b")).select(key, "nth", F.col("b.class").alias("class"), F.col("b.amount").alias("amount"))
    wanted = (F.col("amount") > 0) & ~F.col("class").isin(*base)
    named = rows.join(labels, "class", "left").withColumn("label", F.when(wanted, F.coalesce("label", F.raise_error(F.concat(F.lit("unknown class "), F.col("class"))).cast("string"))))
    item = F.when(wanted, F.struct("nth", F.format_string("+%d %s", "amount", "label").alias("s")))
    per = named.groupBy(key).agg(F.array_sort(F.array_compact(F.collect_list(item))).alias("l"))
    return per.select(key, F.when(F.size("l") > 0, F.array_join(F.transform("l", lambda x: x["s"]), ";")).alias("bonus"))


def sparse_map(columns: Sequence[str]) -> Column:
    """A map of the columns that are not 0."""
    return F.map_filter(F.create_map(*(x for c in columns for x in (F.lit(c), F.col(c)))), lambda k, v: v != 0)


def html_text(c: Column) -> Column:
    """Line breaks to spaces, tags stripped, white space collapsed."""
    text = F.regexp_replace(F.regexp_replace(c, r"(?i)<br\s*/?>", " "), r"<[^>]*>", "")
    return F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def span(c: Column, tag: str) -> Column:
    """The first element of a tag, as text; null if there is none."""
    found = F.regexp_extract(c, rf"(?s)<{tag}>(.*?)</{tag}>", 1)
    return F.when(found != "", html_text(found))


def sectioned_text(df: DataFrame, key: str, text: str, sections: Mapping[str, tuple[Sequence[str], str]], first: str, required: Mapping[str, int] | None = None) -> DataFrame:
    """Items of each section of a text: key, section, nth (line), part, name, effect.

    A line that begins with a section's prefix, in any case, opens it; the lines before the first belong to `first`.
    sections: prefixes and a rule for each. bullets: lines with a bullet are items. effects: the same, and a trailing
    parenthesis is the item's effect. list: commas part items, whose trailing parenthesis is left out. text: all lines are
    one item, joined by blanks. required: how many items a section must have in every text; another number is an error.
    """
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("nth", "line")).withColumn("line", F.trim("line")).filter("line <> ''")
    opens = F.coalesce(*(F.when(F.lower("line").startswith(p.lower()), F.lit(name)) for name, (prefixes, _) in sections.items() for p in prefixes), F.lit(None).cast("string"))
    own = W.partitionBy(key).orderBy("nth")
    placed = lines.withColumn("head", opens).withColumn("section", F.coalesce(F.last("head", ignorenulls=True).over(own), F.lit(first))).filter("head is null")
    rule = F.element_at(F.create_map(*(F.lit(x) for name, (_, r) in sections.items() for x in (name, r))), F.col("section"))
    rows = placed.withColumns({"rule": rule, "bullet": F.col("line").startswith("•"), "body": F.trim(F.regexp_replace("line", "^•", ""))})
    parts = F.when(F.col("rule") == "list", F.split("body", ",")).when(F.col("bullet") & F.col("rule").isin("bullets", "effects"), F.array("body"))
    items = rows.filter("rule <> 'text'").select(key, "section", "nth", "rule", F.posexplode(parts).alias("part", "item")).withColumn("item", F.trim("item"))
    tail = r"\s*\(([^()]*)\)$"
    effect, plain = F.regexp_extract("item", tail, 1), F.trim(F.regexp_replace("item", tail, ""))
    found = items.select(key, "section", "nth", "part", F.when(F.col("rule") == "bullets", F.col("item")).otherwise(plain).alias("name"), F.when((F.col("rule") == "effects") & (effect != ""), effect).alias("effect")).filter("name <> ''")
    joined = rows.filter("rule = 'text'").groupBy(key, "section").agg(F.array_sort(F.collect_list(F.struct("nth", "body"))).alias("l"))
    whole = joined.select(key, "section", F.get("l", F.lit(0))["nth"].alias("nth"), F.lit(0).alias("part"), F.array_join(F.transform("l", lambda x: x["body"]), " ").alias("name"), F.lit(None).cast("string").alias("effect"))
    found = found.unionByName(whole)
    if not required:
        return found
    counted = found.groupBy(key).agg(*(F.count_if(F.col("section") == s).alias(f"_n{i}") for i, s in enumerate(required)))
    rows = df.select(key).distinct().join(counted, key, "left")
    for i, (section, n) in enumerate(required.items()):
        have = F.coalesce(f"_n{i}", F.lit(0))
        rows = rows.withColumn(f"_n{i}", F.when(have != n, F.raise_error(F.concat_ws(" ", F.lit(section), F.lit("has"), have, F.lit("items in"), F.col(key))).cast("bigint")).otherwise(have))
    checked = rows.filter(" and ".join(f"_n{i} >= 0" for i in range(len(required)))).select(key)
    return checked.join(found, key)


def canonical_join(df: DataFrame, side: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """df with its required side row, in order; a missing side row is an error."""
    rows = df.join(side.withColumn("_there", F.lit(True)), key, "left")
    checked = F.when(F.col("_there"), F.col(key)).otherwise(F.raise_error(F.lit("a row without its side row")).cast(df.schema[key].dataType))
    return rows.withColumn(key, checked).drop("_there").orderBy(*order)


def facet_search(df: DataFrame, text: str, query: str, facets: Mapping[str, str]) -> DataFrame:
    """Rows whose text contains the query in any case and whose space-separated facet lists hold each wanted value."""
    rows = df.filter(F.contains(F.lower(text), F.lit(query.lower())))
    for column, value in facets.items():
        rows = rows.filter(F.array_contains(F.split(column, " "), value))
    return rows


def localize(df: DataFrame, locale: str, base: str, key: str, columns: Sequence[str]) -> DataFrame:
    """The base locale's rows, with the locale's own version where there is one; fallback says where not."""
    own = df.filter(F.col("locale") == locale).select(key, F.lit(True).alias("_own"), *(F.col(c).alias(f"_{c}") for c in columns))
    rows = df.filter(F.col("locale") == base).select(key, *columns).join(own, key, "left")
    return rows.select(key, *(F.when(F.col("_own"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in columns), F.col("_own").isNull().alias("fallback"))
