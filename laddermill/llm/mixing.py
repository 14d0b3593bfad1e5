"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source the keys are cut into ranges; the token counts of the
ranges are summed, the sums are accumulated over the ranges and within each range, so the prefix sum of a source is
spread over many tasks however large the source is. A source is cut at its exact budget, after whole epochs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laddermill.llm.common import WORD, materialize, small, table, words

WEIGHTS, CAP, SEED, ROWS_PER_RANGE = (1, 2, 3), 3, "mix", 8192


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source of `sizes` (source, size): source, source_size, n_docs, target.

    Sources in code-point order, null last, take the weights in turn and share the sum of all sizes. A target stops at
    `cap` times its source's size and what it leaves is shared again by weight: going through the sources by
    cap * size / weight, a source is capped exactly if its share of what the capped ones before it leave is above its
    cap. An empty table gives no rows; if all sizes are 0, all targets are 0.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    n = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())).alias("nth")
    ranked = by_source.select("*", n).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("nth") - 1) % len(weights) + 1).cast("int")).cast("long"))
    order = W.orderBy((F.col("most").cast("double") / F.col("weight")), "nth")
    before, everything = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    tried = (
        ranked.withColumn("most", F.col("source_size") * cap)
        .withColumn("left_over", F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("capped", F.col("most").cast("double") * F.col("left_weight") <= F.col("left_over").cast("double") * F.col("weight"))
    )
    free = ~F.col("capped")
    shared = F.max(F.when(free, F.col("left_over"))).over(everything), F.max(F.when(free, F.col("left_weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("most").cast("double")).otherwise((shared[0] * F.col("weight")).cast("double") / shared[1].cast("double"))
    return tried.select("source", "source_size", "n_docs", target.alias("target"))


def plan_mix(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, seed: str = SEED, rows_per_range: int = ROWS_PER_RANGE, ties: Sequence[str] = ()) -> DataFrame:
    """Words to take from each row of `sizes` (doc_id, source, size): adds source_size, target, taken.

    taken counts repeats: whole epochs of the source, plus what the source's budget (its target, rounded down) still
    takes of the document in the last one, in the order of md5(seed:doc_id), then doc_id, then size. A null doc_id has
    a key as well; repeated rows are rows of their own. A row of size 0 takes 0. The columns of `sizes` named in `ties`
    are kept and order rows that are equal in all these; its other columns are ignored.
    """
    # a string that is null for no source makes plain equi-joins of the joins below
    rows = sizes.select("doc_id", "source", "size", *ties, F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("of"), F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"))
    per_source = targets(sizes, weights, cap).select(F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")).alias("of"), "source_size", "target", F.ceil(F.col("n_docs") / rows_per_range).alias("n_ranges"))
    per_source = small(materialize(per_source, "targets"))
    dealt = rows.join(per_source, "of").withColumn("range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("n_ranges") / F.lit(float(2**32))))
    sums = dealt.groupBy("of", "range").agg(F.sum("size").alias("range_size"))
    starts = sums.select("of", "range", F.coalesce(F.sum("range_size").over(W.partitionBy("of").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("range_start"))
    inside = W.partitionBy("of", "range").orderBy("key", F.col("doc_id").asc_nulls_first(), "size", *ties).rowsBetween(W.unboundedPreceding, -1)
    at = F.col("range_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size") - at
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return dealt.join(starts, ["of", "range"]).select("doc_id", "source", "size", *ties, "source_size", "target", taken.cast("long").alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, with the columns of `docs` (doc_id, text, source and any others).

    A document appears once for each epoch that takes it whole and, where its source is cut inside it, once more with
    its first words only, joined by single spaces; n_chars, if there, follows the text. Documents of which nothing is
    taken are left out. Rows that repeat a doc_id or have none are documents of their own, as in `plan_mix`; those that
    are equal in its order too are ordered by a hash of all columns, so that only equal rows can change places.
    """
    named = F.xxhash64(*docs.columns)
    sizes = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), named.alias("_mix_hash")), "mix-sizes")
    repeated = not sizes.groupBy("_mix_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()

    def numbered(rows: DataFrame) -> DataFrame:
        """A row is named by its hash and, where rows repeat, its number among the equal ones."""
        nth = F.row_number().over(W.partitionBy("_mix_hash").orderBy("doc_id")) if repeated else F.lit(1)
        return rows.withColumn("_mix_nth", nth)

    plan = plan_mix(numbered(sizes), ties=("_mix_hash", "_mix_nth"), **options).filter("taken > 0")
    whole, part = F.floor(F.col("taken") / F.col("size")).cast("int"), (F.col("taken") % F.col("size")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    plan = plan.select("_mix_hash", "_mix_nth", copies.alias("_mix_copies"))
    joined = numbered(docs.withColumn("_mix_hash", named)).join(plan, ["_mix_hash", "_mix_nth"]).withColumn("_mix_words", F.explode("_mix_copies"))
    text = F.when(F.col("_mix_words") == 0, F.col("text")).otherwise(F.array_join(F.slice(words(F.col("text")), 1, F.col("_mix_words")), " "))
    mixed = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(*docs.columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "op7-sizes")
    return plan_mix(sizes).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size, md5('mix:' || doc_id) as k from documents),
s as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as nth from d group by source),
r as (select *, cast((nth - 1) % 3 + 1 as bigint) as weight, 3 * source_size as most from s),
t as (select *, cast(sum(source_size) over () - coalesce(sum(most) over o, 0) as bigint) as left_over,
             cast(sum(weight) over () - coalesce(sum(weight) over o, 0) as bigint) as left_weight
      from r window o as (order by cast(most as double) / weight, nth rows between unbounded preceding and 1 preceding)),
c as (select *, cast(most as double) * left_weight <= cast(left_over as double) * weight as capped from t),
g as (select source, source_size, case when capped then cast(most as double)
             else cast(max(case when not capped then left_over end) over () * weight as double) / cast(max(case when not capped then left_weight end) over () as double) end as target from c),
p as (select doc_id, size, source_size, target, cast(floor(target) as bigint) as budget,
             cast(coalesce(sum(size) over (partition by d.source order by k, doc_id rows between unbounded preceding and 1 preceding), 0) as bigint) as before
      from d join g on d.source is not distinct from g.source),
e as (select *, case when source_size > 0 then budget // source_size else 0 end as epochs from p)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) as bigint) as taken from e
"""

QUERIES = {"op7_mixing": op7_mixing}
ORACLE = {"op7_mixing": OP7_SQL}
