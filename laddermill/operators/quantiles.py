"""Exact quantiles of groups from counted values.

Equal values are counted first. Each group's values are then counted by bins of equal width, and running counts of the
bins tell which one or two hold each quantile; only the values of those bins are copied for the sets that are rolled up,
shuffled and ordered. So no aggregate holds a group's values, and no task orders more of a group than a bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def quantiles(rows: DataFrame, sets: Sequence[Sequence[str]], measures: Mapping[str, str], qs: Sequence[float] = (0.5,), width: float = 1024, least: int = 1, times: str | None = None) -> DataFrame:
    """Of each group of each of the grouping sets: its keys, n, and for each measure (name: column) an array of its quantiles.

    The first set has all keys; keys that a set lacks come out as null, and `rolled`, an array of their names, tells them from
    keys that are null. n counts rows, with those whose value is null; a measure without a value has nulls. A quantile
    between two values is interpolated (as by `percentile`). width: of the bins, which should hold some thousand
    different values each; it changes no result. least: groups with a smaller n are left out, before their values are
    ordered. times: a column that says how often a row counts. No rows, no groups.
    """
    keys = list(sets[0])
    names = list(measures)
    each = F.array(*(F.struct(F.lit(i).alias("measure"), F.col(c).cast("double").alias("value")) for i, c in enumerate(measures.values())))
    long = rows.select(*keys, (F.col(times) if times else F.lit(1)).cast("long").alias("_n"), F.explode(each).alias("_v")).select(*keys, "_n", "_v.*")
    counted = long.groupBy(*keys, "measure", "value").agg(F.sum("_n").alias("_n"))
    counted = counted.withColumn("bin", F.floor(F.col("value") / width))

    def copied(df: DataFrame) -> DataFrame:
        """Each row once for each set: `at` has its group, measure and bin. Structs compare nulls as equal."""
        in_set = lambda i, s: [(F.col(k) if k in s else F.lit(None).cast(df.schema[k].dataType)).alias(k) for k in keys] + [F.lit(i).alias("set"), "measure", "bin"]
        return df.withColumn("at", F.explode(F.array(*(F.struct(*in_set(i, s)) for i, s in enumerate(sets)))))

    bins = copied(counted.groupBy(*keys, "measure", "bin").agg(F.sum("_n").alias("_n"))).groupBy("at").agg(F.sum("_n").alias("_n"))
    cell = W.partitionBy(*(F.col(f"at.{k}") for k in keys), "at.set", "at.measure")
    known = F.when(F.col("at.bin").isNotNull(), F.col("_n"))
    upto = cell.orderBy(F.col("at.bin").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    bins = bins.withColumns({"all": F.sum("_n").over(cell), "total": F.coalesce(F.sum(known).over(cell), F.lit(0)), "last": F.sum(known).over(upto)}).withColumn("before", F.col("last") - F.col("_n"))
    ranks = [r for q in qs for r in rank(q)]
    holds = lambda r: (F.col("before") <= r) & (r < F.col("last"))
    wanted = F.col("at.bin").isNull()
    for r in ranks:
        wanted |= holds(r)
    bins = bins.filter((F.col("all") >= least) & wanted).select("at", "all", "total", "before")

    # values of a bin come once for each finest group, and equal ones are peers of the running count
    inside = W.partitionBy("at").orderBy("value").rangeBetween(W.unboundedPreceding, W.currentRow)
    found = copied(counted).select("at", "value", "_n").join(bins, "at").withColumn("last", F.col("before") + F.sum("_n").over(inside))
    value = lambda i, r: F.min(F.when((F.col("at.measure") == i) & (F.col("last") > r), F.col("value")))
    out = []
    for i, name in enumerate(names):
        out.append(F.array(*(between(value(i, low), value(i, high), i, q) for q in qs for low, high in [rank(q)])).alias(name))
    total = F.max(F.when(F.col("at.measure") == 0, F.col("all"))).alias("n")
    done = found.groupBy(*(F.col(f"at.{k}").alias(k) for k in keys), F.col("at.set").alias("set")).agg(total, *out)
    lacking = [F.array(*(F.lit(k) for k in keys if k not in s)).cast("array<string>") for s in sets]
    rolled = F.array(*lacking)[F.col("set")]
    return done.select(*keys, rolled.alias("rolled"), "n", *names)


def rank(q: float) -> tuple[Column, Column]:
    """The places, from 0, of the values below and above the quantile q of `total` values."""
    place = (F.col("total") - 1) * F.lit(float(q))
    return F.floor(place), F.ceil(place)


def between(low: Column, high: Column, measure: int, q: float) -> Column:
    total = F.max(F.when(F.col("at.measure") == measure, F.col("total")))
    place = (total - 1) * F.lit(float(q))
    return low + (high - low) * (place - F.floor(place))
