"""Quantiles by counts beside percentile over raw rows and beside plain sorting."""

import random

import pytest
from pyspark.sql import functions as F

from laddermill.operators.quantiles import quantiles

SCHEMA = "a string, b int, x int, y double, clash string"


def brute(rows, q):
    values = sorted(v for v in rows if v is not None)
    if not values:
        return None
    place = (len(values) - 1) * q
    low = values[int(place)]
    return low + (values[min(int(place) + 1, len(values) - 1)] - low) * (place - int(place))


@pytest.mark.parametrize("width", [1, 7, 1024])
def test_quantiles_beside_sorting(spark, width):
    """A hot group, null keys, null values, ties, negative values, groups of one and groups without a value."""
    rng = random.Random(width)
    rows = [("hot", 1, rng.randrange(-50, 4000), rng.random() * 9, "c") for _ in range(900)]
    rows += [(rng.choice(["p", "q", None]), rng.choice([1, 2, None]), rng.choice([None, 3, 3, 5, rng.randrange(99)]), None if rng.random() < 0.4 else rng.randrange(40) / 4, "c") for _ in range(600)]
    rows += [("one", 5, 17, 2.5, "c"), ("none", 6, None, None, "c"), ("none", 6, None, 1.0, "c")]
    sets, qs = [["a", "b"], ["a"], ["b"], []], (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {(r.a, r.b, tuple(sorted(r.rolled))): r for r in quantiles(spark.createDataFrame(rows, SCHEMA), sets, {"x": "x", "y": "y"}, qs, width).collect()}
    want = {}
    for s in sets:
        for r in rows:
            key = (r[0] if "a" in s else None, r[1] if "b" in s else None, tuple(k for k in "ab" if k not in s))
            want.setdefault(key, []).append(r)
    assert got.keys() == want.keys()
    for key, members in want.items():
        assert got[key].n == len(members)
        for name, i in (("x", 2), ("y", 3)):
            for q, v in zip(qs, got[key][name], strict=True):
                w = brute([m[i] for m in members], q)
                assert (v is None) == (w is None) and (w is None or abs(v - w) < 1e-9), (key, name, q)


def test_quantiles_of_counted_rows(spark):
    rows = [("k", 1, 5, 1.0, ""), ("k", 3, 9, 1.0, ""), ("k", 0, 100, 1.0, "")]
    (got,) = quantiles(spark.createDataFrame(rows, SCHEMA), [["a"]], {"x": "x"}, times="b").collect()
    assert (got.n, got.x, got.rolled) == (4, [9.0], [])


def test_groups_too_small_are_left_out(spark):
    rows = [("k", 1, 5, 1.0, ""), ("k", 1, None, 1.0, ""), ("l", 1, 5, 1.0, "")]
    got = quantiles(spark.createDataFrame(rows, SCHEMA), [["a", "b"], ["b"]], {"x": "x"}, least=2).collect()
    assert sorted((r.a or "", r.rolled, r.n, r.x) for r in got) == [("", ["a"], 3, [5.0]), ("k", [], 2, [5.0])]


def test_quantiles_of_nothing(spark):
    assert quantiles(spark.createDataFrame([], SCHEMA), [["a"], []], {"x": "x"}).collect() == []


def test_no_aggregate_holds_values(spark):
    df = spark.createDataFrame([("k", 1, 5, 1.0, "")], SCHEMA)
    plan = quantiles(df, [["a", "b"], ["a"]], {"x": "x"})._jdf.queryExecution().executedPlan().toString().lower()
    assert "percentile" not in plan and "collect_" not in plan and "cartesian" not in plan
    assert quantiles(df, [["a"]], {"x": "x"}).select(F.col("x")[0]).first()[0] == 5.0
