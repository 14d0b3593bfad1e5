"""What keeps queries in proportion to their tables: shuffles that are not there, tasks that grow in number."""

from __future__ import annotations

import ast

from pyspark.sql import functions as F

from laddermill.functions.scalars import mmss
from laddermill.operators import findings as f
from laddermill.operators import ingest, quality
from laddermill.plans import findings as plans, sources
from laddermill.sources import archives, roles
from laddermill.sources.roles import Tables
from laddermill.streaming import streams

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_players_of_a_match_are_compared_without_a_shuffle(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = plans.metrics(Tables(spark, SF))
    for df in (rows, f.findings(rows), f.superlatives(rows), f.opponent_profile(rows)):
        assert "Exchange hashpartitioning" not in plan(df)
        assert "lineitem" not in plan(df)  # read once, when `played` was written
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == kept


def test_lines_are_dealt_among_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(roles, "MOST_LINES", 500)
    t = Tables(spark, SF)
    n = t.raw("lineitem").count()
    assert t.parts == -(-n // 500) > 4
    assert f"hashpartitioning(l_orderkey#" in plan(t.lines) and f", {t.parts}), REPARTITION_BY_NUM" in plan(t.lines)
    assert sorted(t.lines.collect()) == sorted(Tables(spark, SF).lines.collect())


def test_superlatives_of_ties_zeros_and_lone_players(spark):
    rows = spark.createDataFrame([(1, 1, 0.0), (1, 2, -0.0), (2, 1, 5.0), (3, 1, 1.0), (3, 2, None), (4, 1, None), (4, 2, None), (5, 1, 2.0), (5, 2, 3.0)], "match_id long, profile_id long, v double")
    found = f.superlatives(rows, {"most": ("v", 1), "least": ("v", -1)})
    assert sorted(tuple(r) for r in found.collect()) == [(3, "least", 1), (3, "most", 1), (5, "least", 1), (5, "most", 2)]


def test_minutes_and_seconds_as_printed(spark):
    rows = spark.createDataFrame([(x,) for x in (0.0, 5.9, 59.99, 60.0, 3605.0, -5.0, -65.5, -59.0, -600.0, None)], "s double").select("s", mmss(F.col("s")).alias("t"), F.expr("if(s is null, null, format_string('%d:%02d', cast(floor(cast(floor(s) as int) / 60) as int), cast(floor(s) as int) % 60))").alias("want"))
    assert all(r.t == r.want for r in rows.collect())


def test_backlogs_are_made_once_and_land_in_as_many_batches_whatever_their_files(spark):
    path, files = sources.landed(spark.range(1000).repartition(9), "landed", 4)
    n = spark.read.format("binaryFile").load(path).count()
    assert n > 8 and -(-n // files) == 4
    assert spark.read.parquet(path).count() == 1000
    rows = spark.range(9).withColumn("a", F.lit("old"))
    both = sources.twice(rows, "id % 3 = 0", "id", "'new'")
    assert sorted((r.id, r.a) for r in both.collect()) == sorted([(i, "old") for i in range(9)] + [(i, "new") for i in (0, 3, 6)])


def test_retries_are_kept_by_spark(spark):
    stream = spark.readStream.format("rate").load().selectExpr("value match_id", "value failed_at")
    assert "FlatMapGroupsInPandasWithState" not in streams.retries(stream)._jdf.queryExecution().logical().toString()


def test_ids_are_counted_before_they_meet_the_dimension(spark):
    rows, dim = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int"), spark.createDataFrame([(1,), (1,)], "id int")
    for df in (quality.foreign_keys(rows, dim, "id"), ingest.filter_known(rows, dim, "id")[1]):
        lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
        join, counted = (next(i for i, x in enumerate(lines) if word in x) for word in ("Join LeftAnti", "Aggregate"))
        assert join < counted
    assert sorted(map(str, ingest.filter_known(rows, dim, "id")[1].collect())) == ["Row(id=2, dropped=2)", "Row(id=None, dropped=1)"]


def test_literals_mean_the_same_read_as_json(monkeypatch):
    texts = ["{'a': 1, 'b': [1.5, -2, 'x y'], 'c': {}}", "{'a': None, 'b': True}", "{'a': true}", "{'a': NaN}", '{"it\'s": 1}', r"{'a\n': 1}", "{1: 2, 'a': (1, 2)}", "\n {'a': 1}", " {'a': 1}", "{'a': 01}", "{'a': 1,}", "{'a': 'b' 'c'}", "{'a': '\t'}", "{'a': '\n'}", "{'a': " + "[" * 300 + "]" * 300 + "}", "{'a': 1e5, 'a': 2}", "{'a': 1 # x\n}", "nonsense", ""]

    literal = archives.literal_reader()

    def read(reader, text):
        try:
            return repr(reader(text))
        except (ValueError, SyntaxError, TypeError) as error:
            return "bad" if not isinstance(error, TypeError) else "type"

    assert [read(literal, x) for x in texts] == [read(ast.literal_eval, x) for x in texts]
    monkeypatch.setattr(archives.ast, "literal_eval", lambda text: 1 / 0)
    assert literal(texts[0]) == {"a": 1, "b": [1.5, -2, "x y"], "c": {}}  # without the slow reader


def test_what_needs_no_reference_makes_none(spark, monkeypatch):
    monkeypatch.setattr(plans, "bench", lambda t: 1 / 0)
    for name in ("idle_cost", "opponent_profile", "superlatives", "winner_gaps"):
        assert plans.QUERIES[name](spark, SF).count() > 0
    assert plan(plans.QUERIES["idle_cost"](spark, SF)).count("l_orderkey") and plan(plans.QUERIES["idle_cost"](spark, SF)).count("/lineitem.parquet") <= 1


def test_gaps_need_no_shuffle(spark):
    t = Tables(spark, SF)
    df = f.gaps(plans.metrics(t), plans.own_metrics(t))
    assert "Exchange hashpartitioning" not in plan(df) and "Sort " not in plan(df)


def test_texts_of_findings_are_compiled(spark):
    t = Tables(spark, SF)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        said = f.findings(plans.metrics(t), others=plans.own_metrics(t))._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(x.split(";")[0].split(")")[0]) for x in said.split("maxMethodCodeSize:")[1:]]
    assert sizes and max(sizes) < 8000


def test_players_with_their_match_are_those_of_both_tables(spark):
    t = Tables(spark, SF)
    key = lambda rows: sorted(map(str, rows.collect()))
    both = t.players.join(t.matches, "match_id")
    assert t.met.columns == both.columns and t.met.dtypes == both.dtypes and key(t.met) == key(both)


def test_lines_that_become_events_are_dealt_by_their_number_only(spark):
    t = Tables(spark, SF)
    assert t.parts < int(spark.conf.get("spark.sql.shuffle.partitions")) and f"l_linenumber#" in plan(t.events) and "REPARTITION_BY_NUM" in plan(t.events)
