"""Archives whose files drift, and chunks of ids."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from laddermill.operators import ingest as g
from laddermill.sources import archives as a

COLUMNS = {"game_id": "bigint", "started_timestamp": "timestamp", "opening": "string"}


def store(folder, nth, ids, times, openings, id_type=pa.int64(), unit="us"):
    table = pa.table({"game_id": pa.array(ids, id_type), "started_timestamp": pa.array(times, pa.timestamp(unit, "UTC")), "opening": openings, "raw": ["x"] * len(ids)})
    pq.write_table(table, f"{folder}/{nth}.parquet", version="2.6")


def test_kinds_of_files_are_found_by_executors(spark, tmp_path):
    """Sixty files of three kinds: no reader for each file, and the session's settings are as before."""
    want = []
    for i in range(60):
        kind = i % 3
        store(tmp_path, i, [str(i)] if kind == 1 else [i], [i * 10**9 + 1500 if kind == 2 else i * 10**6], pa.array([None], pa.int32()) if kind == 1 else ["Archers"], pa.string() if kind == 1 else pa.int64(), "ns" if kind == 2 else "us")
        want.append((i, i, 1 if kind == 2 else 0, None if kind == 1 else "Archers"))
    before = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong")
    paths = [str(p) for p in tmp_path.iterdir()]
    kinds = {tuple(r.types): r["count"] for r in a.footers(a.listed(spark, paths), list(COLUMNS), 7).groupBy("types").count().collect()}
    assert kinds == {("bigint", "timestamp", "string"): 20, ("string", "timestamp", "int"): 20, ("bigint", "nanoseconds", "string"): 20}
    out = a.read_drifting(spark, paths, COLUMNS)
    assert sorted(out.selectExpr("game_id", "unix_seconds(started_timestamp)", "unix_micros(started_timestamp) % 1000000", "opening").collect()) == want
    assert out.sparkSession is spark and spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") == before
    assert spark.range(5).withColumnRenamed("id", "game_id").join(out, "game_id").count() == 5


def test_missing_columns_and_values_that_should_be_null_fail(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "y").mkdir()
    store(tmp_path / "x", 0, [1], [1], pa.array([4], pa.int32()))
    with pytest.raises(Exception, match="stored as int and has values"):
        a.read_drifting(spark, [str(tmp_path / "x")], COLUMNS).collect()
    pq.write_table(pa.table({"game_id": [1]}), str(tmp_path / "y" / "0.parquet"))
    with pytest.raises(ValueError, match="no column started_timestamp"):
        a.read_drifting(spark, [str(tmp_path / "x"), str(tmp_path / "y")], COLUMNS)


@pytest.mark.parametrize("width", [1, 10, 1_000_000])
def test_chunks_of_sparse_ids_and_resumption(spark, width):
    """Chunks have exactly n ids, in order; a run that goes on with the cursor of any chunk makes the rest of them."""
    rng = random.Random(3)
    ids = sorted({*rng.sample(range(-500, 10**6), 53), 2**60, 2**60 + 1})
    df = spark.createDataFrame([(i, "x") for i in [*ids, *ids[:9]]] + [(None, "x")], "match_id bigint, nth string").repartition(5)
    for start, limit in ((0, None), (17, None), (20, 44), (55, None), (99, 10)):
        left = ids[: limit or len(ids)][start:]
        want = [(i // 10, part[0], part[-1], len(part), start + i + len(part)) for i in range(0, len(left), 10) for part in [left[i : i + 10]]]
        assert sorted(tuple(r) for r in g.id_ranges(df, 10, start, limit, width=width).collect()) == want
    assert g.id_ranges(df.limit(0), 10).collect() == []


def test_histories_skip_for_a_reason(spark):
    """Unfinished matches (no time, or one that is not above 0) are running; newest first; the new rating, else the old."""
    import json

    match = lambda i, time, kind=6, said="AUTOMATCH", new=None: {"id": i, "description": said, "matchtype_id": kind, "completiontime": time, "members": [{"profile_id": 9, "oldrating": 1, "newrating": 2}, {"profile_id": 5, "oldrating": 1000 + i, "newrating": new}]}
    matches = [match(1, 50), match(2, 70, 8, new=3), match(3, 0), match(4, -1), match(5, None), match(6, 60, said="LOBBY"), match(7, 60, 18), match(8, 60, 99)]
    seeds, census = a.normalize_history(spark.createDataFrame([(5, json.dumps({"matches": matches})), (6, None), (7, "{}"), (8, "broken")], "profile_id bigint, payload string"))
    assert [(r.match_id, r.ladder, r.profile_id, r.elo) for r in seeds.collect()] == [(2, "team", 5, 3), (1, "1v1", 5, 1001)]
    assert {r.reason: r.n for r in census.collect()} == {"ok": 2, "running": 3, "not_automatch": 1, "known_other": 1, "unknown_type": 1}


def test_modes_of_pairs(spark):
    """Counts are summed by (building, band); of equal ones the smaller pair wins."""
    from pyspark.sql import functions as F

    from laddermill.operators.text import mode_per_key

    rows = [(1, "stable", 1, 3), (1, "range", 2, 2), (1, "range", 2, 1), (2, "b", 1, 1), (2, "a", 3, 1), (2, "a", 2, 1), (3, None, 1, 4)]
    got = mode_per_key(spark.createDataFrame(rows, "unit int, building string, band int, n int"), "unit", F.struct("building", "band"), F.col("n"))
    assert sorted((r.unit, *r.value, r.n) for r in got.collect()) == [(1, "range", 2, 3), (2, "a", 2, 1), (3, None, 1, 4)]
