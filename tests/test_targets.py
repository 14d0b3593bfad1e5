"""Versioned, bucketed targets beside a plain model of their rules."""

import random

import pytest

from laddermill.sources.targets import Conflict, Target

MATCH, CHILD = "match_id bigint, source string, build int", "match_id bigint, v int"
NAMES = ("matches", "players", "events", "ages", "age_windows", "units", "techs")
REPLAY = "source = 'replay'"


def schemas(spark):
    match, child = (spark.createDataFrame([], s).schema for s in (MATCH, CHILD))
    return {name: match if name == "matches" else child for name in NAMES}


def content(target, version=None):
    return {name: sorted(tuple(r) for r in df.collect()) for name, df in target.read(version).items()}


def test_upgrade_replaces_all_seven_tables(spark, tmp_path):
    rnd = random.Random(3)
    target = Target(spark, str(tmp_path / "t"), schemas(spark), buckets=2)
    matches, children, seen = {}, {name: {} for name in NAMES[1:]}, {}
    for number in range(4):
        rows = [(rnd.randrange(12), rnd.choice(["archive", "replay"]), 10 * number + i) for i in range(6)] + ([(None, "replay", 1)] if number == 2 else [])
        mine = {name: [(m, 100 * number + i) for i, m in enumerate({r[0] for r in rows}) for _ in range(i % 3)] for name in NAMES[1:-1]}  # no techs in a batch
        first = {}
        for r in sorted(rows, key=lambda r: (r[1] != "replay", r[2])):
            first.setdefault(r[0], r)
        for m, r in first.items():
            if m not in matches or r[1] == "replay" and matches[m][1] != "replay":
                matches[m] = r
                for name in children:
                    children[name][m] = [x for x in mine.get(name, []) if x[0] == m and m is not None]
        batch = {"matches": spark.createDataFrame(rows, MATCH).filter("match_id is not null")} | {name: spark.createDataFrame(x, CHILD) for name, x in mine.items()}
        version = target.upsert(batch, "upgrade", better=REPLAY, order=["build"], source="s", number=number)
        assert target.upsert(batch, "upgrade", better=REPLAY, order=["build"], source="s", number=number) == version  # again: nothing
        matches.pop(None, None)
        want = {"matches": sorted(matches.values())} | {name: sorted(x for m, rows in c.items() if m is not None for x in rows) for name, c in children.items()}
        assert content(target) == want
        seen[version] = want
    for version, want in seen.items():  # readers of a version see it as it was
        assert content(target, version) == want
    other = Target(spark.newSession(), str(tmp_path / "t"), schemas(spark), buckets=5)  # from the manifest alone
    assert other.buckets == 2 and content(other) == want


def test_many_batches_make_few_files(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), {"matches": schemas(spark)["matches"]}, buckets=1)
    pinned = None
    for n in range(24):
        target.upsert({"matches": spark.createDataFrame([(n, "archive", 1), (n // 2, "archive", 2)], MATCH)}, source="s", number=n)
        if n == 5:
            pinned = target.read()["matches"]
    assert len(target._manifest()[1]["layers"]) <= 4
    assert sorted(r.match_id for r in target.read()["matches"].collect()) == [*range(24)]
    assert sorted(r.match_id for r in pinned.collect()) == [*range(6)]  # opened before 18 batches and their merges
    gone = target.vacuum(keep=1)
    assert gone and len(list((tmp_path / "t").glob("layer-*"))) == len(target._manifest()[1]["layers"])
    assert len(target.read()["matches"].collect()) == 24


def test_replacing_a_scope(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), {"events": schemas(spark)["events"]}, buckets=2)
    target.replace("events", spark.createDataFrame([(1, 1), (1, 2), (2, 3)], CHILD), number=0)
    target.replace("events", spark.createDataFrame([(1, 9), (3, 4), (3, 4)], CHILD), number=1)
    assert content(target) == {"events": [(1, 9), (2, 3), (3, 4), (3, 4)]}


def test_two_writers(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), {"events": schemas(spark)["events"]}, buckets=1)
    target._publish(1, {"layers": [], "applied": {}})
    with pytest.raises(Conflict):
        target._publish(1, {"layers": [], "applied": {}})
    with pytest.raises(ValueError, match="no version"):
        target.read(7)


def test_target_is_not_shuffled(spark, tmp_path):
    """A batch meets a layer, and a layer a newer one, without an exchange of what is there."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.enabled", "false")
    target = Target(session, str(tmp_path / "t"), schemas(session), buckets=4)
    for number, source in enumerate(("archive", "replay")):
        target.upsert({"matches": session.range(100 if number else 1000).selectExpr("id match_id", f"'{source}' source", "1 build")}, "upgrade", better=REPLAY, number=number)
    assert len(target._manifest()[1]["layers"]) == 2
    plan = target.read()["matches"]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    batch = session.range(10).selectExpr("id match_id").join(target._layer(target._manifest()[1]["layers"][0], "matches"), "match_id")
    assert batch._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
