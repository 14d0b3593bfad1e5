"""Small golden tables and properties."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from laddermill.functions import scalars as s
from laddermill.operators import cube as q
from laddermill.operators import events as e
from laddermill.operators import findings as f
from laddermill.operators import ingest as g
from laddermill.operators import marts as m
from laddermill.sources import archives as a
from laddermill.sources.roles import Tables

SF = "/root/testdata/sf0.001"


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_bands_and_slugs(spark):
    assert column(spark, [None, 999, 1000, 1399, 1400, 2499, 2500], "int", s.elo_bucket) == [None, "<1000", "1000-1199", "1200-1399", "1400-1649", "2200-2499", "2500+"]
    assert column(spark, ["Black Forest", "İstanbul", None], "string", s.slug) == ["blackforest", "stanbul", None]
    assert column(spark, ["scouts", "unknown", None], "string", s.opening_kind) == ["scouts", None, None]
    assert column(spark, [65.9, 0.0, None], "double", s.mmss) == ["1:05", "0:00", None]
    assert column(spark, [5_000_000_000, 7], "bigint", s.guard_int) == [None, 7]


def test_unknown_leaderboard_fails(spark):
    df = spark.createDataFrame([("x", 2)], "lb string, n int")
    with pytest.raises(PySparkException):
        df.select(s.to_ladder(F.col("lb"), F.col("n"))).collect()


def test_rate_is_half_up(spark):
    df = spark.createDataFrame([(201, 20000), (0, 0)], "w bigint, g bigint")
    assert [r[0] for r in df.select(s.rate(F.col("w"), F.col("g"))).collect()] == [1.01, None]


def test_cube_golden(spark):
    cube = spark.createDataFrame([(1, "<1000", 1, 100, 100, 50), (1, "1650-1799", 1, 100, 100, 60), (1, "1800-1999", 1, 100, 100, 70)], "civ_id int, elo_bucket string, map_id int, build int, games bigint, wins bigint")
    of = lambda **k: tuple(q.slice_win_rate(cube, 1, **k).first())
    assert of(elo="1650-1799") == (100, 60, 60.0)
    assert of() == (300, 180, 60.0)
    assert of(elo="cum:1650") == (200, 130, 65.0)
    assert of(map=9) == (0, 0, None)


def test_opening(spark):
    ev = spark.createDataFrame([(1, 1, t, "train", u, 1) for t, u in ((100, 74), (110, 74), (120, 74), (700, 448), (690, 4), (800, 7))] + [(1, 2, 100, "train", 83, 1)], "match_id int, profile_id int, t_ms int, kind string, target_id int, amount int")
    clicks = spark.createDataFrame([(1, 1, 600, 900), (1, 2, 600, 900), (1, 3, None, 900), (1, 4, 600, None)], "match_id int, profile_id int, feudal_ms int, castle_ms int")
    assert rows(e.classify_opening(ev, clicks)) == [(1, 1, "Drush + Archers into Scouts", "drush"), (1, 2, "Fast Castle", "fast_castle")]


def test_winner_needs_a_loser(spark):
    players = spark.createDataFrame([(1, 1, 2, 5), (1, 2, 3, 5), (2, 1, 2, 5), (2, 2, 3, 5), (1, 9, 4, 0)], "match_id int, profile_id int, team int, civ_id int")
    ev = spark.createDataFrame([(1, 1, 5, "resign")], "match_id int, profile_id int, t_ms int, kind string")
    assert rows(e.winner_team(ev, players)) == [(1, 1, 2, False), (1, 2, 3, True), (2, 1, 2, None), (2, 2, 3, None)]
    assert {(r[0], r[1]): r[2] for r in e.winner_individual(ev, players).collect()} == {(1, 1): False, (1, 2): True, (1, 9): True, (2, 1): None, (2, 2): None}


def test_float_window_ends_at_the_slow_step(spark):
    ev = spark.createDataFrame([(1, 1, 0, "train", 83, 20), (1, 1, 100_000, "build", 9, 1)], "match_id int, profile_id int, t_ms int, kind string, target_id int, amount int")
    players = spark.createDataFrame([(1, 1, 180_000)], "match_id int, profile_id int, duration_ms int")
    costs = spark.createDataFrame([("build", 9, 400.0)], "kind string, target_id int, cost double")
    got = rows(e.float_windows(ev, costs, players))
    # 20 workers gather 180 a step from the first step on; the building of 100 s falls into the fourth step
    assert got == [(1, 1, 0, 120_000, 320.0, 160.0), (1, 1, 120_000, 180_000, 360.0, 360.0)]


def test_upsert_twice_is_once(spark):
    t = Tables(spark, SF)
    match, player = t.matches.select("match_id", "source", "build"), t.players.select("match_id", "profile_id", "civ_id")
    target = {"matches": match.filter("match_id % 3 <> 0"), "players": player.filter("match_id % 3 <> 0")}
    batch = {"matches": match.filter("match_id % 2 = 0").withColumn("source", F.lit("replay")), "players": player.filter("match_id % 2 = 0").withColumn("civ_id", F.lit(9))}
    once = g.upsert(target, batch)
    twice = g.upsert(once, batch)
    for name in target:
        assert rows(once[name]) == rows(twice[name])


def test_matchups_mirror(spark):
    t = Tables(spark, SF)
    got = {(r.civ_id, r.opp_civ_id): (r.games, r.wins) for r in m.matchups(t.matches, t.players.withColumn("won", F.col("profile_id") == 1)).collect()}
    assert got and all(got[b, a_][0] == n for (a_, b), (n, _) in got.items())


def test_drift_rejects_other_types(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as boolean) profile_id", "id game_id").write.parquet(str(tmp_path / "x"))
    with pytest.raises(ValueError, match="profile_id"):
        a.read_player_archive(spark, [str(tmp_path / "x")])


def test_torn_shard_keeps_what_can_be_read(spark, tmp_path):
    import gzip

    lines = "".join('{"match_id":%d,"t_ms":1,"kind":"train"}\n' % i for i in range(5000)).encode()
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(lines)[:-2000])
    n = a.read_event_shards(spark, str(tmp_path)).count()
    assert 0 < n < 5000


def test_fallback_never_takes_another_map(spark):
    players = spark.createDataFrame([(1, 1, 1, "5", "<1000", "1v1"), (1, 2, 1, "7", "<1000", "1v1")], "match_id int, profile_id int, civ_id int, map_id string, elo_bucket string, ladder string")
    bench = spark.createDataFrame([(1, "7", "all", "all", 9.0, 9.0, 9.0, 9.0)], "civ_id int, map_id string, elo_bucket string, ladder string, feudal_s double, castle_s double, imperial_s double, vils_castle double")
    assert {r.profile_id: (r.kind, r.feudal_s) for r in f.bench_slice(players, bench).collect()} == {1: (None, None), 2: ("mapall", 9.0)}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def match_rows(spark, rows):
    return spark.createDataFrame(rows, "match_id int, source string, ladder string, map_id int, build int")


def player_rows(spark, rows):
    return spark.createDataFrame(rows, "match_id int, profile_id int, civ_id int, elo int, won boolean, opening_kind string, castle_t double")


def test_a_pair_needs_the_first_result_only(spark):
    matches = match_rows(spark, [(1, "archive", "1v1", 3, 1), (2, "archive", "team", 3, 1)])
    players = player_rows(spark, [(1, 1, 5, 900, True, None, None), (1, 2, 6, None, None, None, None), (2, 1, 5, 900, True, None, None), (2, 2, 6, 900, None, None, None), (2, 3, 7, 900, False, None, None)])
    assert rows(m.matchups(matches, players)) == [(5, 6, 1, 1, 100.0)]
    assert rows(m.matchups(matches, players, by="map_id")) == [(5, 6, 3, 1, 1, 100.0)]
    assert rows(m.matchups_by_elo(matches, players).select("civ_id", "elo_bucket", "games")) == [(5, "<1000", 1), (5, "all", 1)]
    assert rows(m.matchups(matches, players, "team").select("civ_id", "opp_civ_id")) == [(5, 7), (7, 5)]


def test_villagers_need_reached_windows(spark):
    matches, players = match_rows(spark, [(1, "replay", "1v1", 3, 1)]), player_rows(spark, [(1, p, 5, 900, True, None, None) for p in (1, 2, 3)])
    ages = [(1, 1, 5, True, "dark", 0, 20), (1, 1, 5, True, "feudal", 5, 9), (1, 1, 5, True, "castle", 0, 1)]  # castle at 0 counts
    ages += [(1, 2, 5, True, "dark", 0, 20), (1, 2, 5, True, "feudal", -1, 50), (1, 2, 5, True, "castle", 9, 1)]  # feudal not reached
    ages += [(1, 3, 5, True, "dark", 0, 20), (1, 3, 5, True, "feudal", 5, 50), (1, 3, 5, True, "castle", -1, 1)]
    got = m.benchmark_vils(matches, players, spark.createDataFrame(ages, "match_id int, profile_id int, civ_id int, won boolean, age string, uptime_ms int, villagers int"), 1)
    assert {(r.n, r.vils_median) for r in got.collect()} == {(1, 29.0)}


def test_whose_wins_are_references(spark):
    """Openings and medians are of every source, tech shares of replays; civ 0 counts in the latter two."""
    matches = match_rows(spark, [(1, "replay", "1v1", 3, 1), (2, "archive", "1v1", 3, 1), (3, "replay", "1v1", 3, 1)])
    players = player_rows(spark, [(1, 1, 5, 900, True, "scouts", 800.0), (2, 1, 5, 900, True, "drush", 800.0), (3, 1, 0, 900, True, "scouts", 800.0)])
    every = m.winners(matches, players, None, random_civ=True)
    assert rows(m.winner_refs_openings(m.winners(matches, players, None), 1, 0.0).select("civ_id", "opening_kind", "n", "winners")) == [(5, "drush", 1, 2), (5, "scouts", 1, 2)]
    techs = spark.createDataFrame([(3, 1, 22, 100)], "match_id int, profile_id int, tech_id int, t_ms int")
    assert ("<1000", 2, 22, 1) in rows(m.winner_refs_ecotech(m.winners(matches, players, random_civ=True), techs, 1).select("elo_bucket", "n", "tech_id", "clicked"))
    events = spark.createDataFrame([(2, 1, 50, "train", 4), (3, 1, 70, "research", 22), (1, 1, 5, "train", 83), (1, 1, 5, "move", 22)], "match_id int, profile_id int, t_ms int, kind string, target_id int")
    assert rows(m.winner_refs_meds(every, events, 1).select("map_id", "n", "military_median", "t22_median")) == [("3", 2, 50.0, 70.0), ("all", 2, 50.0, 70.0)]


def archive_file(tmp_path, name, **columns):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = str(tmp_path / name)
    pq.write_table(pa.table(columns), path)
    return path


def test_archives_in_all_their_types(spark, tmp_path):
    import datetime

    import pyarrow as pa

    at = datetime.datetime(2024, 3, 1, 12, 0, 5, 250, tzinfo=datetime.timezone.utc)
    rest = {"map": ["passage", "Black_Forest"], "duration": [2_971_600_000_000, None], "num_players": [2, 2], "leaderboard": ["x", "y"], "patch": [1, 2]}
    files = [archive_file(tmp_path, f"m_{unit}.parquet", game_id=["1", "2"], started_timestamp=pa.array([at, None], pa.timestamp(unit, "UTC")), **rest) for unit in ("us", "ns")]
    got = a.read_match_archive(spark, files).filter("game_id = 1").select("map", "duration_ms", F.unix_micros("started_timestamp")).distinct().collect()
    assert [tuple(r) for r in got] == [("thepassage", 2_971_600, int(at.timestamp()) * 1_000_000 + 250)]
    for bad in ({"patch": ["one", "two"]}, {"leaderboard": [1, 2]}, {"duration": ["1", "2"]}):
        with pytest.raises(ValueError):
            a.read_match_archive(spark, [archive_file(tmp_path, "bad.parquet", game_id=["1", "2"], started_timestamp=pa.array([at, None], pa.timestamp("us", "UTC")), **(rest | bad))])
    with pytest.raises(ValueError):
        a.read_match_archive(spark, [archive_file(tmp_path, "short.parquet", game_id=["1"])])


def test_a_column_without_values_stored_as_int(spark, tmp_path):
    import pyarrow as pa

    def file(name, opening):
        none = pa.array([None, None], pa.int32())
        return archive_file(tmp_path, name, game_id=[1, 2], profile_id=[1.0, 2.0], civ=["a", "b"], winner=[True, None], opening=opening, feudal_age_uptime=[1.5, None], castle_age_uptime=none, imperial_age_uptime=none, new_rating=[1000, None])

    got = a.read_player_archive(spark, [file("p_1.parquet", pa.array([None, None], pa.int32())), file("p_2.parquet", ["scouts", None])])
    assert rows(got.filter("profile_id = 1").select("profile_id", F.coalesce("opening", F.lit("-")), "feudal_age_uptime")) == [(1, "-", 1.5), (1, "scouts", 1.5)]
    with pytest.raises(PySparkException):
        a.read_player_archive(spark, [file("p_3.parquet", pa.array([7, None], pa.int32()))]).collect()


def test_readable_documents(spark, tmp_path):
    docs = spark.createDataFrame([("a", 1, [1, 2]), ("b", 2, [])], "name string, n int, l array<int>")
    a.write_docs(docs, str(tmp_path / "docs"), "name")
    files = list((tmp_path / "docs").glob("name=*/*.txt"))
    assert len(files) == 2 and all('\n  "n" : ' in f.read_text() for f in files)


def test_aliases_and_required_items(spark):
    from laddermill.operators import text as x

    df = spark.createDataFrame([("packed", 2), ("packed", 1), ("other", 5)], "k string, n int")
    assert rows(x.first_wins(df, "k", ["n"], aliases={"plain": "packed", "other": "packed"})) == [("other", 5), ("packed", 1), ("plain", 1)]
    help_text = spark.createDataFrame([(1, "Techs\n• a\n• b"), (2, "Techs\n• a")], "k int, help string")
    sections = {"Techs": (("techs",), "effects")}
    assert x.sectioned_text(help_text.filter("k = 1"), "k", "help", sections, "Bonus", {"Techs": 2}).count() == 2
    with pytest.raises(PySparkException):
        x.sectioned_text(help_text, "k", "help", sections, "Bonus", {"Techs": 2}).collect()


def test_fallback_takes_the_first_step(spark):
    bench = spark.createDataFrame([(1, "m", "<1000", "1v1", 10.0), (1, "m", "all", "1v1", 20.0), (1, "m", "all", "all", 30.0), (1, "n", "all", "all", 40.0)], "civ_id int, map_id string, elo_bucket string, ladder string, castle_s double")
    players = spark.createDataFrame([(1, 1, "m", "<1000", "1v1"), (2, 1, "m", "2500+", "1v1"), (3, 1, "m", None, "team"), (4, 1, "n", "<1000", "1v1"), (5, 2, "m", "<1000", "1v1"), (5, 2, "m", "<1000", "1v1")], "profile_id int, civ_id int, map_id string, elo_bucket string, ladder string")
    got = sorted((r.profile_id, r.castle_s, r.kind) for r in f.bench_slice(players, bench).filter("kind is not null").collect())
    assert got == [(1, 10.0, "exact"), (2, 20.0, "mapmode"), (3, 30.0, "mapall"), (4, 40.0, "mapall")] and f.bench_slice(players, bench).count() == 6


EV = "match_id int, profile_id int, t_ms int, kind string, target_id int, amount int, x double, y double"


def test_floats_by_hand(spark):
    """Ten villagers queued by one command of 50 each: 500 are spent, so the surplus grows from 1:00 on."""
    costs = spark.createDataFrame([("train", 83, 50.0)], "kind string, target_id int, cost double")
    players = spark.createDataFrame([(1, 1, 120_000), (1, 2, 120_000), (1, 3, 120_000)], "match_id int, profile_id int, duration_ms int")
    ev = spark.createDataFrame([(1, 1, 0, "train", 83, 10, None, None), (1, 2, 0, "train", 83, 10, None, None), (1, 2, 125_000, "train", 83, 60, None, None), (1, 3, 5, "move", None, None, 1.0, 1.0)], EV)
    assert rows(e.float_windows(ev, costs, players, per_second=1.0)) == [(1, 1, 30_000, 120_000, 700.0, 466.666667), (1, 2, 30_000, 120_000, 700.0, 466.666667)]
    free = costs.limit(0)
    assert rows(e.float_windows(ev, free, players, per_second=1.0)) == [(1, p, 0, 120_000, 1200.0, 600.0) for p in (1, 2)]


def test_places_beside_brute_force(spark):
    """Distances of exactly 15 do not count, players without a base find nobody, far bases are found on the widest ring."""
    rnd = random.Random(1)
    players, bases, moves = [], {}, []
    for match in range(30):
        for p in range(rnd.choice([1, 2, 3, 8])):
            players.append((match, p, rnd.choice([2, 3, 4])))
            if rnd.random() < 0.85:
                bases[match, p] = (float(rnd.randint(-300, 300)), float(rnd.randint(-300, 300))) if match % 3 else (float(rnd.randint(0, 60)), float(rnd.randint(0, 60)))
            moves += [(match, p, rnd.randint(0, 900), rnd.choice(["move", "interact", "train"]), None, None, float(rnd.randint(0, 60)), float(rnd.randint(0, 60))) for _ in range(12)]
    players += [(99, 1, 2), (99, 2, 3), (99, 3, 3)]
    bases |= {(99, 1): (0.0, 0.0), (99, 2): (5000.0, 0.0), (99, 3): (100.0, 100.0)}
    moves += [(99, 1, 10, "move", None, None, 115.0, 100.0), (99, 1, 20, "move", None, None, 100.0, 85.0), (99, 1, 30, "move", None, None, 109.0, 111.9), (99, 2, 5, "move", None, None, None, 3.0)]
    team = {(m, p): t for m, p, t in players}
    enemies = lambda m, p: [b for (n, q), b in bases.items() if n == m and team[n, q] != team[m, p]]
    near = {k: min(math.dist(b, x) for x in enemies(*k)) for k, b in bases.items() if enemies(*k)}
    found = {}
    for m, p, t, kind, _, _, x, y in moves:
        if kind != "train" and x is not None and (m, p) in bases and any(math.dist((x, y), b) < 15 for b in enemies(m, p)):
            found[m, p] = min(t, found.get((m, p), t))
    ps = spark.createDataFrame(players, "match_id int, profile_id int, team int")
    bs = spark.createDataFrame([(*k, *v) for k, v in bases.items()], "match_id int, profile_id int, base_x double, base_y double")
    assert {r[:2]: r[2] for r in rows(e.nearest_enemy(bs, ps))} == {k: round(v, 6) for k, v in near.items()}
    assert {r[:2]: r[2] for r in rows(e.find_enemy(spark.createDataFrame(moves, EV), bs, ps))} == found and found[99, 1] == 30
    plan = e.find_enemy(spark.createDataFrame(moves, EV), bs, ps)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and all("cx" in line for line in plan.splitlines() if "enemy_x" in line and "Join Inner" in line)


def test_metrics_without_ages(spark):
    """No Castle click: villagers at the end; no age: no idle time; on nomad maps idle time starts with the first centre."""
    ev = [(1, 1, 1000, "train", 83, 3, None, None), (1, 1, 900_000, "train", 83, 70, None, None), (1, 1, 60_000, "build", 109, None, 3.0, 4.0), (1, 1, 300_000, "research", 101, None, None, None), (1, 1, 200_000, "research", 22, None, None, None), (1, 1, 250_000, "research", 999, None, None, None), (1, 2, 7, "market_buy", None, None, None, None), (1, 2, 9, "market_sell", None, None, None, None)]
    players = spark.createDataFrame([(1, 1, 2, 1, 1_200_000, "nomad"), (1, 2, 3, 1, 1_200_000, "open"), (1, 3, 3, 1, 1_200_000, "open")], "match_id int, profile_id int, team int, civ_id int, duration_ms int, family string")
    got = {r.profile_id: r for r in e.player_metrics(spark.createDataFrame(ev, EV), players, spark.createDataFrame([], "kind string, target_id int, cost double")).collect()}
    assert got[1].vils_castle == 63 and got[1].idle_dark_ms == 300_000 - 60_000 - 3 * 25_000 - 25_000 and got[1].idle_feudal_ms == 0
    assert got[2].vils_castle == 0 and got[2].idle_dark_ms == 0 and (got[2].market_buys, got[2].market_sells) == (1, 1) and got[2].nearest_enemy is None
    assert got[1].opening is None and got[3].apm == 0 and got[3].float_rate == 0 and got[1].eco_apm == 0.25


def test_recorder_is_the_focus(spark):
    players = spark.createDataFrame([(1, 10, "Ann", 1, 2), (1, 11, "Bob", 2, 2)], "match_id int, profile_id int, name string, player_number int, recorder int")
    assert [r[1] for r in rows(e.resolve_focus(players))] == [11] and [r[1] for r in rows(e.resolve_focus(players, "aNN"))] == [10] and [r[1] for r in rows(e.resolve_focus(players, 11))] == [11]
    with pytest.raises(Exception, match="no player"):
        e.resolve_focus(players, "11").collect()


def test_opponents_and_awards_by_hand(spark):
    kinds = {"match_id": "int", "profile_id": "int", "team": "int", "castle_t": "double", "vils": "int", "castle_click": "double", "feudal_click": "double", "idle_dark_s": "double", "idle_feudal_s": "double", "apm": "double", "first_military_s": "double", "market_buys": "int", "market_sells": "int"}
    data = [
        (1, 1, 2, 900.0, 30, 740.0, 500.0, 10.0, 20.0, 5.0, None, 0, 0), (1, 2, 2, None, 99, None, 500.0, 0.0, 0.0, 5.0, 50.0, 0, 0),  # one team, two players: they face each other
        (2, 1, 2, 900.0, 30, 740.0, 500.0, 10.0, 20.0, 5.0, 9.0, 1, 1), (3, 1, 2, None, 1, None, None, 0.0, 0.0, 5.0, None, 0, 0), (3, 2, 3, 800.0, 40, 640.0, None, 0.0, 0.0, 7.0, None, 1, 0), (3, 3, None, 600.0, 20, 440.0, 1.0, 3.0, 0.0, 6.0, 7.0, 0, 1),
    ]
    metrics = spark.createDataFrame(data, ", ".join(f"{k} {v}" for k, v in kinds.items()))
    opp = {(r.match_id, r.profile_id): (r.opp_castle_t, r.opp_vils, r.opp_apm) for r in f.opponent_profile(metrics, ["castle_t", "vils", "apm"]).collect()}
    assert opp == {(1, 1): (None, None, 5.0), (1, 2): (900.0, 30.0, 5.0), (3, 1): (700.0, 30.0, 6.5), (3, 2): (600.0, 20.0, 5.5), (3, 3): (800.0, 40.0, 6.0)}
    assert sorted(rows(f.superlatives(metrics))) == [(1, "fastest_castle", 1), (1, "first_military", 2), (1, "least_idle", 1), (1, "most_villagers", 1), (3, "fastest_castle", 3), (3, "first_military", 3), (3, "highest_apm", 2), (3, "least_idle", 3), (3, "most_villagers", 2)]


def test_equal_gaps_go_to_the_first_age(spark):
    gap = spark.createDataFrame([(1, 1, *[-50.0, 60.0] * 3), (1, 2, None, None, -31.0, None, 20.0, 30.0)], "match_id int, profile_id int, " + ", ".join(f"{a}_vs_{w} double" for a in ("feudal", "castle", "imperial") for w in ("opp", "ref")))
    assert rows(f.biggest_gap(gap)) == [(1, 1, "feudal", -50.0, "feudal", 60.0), (1, 2, "castle", -31.0, None, None)]


def test_sections_by_their_own_rules(spark):
    """Bonuses come first without a header and keep their commas; only units are parted at commas."""
    from laddermill.operators import text as x

    sections = {"bonus": ((), "bullets"), "units": (("Unique Unit",), "list"), "techs": (("Unique Tech",), "effects"), "team": (("Team Bonus",), "text")}
    text = "• Farms cost 10, not 20\nplain line\nunique units:\nSamurai (infantry), Turtle Ship (war (ship))\nUnique Technologies\n• Yasama (towers shoot, more)\n• Kataparuto\nteam bonus:\ngalleys see\nfurther"
    got = rows(x.sectioned_text(spark.createDataFrame([(1, text), (2, None)], "k int, t string"), "k", "t", sections, "bonus"))
    assert [r[1:] for r in got] == [("bonus", 0, 0, "Farms cost 10, not 20", None), ("team", 8, 0, "galleys see further", None), ("techs", 5, 0, "Yasama", "towers shoot, more"), ("techs", 6, 0, "Kataparuto", None), ("units", 3, 0, "Samurai", None), ("units", 3, 1, "Turtle Ship (war (ship))", None)]


def test_kebab_by_hand(spark):
    assert column(spark, ["! abc", "a\nb", "A  b_c-d", " x ", None], "string", s.kebab) == ["abc", "a-b", "a-b_c-d", "x", None]
    assert column(spark, ["it's", "it’s", "--A.B--"], "string", lambda c: s.kebab(c, "runs")) == ["its", "it-s", "a-b"]


def test_bonuses_keep_their_order(spark):
    from laddermill.operators import text as x

    df = spark.createDataFrame([(1, [(9, 2), (4, 3), (3, 5), (9, 0)]), (2, [(3, 5)]), (3, None)], "k int, bonuses array<struct<class: int, amount: int>>")
    labels = spark.createDataFrame([(9, "ships"), (4, "camels")], "class int, label string")
    assert rows(x.bonus_string(df, labels, "k", [3])) == [(1, "+2 ships;+3 camels"), (2, None), (3, None)]


def test_quality_rules_by_hand(spark):
    """Nulls and no games pass, "and" may part a label, a counter is compared with the last one stated."""
    from laddermill.operators import quality as v

    rate = spark.createDataFrame([(1, None, None), (2, 101.0, "S"), (3, 50.0, "X"), (4, float("nan"), "A"), (5, 0.0, "D")], "k int, rate double, tier string")
    assert {(r.check, r.key) for r in v.rates(rate, "rate", "tier", F.col("k")).collect()} == {("rate_range", "2"), ("tier", "3"), ("rate_range", "4")}
    cells = spark.createDataFrame([(1, 0, 0), (2, 3, 2), (3, 0, -1)], "k int, wins int, games int")
    assert {r.key for r in v.cube(cells, {}, F.col("k")).collect()} == {"2", "3"}
    text = spark.createDataFrame([(1, "a-b", "x", "Naval and Archer", ["b"]), (2, "-a--", "x", "Naval and archer", ["b"]), (3, "a", "x", "2nd Navy", ["best calvary!"]), (4, "a", "y", "Band Calvaryman", []), (5, "A", "x", "Sandy", ["b"])], "k int, slug string, region string, label string, bonuses array<string>")
    got = {(r.check, r.key) for r in v.text_rules(text, "k", "slug", "region", "label", "bonuses", ["x"], ["Calvary"]).collect()}
    assert got == {("title", "2"), ("title", "3"), ("typo", "3"), ("region", "4"), ("bonus", "4"), ("slug", "5")}
    steps = [
        (1, 1, 5, 10, 1, "start"), (1, 2, None, None, None, "+9 → wood"), (1, 3, 8, 5, None, "+2 → gold"), (1, 4, 10, 4, 0, "+3 -> food"), (1, 5, 9, 40, 2, "a +7 → b"), (1, 6, 12, None, 1, "+1→a +2→b"), (1, 7, 13, 41, 3, "+5"),
        (2, 1, 3, 500, 4, "+3 →"), (2, 2, 3, None, None, None),
    ]
    df = spark.createDataFrame(steps, "build_id int, nth int, counter int, at_s int, phase int, text string")
    builds = spark.createDataFrame([(1, 100, 3), (2, 400, 3)], "build_id int, duration_s int, target_phase int")
    # 1/3: the step before states no counter; 1/3 and 1/4 fall behind 10 s, of which the first counts; so with phases
    assert {(r.check, r.key) for r in v.sequence(df, builds).collect()} == {("counter", "1/5"), ("delta", "1/4"), ("time", "1/3"), ("phase", "1/4"), ("length", "2"), ("target", "2")}


def test_queues_by_hand(spark):
    queue = spark.createDataFrame([(1, "error", 2, None, 5), (2, "error", 8, None, 6), (3, "error", 1, 990, 7)], "match_id int, status string, attempts int, updated_at int, played_at int")
    assert [r.match_id for r in g.take_ready(queue, 1000, 9).collect()] == [1]
    seeds = spark.createDataFrame([(1, 10, None), (1, 9, "7"), (2, 5, "1,2"), (2, 5, "1,2")], "match_id int, played_at int, profile_ids string")
    known = spark.createDataFrame([(2, 5, None, "expired", 3)], "match_id int, played_at int, profile_ids string, status string, attempts int")
    assert rows(g.seed_manifest(known, seeds)) == [(1, 9, "7", "pending", 0), (2, 5, "1,2", "pending", 3)]
    table = spark.createDataFrame([(1, "pending", 3, "old", 0, 5), (2, "pending", None, None, 1, 6)], "match_id int, status string, events int, error string, attempts int, updated_at int")
    updates = spark.createDataFrame([(1, 0, "error", None, "timeout", True), (1, 1, "parsed", 40, None, True), (1, 2, "loaded", None, None, False), (9, 0, "error", 1, None, True)], "match_id int, nth int, status string, events int, error string, attempts_inc boolean")
    assert rows(g.record_status(table, updates, 77)) == [(1, "loaded", 40, "timeout", 2, 77), (2, "pending", None, None, 1, 6)]


def test_summaries_without_ages(spark):
    pad = " " * 60
    blobs = ["{'age_stats': {'dark': {}, 'feudal': None, 'castle': {'uptime': 1.5, 'unit_counts': None}}}", "{'other': 1}", "{'age_stats': None}", "None", "{'age_stats': {'dark': 5}}", "{broken"]
    df = spark.createDataFrame([(i, 1, "Mongols!", True, b + pad) for i, b in enumerate(blobs)], "game_id int, profile_id int, civ string, won boolean, summary string")
    assert [(r.game_id, r.age, r.civ, r.uptime_ms) for r in a.explode_age_summaries(df).orderBy("game_id").collect()] == [(0, "castle", "mongols", 1500), (4, "bad", "mongols", None), (5, "bad", "mongols", None)]


def test_opening_shares_are_of_all_games(spark):
    from laddermill.operators import documents as d

    civs = spark.createDataFrame([(1, "a")], "civ_id int, slug string")
    meta = spark.createDataFrame([(1, "1v1", "all", 1000, 500, 50.0, 2000)], "civ_id int, ladder string, elo_bucket string, games bigint, wins bigint, winrate double, ladder_total_games bigint")
    none = lambda c: spark.createDataFrame([], f"civ_id int, ladder string, {c}, games bigint, winrate double")
    openings = spark.createDataFrame([(1, "1v1", "scouts", 100, 1), (1, "1v1", "archers", 40, 2)], "civ_id int, ladder string, opening_kind string, games bigint, rank int")
    ages = spark.createDataFrame([(1, "1v1", 600.5, 1100.4, 1900.6)], "civ_id int, ladder string, feudal_median double, castle_median double, imperial_median double")
    got = d.doc_civ_meta(civs, meta, none("map_id string"), none("build int"), openings, ages, spark.createDataFrame([], "build int")).first().ladders["1v1"]
    assert [tuple(o) for o in got.openings] == [("scouts", 10.0), ("archers", 4.0)] and tuple(got.age_up) == (601.0, 1100.0, 1901.0)


def test_compositions_go_by_name(spark):
    """Two units of one name count together; shares are percentages of all winners, to one decimal; ties go by name."""
    won = spark.createDataFrame([(i, 1, 7, "<1000") for i in range(3)], "match_id int, profile_id int, civ_id int, elo_bucket string")
    units = spark.createDataFrame([(0, 1, 4, 2), (1, 1, 5, 4), (1, 1, 6, 9), (2, 1, 6, 9), (2, 1, 83, 50), (2, 1, 99, 1)], "match_id int, profile_id int, unit_id int, trained int")
    names = spark.createDataFrame([(4, "Archer"), (5, "ARCHER"), (6, "Aaa"), (83, "Villager")], "unit_id int, name string")
    got = [(r.unit, r.producers, r.winners, r.share, r.trained_median, r["rank"]) for r in m.winner_comps(won, units, names, 1).orderBy("rank").collect()]
    assert got == [("aaa", 2, 3, 66.7, 9.0, 1), ("archer", 2, 3, 66.7, 3.0, 2)]
