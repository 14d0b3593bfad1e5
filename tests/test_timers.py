"""Timers of the retry stream beside the batch rule at each clock."""

import datetime

from laddermill.operators import ingest as g
from laddermill.streaming import streams

UTC = datetime.timezone.utc


def at(seconds):
    return datetime.datetime.fromtimestamp(1_700_000_000 + seconds, UTC)


def test_timers_give_what_the_queue_gives(spark, tmp_path):
    """At each batch the stream has emitted what take_ready finds at its clock, without events of those matches.

    A wait that a later failure in the same batch cuts short is not emitted.
    """
    batches = [[(1, 0), (2, 10), (3, 0), (3, 5)], [(1, 1000), (9, 2000)], [(9, 9000)], [(9, 40_000)]]
    batches[0] += [(4, i) for i in range(8)]  # given up
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.ROCKSDB)
    try:
        failures, emitted = [], set()
        for rows in batches:
            spark.createDataFrame([(m, at(s)) for m, s in rows], "match_id bigint, failed_at timestamp").coalesce(1).write.mode("append").parquet(source)
            found = streams.run(streams.ready_by_timer(streams.source(spark, source, None), late="0 seconds", forget_s=20_000), out, f"{out}-checkpoint")
            failures += rows
            clock = max(s for _, s in failures)
            manifest = [(m, "error", sum(x == m for x, _ in failures), max(s for x, s in failures if x == m), 0) for m in {m for m, _ in failures}]
            ready = g.take_ready(spark.createDataFrame(manifest, "match_id bigint, status string, attempts int, updated_at int, played_at int"), clock, 100)
            emitted = {(r.match_id, r.attempts, round(r.ready_at.replace(tzinfo=UTC).timestamp() if r.ready_at.tzinfo is None else r.ready_at.timestamp()) - 1_700_000_000) for r in found.collect()}
            last = {m: (n, s) for m, _, n, s, _ in manifest}
            want = {m for m, in ready.select("match_id").collect()}
            assert {m for m, n, _ in emitted if n == last[m][0]} == want, (clock, emitted, want)
            assert all(s == last[m][1] + 60 * 2 ** min(n, 6) for m, n, s in emitted if n == last[m][0])
        assert 4 not in {m for m, _, _ in emitted} and {(1, 2, 1240), (2, 1, 130), (3, 2, 245)} <= emitted and (1, 1, 120) not in emitted
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)


def test_matches_of_a_bucket_wake_each_at_its_own_time(spark, tmp_path):
    """All matches in one bucket: one key in the state, and the same rows as with a bucket for each."""
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", streams.ROCKSDB)
    found = {}
    try:
        for buckets in (1, 4096):
            source, out = str(tmp_path / f"in{buckets}"), str(tmp_path / f"out{buckets}")
            for rows in ([(1, 0), (2, 10), (3, 0), (3, 5), *((4, i) for i in range(8))], [(1, 1000), (9, 2000)], [(9, 9000), (None, 9000)], [(9, 40_000)]):
                spark.createDataFrame([(m, at(s)) for m, s in rows], "match_id bigint, failed_at timestamp").coalesce(1).write.mode("append").parquet(source)
                got = streams.run(streams.ready_by_timer(streams.source(spark, source, None), late="0 seconds", forget_s=20_000, buckets=buckets), out, f"{out}-checkpoint")
            found[buckets] = sorted((str(r.match_id), r.attempts, str(r.ready_at)) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    assert found[1] == found[4096] and {("None", 1), ("9", 2), ("1", 2)} <= {x[:2] for x in found[1]}
