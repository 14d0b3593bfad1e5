"""The batch policies as Structured Streaming: ingest, deduplication, counts a minute and retries.

Late data: rows later than the watermark are dropped. Every stream here is bounded by availableNow and can be resumed
from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laddermill.operators.ingest import BACKOFF_S, MAX_ATTEMPTS, MAX_DOUBLINGS
from laddermill.sources.targets import Target


def source(spark: SparkSession, path: str, files_per_trigger: int | None = 2) -> DataFrame:
    """A folder of Parquet files as a stream; the schema is that of the files there.

    None: all files that are there are one batch. A backlog whose files are in no order of time needs that under a
    watermark, which would otherwise pass the later files' rows by.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def run(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(out)


def ingest(spark: SparkSession, path: str, target: str, checkpoint: str, policy: str = "skip", buckets: int = 8, files_per_trigger: int = 2) -> DataFrame:
    """Takes matches in batch by batch and returns what then counts. skip: the first writer of a match wins. upgrade: a
    replay also takes the place of an archive match; replays stay.

    The target (sources/targets.py) is bucketed by match, a batch that runs again changes nothing, and layers are merged
    as they come, so that files grow with the logarithm of the batches.
    """
    stream = source(spark, path, files_per_trigger)
    held = Target(spark, target, {"matches": stream.schema}, buckets=buckets)
    better = "source = 'replay'" if policy == "upgrade" else None

    def write(batch: DataFrame, number: int) -> None:
        held.upsert({"matches": batch}, policy, better=better, order=["played_at", "build"], source=checkpoint, number=number)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return held.read()["matches"]


def dedup(stream: DataFrame, key: str, time: str, within: str = "60 days") -> DataFrame:
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark([key])


def commands_per_minute(stream: DataFrame, time: str, late: str = "10 minutes") -> DataFrame:
    """Commands of each user in each minute, emitted once a row that is `late` or more after the minute's end has come.

    So a source that ends needs a closing row that is later than all others by more than that; its own minute is never
    emitted. (A filter on the user here would reach the source before the watermark and take the closing row away.)
    """
    counted = stream.withWatermark(time, late).groupBy(F.window(time, "1 minute"), "user_id").agg(F.count(F.lit(1)).alias("commands"))
    return counted.select(F.col("window.start").alias("minute"), "user_id", "commands")


def retries(stream: DataFrame) -> DataFrame:
    """Failed attempts per match as keyed state: after each, when to try next, or null when given up.

    stream: match_id, failed_at (seconds)."""
    # the state is a count and a maximum, which Spark keeps itself
    per = stream.groupBy("match_id").agg(F.count(F.lit(1)).cast("int").alias("attempts"), F.greatest(F.max("failed_at"), F.lit(0)).cast("long").alias("last"))
    wait = F.when(F.col("attempts") < MAX_ATTEMPTS, F.col("last") + BACKOFF_S * F.pow(F.lit(2), F.least("attempts", F.lit(MAX_DOUBLINGS))).cast("long"))
    return per.select(F.col("match_id").cast("long").alias("match_id"), "attempts", wait.alias("next_at"))


#: The state store that keeps timers.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ready_by_timer(stream: DataFrame, time: str = "failed_at", late: str = "10 minutes", forget_s: int = 7 * 86_400, buckets: int = 4096) -> DataFrame:
    """Matches that may be tried again, emitted once their wait is over by the clock of the stream, without an event of theirs.

    stream: match_id, and the time of a failed attempt. A failure sets the match's timer anew, to what `take_ready` waits
    after so many attempts; at MAX_ATTEMPTS the match is given up and has none. State is dropped forget_s after the last
    failure. Rows: match_id, attempts, ready_at. The clock is the watermark, `late` behind the latest failure of any match.

    Matches share their state and timer with those of their bucket, as each call to the store costs about as much as
    hundreds of matches; some hundred of them in a bucket are best. A checkpoint goes with its number of buckets.
    """
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    base, most, doublings = BACKOFF_S, MAX_ATTEMPTS, MAX_DOUBLINGS

    class Retry(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("failures", "ids array<bigint>, attempts array<int>, last_ms array<bigint>, wake_ms array<bigint>, timer bigint")

        def _load(self) -> tuple[dict, int | None]:
            found = self.state.get()
            return ({m: (n, last, wake) for m, n, last, wake in zip(*found[:4], strict=True)}, found[4]) if found else ({}, None)

        def _keep(self, matches: dict, timer: int | None) -> None:
            """Keeps the matches, and a timer for the first of them to wake."""
            if not matches:
                self.state.clear()
                return
            wake = min(w for _, _, w in matches.values())
            if timer is not None and timer != wake:
                self.handle.deleteTimer(timer)
            if timer != wake:
                self.handle.registerTimer(wake)
            columns = [list(x) for x in zip(*matches.values(), strict=True)]
            self.state.update((list(matches), *columns, wake))

        def handleInputRows(self, key, rows, timerValues):
            matches, timer = self._load()
            for r in rows:
                attempts, last, _ = matches.get(r.match_id, (0, 0, None))
                attempts, last = attempts + 1, max(last, r.at_ms)
                matches[r.match_id] = (attempts, last, last + 1000 * (forget_s if attempts >= most else base * 2 ** min(attempts, doublings)))
            self._keep(matches, timer)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            matches, _ = self._load()
            now, ready = timerValues.getCurrentWatermarkInMs(), []
            for m, (attempts, last, wake) in list(matches.items()):
                gone = last + 1000 * forget_s
                if wake > now:
                    continue
                if wake >= gone:
                    del matches[m]
                else:
                    ready.append(Row(match_id=m, attempts=attempts, ready_ms=wake))
                    matches[m] = (attempts, last, gone)
            self._keep(matches, None)
            return iter(ready)

        def close(self) -> None:
            pass

    timed = stream.withWatermark(time, late).select("match_id", time, F.unix_millis(time).alias("at_ms"))
    found = timed.withColumn("_bucket", F.pmod(F.xxhash64("match_id"), F.lit(buckets))).groupBy("_bucket").transformWithState(Retry(), "match_id bigint, attempts int, ready_ms bigint", "append", "EventTime")
    return found.select("match_id", "attempts", F.timestamp_millis("ready_ms").alias("ready_at"))
