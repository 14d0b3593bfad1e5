"""Chroma audio fingerprints.

A recording is a sequence of frames with the energy of the 12 pitch classes. Sixteen filters, log ratios of sums over
the two parts of a rectangle of an integral image, look at each window of frames; each gives one of four levels, two
bits in Gray code, so a window packs into one 32-bit integer. Recordings are aligned by a histogram of the offsets at
which they have equal integers, where a query also asks for the integers with its least certain levels moved across
their thresholds; at each such offset the share of differing bits over the whole overlap decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laddermill.llm.common import counted, materialize, ship, table

CLASSES, WIDTH = 12, 16
#: Thresholds of the log ratios, and how many of a query's least certain levels are tried on both sides.
LEVELS, UNSURE = (-0.1, 0.0, 0.1), 3
#: Half the bits of unrelated recordings differ; over n integers that share has a standard deviation of SPREAD / sqrt(n)
#: (0.046 over the 49 integers of pairs of vectors). An alignment lies SURE deviations or more below one half, where
#: chance puts 4 in 10^11, and has a bit error of MOST_ERROR at most. So overlaps below 18 integers never suffice.
SPREAD, SURE, MOST_ERROR = 0.32, 6.5, 0.18
#: Queries that meet an integer of a recording in one row.
BLOCK = 1024
_GRAY = np.array([0, 1, 3, 2], np.uint32)


def filters() -> list[tuple[int, int, int, int, int]]:
    """(kind, first class, classes, first frame, frames), by a rule: each kind over low and high classes, short and long.

    Kinds compare the two halves of a rectangle in pitch (0) or time (1), its quarters crosswise (2), or the middle
    third of its time with the rest (3).
    """
    return [(kind, 6 * high, 6, 0, WIDTH >> short) for kind in range(4) for high in range(2) for short in range(2)]


def log_ratios(frames: np.ndarray) -> np.ndarray:
    """The filters' values (recording, window, filter) of recordings of one length (recording, frame, class)."""
    n = frames.shape[1] - WIDTH + 1
    image = np.zeros((len(frames), frames.shape[1] + 1, CLASSES + 1))
    image[:, 1:, 1:] = np.cumsum(np.cumsum(frames, axis=1), axis=2)

    def total(c: int, dc: int, t: int, dt: int) -> np.ndarray:
        late, early = image[:, t + dt : t + dt + n], image[:, t : t + n]
        return late[:, :, c + dc] - early[:, :, c + dc] - late[:, :, c] + early[:, :, c]

    out = []
    for kind, c, dc, t, dt in filters():
        whole = total(c, dc, t, dt)
        if kind == 0:
            part = total(c, dc // 2, t, dt)
        elif kind == 1:
            part = total(c, dc, t, dt // 2)
        elif kind == 2:
            part = total(c, dc // 2, t, dt // 2) + total(c + dc // 2, dc - dc // 2, t + dt // 2, dt - dt // 2)
        else:
            part = total(c, dc, t + dt // 4, dt // 2)
        out.append(np.log(np.maximum(part, 1e-9)) - np.log(np.maximum(whole - part, 1e-9)))
    return np.stack(out, axis=-1)


def packed(levels: np.ndarray) -> np.ndarray:
    """One integer of the levels along the last axis."""
    shifts = np.arange(2 * levels.shape[-1] - 2, -1, -2, dtype=np.uint32)
    return (_GRAY[levels] << shifts).sum(axis=-1, dtype=np.uint32)


def fingerprint(frames: np.ndarray) -> np.ndarray:
    """The integers of a recording, frames of 12 energies; fewer than WIDTH frames: none."""
    return packed(np.digitize(log_ratios(frames[None]), LEVELS))[0] if len(frames) >= WIDTH else np.zeros(0, np.uint32)


def probes(values: np.ndarray, unsure: int = UNSURE) -> np.ndarray:
    """The integers to ask for, in each window 2 ** unsure: the nearest levels moved across their thresholds or not."""
    levels = np.digitize(values, LEVELS)
    away = np.abs(values[..., None] - np.array(LEVELS))
    edge = away.argmin(axis=-1)
    weak = np.argsort(away.min(axis=-1), axis=-1, kind="stable")[..., :unsure]
    out = []
    for which in range(1 << unsure):
        moved = levels.copy()
        for bit in range(unsure):
            if which >> bit & 1:
                at = weak[..., bit : bit + 1]
                near = np.take_along_axis(edge, at, -1)
                np.put_along_axis(moved, at, np.where(np.take_along_axis(levels, at, -1) <= near, near + 1, near), -1)
        out.append(packed(moved))
    return np.stack(out, axis=-1)


def fingerprints(recordings: DataFrame, unsure: int | None = None) -> DataFrame:
    """rec_id, prints array<long> of recordings (rec_id, frames: all energies in a row, 12 a frame).

    With `unsure`, prints holds for each window all integers to ask for, one window after the other. Null energies count
    as 0, an incomplete last frame is left out; null or short frames give no integers.
    """
    ship(recordings.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first in range(0, b.num_rows, 256):
                part = b.slice(first, 256)
                sizes = part.column(1).value_lengths().fill_null(0).to_numpy()
                values = np.nan_to_num(part.column(1).flatten().to_numpy(zero_copy_only=False))
                begins, n_frames = np.cumsum(sizes) - sizes, sizes // CLASSES
                found: list[np.ndarray] = [np.zeros(0, np.int64)] * part.num_rows
                for n in np.unique(n_frames[n_frames >= WIDTH]).tolist():  # recordings of one length are worked on together
                    which = np.flatnonzero(n_frames == n)
                    ratios = log_ratios(values[begins[which, None] + np.arange(n * CLASSES)].reshape(-1, n, CLASSES))
                    ints = packed(np.digitize(ratios, LEVELS)) if unsure is None else probes(ratios, unsure)
                    for i, x in zip(which.tolist(), ints.reshape(len(which), -1).astype(np.int64), strict=True):
                        found[i] = x
                places = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate(found)))], ["rec_id", "prints"])

    return recordings.select(F.col("rec_id").cast("long").alias("rec_id"), F.col("frames").cast("array<double>").alias("frames")).mapInArrow(run, "rec_id bigint, prints array<bigint>")


def align(recordings: DataFrame, queries: DataFrame, sure: float = SURE, most_error: float = MOST_ERROR, unsure: int = UNSURE) -> DataFrame:
    """The recordings that align with a query's recording: rec_id, class_id, n_queries, and of the best of them query_id,
    offset, votes, overlap, bit_error.

    recordings: rec_id, frames; queries: rec_id. Recordings with equal integers are one class, named by its smallest id,
    and aligned as one; query_id is such a name, and n_queries counts them. offset: where the query's first integer
    falls in the other recording. An offset needs a vote, an integer of the query, or of its probes, at the same place;
    then the bits that differ in the overlap decide (see SURE). Of the offsets of a pair that pass, the one with most
    votes counts, then the smallest. Best: least bit error, then most votes, then the smallest id. A null id or a
    recording without integers is aligned with nothing; a class is not aligned with itself: `matches` adds that.
    Recordings that repeat an id count once; other columns are ignored.
    """
    prints = classes(recordings)
    per = _aligned_classes(prints, asked_for(recordings, queries, prints, unsure), sure, most_error)
    return _listed(prints.select("rec_id", "class_id").join(per, "class_id"))


def matches(recordings: DataFrame, queries: DataFrame, sure: float = SURE, most_error: float = MOST_ERROR, unsure: int = UNSURE) -> DataFrame:
    """What `align` returns, and every recording whose integers equal those of a query other than itself.

    Such a recording, however short, aligns with its own class at offset 0 with all its integers and no bit error; that
    class counts in n_queries.
    """
    prints = classes(recordings)
    per = _aligned_classes(prints, asked_for(recordings, queries, prints, unsure), sure, most_error)
    asked = prints.select("rec_id", "class_id").join(queries.select("rec_id").distinct(), "rec_id", "left_semi")
    members = prints.select("rec_id", "class_id", F.size("prints").alias("n")).join(asked.select("rec_id", F.lit(1).alias("is_query")), "rec_id", "left")
    members = members.join(asked.groupBy("class_id").agg(F.count(F.lit(1)).alias("in_class")), "class_id", "left").join(per, "class_id", "left")
    n = F.col("n").cast("long")
    same = F.coalesce("in_class", F.lit(0)) > F.coalesce("is_query", F.lit(0))
    own = F.when(same, F.struct(F.lit(0.0).alias("bit_error"), (-n).alias("fewest"), F.col("class_id").alias("query_id"), F.lit(0).alias("offset"), F.col("n").alias("overlap")))
    found = members.withColumn("n_queries", F.coalesce("n_queries", F.lit(0)) + same.cast("long")).filter("n_queries > 0")
    return _listed(found.withColumn("b", F.when(F.col("b").isNull() | (same & (own < F.col("b"))), own).otherwise(F.col("b"))))


def asked_for(recordings: DataFrame, queries: DataFrame, prints: DataFrame, unsure: int = UNSURE) -> DataFrame:
    """query_id (a class that holds a query), query_prints, and probes of its query with the smallest id."""
    own = recordings.join(queries.select("rec_id").distinct(), "rec_id", "left_semi")
    known = fingerprints(own, unsure).withColumnRenamed("prints", "probes").join(prints, "rec_id")
    return known.groupBy(F.col("class_id").alias("query_id")).agg(F.min_by("prints", "rec_id").alias("query_prints"), F.min_by("probes", "rec_id").alias("probes"))


def dealt(asked: DataFrame) -> DataFrame:
    """asked (query_id, ...) with block and nth, its number there: some BLOCK queries are a block."""
    block = F.pmod(F.xxhash64("query_id"), F.lit(-(-asked.count() // BLOCK) or 1))
    return asked.withColumn("block", block).withColumn("nth", F.row_number().over(Window.partitionBy("block").orderBy("query_id")).cast("long"))


def meetings(asked: DataFrame, ones: DataFrame) -> DataFrame:
    """rec_id, block, at array<long>: for each integer of a recording, the places of a block's queries that ask for it.

    asked: block, nth, query_prints, probes; ones: rec_id, prints. An integer that many recordings and many queries share
    makes a row for each recording and block. A place holds nth in its upper 32 bits, the offset plus 2 ** 31 in the others.
    """
    at = ones.select("rec_id", F.posexplode("prints").alias("at", "print"))
    each = asked.select("block", "nth", (F.size("probes") / F.size("query_prints")).cast("int").alias("each"), F.posexplode("probes").alias("probe", "print"))
    place = F.shiftleft("nth", 32) + F.lit(1 << 31) - F.floor(F.col("probe") / F.col("each"))
    lists = each.groupBy("print", "block").agg(F.collect_list(place).alias("places"))
    return at.join(lists, "print").select("rec_id", "block", F.transform("places", lambda p: p + F.col("at")).alias("at"))


def votes(asked: DataFrame, ones: DataFrame) -> DataFrame:
    """block, nth, rec_id, offset, votes: at how many places a recording has an integer that the query asks for there."""
    found = meetings(asked, ones).groupBy("rec_id", "block").agg(counted(F.flatten(F.collect_list("at"))).alias("found"))
    each = found.select("rec_id", "block", F.explode("found").alias("f"))
    offset = F.col("f.value").bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(1 << 31)
    return each.select("block", F.shiftright("f.value", 32).alias("nth"), "rec_id", offset.cast("int").alias("offset"), F.col("f.n").cast("long").alias("votes"))


def _aligned_classes(prints: DataFrame, asked: DataFrame, sure: float, most_error: float) -> DataFrame:
    """class_id, n_queries, b (the best) of the classes that align with another class that holds a query."""
    asked = materialize(dealt(asked), "asked")
    ones = prints.filter("rec_id = class_id").select(F.col("class_id").alias("rec_id"), "prints")
    both = votes(asked, ones).join(asked.drop("probes"), ["block", "nth"]).filter("query_id <> rec_id").join(ones, "rec_id")
    start, other = F.greatest(-F.col("offset"), F.lit(0)), F.greatest(F.col("offset"), F.lit(0))
    both = both.withColumn("overlap", F.least(F.size("query_prints") - start, F.size("prints") - other))
    limit = F.least(F.lit(most_error), 0.5 - sure * SPREAD / F.sqrt("overlap"))
    pairs = F.zip_with(F.slice("query_prints", start + 1, F.col("overlap")), F.slice("prints", other + 1, F.col("overlap")), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    error = F.aggregate(pairs, F.lit(0), lambda a, x: a + x) / (F.col("overlap") * 32)
    linked = both.filter(limit >= 0).withColumn("bit_error", F.round(error, 6)).filter(F.col("bit_error") <= limit)
    best = linked.groupBy("query_id", "rec_id").agg(F.max(F.struct("votes", (-F.col("offset")).alias("least"), "overlap", "bit_error")).alias("o"))
    top = F.min(F.struct(F.col("o.bit_error").alias("bit_error"), (-F.col("o.votes")).alias("fewest"), "query_id", (-F.col("o.least")).alias("offset"), F.col("o.overlap").alias("overlap")))
    return best.groupBy("rec_id").agg(F.count(F.lit(1)).alias("n_queries"), top.alias("b")).withColumnRenamed("rec_id", "class_id")


def _listed(found: DataFrame) -> DataFrame:
    return found.select("rec_id", "class_id", "n_queries", "b.query_id", F.col("b.offset").cast("long").alias("offset"), (-F.col("b.fewest")).alias("votes"), F.col("b.overlap").cast("long").alias("overlap"), "b.bit_error")


def classes(recordings: DataFrame) -> DataFrame:
    """rec_id, class_id (the smallest rec_id with equal integers), prints; recordings without integers are left out."""
    prints = fingerprints(recordings.filter("rec_id is not null").dropDuplicates(["rec_id"])).filter("size(prints) > 0")
    prints = materialize(prints.withColumn("name", F.sha2(F.array_join("prints", ","), 256)), "fingerprints")
    least = prints.groupBy("name").agg(F.min("rec_id").alias("class_id"))
    return materialize(prints.join(least, "name").select("rec_id", "class_id", "prints"), "classes")


def as_recordings(embeddings: DataFrame) -> DataFrame:
    """The vectors as short looped recordings: class c of frame i has the magnitude of value i + 5 c, modulo the length.

    A shift of the vector is a shift in time, and the classes of a frame are far enough apart to be independent."""
    n = F.size("embedding")
    frames = F.transform(F.sequence(F.lit(0), n * CLASSES - 1), lambda k: F.abs(F.get("embedding", ((F.floor(k / CLASSES) + 5 * (k % CLASSES)) % n).cast("int")).cast("double")))
    return embeddings.select(F.col("vec_id").alias("rec_id"), F.when(n >= CLASSES, frames).alias("frames"))


def op8_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    recordings = materialize(as_recordings(table(spark, sf_dir, "embeddings")), "recordings")
    return matches(recordings, recordings.filter("rec_id % 50 = 0"))


QUERIES = {"op8_chroma": op8_chroma}
ORACLE: dict[str, str] = {}
