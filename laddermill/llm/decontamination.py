"""Benchmark decontamination by a prefix-filtered set join.

A window is ten words in a row of a benchmark item; a document holds it if all its shingles (five words in a row) occur
there in order. A document that holds a window shares every shingle with it, so one of them is enough to find it: the
prefix of a window is its rarest shingle. Shingles are put in order by how often suspicious passages have them, prefixes
are joined with the places of equal shingles, the place and the lengths bound where a window can lie, and its words are
compared one by one.

Suspicious passages are stretches of words all of whose shingles may belong to an item, by a bitmap of hashes whose size
is fixed however long the benchmark is: a full bitmap lets more through, and loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laddermill.llm import textcore as tc
from laddermill.llm.common import let, materialize, ship, table

WINDOW, SHINGLE = 10, 5
#: Bits of the bitmap as a power of two: 8 MB, whatever the benchmark's size.
FILTER_BITS = 26
#: Bytes of prefixes up to which they are broadcast; beyond, the join is a shuffle.
BROADCAST_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Bytes of words as they are, A-Z as a-z, all others as blanks.
_PLAIN = np.full(256, 0x20, np.uint8)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _PLAIN[_first : _last + 1] = np.arange(_first, _last + 1)
_PLAIN[0x41:0x5B] += 0x20


def item_words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id (as a string), window (its words joined by blanks), n (how many): each once; an item without words has none."""
    cut = lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - window, F.lit(0))), lambda i: F.slice(w, i + 1, window))
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.explode(let(item_words(F.col("text")), cut)).alias("w"))
    return rows.filter(F.size("w") > 0).select("item_id", F.array_join("w", " ").alias("window"), F.size("w").alias("n")).distinct()


def gram_keys(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k words in a row that differs between sizes."""
    return tc.mix(tc.gram_hashes(hashes, k) + np.uint64(k))


def _probes(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (keys & mask).astype(np.int64), ((keys >> np.uint64(64 - bits)) & mask).astype(np.int64)


def bitmap(windows: DataFrame, shingle: int, bits: int) -> np.ndarray:
    """The bits of all shingles of the windows; at most 2 ** bits / 64 rows reach the driver."""
    ship(windows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk in tc.chunks(b.column(0)):
                starts, ends, borders = tc.word_bounds(chunk)
                hashes = tc.word_hashes(chunk, starts, ends)
                found = [_probes(gram_keys(hashes[i:j], min(shingle, j - i)), bits) for i, j in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]
                at = np.unique(np.concatenate([x for pair in found for x in pair]))
                yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], ["slot", "bit"])

    rows = windows.select("window").mapInArrow(run, "slot bigint, bit bigint").groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), np.int64)
    words[rows["slot"].to_numpy()] = rows["bits"].to_numpy()
    return words.view(np.uint8)


def suspects(docs: DataFrame, held: np.ndarray, needs: dict[int, int], bits: int) -> DataFrame:
    """One row per row of docs: row (unique), doc_id, n_words, and the suspicious words (words) with their numbers (at).

    needs: for each size of shingles how many in a row a window has at least.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            for chunk in tc.chunks(b.column(1)):
                chunk = tc.Chunk(chunk.rows, _PLAIN[chunk.data], chunk.borders)
                starts, ends, borders = tc.word_bounds(chunk)
                hashes = tc.word_hashes(chunk, starts, ends)
                left = np.repeat(borders[1:], np.diff(borders)) - np.arange(len(hashes))
                step = np.zeros(len(hashes) + 1, np.int32)
                for k, need in needs.items():
                    one, two = _probes(gram_keys(hashes, k), bits)
                    hit = np.flatnonzero((known[one >> 3] >> (one & 7)) & (left[: len(one)] >= k))
                    hit = hit[(known[two[hit] >> 3] >> (two[hit] & 7)) & 1 == 1]
                    if len(hit):
                        new = np.flatnonzero(np.concatenate(([True], np.diff(hit) > 1)))
                        sizes = np.diff(np.append(new, len(hit)))
                        new, sizes = hit[new[sizes >= need]], sizes[sizes >= need]
                        np.add.at(step, new, 1)
                        np.add.at(step, new + sizes + k - 1, -1)
                at = np.flatnonzero(np.cumsum(step[:-1]) > 0)
                sizes = ends[at] - starts[at]
                first = np.append(0, np.cumsum(sizes))
                letters = chunk.data[np.arange(int(first[-1])) - np.repeat(first[:-1] - starts[at], sizes)]
                words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(first.astype(np.int64)), pa.py_buffer(letters)).cast(pa.string())
                cuts = pa.array(np.searchsorted(at, borders), pa.int32())
                of = np.searchsorted(borders, at, "right") - 1
                lo, hi = chunk.rows
                columns = [b.column(0).slice(lo, hi - lo), pa.array(np.diff(borders), pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(at - borders[of], pa.int32())), pa.ListArray.from_arrays(cuts, words)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "at", "words"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_words bigint, at array<int>, words array<string>")
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "suspects")


def _grams(at: Column, words: Column, k: int, extra) -> Column:
    """An array with one struct for each k suspicious words in a row: their gram, and what extra(place in the arrays) adds."""
    many = F.size(at) - k
    every = F.when(many >= 0, F.transform(F.sequence(F.lit(0), many), lambda i: F.when(F.get(at, i + k - 1) - F.get(at, i) == k - 1, F.struct(F.array_join(F.slice(words, i + 1, k), " ").alias("gram"), *extra(i)))))
    return F.filter(F.coalesce(every, F.array()), lambda x: x.isNotNull())


def prefixes(windows: DataFrame, found: DataFrame, shingle: int, sizes: list[int]) -> DataFrame:
    """window, n, gram, offset: each window that may occur by the rarest of its shingles; found: suspects."""
    counts = found.filter(F.size("at") > 0).select(F.explode(F.concat(*(_grams(F.col("at"), F.col("words"), k, lambda i: []) for k in sizes))).alias("x")).groupBy("x.gram").agg(F.count(F.lit(1)).alias("seen"))
    k = F.least(F.col("n"), F.lit(shingle))
    cut = lambda w: F.transform(F.sequence(F.lit(0), F.col("n") - k), lambda i: F.array_join(F.slice(w, i + 1, k), " "))
    grams = windows.select("window", "n", F.posexplode(let(F.split("window", " "), cut)).alias("offset", "gram"))
    rarest = grams.join(counts, "gram", "left").groupBy("window", "n").agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "gram", "offset")).alias("p"))
    return rarest.filter("p.seen > 0").select("window", "n", "p.gram", "p.offset")


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, bits: int = FILTER_BITS, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of docs (row, doc_id, n_words), where they hold windows (row, start, n, window), and whose windows these are (item_id, window).

    start: the number of the window's first word in its document, from 0.
    """
    held = materialize(item_windows(benchmark, window), "item-windows")
    windows = held.select("window", "n").distinct()
    least = {r.k: r.need for r in windows.groupBy(F.least("n", F.lit(shingle)).alias("k")).agg((F.min("n") - F.first(F.least("n", F.lit(shingle))) + 1).alias("need")).collect()}  # as many rows as sizes up to `shingle`
    found = suspects(docs, bitmap(windows, shingle, bits), least, bits)
    rows = found.select("row", "doc_id", "n_words")
    if not least:
        return rows, found.select("row", F.lit(0).alias("start"), F.lit(0).alias("n"), F.lit("").alias("window")).limit(0), held
    prefix = materialize(prefixes(windows, found, shingle, [*least]), "prefixes")

    def around(k: int):
        """The words that a window which holds the k words at i may have, and their numbers."""
        low = lambda i: F.greatest(i - (window - k), F.lit(0))
        return lambda i: [(i - low(i)).alias("lead"), *(F.slice(c, low(i) + 1, i - low(i) + window).alias(c) for c in ("at", "words"))]

    each = found.filter(F.size("at") > 0).select("row", F.inline(F.concat(*(_grams(F.col("at"), F.col("words"), k, around(k)) for k in least))))
    few = (prefix.agg(F.sum(F.octet_length("window") + F.octet_length("gram") + 64)).first()[0] or 0) <= broadcast_bytes
    first = F.col("lead") - F.col("offset")
    start = F.get("at", first)
    fits = (first >= 0) & (first + F.col("n") <= F.size("at"))
    same = (F.get("at", first + F.col("n") - 1) - start == F.col("n") - 1) & (F.array_join(F.slice("words", F.greatest(first, F.lit(0)) + 1, F.col("n")), " ") == F.col("window"))
    places = each.join(F.broadcast(prefix) if few else prefix, "gram").filter(fits & same).select("row", start.alias("start"), "n", "window")
    return rows, materialize(places, "places"), held


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    benchmark: item_id, text. A null text has no words, and an item without words has no windows. Each row of docs is
    judged by itself, whether its doc_id is null, repeated or neither. Rows that repeat an item_id are one item, which has
    the windows of all of them; windows of a row with a null item_id hit, and name no item. Other columns are ignored. No
    documents: no rows; no items: nothing is hit.
    """
    rows, places, held = occurrences(docs, benchmark, **options)
    ends = F.aggregate(F.array_sort(F.collect_list(F.struct("start", "n"))), F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("end")), lambda a, x: F.struct((a["hit"] + F.greatest(x["start"] + x["n"] - F.greatest(a["end"], x["start"]), F.lit(0))).alias("hit"), F.greatest(a["end"], x["start"] + x["n"]).alias("end")))
    hits = places.groupBy("row").agg(ends["hit"].alias("n_hit"))
    items = places.select("row", "window").distinct().join(held.select("window", "item_id"), "window").groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    joined = rows.join(hits, "row", "left").join(items, "row", "left")
    n_hit, listed = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the documents that hold a window; rows with a null doc_id stay."""
    gone = contamination(docs, benchmark, **options).filter("contaminated and doc_id is not null").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op11_decontaminate": op11_decontaminate}

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}')"
ORACLE = {
    "op11_decontaminate": rf"""
with d as (select row_number() over () rid, doc_id, {_WORDS} w from documents),
     windows as (select distinct item_id, unnest(list_transform(range(0, greatest(len(w) - {WINDOW}, 0) + 1), lambda i: w[i + 1 : i + {WINDOW}])) g
                 from (select item_id, {_WORDS} w from benchmark) where len(w) > 0),
     grams as (select rid, unnest(range(0, len(w) - l + 1)) start, l, unnest(list_transform(range(0, len(w) - l + 1), lambda i: w[i + 1 : i + l])) g
               from d, (select distinct len(g) l from windows) where len(w) >= l),
     found as (select rid, start, l, item_id from grams join windows using (g)),
     hit as (select rid, count(distinct p) n_hit from (select rid, unnest(range(start, start + l)) p from (select distinct rid, start, l from found)) group by rid),
     items as (select rid, count(*) n_items, string_agg(i, ',' order by i) listed from (select distinct rid, cast(item_id as varchar) i from found) group by rid)
select doc_id, len(w) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(listed, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join hit using (rid) left join items using (rid)
"""
}
