"""Near-duplicate documents by MinHash.

One permutation hashing: a document's shingle hashes are dealt into bins and each bin keeps its least; an empty bin
takes the value of the first full bin in a random order of its own (optimal densification). Bands of bins name buckets.
In each bucket every member is compared with one centre only, a star, so pairs grow with the members and not with
their square; links are confirmed on the full shingle sets. Documents with equal sets are one node throughout.

The centre is the member with the most company over all its buckets, which is the text that copies derive from.
The members of buckets that the stars leave in several components are joined exactly across components, by the rarest
shingles of each set: whatever the stars did not compare is compared there, or has too little in common by a bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from laddermill.llm import textcore as tc
from laddermill.llm.common import materialize, semi_by_id, ship, table
from laddermill.llm.components import components

SHINGLE, PERCENT = 4, 80
BINS, ROWS = 128, 4
_ORDERS = np.argsort(np.random.default_rng(7).random((BINS, BINS)), axis=1)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, ascending; A-Z count as a-z. Fewer words than `size` make one shingle."""
    for chunk in tc.chunks(column):
        starts, ends, borders = tc.word_bounds(chunk)
        words = tc.word_hashes(chunk, starts, ends, lower=True)
        grams = tc.gram_hashes(words, size)
        for lo, hi in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            if hi - lo >= size:
                yield np.unique(grams[lo : hi - size + 1])
            else:
                yield tc.gram_hashes(words[lo:hi], hi - lo) + np.uint64(hi - lo) if hi > lo else words[:0]


def signature(hashes: np.ndarray) -> np.ndarray:
    """The bins of ascending hashes: each its least hash, or for an empty bin that of the first full one in its order."""
    bins = (hashes >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    full = np.zeros(BINS, bool)
    values = np.zeros(BINS, np.uint64)
    full[bins[first]], values[bins[first]] = True, hashes[first]
    if len(first) < BINS:
        empty = np.flatnonzero(~full)
        orders = _ORDERS[empty]
        values[empty] = values[orders[np.arange(len(empty)), np.argmax(full[orders], axis=1)]]
    return values


def signatures(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (hashes of the whole set), bands (bucket names). No words: 0, null, null, []."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, weights = BINS // ROWS, tc._FACTORS[8 : 8 + ROWS]
        for b in batches:
            n, one, two, bands, ends = [], [], [], [], [0]
            for s in shingle_sets(b.column(1), shingle):
                n.append(len(s))
                if len(s):
                    one.append(int(tc.mix(s + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)))
                    two.append(int(np.bitwise_xor.reduce(tc.mix(s ^ np.uint64(0x5BD1E995))).view(np.int64)))
                    values = (signature(s).reshape(rows, ROWS) * weights).sum(axis=1, dtype=np.uint64)
                    bands.append(tc.mix(values + np.arange(1, rows + 1, dtype=np.uint64) * tc._ODD).view(np.int64))
                else:
                    one.append(None)
                    two.append(None)
                ends.append(ends[-1] + (rows if len(s) else 0))
            flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
            listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), listed], ["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_col).mapInArrow(run, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>")


def confirmed(pairs: DataFrame, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Those pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union; docs: doc_id, text.

    A doc_id with several texts has several sets; one similar pair of them is enough, and may give its link repeatedly.
    """
    ship(docs.sparkSession)
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = semi_by_id(docs.select("doc_id", "text"), ids, "doc_id")
    joined = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    joined = joined.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, kept = None, None
        for b in batches:
            good = []
            for i, s in enumerate(shingle_sets(b.column(2), shingle)):
                if (text := b.column(3)[i].as_py()) != last:  # the pairs come sorted by b
                    last, kept = text, next(shingle_sets(b.column(3).slice(i, 1), shingle))
                both = len(np.intersect1d(s, kept, assume_unique=True))
                good.append(len(s) > 0 and 100 * both >= percent * (len(s) + len(kept) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return joined.mapInArrow(run, "a bigint, b bigint")


def shingle_rows(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """rep, version, n, gram: one row for each distinct shingle hash of each text (rep, version, text); n: the set's size."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first in range(0, b.num_rows, 256):
                part = b.slice(first, 256)
                sets = list(shingle_sets(part.column(2), shingle))
                sizes = np.array([*map(len, sets)], np.int64)
                columns = [np.repeat(part.column(k).to_numpy(), sizes) for k in (0, 1)] + [np.repeat(sizes, sizes), np.concatenate(sets).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["rep", "version", "n", "gram"])

    return docs.select("rep", "version", "text").mapInArrow(run, "rep bigint, version bigint, n bigint, gram bigint")


def crossing_pairs(placed: DataFrame, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Pairs (a < b) of different components that can be similar enough; placed: rep, component.

    The shingles of all sets are put in one order: those of a single component first, as no pair looked for shares them,
    then the rarer ones. Similar enough sets of n >= m shingles share (n + m) * percent / (100 + percent) or more, so the
    first one that they share has at least that many, itself included, from its place on in either set. The smaller set
    needs to be indexed by its first m - 2 * m * percent / (100 + percent) shingles only, and the larger one to look up
    its first n - n * percent / 100. Sets whose own shingles fill these places, as those of texts with one passage in
    common do, meet nowhere.
    """
    own = ["rep", "version"]
    texts = semi_by_id(docs.select("doc_id", "text"), placed.select(F.col("rep").alias("doc_id")), "doc_id")
    texts = texts.select(F.col("doc_id").alias("rep"), F.xxhash64("text").alias("version"), "text")
    grams = materialize(shingle_rows(texts, shingle).join(placed, "rep"), "grams")
    held = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("holders"), F.min("component").alias("low"), F.max("component").alias("high"))
    shared = grams.join(held.filter("low < high").select("gram", "holders"), "gram")
    place = F.col("n") - F.count(F.lit(1)).over(W.partitionBy(*own)) + F.row_number().over(W.partitionBy(*own).orderBy("holders", "gram")) - 1
    first = materialize(shared.withColumn("left", F.col("n") - place).filter(F.col("left") * 100 >= F.col("n") * percent).select("gram", "rep", "n", "left", "component"), "prefixes")
    enough = lambda left, sizes: left * (100 + percent) >= sizes * percent
    index = first.filter(enough(F.col("left"), F.col("n") * 2)).select("gram", *(F.col(c).alias(f"of_{c}") for c in ("rep", "n", "left", "component")))
    possible: Column = (F.col("of_n") <= F.col("n")) & (F.col("component") != F.col("of_component")) & (F.col("of_n") * 100 >= F.col("n") * percent)
    rows = first.join(index, "gram").filter(possible & enough(F.least("left", "of_left"), F.col("n") + F.col("of_n")))
    return rows.select(F.least("rep", "of_rep").alias("a"), F.greatest("rep", "of_rep").alias("b")).distinct()


def near_links(nodes: DataFrame, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Confirmed links (a, b) that hold similar nodes together; nodes: rep, n_shingles, bands (a row for each set of a rep)."""
    names = nodes.select(F.explode("bands").alias("bucket"), "rep", "n_shingles")
    sizes = names.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = materialize(names.join(sizes, "bucket"), "buckets")
    company = buckets.groupBy("rep").agg(F.sum("members").alias("company"))
    buckets = materialize(buckets.join(company, "rep").select("bucket", "rep", "n_shingles", "company"), "buckets")
    centres = buckets.groupBy("bucket").agg(F.max(F.struct("company", (-F.col("rep")).alias("least"), "n_shingles")).alias("c"))
    stars = buckets.join(centres.select("bucket", (-F.col("c.least")).alias("centre"), F.col("c.n_shingles").alias("centre_n")), "bucket").filter("rep <> centre")
    stars = stars.filter(F.least("n_shingles", "centre_n") * 100 >= F.greatest("n_shingles", "centre_n") * percent)
    pairs = materialize(stars.select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct(), "pairs")
    linked = materialize(confirmed(pairs, docs, shingle, percent), "confirmed")

    # Members of buckets that still hold several components: what links them across components, by an exact join.
    roots = components(linked.select(F.col("a").alias("u"), F.col("b").alias("v")))
    placed = materialize(buckets.select("bucket", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep")), "placed")
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    left = materialize(placed.join(mixed.select("bucket"), "bucket", "left_semi").select("rep", "component").distinct(), "left-over")
    return linked.union(confirmed(materialize(crossing_pairs(left, docs, shingle, percent), "pairs"), docs, shingle, percent))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id, kept.

    A text that is null or has no words has 0 shingles and is linked with nothing: its component is its own doc_id.
    A row with a null doc_id is in no component (component_id and kept are null). Rows that repeat a doc_id are one
    document: their texts are in one component, and n_shingles is each row's own. Other columns are ignored. An empty
    table gives no rows.
    """
    of_set = ["set_a", "set_b", "n_shingles"]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialize(signatures(docs, shingle), "signatures")
    named = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = materialize(named.groupBy(*of_set).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes")
    repeated = materialize(named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc_id"), "repeated-ids")
    again = not repeated.isEmpty()
    if again:
        texts = texts.withColumn("_version", F.xxhash64("text")).dropDuplicates(["doc_id", "_version"]).drop("_version")
    links = near_links(classes.select("rep", "n_shingles", "bands"), texts, shingle, percent).select(F.col("a").alias("u"), F.col("b").alias("v"))
    if again:  # a document with several texts holds their classes together
        own = named.join(repeated, "doc_id", "left_semi").join(classes.drop("bands"), of_set).select("doc_id", "rep")
        links = links.union(own.join(own.groupBy("doc_id").agg(F.min("rep").alias("least")), "doc_id").select("rep", "least"))
    roots = components(links)
    ends = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(*of_set, F.coalesce("component", "rep").alias("of_set"))
    out = signed.drop("bands").join(ends, of_set, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("of_set", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """docs without the documents that a near-duplicate with a smaller doc_id stands for; rows with a null doc_id stay."""
    gone = near_duplicates(docs, **options).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op10_near_dedup": op10_near_dedup}
ORACLE: dict[str, str] = {}
