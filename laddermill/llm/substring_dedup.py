"""Removal of repeated word sequences by prefix-partitioned suffix trees.

Suffixes are split into memory-sized groups by prefixes of variable length: a suffix's prefix reaches as far as the
anchor of its first `length` words (the gram of words with the least hash), and prefixes that end in one anchor share a
group, so the suffixes of a run travel as one stretch of text. Anchors that occur once end in leaves too shallow to
matter and are left out first; an anchor that is too frequent has its prefixes lengthened to the full depth. Each group
builds its subtree, cut off at that depth, from the sorted suffixes and their common prefixes; the leaves below a
deep internal node start with the same `length` words, and all but the earliest repeat it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laddermill.llm import cuts
from laddermill.llm import textcore as tc
from laddermill.llm.common import materialize, table

LENGTH, GRAM, GROUP_BYTES = 20, 4, 1 << 21


def subtree(codes: np.ndarray, suffixes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in lexicographic order, and the length of each one's common prefix with the one before, up to depth.

    The two describe the suffix tree of the group: an internal node of depth d is a maximal range in which all common
    prefixes but the first are d or more.
    """
    order = np.lexsort([codes[suffixes + d] for d in range(depth - 1, -1, -1)])
    ranked = suffixes[order]
    common = np.zeros(len(ranked), np.int64)
    alive = np.arange(1, len(ranked))
    for d in range(depth):
        alive = alive[codes[ranked[alive] + d] == codes[ranked[alive - 1] + d]]
        common[alive] = d + 1
    return order, common


def earlier_elsewhere(length: int):
    """For each window of a group's stretches: does its word sequence start anywhere before the stretch's first place?"""

    def solve(bodies: list[bytes], windows: np.ndarray, seen: np.ndarray, doc_ids: np.ndarray, versions: np.ndarray, starts: np.ndarray) -> np.ndarray:
        column = pa.array(bodies, pa.binary()).cast(pa.string())
        words, firsts, at = [], [], 0
        for chunk in tc.chunks(column):
            s, e, borders = tc.word_bounds(chunk)
            words.append(tc.word_hashes(chunk, s, e))
            firsts.append(borders[:-1] + at)
            at += len(s)
        codes = np.unique(np.concatenate(words), return_inverse=True)[1].astype(np.int32)
        inside = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        order, common = subtree(codes, np.repeat(np.concatenate(firsts), windows) + inside, length)
        place = np.empty(len(order), np.int64)
        place[np.lexsort([np.repeat(starts, windows) + inside, np.repeat(versions, windows), np.repeat(doc_ids, windows)])] = np.arange(len(order))
        nodes = np.flatnonzero(common < length)
        least = np.repeat(np.minimum.reduceat(place[order], nodes), np.diff(np.append(nodes, len(order))))
        marks = np.empty(len(order), bool)
        marks[order] = place[order] != least
        return marks

    return solve


def repeated_words(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_bytes: int = GROUP_BYTES, hot: int = cuts.HOT_ANCHOR) -> DataFrame:
    """Runs of windows that repeat: doc_id, version, start, windows, marks (which start earlier elsewhere; null: all).

    docs: a row for each document (doc_id, version, text). Earlier is a smaller (doc_id, version), or the same document
    and an earlier word.
    """
    found = cuts.repeated_runs(docs, length, gram, of_bytes=False)
    every = materialize(cuts.stretches(found), "stretches")
    # a stretch that has its anchor to itself is one leaf: its later occurrences repeat it, and nothing else decides
    per_anchor = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("anchor", (F.col("k") > hot).alias("hot"))
    cut = materialize(cuts.bodies(every.join(per_anchor, "anchor"), docs, length, of_bytes=False), "bodies")
    earlier = cuts.marked_one_by_one(cut, lambda first, n, own: first < own)
    marks = materialize(cuts.marked(cut, earlier_elsewhere(length), group_bytes).union(earlier).filter("contains(marks, '1')"), "marks")
    first = every.select("anchor", "stretch", F.struct(*cuts.DOC, "start").alias("first")).join(marks, ["anchor", "stretch"], "left")
    at_first = F.struct(*cuts.DOC, "start") == F.col("first")
    runs = found.join(first, ["anchor", "stretch"]).filter(~at_first | F.col("marks").isNotNull())
    return runs.select(*cuts.DOC, "start", "windows", F.when(at_first, F.col("marks")).alias("marks"))


def digest(data: np.ndarray, borders: np.ndarray, gone: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[str, pa.Array]:
    texts = kept_words(data, borders, gone, starts, ends)
    lost = np.append(0, np.cumsum(gone))
    return {"n_words": pa.array(np.diff(borders), pa.int64()), "n_removed": pa.array(np.diff(lost[borders]), pa.int64()), "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())}


def kept_words(data: np.ndarray, borders: np.ndarray, gone: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The kept words of each document, joined by single spaces."""
    left = np.flatnonzero(~gone)
    sizes = ends[left] - starts[left] + 1
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts[left], sizes)
    out = np.append(data, np.uint8(0x20))[place]
    out[np.cumsum(sizes) - 1] = 0x20
    whole, at = out.tobytes(), np.append(0, np.cumsum(sizes))[np.searchsorted(left, borders)].tolist()
    return [whole[i : max(i, j - 1)] for i, j in zip(at, at[1:], strict=False)]


def without_repeated_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text: the words that are left, joined by single spaces. Null texts become empty."""
    rows, once = cuts.versioned(docs)
    text = lambda *chunk: {"text": pa.array([t.decode() for t in kept_words(*chunk)], pa.string())}
    return cuts.covered(rows, repeated_words(once, **options), options.get("length", LENGTH), False, "text string", text)


def substring_dedup(docs: DataFrame, **options) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_removed, kept_sha256.

    A null text has no words. A row with a null doc_id is kept whole and repeats nothing. Rows that repeat a doc_id and
    its text are one document and get the same result; other texts with the doc_id are documents of their own, ordered by
    a hash of the text. Other columns are ignored. An empty table gives no rows.
    """
    rows, once = cuts.versioned(docs)
    return cuts.covered(rows, repeated_words(once, **options), options.get("length", LENGTH), False, "n_words bigint, n_removed bigint, kept_sha256 string", digest)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op1_substring_dedup": op1_substring_dedup}
ORACLE: dict[str, str] = {}
