"""Removal of repeated byte strings by suffix arrays, built by two-stage sorting.

The stretches of text that could repeat (see cuts) are dealt into memory-sized groups. In each, only the suffixes that
are smaller than their successors are sorted directly; the others follow by scanning the array bucket by bucket, each
suffix placing the one before it. Common prefixes of neighbours of `length` bytes or more are repeats.

Equal stretches are sorted once, and their places in the array count as often as they occur.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laddermill.llm import cuts
from laddermill.llm.common import materialize, table

LENGTH, GRAM, GROUP_BYTES = 200, 16, 3 << 20


def eights(text: np.ndarray, room: int) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number; zeros follow the text, `room` places of them too."""
    padded = np.concatenate((text, np.zeros(room + 8, np.uint8)))
    out = np.zeros(len(text) + room, np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j : j + len(out)]
    return out


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one counts as smaller."""
    change = np.flatnonzero(text[1:] != text[:-1])
    rises = np.append(text[change + 1] > text[change], True)
    return np.repeat(rises, np.diff(np.concatenate(([-1], change, [len(text) - 1]))))


def agree(blocks: np.ndarray, a: np.ndarray, b: np.ndarray, depth: np.ndarray | int, most: int) -> np.ndarray:
    """Bytes, in eights, in which the places a and b agree, from what is known to agree up to `most`."""
    common = np.broadcast_to(np.asarray(depth, np.int64), a.shape).copy()
    alive = np.flatnonzero(common < most)
    while len(alive):
        same = blocks[a[alive] + common[alive]] == blocks[b[alive] + common[alive]]
        alive = alive[same]
        common[alive] += 8
        alive = alive[common[alive] < most]
    return common


def agree_all(blocks: np.ndarray, rows: np.ndarray, size: np.ndarray, depth: np.ndarray, most: int) -> np.ndarray:
    """Bytes, in eights, in which all the places of a group agree: rows holds groups of `size`, each known to `depth`."""
    depth, active = depth.copy(), np.arange(len(size))
    while len(active):
        own = size[active]
        head = np.cumsum(own) - own
        same = blocks[rows + np.repeat(depth[active], own)]
        every = np.logical_and.reduceat(same == np.repeat(same[head], own), head)
        depth[active[every]] += 8
        further = every & (depth[active] < most)
        rows, active = rows[np.repeat(further, own)], active[further]
    return depth


def sorted_within(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The order by group, then key: keys become ranks first, as numpy sorts plain integers fastest."""
    order = np.argsort(key)
    ranked = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(np.concatenate(([False], ranked[1:] != ranked[:-1])))
    return np.argsort((group << np.int64(32)) + rank)


def sorted_directly(blocks: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """The places by the text from them on, compared up to `most` bytes.

    A group of places that agree is skipped as far as all its members agree, and split there.
    """
    order = places[np.argsort(blocks[places])]
    key = blocks[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    at, depth = np.arange(len(order)), np.full(len(order), 8)
    while True:
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(at)))
        split = (size > 1) & (depth[head] < most)
        if not split.any():
            return order
        keep = np.repeat(split, size)
        at, size, depth = at[keep], size[split], depth[head][split]
        depth = agree_all(blocks, order[at], size, depth, most)
        open_ = depth < most
        if not open_.any():
            return order
        at, size, depth = at[np.repeat(open_, size)], size[open_], depth[open_]
        rows, depth = order[at], np.repeat(depth, size)
        group = np.repeat(np.arange(len(size)), size)
        key = blocks[rows + depth]
        by = sorted_within(group, key)
        order[at], key = rows[by], key[by]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])))
        depth = depth + 8


def reached(small: np.ndarray, first: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether each suffix starts one of `windows` windows from `first` on, or follows their last up to a smaller one.

    A suffix that is larger than its successor is placed by it, so these suffixes are all that the windows' order needs.
    """
    smaller = np.flatnonzero(small)
    last = smaller[np.searchsorted(smaller, first + windows - 1)]
    step = np.zeros(len(small) + 1, np.int8)
    step[first] = 1
    step[last + 1] -= 1
    return np.cumsum(step[:-1], dtype=np.int8) > 0


def two_stage(text: np.ndarray, blocks: np.ndarray, most: int, small: np.ndarray | None = None, needed: np.ndarray | None = None) -> np.ndarray:
    """The suffix array of text, or of its `needed` suffixes, in the order of the suffixes' first `most` bytes."""
    small = smaller_than_next(text) if small is None else small
    needed = np.ones(len(text), bool) if needed is None else needed
    direct = sorted_directly(blocks, np.flatnonzero(small & needed), most)
    large = needed & ~small
    sizes = np.bincount(text[needed], minlength=256)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    array = np.full(int(sizes.sum()), -1, np.int64)
    direct_sizes = np.bincount(text[direct], minlength=256)
    within = np.arange(len(direct)) - np.repeat(np.cumsum(direct_sizes) - direct_sizes, direct_sizes)
    array[np.repeat(ends - direct_sizes, direct_sizes) + within] = direct
    free = begins.copy()
    for c in np.flatnonzero(sizes).tolist():
        low, high, done = begins[c], free[c], []
        while high > low:  # suffixes of a run of one letter place each other inside the bucket
            done.append(array[low:high])
            before = array[low:high] - 1
            before = before[before >= 0]
            before = before[(text[before] == c) & large[before]]
            array[high : high + len(before)] = before
            low, high = high, high + len(before)
        scan = np.concatenate([*done, array[ends[c] - direct_sizes[c] : ends[c]]]) - 1
        scan = scan[scan >= 0]
        letters = text[scan]
        larger = (letters > c) & large[scan]
        scan, letters = scan[larger], letters[larger]
        by = np.argsort(letters, kind="stable")
        counts = np.bincount(letters, minlength=256)
        array[np.arange(len(by)) + np.repeat(free - (np.cumsum(counts) - counts), counts)] = scan[by]
        free += counts
    return array


def occurs_again(length: int):
    """For each window of a group's stretches: do the same bytes occur again, in the group or by its stretch's repetition?"""

    def solve(bodies: list[bytes], windows: np.ndarray, seen: np.ndarray, doc_ids: np.ndarray, versions: np.ndarray, starts: np.ndarray) -> np.ndarray:
        text = np.frombuffer(b"\0".join([*bodies, b""]), np.uint8)
        most = -(-length // 8) * 8
        blocks = eights(text, most)
        first = np.cumsum([0, *(len(b) + 1 for b in bodies)])[:-1]
        wanted = np.repeat(first, windows) + np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        number = np.full(len(text), -1, np.int64)
        number[wanted] = np.arange(len(wanted))
        small = smaller_than_next(text)
        array = two_stage(text, blocks, most, small, reached(small, first, windows))
        array = array[number[array] >= 0]
        common = agree(blocks, array[:-1], array[1:], 0, length // 8 * 8)
        full = common >= length // 8 * 8
        if length % 8:
            rest = np.uint64(64 - 8 * (length % 8))
            full &= blocks[array[:-1] + length // 8 * 8] >> rest == blocks[array[1:] + length // 8 * 8] >> rest
        again = np.zeros(len(array), bool)
        again[:-1] |= full
        again[1:] |= full
        marks = np.empty(len(wanted), bool)
        marks[number[array]] = again
        return marks | np.repeat(seen > 1, windows)  # places that stand for several

    return solve


def repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_bytes: int = GROUP_BYTES, hot: int = cuts.HOT_ANCHOR) -> DataFrame:
    """Runs of windows that repeat: doc_id, version, start, windows, marks (which of them occur elsewhere; null: all).

    docs: a row for each document (doc_id, version, text), read as UTF-8 bytes. gram is a power of two.
    """
    found = cuts.repeated_runs(docs, length, gram, of_bytes=True)
    every = materialize(cuts.stretches(found), "stretches")
    per_anchor = every.groupBy("anchor").agg((F.count(F.lit(1)) > hot).alias("hot"))
    cut = materialize(cuts.bodies(every.join(per_anchor, "anchor"), docs, length, of_bytes=True), "bodies")
    again = cuts.marked_one_by_one(cut, lambda first, n, own: n > 1)
    marks = materialize(cuts.marked(cut, occurs_again(length), group_bytes).union(again).filter("contains(marks, '1')"), "marks")
    whole = F.when(F.contains("marks", F.lit("0")), F.col("marks")).alias("marks")
    return found.join(marks.select("anchor", "stretch", whole), ["anchor", "stretch"]).select(*cuts.DOC, "start", "windows", "marks")


def digest(data: np.ndarray, borders: np.ndarray, gone: np.ndarray, starts: None, ends: None) -> dict[str, pa.Array]:
    lost = np.append(0, np.cumsum(gone))
    begin = gone & ~np.append(False, gone[:-1])
    inner = borders[:-1][borders[:-1] < len(gone)]
    begin[inner] = gone[inner]
    spans = np.append(0, np.cumsum(begin))
    sums = [hashlib.sha256(t).hexdigest() for t in kept_bytes(data, borders, gone)]
    return {"n_bytes": pa.array(np.diff(borders), pa.int64()), "n_removed": pa.array(np.diff(lost[borders]), pa.int64()), "n_spans": pa.array(np.diff(spans[borders]), pa.int64()), "kept_sha256": pa.array(sums, pa.string())}


def kept_bytes(data: np.ndarray, borders: np.ndarray, gone: np.ndarray, starts: None = None, ends: None = None) -> list[bytes]:
    left = data[~gone].tobytes()
    at = np.append(0, np.cumsum(~gone))[borders].tolist()
    return [left[i:j] for i, j in zip(at, at[1:], strict=False)]


def without_repeated_bytes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, text: what is left, with U+FFFD where a removed string cut a character in two. Null texts become empty."""
    rows, once = cuts.versioned(docs)
    text = lambda *chunk: {"text": pa.array([t.decode("utf-8", "replace") for t in kept_bytes(*chunk)], pa.string())}
    return cuts.covered(rows, repeated_bytes(once, **options), options.get("length", LENGTH), True, "text string", text)


def suffix_dedup(docs: DataFrame, **options) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text counts as empty. A row with a null doc_id is kept whole and repeats nothing. Rows that repeat a doc_id and
    its text are one document and get the same result; other texts with the doc_id are documents of their own. Other
    columns are ignored. An empty table gives no rows.
    """
    rows, once = cuts.versioned(docs)
    return cuts.covered(rows, repeated_bytes(once, **options), options.get("length", LENGTH), True, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", digest)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op2_suffix_dedup": op2_suffix_dedup}
ORACLE: dict[str, str] = {}
